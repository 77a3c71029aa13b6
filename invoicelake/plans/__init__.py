"""Whole jobs, table writing, and the registered queries with their SQL counterparts."""

"""Incremental variant of the bronze layer."""

"""Evaluating a costly expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def evaluate_once(df: DataFrame, *keep: str, **columns: Column | str) -> DataFrame:
    """The columns `keep` of `df` and the new `columns` (SQL text or Column), computed once per row.

    A plain projection would be repeated in every filter that the optimizer pushes below it
    (a filter on a parsed record, the size check it adds under an explode). A one-row generator
    is not crossed by such filters, adds no shuffle and stays inside code generation.
    """
    record = F.struct(*(
        (F.expr(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()
    ))
    return df.select(*keep, F.inline(F.array(record)))

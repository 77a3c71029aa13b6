"""Silver layer: one row per invoice, one row per invoice line."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from invoicelake import contract


def silver_header(parsed: DataFrame, sections: tuple[str, ...] | None = None) -> DataFrame:
    """Parsed messages -> invoice rows; `sections` keeps the columns of some sections only."""
    columns = [f"data.{path} AS {name}" for path, name in contract.header_columns(sections)]
    return parsed.selectExpr(*columns, *contract.LINEAGE)


def silver_item(parsed: DataFrame) -> DataFrame:
    """Parsed messages -> invoice lines; an invoice without lines gives no row."""
    identity = [f"data.{name}" for name in ("chave_nfe", "source_file", "ingestion_ts")]
    return parsed.select(
        *identity, F.explode("data.itens").alias("item"), *contract.LINEAGE
    ).select(
        "chave_nfe", "source_file", "ingestion_ts",
        *(f"item.{name}" for name in contract.item_columns()),
        *contract.LINEAGE,
    )

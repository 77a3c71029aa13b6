"""Gold layer: totals per issuer, per recipient state and per product."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from invoicelake.functions.sums import exact_sum, merged_sum, partial_sum, sum_of

ISSUER = ("emit_documento", "emit_nome")
PRODUCT = ("codigo_produto", "descricao_produto")
TOP = 10


def per_issuer(header: DataFrame) -> DataFrame:
    return header.groupBy(*ISSUER).agg(
        F.count("*").alias("qtd_notas"),
        exact_sum("valor_nota").alias("valor_total_notas"),
        exact_sum("valor_produtos").alias("valor_total_produtos"),
        exact_sum("valor_total_tributos").alias("valor_total_tributos"),
    )


def taxes_per_issuer(header: DataFrame) -> DataFrame:
    return header.groupBy(*ISSUER).agg(
        exact_sum("valor_total_tributos").alias("total_tributos")
    )


def per_recipient_state(header: DataFrame) -> DataFrame:
    return header.groupBy("dest_uf").agg(
        F.count("*").alias("qtd_notas"),
        exact_sum("valor_nota").alias("valor_total_notas"),
    )


def per_product(items: DataFrame) -> DataFrame:
    """Value and quantity of every product, the common input of both rankings."""
    return items.groupBy(*PRODUCT).agg(
        exact_sum("valor_produto").alias("valor_total"),
        exact_sum("quantidade_comercial", places=4).alias("quantidade_total"),
    )


def top_products(products: DataFrame, total: str) -> DataFrame:
    """The ten products with the largest `total`; ties are settled by code and name."""
    return (
        products.select(*PRODUCT, total)
        .orderBy(F.desc_nulls_last(total), *PRODUCT)
        .limit(TOP)
    )


def top_products_by_value(items: DataFrame) -> DataFrame:
    return top_products(per_product(items), "valor_total")


def top_products_by_quantity(items: DataFrame) -> DataFrame:
    return top_products(per_product(items), "quantidade_total")


@dataclass(frozen=True)
class Totals:
    """A gold aggregation whose state can be kept and merged: keys, row count, and exact sums."""

    keys: tuple[str, ...]
    sums: tuple[tuple[str, str, int], ...]  # (result, summed column, decimal places)
    count: str | None = None

    def partial(self, rows: DataFrame) -> DataFrame:
        """The state of some silver rows: keys, count and a struct for each sum."""
        counts = [F.count("*").alias(self.count)] if self.count else []
        return rows.groupBy(*self.keys).agg(
            *counts, *(partial_sum(column, places).alias(name) for name, column, places in self.sums))

    def merged(self, states: DataFrame) -> DataFrame:
        """One state for each key from the states of several sets of rows."""
        counts = [F.sum(self.count).alias(self.count)] if self.count else []
        return states.groupBy(*self.keys).agg(
            *counts, *(merged_sum(name).alias(name) for name, _, _ in self.sums))

    def finished(self, state: DataFrame) -> DataFrame:
        """The gold rows that the merged state stands for."""
        counts = [self.count] if self.count else []
        return state.select(
            *self.keys, *counts, *(sum_of(name, places).alias(name) for name, _, places in self.sums))


ISSUER_TOTALS = Totals(ISSUER, (
    ("valor_total_notas", "valor_nota", 2),
    ("valor_total_produtos", "valor_produtos", 2),
    ("valor_total_tributos", "valor_total_tributos", 2),
), "qtd_notas")
STATE_TOTALS = Totals(("dest_uf",), (("valor_total_notas", "valor_nota", 2),), "qtd_notas")
PRODUCT_TOTALS = Totals(PRODUCT, (
    ("valor_total", "valor_produto", 2),
    ("quantidade_total", "quantidade_comercial", 4),
))

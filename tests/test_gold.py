"""Aggregates, rankings and exact sums against plain Python."""

import math
import random
from collections import defaultdict
from decimal import Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from invoicelake.functions.sums import exact_sum
from invoicelake.operators import gold

HEADER = "emit_documento string, emit_nome string, dest_uf string, valor_nota double, valor_produtos double, valor_total_tributos double"
ITEM = "codigo_produto string, descricao_produto string, valor_produto double, quantidade_comercial double"


def total(values):
    values = [v for v in values if v is not None]
    return float(sum(Decimal(repr(v)) for v in values)) if values else None


def test_totals_per_group(spark):
    rng = random.Random(7)
    # One issuer holds a third of all rows; null keys form their own group.
    rows = [
        (None if rng.random() < 0.1 else "hot" if rng.random() < 0.33 else str(rng.randrange(20)),
         rng.choice(["A", None]), rng.choice(["SP", "RJ", None]),
         *(None if rng.random() < 0.1 else round(rng.uniform(-50, 9e6), 2) for _ in range(3)))
        for _ in range(3000)
    ]
    header = spark.createDataFrame(rows, HEADER).repartition(7)
    issuers, states = defaultdict(list), defaultdict(list)
    for r in rows:
        issuers[r[:2]].append(r)
        states[r[2]].append(r)
    assert {tuple(r)[:2]: tuple(r)[2:] for r in gold.per_issuer(header).collect()} == {
        k: (len(v), *(total(r[i] for r in v) for i in (3, 4, 5))) for k, v in issuers.items()
    }
    assert {tuple(r)[:2]: r.total_tributos for r in gold.taxes_per_issuer(header).collect()} == {
        k: total(r[5] for r in v) for k, v in issuers.items()
    }
    assert {r.dest_uf: tuple(r)[1:] for r in gold.per_recipient_state(header).collect()} == {
        k: (len(v), total(r[3] for r in v)) for k, v in states.items()
    }


def test_rankings(spark):
    rng = random.Random(8)
    rows = [
        (str(rng.randrange(25)), rng.choice("xy"), round(rng.uniform(0, 9), 2), float(rng.randrange(3)))
        for _ in range(400)
    ] + [(None, None, None, None), ("n", "only nulls", None, None)]
    items = spark.createDataFrame(rows, ITEM).repartition(5)
    for column, ranking, name in (
        (2, gold.top_products_by_value, "valor_total"), (3, gold.top_products_by_quantity, "quantidade_total"),
    ):
        groups = defaultdict(list)
        for r in rows:
            groups[r[:2]].append(r[column])
        totals = [(k, total(v)) for k, v in groups.items()]
        expected = sorted(
            totals, key=lambda t: (t[1] is None, -(t[1] or 0), t[0][0] or "", t[0][1] or "")
        )[:10]
        got = ranking(items)
        assert got.columns == ["codigo_produto", "descricao_produto", name]
        assert [((r[0], r[1]), r[2]) for r in got.collect()] == expected


def test_ranking_keeps_totals_of_nulls_last(spark):
    items = spark.createDataFrame([("a", "a", None, None), ("b", "b", -1.0, 1.0)], ITEM)
    assert [r.codigo_produto for r in gold.top_products_by_value(items).collect()] == ["b", "a"]


def test_exact_sum_of_odd_values(spark):
    inf, nan = math.inf, math.nan
    groups = {
        "tenths": [0.1, 0.2, None], "nulls": [None], "nan": [nan, 1.0], "inf": [inf, 1.0],
        "huge": [1e300, 1.0], "thousandths": [1.005, 0.1], "big": [9e15, 0.01, 0.01], "minus": [-5.55, 5.55],
        "many": [9e13] * 1100,
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, x double").repartition(4)
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    assert math.isnan(got.pop("nan"))
    assert got == {
        "tenths": 0.3, "nulls": None, "inf": inf, "huge": 1e300, "thousandths": 1.105,
        "big": float(Decimal("9000000000000000.02")), "minus": 0.0, "many": 9.9e16,
    }


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e12, 1e12).map(lambda x: round(x, 2)), min_size=1, max_size=60))
def test_exact_sum_ignores_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    assert df.agg(exact_sum("x").alias("s")).first().s == total(values)
    assert df.agg(exact_sum("x", places=4).alias("s")).first().s == total(values)


def test_no_rows(spark):
    header = spark.createDataFrame([], HEADER)
    assert gold.per_issuer(header).count() == 0
    assert header.agg(exact_sum("valor_nota").alias("s"), F.count("*").alias("n")).first() == (None, 0)

"""The registered text queries against DuckDB, and the pipeline's stages, on the given tables."""

from __future__ import annotations

import os

import duckdb
import pytest

pytest.importorskip("invoicelake.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from invoicelake.llm import oracles, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = queries.queries()[name](spark, SF_DIR).toArrow()
    con.register("got", got)
    columns = ", ".join(sorted(got.schema.names))
    con.sql(f"CREATE TEMP TABLE want AS {oracles.oracle_sql()[name]}")
    for a, b in (("got", "want"), ("want", "got")):
        assert con.sql(f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b}").fetchall() == []


def test_items_without_id_contaminate(spark, tmp_path):
    passage = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame(
        [(None, passage), (1, "tiny"), (2, None), (None, None)], "item_id bigint, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(
        [(1, f"so {passage} so"), (2, "a tiny one"), (3, passage[4:]), (4, None), (None, passage)],
        "doc_id bigint, text string")
    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.toArrow())
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert len(last) == counts[-1]
    sizes = [sum(r.shard == s for r in last) for s in range(corpus_pipeline.SHARDS)]
    assert max(sizes) - min(sizes) <= 1

"""What the optimizer makes of the operators: one parse per record, narrow scans, no cross joins."""

import os
import re

import pytest
from pyspark.sql import functions as F

from invoicelake.plans import queries as registered
from conftest import invoice
from invoicelake import contract
from invoicelake.operators import gold
from invoicelake.operators.messages import parse_messages
from invoicelake.operators.silver import silver_header, silver_item
from invoicelake.operators.xml_parse import good_documents, parse_invoices

READING_XML = (
    "source_limit", "xml_parse_header", "xml_parse_items", "xml_document_id", "xml_access_key",
    "xml_quarantine", "ingest_summary",
)
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def wide(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", str(2**30))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    yield
    spark.conf.unset("spark.sql.maxPlanStringLength")
    spark.conf.unset("spark.sql.debug.maxToStringFields")


@pytest.fixture
def bronze(spark, tmp_path):
    path = str(tmp_path / "bronze")
    spark.sql("""
        SELECT 't' AS topic, 0 AS partition, 0L AS offset, current_timestamp() AS kafka_timestamp,
               'k' AS message_key, '{"chave_nfe":"1","itens":[{"n_item":1}]}' AS payload_json,
               current_timestamp() AS processed_at""").write.parquet(path)
    return spark.read.parquet(path)


def test_json_is_parsed_once(wide, bronze):
    items = silver_item(parse_messages(bronze, ("itens",))).where("valor_produto > 1 OR n_item = 1")
    header = silver_header(parse_messages(bronze)).where("dest_uf = 'SP' AND valor_nota > 1")
    for df in (items, header):
        assert optimized(df).count("from_json(") == 1
    assert items.count() == 1


def test_bronze_scan_reads_only_what_silver_needs(wide, bronze):
    df = silver_item(parse_messages(bronze, ("itens",))).select("codigo_produto", "valor_produto")
    assert "ReadSchema: struct<payload_json:string>" in physical(df)


def test_xml_is_parsed_once(spark, wide):
    files = spark.createDataFrame([("a.xml", invoice().encode())], "path string, content binary")
    documents = good_documents(parse_invoices(files.repartition(1)))
    df = documents.select(F.explode("document.itens").alias("i")).where("i.valor_produto > 1")
    plan = optimized(df)
    assert plan.count("from_xml(") == 1
    assert plan.count("transform(") == 2
    assert "PythonUDF" not in plan


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_only_lines_of_oversized_orders_are_numbered(spark, wide):
    """The others are not sorted by place and are shuffled once, with the lines of their invoice."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(registered.q_xml_parse_items(spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("Window")[0]
    assert "LeftAnti" in lines and plan.count("Window [row_number()") == 1
    shuffled = re.findall(r"Exchange hashpartitioning\((l_partkey|l_orderkey)#\d+L?, (\d+|invoice#\d+L?)", plan)
    assert [key for key, other in shuffled if other.startswith("invoice")] == ["l_orderkey"]


def test_gold_scans_are_narrow_and_combined_before_the_shuffle(spark, wide, tmp_path):
    schema = ", ".join(
        [f"{name} {'double' if name.startswith('valor') else 'string'}" for _, name in contract.header_columns()]
    )
    path = str(tmp_path / "header")
    spark.createDataFrame([], schema).write.parquet(path)
    plan = physical(gold.per_recipient_state(spark.read.schema(schema).parquet(path)))
    assert "ReadSchema: struct<dest_uf:string,valor_nota:double>" in plan
    assert "partial_count(1)" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan


def test_ranking_needs_no_full_sort(spark):
    items = spark.createDataFrame(
        [("a", "b", 1.0, 2.0)], "codigo_produto string, descricao_produto string, valor_produto double, quantidade_comercial double"
    )
    plan = physical(gold.top_products_by_value(items))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan
    assert "sum(quantidade_comercial" not in plan


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registered.queries()))
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_no_query_plans_a_cross_join_or_single_partition(spark, name, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = physical(registered.queries()[name](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Files in unusual forms are rewritten in Python workers, in one pass; nothing else is done there.
    assert plan.count("ArrowEvalPython") == (name in READING_XML)
    plan = re.sub("ArrowEvalPython.*", "", plan)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|LocalTableScan|BatchEvalPython", plan)
    if name != "layer_row_counts":  # a total over everything: one row from each task
        assert "SinglePartition" not in plan

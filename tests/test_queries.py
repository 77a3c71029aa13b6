"""Every registered query against its SQL over the same tables, as given and heavily skewed."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from invoicelake.plans import oracles, queries as registered
from invoicelake.sources import star_schema

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")

needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def database(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def assert_same(df, con, sql):
    columns = sorted(df.columns)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(repr(tuple(row[i] for i in order)) for row in cursor.fetchall())
    got = sorted(repr(tuple(row)) for row in df.select(*columns).collect())
    assert len(got) == len(expected)
    assert got == expected


@needs_tables
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(registered.queries()) == set(oracles.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, name):
    assert_same(registered.queries()[name](spark, SF_DIR), database(SF_DIR), oracles.oracle_sql()[name])


@needs_tables
@pytest.mark.parametrize("name", ["xml_parse_header", "xml_quarantine", "json_parse_malformed", "layer_row_counts"])
def test_query_under_other_settings(spark, name):
    changed = {"spark.sql.ansi.enabled": "false", "spark.sql.session.timeZone": "America/Sao_Paulo"}
    before = {key: spark.conf.get(key) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        assert_same(registered.queries()[name](spark, SF_DIR), database(SF_DIR), oracles.oracle_sql()[name])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The tables with a third of all lines on one order, a third of orders on one customer, and
    many copies of one line and of two orders, one of them with many lines."""
    folder = tmp_path_factory.mktemp("skewed")
    con = database(SF_DIR)
    hot = "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_orderkey END"
    con.execute(f"""COPY (
        SELECT * REPLACE ({hot} AS l_orderkey) FROM lineitem
        UNION ALL SELECT * REPLACE (987654321 AS l_partkey) FROM lineitem WHERE l_orderkey = 10
        UNION ALL SELECT * REPLACE (11 AS l_orderkey, -1.05 AS l_extendedprice, 0.5 AS l_tax) FROM lineitem WHERE l_orderkey = 10
        UNION ALL SELECT line.* REPLACE (2 AS l_orderkey) FROM (SELECT * FROM lineitem LIMIT 1) line, range(1500)
    ) TO '{folder}/lineitem.parquet' (FORMAT parquet)""")
    con.execute(f"""COPY (
        SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey) FROM orders
        UNION ALL SELECT o.* FROM (SELECT * FROM orders WHERE o_orderkey = 5) o, range(700)
        UNION ALL SELECT o.* FROM (SELECT * FROM orders WHERE o_orderkey = 2) o, range(3)
        UNION ALL SELECT * REPLACE (CAST(NULL AS BIGINT) AS o_custkey) FROM orders WHERE o_orderkey = 9
    ) TO '{folder}/orders.parquet' (FORMAT parquet)""")
    for name in TABLES:
        if name not in ("lineitem", "orders"):
            con.execute(f"COPY {name} TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@needs_tables
@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_on_skewed_tables(spark, skewed, name):
    assert_same(registered.queries()[name](spark, skewed), database(skewed), oracles.oracle_sql()[name])


@needs_tables
def test_no_document_grows_with_its_order(spark, skewed):
    """Oversized orders are split by exact line numbers."""
    limit = 100
    docs = star_schema.order_documents(spark, skewed, ("itens",), lines_per_invoice=limit)
    sizes = docs.selectExpr("document.chave_nfe AS key", "size(document.itens) AS n").collect()
    assert max(r.n for r in sizes) == limit
    con = database(skewed)
    # Lines of unknown parts are invoice lines like any other.
    expected = con.execute("""
        SELECT CAST(o_orderkey AS VARCHAR), copies * n, copies * greatest(1, ceil(n / 100.0))
        FROM (SELECT o_orderkey, count(*) AS copies FROM orders GROUP BY o_orderkey)
        JOIN (SELECT o_orderkey, count(l_orderkey) AS n
              FROM (SELECT DISTINCT o_orderkey FROM orders)
              LEFT JOIN lineitem ON o_orderkey = l_orderkey
              GROUP BY o_orderkey) USING (o_orderkey)""").fetchall()
    lines, invoices = {}, {}
    for r in sizes:
        lines[r.key] = lines.get(r.key, 0) + r.n
        invoices[r.key] = invoices.get(r.key, 0) + 1
    assert lines == {key: n for key, n, _ in expected}
    assert invoices == {key: n for key, _, n in expected}


@needs_tables
@pytest.mark.parametrize("sections", [(), ("header",), ("totais",), ("emitente", "itens"), None])
def test_the_same_invoices_whatever_is_read(spark, skewed, sections):
    """Order 1 has 2,000 lines or so and order 2 has 1,500, in several copies."""
    docs = star_schema.order_documents(spark, skewed, sections)
    got = {r.source_file: r["count"] for r in docs.groupBy("source_file").count().collect()}
    want = database(skewed).execute("""
        SELECT 'nfe_' || o_orderkey || '.xml', CAST(sum(greatest(1, ceil(coalesce(n, 0) / 990.0))) AS BIGINT)
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
        GROUP BY 1""").fetchall()
    assert got == dict(want) and got["nfe_2.xml"] == 8


@needs_tables
def test_building_a_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for name, query in registered.queries().items():
            query(spark, SF_DIR)
        # Reading a Parquet schema is a job of one task; nothing else may run.
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
        assert all(s.numTasks == 1 for s in stages if s)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

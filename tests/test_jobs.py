"""Sources, sinks, jobs, tables, stream and command line on small invented files."""

import itertools
import os
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import invoice
from invoicelake import contract
from invoicelake.__main__ import arguments, main
from invoicelake.functions.sums import exact_sum
from invoicelake.operators.gold import Totals
from invoicelake.operators.xml_parse import parse_invoices
from invoicelake.plans import jobs, tables
from invoicelake.plans.tables import list_tables, overwrite_table, row_counts, staged
from invoicelake.plans.totals import updated_totals
from invoicelake.sources.messages import PUBLISH_OFFSETS, KafkaTopic, MessageLog
from invoicelake.sources.xml_files import limit_files, packed_small_files, underscored_files, xml_files
from invoicelake.streaming.bronze import update_layers

_names = itertools.count()
LINE = "<det nItem='1'><prod><cProd>P</cProd><xProd>p</xProd><qCom>2.0</qCom><vProd>1.10</vProd></prod></det>"
TOTAL = "<total><ICMSTot><vProd>2.20</vProd><vNF>2.20</vNF><vTotTrib>0.30</vTotTrib></ICMSTot></total>"


@pytest.fixture
def db(spark):
    name = f"db{next(_names)}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.fixture
def log(tmp_path):
    return MessageLog(str(tmp_path / "log"), f"topic{next(_names)}")


@pytest.fixture
def xml_dir(tmp_path):
    folder = tmp_path / "xml"
    write(folder / "a.xml", invoice(key="<chNFe>A</chNFe>", det=LINE * 2, total=TOTAL))
    write(folder / "sub dir" / "x 1.xml", invoice(key="<chNFe>X</chNFe>", det=LINE, total=TOTAL))
    write(folder / "sub dir" / "deeper" / "n[1].xml", invoice(key=None, id_="", total=TOTAL))
    write(folder / "broken.xml", "<a>")
    write(folder / "upper.XML", invoice())
    write(folder / ".hidden.xml", invoice())
    write(folder / "other.txt", invoice())
    return str(folder)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def names(files):
    return [os.path.basename(r.path) for r in files.select("path").orderBy("path").collect()]


def test_xml_files(spark, xml_dir):
    assert names(xml_files(spark, xml_dir)) == ["a.xml", "broken.xml", "n[1].xml", "x 1.xml"]


@pytest.mark.parametrize("limit", [None, 0, 1, 3, 9])
def test_limit(spark, xml_dir, limit):
    expected = ["a.xml", "broken.xml", "n[1].xml", "x 1.xml"][: limit or None]
    assert names(xml_files(spark, xml_dir, limit)) == expected
    assert names(limit_files(xml_files(spark, xml_dir), limit)) == expected


def test_limit_goes_by_path_and_not_by_its_encoded_form(spark, tmp_path):
    for name in ("a!.xml", "a b.xml", "a-.xml"):
        (tmp_path / name).write_text("<x/>")
    assert names(xml_files(spark, str(tmp_path), 1)) == ["a b.xml"]
    assert names(xml_files(spark, str(tmp_path), 2)) == ["a b.xml", "a!.xml"]


def test_limit_of_an_empty_folder(spark, tmp_path):
    assert xml_files(spark, str(tmp_path), 2).count() == 0


def test_limited_read_opens_only_the_wanted_files(spark, xml_dir):
    files = xml_files(spark, xml_dir, 2)
    assert len(files.collect()) == 2
    scan = files._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 2


def test_names_with_underscores_are_read(spark, xml_dir, tmp_path, log, db):
    for name in ("_a b.xml", "sub dir/_%41.xml", "_d/_e/x.xml", "_d/.h/x.xml", ".h/_x.xml", "_d/y=1.xml", "_k=1/z.xml",
                 "_n.txt"):
        write(tmp_path / "xml" / name, invoice(key=f"<chNFe>{name}</chNFe>"))
    write(tmp_path / "xml" / "_broken.xml", "<a>")
    found = xml_files(spark, xml_dir)
    every = sorted(["a.xml", "broken.xml", "sub dir/x 1.xml", "sub dir/deeper/n[1].xml", "_a b.xml", "sub dir/_%41.xml",
                    "_d/_e/x.xml", "_d/y=1.xml", "_k=1/z.xml", "_broken.xml"])
    assert [r.path for r in found.select("path").orderBy("path").collect()] == [f"file:{xml_dir}/{n}" for n in every]
    read = {r.path: bytes(r.content) for r in found.collect()}
    assert all(read[f"file:{xml_dir}/{n}"] == (tmp_path / "xml" / n).read_bytes() for n in every)
    for limit in (1, 3, 5, 7, 10, 99):
        assert sorted(r.path for r in xml_files(spark, xml_dir, limit).select("path").collect()) == [
            f"file:{xml_dir}/{n}" for n in every[:limit]]
    summary = jobs.publish(spark, xml_dir, log, db=db)
    assert (summary.published, summary.failed) == (8, 2)
    # One underscored file alone, in a folder with a pattern's characters in its name.
    write(tmp_path / "o[1]{a}" / "_only.xml", invoice())
    assert names(xml_files(spark, str(tmp_path / "o\\[1\\]\\{a\\}"))) == ["_only.xml"]


def test_files_that_workers_cannot_open_are_unreadable(spark):
    (row,) = underscored_files(spark, ["nowhere://x/_a.xml"]).collect()
    assert row.path == "nowhere://x/_a.xml" and row.content is None
    (row,) = parse_invoices(underscored_files(spark, ["file:/none/_a.xml"])).collect()
    assert row.error == "invalid_encoding" and row.document is None


def test_small_files_share_tasks(spark, tmp_path):
    for i in range(200):
        write(tmp_path / f"{i:03}.xml", invoice())
    key = "spark.sql.files.openCostInBytes"
    default = spark.conf.get(key)
    apart = xml_files(spark, str(tmp_path)).rdd.getNumPartitions()
    with packed_small_files(spark):
        packed = xml_files(spark, str(tmp_path)).rdd.getNumPartitions()
    assert packed <= spark.sparkContext.defaultParallelism + 1 < apart
    assert spark.conf.get(key) == default
    try:
        for own in ("1m", "4194304"):  # the default, if the user says so, is the user's setting, too
            spark.conf.set(key, own)
            with packed_small_files(spark):
                assert spark.conf.get(key) == own
    finally:
        spark.conf.unset(key)


def test_negative_limit(spark, xml_dir):
    with pytest.raises(ValueError):
        xml_files(spark, xml_dir, -1)


def test_pipeline(spark, xml_dir, log, db):
    summary, rows = jobs.run_pipeline(spark, xml_dir, log, db)
    assert (summary.published, summary.failed) == (3, 1)
    assert [(r.source_file, r.error) for r in summary.quarantine.collect()] == [("broken.xml", "malformed_xml")]
    assert rows == {
        "bronze_nfe_json": 3, "silver_nfe_header": 3, "silver_nfe_item": 3, "gold_nfe_por_emitente": 1,
        "gold_nfe_por_uf_destino": 1, "gold_top_produtos_valor": 1, "gold_top_produtos_quantidade": 1,
    }
    assert list_tables(spark, db) == sorted((*contract.LAYER_TABLES, contract.QUARANTINE))
    keys = {r.message_key for r in spark.table(f"{db}.bronze_nfe_json").collect()}
    assert keys == {"A", "X", "n[1].xml"}
    assert spark.table(f"{db}.gold_nfe_por_emitente").first() == (None, None, 3, 6.6, 6.6, 0.9)
    assert spark.table(f"{db}.gold_top_produtos_valor").first() == ("P", "p", 3.3)
    times = spark.sql(f"""
        SELECT DISTINCT processed_at FROM {db}.silver_nfe_header
        UNION SELECT processed_at FROM {db}.silver_nfe_item UNION SELECT processed_at FROM {db}.bronze_nfe_json""")
    assert times.count() == 1
    counts = row_counts(spark, db, contract.LAYER_TABLES).collect()
    assert {r.layer: r.row_count for r in counts} == rows

    # The layer job alone rewrites the same tables; a second publish doubles every figure.
    assert jobs.build_layers(spark, log, db) == rows
    jobs.publish(spark, xml_dir, log)
    assert jobs.build_layers(spark, log, db)["silver_nfe_item"] == 6
    assert spark.table(f"{db}.gold_nfe_por_emitente").first() == (None, None, 6, 13.2, 13.2, 1.8)

    jobs.build_analytics(spark, db)
    assert list_tables(spark, db) == sorted(
        (*contract.LAYER_TABLES, *contract.ANALYTICS_TABLES, contract.QUARANTINE))
    for analytics, layer in (
        ("analytics_01_emitente", "gold_nfe_por_emitente"), ("analytics_02_uf_destino", "gold_nfe_por_uf_destino"),
        ("analytics_03_top_produtos_valor", "gold_top_produtos_valor"),
        ("analytics_04_top_produtos_quantidade", "gold_top_produtos_quantidade"),
    ):
        a, b = spark.table(f"{db}.{analytics}"), spark.table(f"{db}.{layer}")
        assert (a.dtypes, a.collect()) == (b.dtypes, b.collect())
    taxes = spark.table(f"{db}.analytics_05_tributos_emitente")
    assert taxes.columns == ["emit_documento", "emit_nome", "total_tributos"]
    assert taxes.first() == (None, None, 1.8)


def test_messages_without_lines(spark, tmp_path, log, db):
    write(tmp_path / "in" / "a.xml", invoice())
    _, rows = jobs.run_pipeline(spark, str(tmp_path / "in"), log, db)
    assert (rows["silver_nfe_header"], rows["silver_nfe_item"], rows["gold_top_produtos_valor"]) == (1, 0, 0)


def test_empty_topic_touches_no_table(spark, xml_dir, log, db):
    assert jobs.build_layers(spark, log, db) == {}
    assert list_tables(spark, db) == []
    jobs.run_pipeline(spark, xml_dir, log, db)
    empty = MessageLog(log.path, "another topic")
    assert jobs.build_layers(spark, empty, db) == {}
    assert spark.table(f"{db}.bronze_nfe_json").count() == 3


def test_nothing_to_publish(spark, tmp_path, log):
    (tmp_path / "empty").mkdir()
    with pytest.raises(jobs.NothingToPublish):
        jobs.publish(spark, str(tmp_path / "empty"), log)
    write(tmp_path / "bad" / "a.xml", "x")
    with pytest.raises(jobs.NothingToPublish):
        jobs.publish(spark, str(tmp_path / "bad"), log)
    assert log.read(spark).isEmpty()


def test_message_log(spark, log):
    messages = spark.range(50).selectExpr("CAST(id % 7 AS STRING) AS key", "CAST(id AS STRING) AS value")
    for _ in range(2):
        log.write(messages.repartition(3))
    read = log.read(spark)
    assert read.dtypes == spark.createDataFrame([], contract.MESSAGE_LOG_SCHEMA).dtypes
    assert (read.count(), read.select("offset").distinct().count()) == (100, 100)
    assert MessageLog(log.path, "20240101").read(spark).isEmpty()
    assert read.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").isEmpty()
    first, second = [r.o for r in read.groupBy("timestamp").agg(F.max("offset").alias("o")).orderBy("timestamp").collect()]
    assert first < second


def test_topic_names_that_look_like_numbers(spark, log):
    numbered = MessageLog(log.path, "007")
    numbered.write(spark.sql("SELECT 'k' AS key, 'v' AS value"))
    log.write(spark.sql("SELECT 'k' AS key, 'w' AS value"))
    assert [(r.topic, bytes(r.value)) for r in numbered.read(spark).collect()] == [("007", b"v")]


def test_kafka_reads_a_bounded_batch_in_many_tasks(spark):
    assert KafkaTopic("t", "h:1").read_options(spark) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
        "minPartitions": "4",
    }
    assert KafkaTopic("t", "h:1", 64).read_options(spark)["minPartitions"] == "64"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        KafkaTopic("t").read(spark)


def test_staging_prefers_the_checkpoint_folder(spark):
    df = staged(spark.range(3), "numbers")
    assert df.count() == 3
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]


def test_overwrite_counts_rows(spark, db):
    spark.sql(f"CREATE DATABASE {db}")
    assert overwrite_table(spark.range(5), f"{db}.t") == 5
    assert overwrite_table(spark.range(0), f"{db}.t") == 0
    assert spark.table(f"{db}.t").count() == 0


def test_failed_write_leaves_the_table(spark, db):
    spark.sql(f"CREATE DATABASE {db}")
    name = f"{db}.t"
    overwrite_table(spark.range(5), name)
    reader = spark.table(name)
    failing = spark.range(0, 1000, 1, 8).selectExpr("if(id = 900, raise_error('no'), id) AS id")
    with pytest.raises(Exception, match="no"):
        overwrite_table(failing, name)
    assert spark.table(name).count() == 5
    # Whoever read the version before can go on; the one before that and the failed one are gone.
    assert overwrite_table(spark.range(7), name) == 7
    assert (reader.count(), spark.table(name).count()) == (5, 7)
    assert overwrite_table(spark.range(3), name) == 3
    folder = os.path.dirname(spark.table(name).inputFiles()[0].removeprefix("file://"))
    whole = [v for v in os.listdir(os.path.dirname(folder)) if not v.startswith(".")]
    assert len(whole) == 2 and os.path.basename(folder) == max(whole)
    # From the table itself, and with other columns.
    assert overwrite_table(spark.table(name).selectExpr("id + 1 AS id"), name) == 3
    assert overwrite_table(spark.sql("SELECT 'x' AS word"), name) == 1
    assert spark.table(name).collect() == [("x",)]


def test_quarantine_holds_every_bad_file(spark, tmp_path, log, db, capsys):
    for i in range(250):
        write(tmp_path / "in" / f"{i}.xml", "<a>" if i else "x")
    publish = ["publish", "--xml-dir", str(tmp_path / "in"), "--topic", "t", "--log-path", log.path, "--db", db]
    assert main(publish) == 1
    assert spark.table(f"{db}.{contract.QUARANTINE}").count() == 250
    write(tmp_path / "in" / "good.xml", invoice())
    assert main(publish) == 0
    out = capsys.readouterr().out
    assert f"the first 100 of 250 failures; all are in the table {db}.{contract.QUARANTINE}" in out
    bad = spark.table(f"{db}.{contract.QUARANTINE}")
    assert bad.columns == ["path", "source_file", "error"] and bad.count() == 250


def test_publishers_at_the_same_time_share_no_offset(spark, log):
    messages = spark.range(0, 1000, 1, 5).selectExpr("CAST(id AS STRING) AS key", "'v' AS value").where("id <> 300")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: MessageLog(log.path, log.topic).write(messages), range(4)))
    offsets = sorted(r.offset for r in log.read(spark).select("offset").collect())
    assert offsets == [k * PUBLISH_OFFSETS + i for k in range(4) for i in range(999)]


def test_log_without_claims_goes_on(spark, log):
    old = spark.createDataFrame([(log.topic, 0, 5, None, b"k", b"v")], contract.MESSAGE_LOG_SCHEMA)
    old.write.partitionBy("topic").parquet(log.path)
    log.write(spark.sql("SELECT 'k' AS key, 'w' AS value"))
    assert sorted(r.offset for r in log.read(spark).collect()) == [5, PUBLISH_OFFSETS]


def test_staging_refuses_a_folder_of_one_machine(monkeypatch):
    def session(master, **settings):
        conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.rsplit(".")[1], default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    monkeypatch.setattr(tables.files, "is_local", lambda *_: True)
    with pytest.raises(ValueError, match="shared folder"):
        tables.shared_folder(session("spark://host:1", sql="file:/warehouse"))
    assert tables.shared_folder(session("local[4]", sql="file:/warehouse")) == "file:/warehouse/_staging"
    assert tables.shared_folder(session("yarn", checkpoint="hdfs:/shared/")) == "hdfs:/shared"


def test_stream_takes_over_each_message_once(spark, xml_dir, log, db, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    jobs.publish(spark, xml_dir, log)
    assert update_layers(spark, log, db, checkpoint)["silver_nfe_item"] == 3
    assert update_layers(spark, log, db, checkpoint)["silver_nfe_item"] == 3
    jobs.publish(spark, xml_dir, log, limit=1)
    assert update_layers(spark, log, db, checkpoint)["silver_nfe_item"] == 5
    batch = jobs.build_layers(spark, log, db + "_batch")
    assert batch["silver_nfe_item"] == 5
    spark.sql(f"DROP DATABASE {db}_batch CASCADE")


GOLD = (contract.GOLD_EMITENTE, contract.GOLD_UF_DESTINO, contract.GOLD_TOP_VALOR, contract.GOLD_TOP_QUANTIDADE)


def test_stream_totals_equal_a_full_rebuild(spark, tmp_path, log, db):
    checkpoint = str(tmp_path / "checkpoint")
    for batch in range(3):
        folder = tmp_path / f"in{batch}"
        for i in range(6):
            emit = f"<emit><CNPJ>{i % 2}</CNPJ><xNome>e</xNome></emit>" if i else ""
            value = ["0.10", "0.20", "1e-5", "90071992547409.93", "", "-7"][(i + batch) % 6]
            line = LINE.replace("<cProd>P", f"<cProd>P{i % 4}").replace("1.10", value)
            write(folder / f"{i}.xml", invoice(
                key=f"<chNFe>{batch}{i}</chNFe>", emit=emit, det=line * i, total=TOTAL.replace("2.20", value or "0")))
        jobs.publish(spark, str(folder), log, db=db)
        rows = update_layers(spark, log, db, checkpoint)
        assert rows == {
            name: n for name, n in jobs.build_layers(spark, log, f"{db}_full").items() if name != contract.BRONZE}
        for table in GOLD:
            whole, kept = spark.table(f"{db}_full.{table}"), spark.table(f"{db}.{table}")
            assert kept.schema == whole.schema
            assert sorted(map(str, kept.collect())) == sorted(map(str, whole.collect()))
    # Nothing new: no version is written. Of the versions, two stay.
    versions = sorted(os.listdir(f"{checkpoint}/totals/header"))
    assert versions == ["0000000001", "0000000002"]
    update_layers(spark, log, db, checkpoint)
    assert sorted(os.listdir(f"{checkpoint}/totals/header")) == versions
    spark.sql(f"DROP DATABASE {db}_full CASCADE")


def test_totals_go_on_after_a_cut_and_start_anew_after_a_rebuild(spark, tmp_path, db):
    tables.create_database(spark, db)
    name, folder = f"{db}.rows", str(tmp_path / "totals")
    wanted = Totals(("k",), (("total", "v", 2),), "n")

    def totals():
        return sorted(map(tuple, updated_totals(spark, name, (wanted,), folder)[0].collect()))

    def expected():
        return sorted(map(tuple, spark.table(name).groupBy("k").agg(
            F.count("*").alias("n"), exact_sum("v").alias("total")).collect()))

    rows = spark.sql("SELECT id % 3 AS k, id / 100D AS v FROM range(100)")
    rows.limit(0).write.saveAsTable(name)
    assert totals() == []
    rows.write.insertInto(name)
    write(tmp_path / "totals" / "0000000001" / "0" / "junk", "cut short")
    assert totals() == expected()
    rows.selectExpr("k", "if(k = 1, double('NaN'), v)").write.insertInto(name)
    assert repr(totals()) == repr(expected())
    spark.sql(f"TRUNCATE TABLE {name}")
    rows.where("k < 2").write.insertInto(name)
    assert totals() == expected()


def test_command_line(spark, xml_dir, tmp_path, db, capsys):
    common = ["--topic", "t", "--log-path", str(tmp_path / "cli"), "--db", db]
    assert main(["run", "--xml-dir", xml_dir, *common]) == 0
    assert main(["layers", *common]) == 0
    assert main(["analytics", "--db", db]) == 0
    assert main(["inspect", "--db", db]) == 0
    out = capsys.readouterr().out
    assert "published: 3, failed: 1" in out
    assert "broken.xml: malformed_xml" in out
    assert f"{db}.silver_nfe_item: 3" in out
    assert f"{db}.analytics_05_tributos_emitente: 1" in out
    assert "|silver_nfe_item  |3" in out
    assert "|P             |p                |3.3" in out
    (tmp_path / "none").mkdir()
    assert main(["publish", "--xml-dir", str(tmp_path / "none"), *common]) == 1


def test_command_line_in_separate_processes(xml_dir, tmp_path):
    """Each job finds the tables of the ones before it through the table folder alone."""
    settings = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
                "spark.checkpoint.dir": str(tmp_path / "shared")}
    conf = " ".join(f"--conf {k}={v}" for k, v in settings.items())
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYTHONPATH": root, "PYSPARK_SUBMIT_ARGS": f"{conf} pyspark-shell"}

    def run(*argv):
        done = subprocess.run(
            [sys.executable, "-m", "invoicelake", *argv, "--master", "local[2]", "--table-path", str(tmp_path / "tables")],
            cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr[-2000:]
        return done.stdout

    topic = ["--topic", "t", "--log-path", str(tmp_path / "cli")]
    counted = [line for line in run("run", "--xml-dir", xml_dir, *topic).splitlines() if line.startswith("nfe.")]
    assert "nfe.silver_nfe_item: 3" in counted
    assert run("layers", *topic).splitlines() == counted
    analytics = run("analytics")
    assert "nfe.analytics_05_tributos_emitente: 1" in analytics
    assert run("analytics") == analytics
    assert "|silver_nfe_item  |3" in run("inspect")


@pytest.mark.parametrize("argv", [
    ["publish", "--topic", "t"], ["layers"], ["publish", "--topic", "t", "--xml-dir", "d", "--limit", "-1"],
])
def test_wrong_arguments(argv):
    with pytest.raises(SystemExit):
        arguments(argv)


@pytest.mark.skipif("INVOICE_XML_DIR" not in os.environ, reason="no invoice corpus given")
def test_corpus(spark, log, db):
    """100 real-looking invoices with known totals."""
    summary, rows = jobs.run_pipeline(spark, os.environ["INVOICE_XML_DIR"], log, db)
    assert (summary.published, summary.failed) == (100, 0)
    assert list(rows.values()) == [100, 100, 314, 100, 27, 10, 10]
    sums = spark.table(f"{db}.silver_nfe_header").selectExpr(
        "round(sum(valor_nota), 2)", "round(sum(valor_produtos), 2)",
        "round(sum(valor_total_tributos), 2)", "round(sum(valor_desconto), 2)",
    ).first()
    assert tuple(sums) == (9553.23, 9660.77, 565.23, 107.54)

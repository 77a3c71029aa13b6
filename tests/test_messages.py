"""Messages, bronze and the tolerant JSON parse."""

import json
import math

import pytest
from pyspark.sql import functions as F

from conftest import invoice
from invoicelake import contract
from invoicelake.operators.messages import bronze_messages, encode_messages, parse_messages
from invoicelake.operators.silver import silver_header, silver_item
from invoicelake.operators.xml_parse import good_documents, parse_invoices


def bronze_of(spark, payloads):
    rows = [("t", i % 2, i, f"k{i}", p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(
        rows, "topic string, partition int, offset bigint, message_key string, payload_json string"
    ).select("*", F.current_timestamp().alias("kafka_timestamp"), F.current_timestamp().alias("processed_at"))


def test_bronze_columns(spark):
    log = spark.createDataFrame([], contract.MESSAGE_LOG_SCHEMA)
    assert dict(bronze_messages(log).dtypes) == {
        "topic": "string", "partition": "int", "offset": "bigint", "kafka_timestamp": "timestamp",
        "message_key": "string", "payload_json": "string", "processed_at": "timestamp",
    }


def test_silver_columns(spark):
    parsed = parse_messages(bronze_of(spark, ["{}"]))
    assert len(silver_header(parsed).columns) == 36
    assert len(silver_item(parsed).columns) == 19
    assert silver_header(parsed).columns[-5:] == list(contract.LINEAGE)


def test_encoded_message(spark):
    files = spark.createDataFrame(
        [("x/a.xml", invoice(ide="<natOp>ação</natOp>").encode()),
         ("x/b.xml", invoice(key=None, id_="").encode()),
         ("x/c.xml", invoice(key=None, id_='Id="NFe"').encode())],
        "path string, content binary",
    )
    messages = {r.key: r.value for r in encode_messages(good_documents(parse_invoices(files))).collect()}
    assert set(messages) == {"K1", "b.xml", "c.xml"}
    assert "ação" in messages["K1"]
    value = json.loads(messages["K1"])
    assert list(value) == [f.name for f in contract.document_schema()]
    assert value["destinatario"] == dict.fromkeys(value["destinatario"])
    assert value["itens"] == []
    assert json.loads(messages["b.xml"])["chave_nfe"] is None
    assert json.loads(messages["c.xml"])["chave_nfe"] == ""


CASES = [
    # payload, kept, chave_nfe, valor_nota, lines
    (None, False, None, None, 0),
    ("", False, None, None, 0),
    (" \t\r\n", False, None, None, 0),
    ("not json", True, None, None, 0),
    ("null", True, None, None, 0),
    ("5", True, None, None, 0),
    ("[{},{}]", True, None, None, 0),
    ("{}", True, None, None, 0),
    (" ", True, None, None, 0),
    ('{"chave_nfe":"1","totais":{"valor_nota":', True, "1", None, 0),
    ('{"chave_nfe":"1","totais":{"valor_nota":"x"}}', True, "1", None, 0),
    ('{"chave_nfe":"1","totais":{"valor_nota":"2.5"}}', True, "1", None, 0),
    ('{"chave_nfe":"1","totais":{"valor_nota":NaN}}', True, "1", math.nan, 0),
    ('{"chave_nfe":12,"unknown":[1]}', True, "12", None, 0),
    ('{"itens":[{"n_item":"z","valor_produto":1.0},{"n_item":2}]}', True, None, None, 2),
    ('{"itens":[]}', True, None, None, 0),
    ('{"itens":null}', True, None, None, 0),
]


@pytest.mark.parametrize("sections", [None, ("totais", "itens")])
def test_unreadable_payloads(spark, sections):
    parsed = parse_messages(bronze_of(spark, [c[0] for c in CASES]), sections).cache()
    got = {r.offset: r for r in parsed.select("offset", "data.chave_nfe", "data.totais.valor_nota").collect()}
    items = {r.offset: r["count"] for r in silver_item(parsed).groupBy("offset").count().collect()}
    for i, (_, kept, key, value, lines) in enumerate(CASES):
        assert (i in got) == kept
        assert items.get(i, 0) == lines
        if kept:
            assert got[i].chave_nfe == key
            assert got[i].valor_nota == value or math.isnan(got[i].valor_nota)
    parsed.unpersist()


def test_bad_line_field_spoils_only_that_field(spark):
    parsed = parse_messages(bronze_of(spark, ['{"itens":[{"n_item":"z","valor_produto":1.0},{"n_item":2}]}']))
    rows = silver_item(parsed).select("n_item", "valor_produto").collect()
    assert [tuple(r) for r in rows] == [(None, 1.0), (2, None)]


def test_strict_drops_unreadable_payloads(spark):
    parsed = parse_messages(bronze_of(spark, ["not json", '{"chave_nfe":"1"}', None]), strict=True)
    assert [r.chave_nfe for r in silver_header(parsed).collect()] == ["1"]

"""Registered queries: every operator over the star-schema tables, named as in the coverage list.

Orders become contract documents (`order_documents`), travel as JSON messages or XML files, and
come back through the same operators that the jobs use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from invoicelake import contract
from invoicelake.contract import NAMESPACE
from invoicelake.operators import gold
from invoicelake.operators.messages import bronze_messages, encode_messages, parse_messages
from invoicelake.operators.silver import silver_header, silver_item
from invoicelake.operators.xml_parse import (
    good_documents, ingest_summary, parse_invoices, quarantine,
)
from invoicelake.operators.xml_write import invoice_xml
from invoicelake.sources.star_schema import (
    TOPIC, as_messages, events_as_messages, order_documents,
)
from invoicelake.sources.xml_files import limit_files

SOURCE_LIMIT = 100

_VOLATILE = ("ingestion_ts", "partition", "offset", "kafka_timestamp", "processed_at")


# -- messages ------------------------------------------------------------------------------


def _parsed_orders(
    spark: SparkSession, sf_dir: str, sections: tuple[str, ...] | None = None, **options
) -> DataFrame:
    messages = as_messages(order_documents(spark, sf_dir, sections, **options))
    return parse_messages(bronze_messages(messages), sections)


def _header(spark: SparkSession, sf_dir: str, *sections: str, **options) -> DataFrame:
    return silver_header(_parsed_orders(spark, sf_dir, sections, **options), sections)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_item(_parsed_orders(spark, sf_dir, ("itens",)))


def q_publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every invoice field of every message; `silver_item` shows the lines of the same messages."""
    messages = encode_messages(order_documents(spark, sf_dir))
    bronze = bronze_messages(messages.select(
        F.lit(TOPIC).alias("topic"), F.lit(0).alias("partition"), F.lit(0).alias("offset"),
        F.current_timestamp().alias("timestamp"), "key", "value",
    ))
    fields = [F.col(f"data.{path}").alias(name) for path, name in contract.header_columns()]
    return parse_messages(bronze).select("message_key", *fields).drop("ingestion_ts")


def q_bronze_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Zoned in the log; shown again as the clock time the table holds.
    clock = F.col("kafka_timestamp").cast("timestamp_ntz")
    return (
        bronze_messages(events_as_messages(spark, sf_dir))
        .withColumn("kafka_timestamp", clock)
        .drop("processed_at")
    )


def q_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_messages(events_as_messages(spark, sf_dir))
    return bronze.select(
        F.col("offset").alias("event_id"), F.from_json("payload_json", "k int").k.alias("k")
    )


def q_json_parse_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads broken in a way that depends on the order's priority."""
    sections = ("header", "destinatario", "totais")
    messages = as_messages(order_documents(spark, sf_dir, sections, line_totals=False))
    payload = F.col("value").cast("string")
    priority = F.get_json_object(payload, "$.header.natureza_operacao")
    broken = (
        F.when(priority == "1-URGENT", F.lit(" \t\r\n"))
        .when(priority == "2-HIGH", F.lit("not json"))
        .when(
            priority == "3-MEDIUM",
            F.concat(F.substring_index(payload, '"totais"', 1), F.lit('"totais":{"valor_nota":')),
        )
        .when(
            priority == "4-NOT SPECIFIED",
            F.regexp_replace(payload, r'"valor_nota":[^,}]+', '"valor_nota":"x"'),
        )
        .otherwise(payload)
    )
    bronze = bronze_messages(messages.withColumn("value", broken.cast("binary")))
    return parse_messages(bronze, sections).select(
        "message_key",
        F.col("data.chave_nfe").alias("chave_nfe"),
        F.col("data.destinatario.uf").alias("dest_uf"),
        F.col("data.totais.valor_nota").alias("valor_nota"),
        F.col("data.totais.valor_frete").alias("valor_frete"),
    )


def q_silver_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = ("header", "emitente", "destinatario", "totais", "protocolo")
    return _header(spark, sf_dir, *sections).drop(*_VOLATILE)


def q_silver_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).drop(*_VOLATILE)


def q_gold_por_emitente(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.per_issuer(_header(spark, sf_dir, "emitente", "totais"))


def q_gold_por_uf_destino(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.per_recipient_state(
        _header(spark, sf_dir, "destinatario", "totais", line_totals=False)
    )


def q_gold_top_produtos_valor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_products_by_value(_items(spark, sf_dir))


def q_gold_top_produtos_quantidade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_products_by_quantity(_items(spark, sf_dir))


def q_analytics_tributos_emitente(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.taxes_per_issuer(_header(spark, sf_dir, "emitente", "totais"))


def q_layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first three layers, each counted behind its own operator."""
    bronze = bronze_messages(as_messages(order_documents(spark, sf_dir, ("itens",))))
    layers = {
        contract.BRONZE: bronze,
        contract.SILVER_HEADER: silver_header(parse_messages(bronze, ()), ()),
        contract.SILVER_ITEM: silver_item(parse_messages(bronze, ("itens",))),
    }
    counts = [
        rows.agg(F.lit(name).alias("layer"), F.count("*").alias("row_count"))
        for name, rows in layers.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# -- XML -----------------------------------------------------------------------------------


def _xml_files(
    spark: SparkSession,
    sf_dir: str,
    sections: tuple[str, ...],
    shape: Callable[[Column], Column] = lambda xml: xml,
    **options,
) -> DataFrame:
    """Order documents as XML files (path, content), their text changed by `shape`.

    `shape` may use the columns `priority` and `status` of the order.
    """
    documents = order_documents(spark, sf_dir, sections, **options)
    texts = documents.select(
        F.concat(F.lit("orders/"), "source_file").alias("path"),
        F.expr(invoice_xml("document", sections)).alias("xml"),
        *(
            (F.col("document.header.natureza_operacao").alias("priority"),
             F.col("document.header.tipo_nota").alias("status"))
            if "header" in sections else ()
        ),
    )
    return texts.select("path", shape(F.col("xml")).cast("binary").alias("content"))


def q_source_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = limit_files(_xml_files(spark, sf_dir, ("header", "protocolo")), SOURCE_LIMIT)
    return parse_invoices(files, sections=("header",)).select(
        "path",
        F.col("document.chave_nfe").alias("chave_nfe"),
        F.col("document.header.data_emissao").alias("data_emissao"),
    )


def _as_found(xml: Column) -> Column:
    """Issued orders with envelope and declaration, finished ones as a bare invoice without
    protocol, pending ones in unusual forms: inside a lot, without the element around the invoice, with
    quoted markup and elements of other names, and with prefixed tags inside a foreign envelope."""
    bare = F.replace(
        F.regexp_extract(xml, "(?s)<NFe>.*</NFe>", 0),
        F.lit("<NFe>"), F.lit(f'<NFe xmlns="{NAMESPACE}">'),
    )
    prefixed = F.regexp_replace(
        F.replace(xml, F.lit(" xmlns="), F.lit(" xmlns:n=")), r"<(/?)(\w)", "<$1n:$2"
    )
    in_lot = F.replace(F.replace(xml, F.lit("<NFe>"), F.lit("<lote><NFe>")), F.lit("</NFe>"), F.lit("</NFe></lote>"))
    direct = F.replace(F.replace(xml, F.lit("<NFe>"), F.lit("")), F.lit("</NFe>"), F.lit(""))
    quoted = F.replace(xml, F.lit("<ide>"), F.lit(
        "<obs><![CDATA[<infNFe><ide><nNF>0</nNF></ide></infNFe>]]></obs>"
        '<ide><nnf>0</nnf><x:serie xmlns:x="urn:x">0</x:serie>'))
    unusual = (
        F.when(F.col("priority") == "1-URGENT", in_lot).when(F.col("priority") == "2-HIGH", direct)
        .when(F.col("priority") == "3-MEDIUM", quoted)
    )
    return (
        F.when(F.col("status") == "F", bare)
        .when((F.col("status") == "P") & unusual.isNotNull(), unusual)
        .when(F.col("status") == "P", F.concat(F.lit("<envio><lote>"), prefixed, F.lit("</lote></envio>")))
        .otherwise(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n'), xml))
    )


def q_xml_parse_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = ("header", "emitente", "destinatario", "totais", "protocolo")
    files = _xml_files(spark, sf_dir, sections, _as_found)
    parsed = good_documents(parse_invoices(files, sections=sections))
    data = parsed.select(
        F.col("document").alias("data"),
        *(F.lit(None).alias(name) for name in ("topic", *_VOLATILE) if name != "ingestion_ts"),
    )
    return silver_header(data).drop("topic", *_VOLATILE)


def q_xml_parse_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _xml_files(spark, sf_dir, ("itens",))
    parsed = good_documents(parse_invoices(files, sections=("itens",)))
    data = parsed.select(
        F.col("document").alias("data"),
        *(F.lit(None).alias(name) for name in ("topic", *_VOLATILE) if name != "ingestion_ts"),
    )
    return silver_item(data).drop("topic", *_VOLATILE)


def _recipient_documents(xml: Column) -> Column:
    """CPF alone, CNPJ alone, both, neither, or a blank CNPJ beside a CPF."""
    cpf = F.regexp_extract(xml, "<CPF>(.*?)</CPF>", 1)

    def elements(text: Column) -> Column:
        return F.replace(xml, F.concat(F.lit("<CPF>"), cpf, F.lit("</CPF>")), text)

    cnpj = F.concat(F.lit("<CNPJ>777"), cpf, F.lit("</CNPJ>"))
    both = F.concat(F.lit("<CPF>"), cpf, F.lit("</CPF>"), cnpj)
    blank = F.concat(F.lit("<CNPJ> \n</CNPJ><CPF>"), cpf, F.lit("</CPF>"))
    priority = F.col("priority")
    return (
        F.when(priority == "1-URGENT", elements(cnpj))
        .when(priority == "2-HIGH", elements(both))
        .when(priority == "3-MEDIUM", elements(F.lit("")))
        .when(priority == "4-NOT SPECIFIED", elements(blank))
        .otherwise(xml)
    )


def q_xml_document_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _xml_files(spark, sf_dir, ("header", "destinatario"), _recipient_documents)
    return parse_invoices(files, sections=("destinatario",)).select(
        "source_file",
        F.col("document.destinatario.documento").alias("dest_documento"),
        F.col("document.destinatario.tipo_documento").alias("dest_tipo_documento"),
    )


def _access_keys(xml: Column) -> Column:
    """Key in the protocol; no protocol; blank key; `NFe` inside the Id; neither key nor Id."""
    no_protocol = F.regexp_replace(xml, "(?s)<protNFe>.*</protNFe>", "")
    blank_key = F.regexp_replace(xml, "<chNFe>.*?</chNFe>", "<chNFe> </chNFe>")
    inner = F.replace(no_protocol, F.lit(' Id="NFe'), F.lit(' Id="7NFeNFe'))
    no_id = F.regexp_replace(no_protocol, ' Id="[^"]*"', "")
    priority = F.col("priority")
    return (
        F.when(priority == "1-URGENT", no_protocol)
        .when(priority == "2-HIGH", blank_key)
        .when(priority == "3-MEDIUM", inner)
        .when(priority == "4-NOT SPECIFIED", no_id)
        .otherwise(xml)
    )


def q_xml_access_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _xml_files(spark, sf_dir, ("header", "protocolo"), _access_keys)
    keys = encode_messages(good_documents(parse_invoices(files, sections=())))
    return keys.select(
        F.col("key").alias("message_key"),
        F.get_json_object("value", "$.chave_nfe").alias("chave_nfe"),
    )


def _damaged(xml: Column) -> Column:
    """Truncated, followed by text, with an unreadable line number, no XML at all, or intact."""
    priority = F.col("priority")
    return (
        F.when(priority == "1-URGENT", F.replace(xml, F.lit("</nfeProc>"), F.lit("")))
        .when(priority == "2-HIGH", F.concat(xml, F.lit("\nfim")))
        .when(priority == "3-MEDIUM", F.replace(xml, F.lit(' nItem="'), F.lit(' nItem="x')))
        .when(priority == "4-NOT SPECIFIED", F.lit("plain text"))
        .otherwise(xml)
    )


def _parsed_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _xml_files(spark, sf_dir, ("header", "itens"), _damaged)
    return parse_invoices(files, sections=())


def q_xml_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(_parsed_damaged(spark, sf_dir))


def q_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_summary(_parsed_damaged(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "source_limit": q_source_limit,
        "publish_messages": q_publish_messages,
        "bronze_messages": q_bronze_messages,
        "json_parse": q_json_parse,
        "json_parse_malformed": q_json_parse_malformed,
        "silver_header": q_silver_header,
        "silver_item": q_silver_item,
        "gold_por_emitente": q_gold_por_emitente,
        "gold_por_uf_destino": q_gold_por_uf_destino,
        "gold_top_produtos_valor": q_gold_top_produtos_valor,
        "gold_top_produtos_quantidade": q_gold_top_produtos_quantidade,
        "analytics_tributos_emitente": q_analytics_tributos_emitente,
        "xml_parse_header": q_xml_parse_header,
        "xml_parse_items": q_xml_parse_items,
        "xml_document_id": q_xml_document_id,
        "xml_access_key": q_xml_access_key,
        "xml_quarantine": q_xml_quarantine,
        "ingest_summary": q_ingest_summary,
        "layer_row_counts": q_layer_row_counts,
    }

"""The jobs: publish XML files as messages, build the layers, both in a row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from invoicelake import contract
from invoicelake.operators import gold
from invoicelake.operators.messages import bronze_messages, encode_messages, parse_messages
from invoicelake.operators.silver import silver_header, silver_item
from invoicelake.operators.xml_parse import good_documents, parse_invoices, quarantine
from invoicelake.plans.tables import create_database, overwrite_table, staged
from invoicelake.sources.messages import KafkaTopic, MessageLog
from invoicelake.sources.xml_files import packed_small_files, xml_files

Topic = KafkaTopic | MessageLog

HEADER_SECTIONS = tuple(s.name for s in contract.SECTIONS)
ITEM_SECTIONS = (contract.ITEMS.name,)


class NothingToPublish(Exception):
    """No XML file was found, or none of them could be read."""


@dataclass(frozen=True)
class PublishSummary:
    published: int
    failed: int
    quarantine: DataFrame  # (path, source_file, error) of the failed files


def publish(
    spark: SparkSession, xml_dir: str, topic: Topic, limit: int | None = None, db: str = "nfe"
) -> PublishSummary:
    """Parse all XML files below `xml_dir` and publish one message per readable file.

    The files are parsed once into a staging copy, readable and unreadable ones in folders of their
    own, from which messages, counts and quarantine are taken. Unreadable files never stop the
    others; all that the last publish met are in the table QUARANTINE of `db`, also if none could be read.
    """
    files = xml_files(spark, xml_dir, limit)
    if files.select("path").isEmpty():
        raise NothingToPublish(f"no XML file in {xml_dir}")
    with packed_small_files(spark):
        readable = F.col("error").isNull().alias("readable")
        parsed = staged(
            parse_invoices(files).select("*", readable), f"parsed_{topic.topic}", "readable")
    counts = parsed.agg(F.count("*").alias("files"), F.count_if("readable").alias("readable")).first()
    create_database(spark, db)
    failed = overwrite_table(
        quarantine(parsed.where("NOT readable")), f"{db}.{contract.QUARANTINE}")
    summary = PublishSummary(
        counts.readable, failed, spark.table(f"{db}.{contract.QUARANTINE}"))
    if summary.published == 0:
        raise NothingToPublish(
            f"none of {counts.files} XML files in {xml_dir} could be read; see {db}.{contract.QUARANTINE}")
    parsed = parsed.where("readable")
    topic.write(encode_messages(good_documents(parsed)))
    return summary


def build_layers(
    spark: SparkSession, topic: Topic, db: str = "nfe", strict: bool = False
) -> dict[str, int]:
    """Read the topic from its beginning to its end and rewrite all layer tables.

    Returns the rows written per table; an empty topic leaves the tables untouched. Every layer
    is read back from the table of the one before, so all agree on one snapshot of the topic.
    """
    create_database(spark, db)
    messages = topic.read(spark)
    if messages.isEmpty():
        return {}
    rows = {contract.BRONZE: overwrite_table(bronze_messages(messages), f"{db}.{contract.BRONZE}")}
    return rows | build_silver(spark, db, strict) | build_gold(spark, db)


def build_silver(spark: SparkSession, db: str, strict: bool = False) -> dict[str, int]:
    """Both silver tables from the bronze table; each parses only the part of a message it needs."""
    bronze = spark.table(f"{db}.{contract.BRONZE}")
    header = silver_header(parse_messages(bronze, HEADER_SECTIONS, strict))
    item = silver_item(parse_messages(bronze, ITEM_SECTIONS, strict))
    return {
        contract.SILVER_HEADER: overwrite_table(header, f"{db}.{contract.SILVER_HEADER}"),
        contract.SILVER_ITEM: overwrite_table(item, f"{db}.{contract.SILVER_ITEM}"),
    }


def build_gold(spark: SparkSession, db: str) -> dict[str, int]:
    """The four gold tables from the silver tables."""
    return _aggregate_tables(spark, db, (
        contract.GOLD_EMITENTE, contract.GOLD_UF_DESTINO,
        contract.GOLD_TOP_VALOR, contract.GOLD_TOP_QUANTIDADE,
    ))


def build_analytics(spark: SparkSession, db: str) -> dict[str, int]:
    """The five analytics tables from the silver tables."""
    rows = _aggregate_tables(spark, db, (
        contract.ANALYTICS_EMITENTE, contract.ANALYTICS_UF_DESTINO,
        contract.ANALYTICS_TOP_VALOR, contract.ANALYTICS_TOP_QUANTIDADE,
    ))
    # Taxes per issuer are a column of the first table: no second pass over the invoices.
    taxes = spark.table(f"{db}.{contract.ANALYTICS_EMITENTE}").select(
        *gold.ISSUER, F.col("valor_total_tributos").alias("total_tributos")
    )
    name = contract.ANALYTICS_TRIBUTOS
    return rows | {name: overwrite_table(taxes, f"{db}.{name}")}


def _aggregate_tables(
    spark: SparkSession, db: str, names: tuple[str, str, str, str]
) -> dict[str, int]:
    issuer, state, by_value, by_quantity = names
    header = spark.table(f"{db}.{contract.SILVER_HEADER}")
    rows = {
        issuer: overwrite_table(gold.per_issuer(header), f"{db}.{issuer}"),
        state: overwrite_table(gold.per_recipient_state(header), f"{db}.{state}"),
    }
    # Both rankings come from one aggregation of the invoice lines.
    products = staged(gold.per_product(spark.table(f"{db}.{contract.SILVER_ITEM}")), "products")
    for name, total in ((by_value, "valor_total"), (by_quantity, "quantidade_total")):
        rows[name] = overwrite_table(gold.top_products(products, total), f"{db}.{name}")
    return rows


def run_pipeline(
    spark: SparkSession, xml_dir: str, topic: Topic, db: str = "nfe", limit: int | None = None
) -> tuple[PublishSummary, dict[str, int]]:
    """Publish, then build the layers."""
    return publish(spark, xml_dir, topic, limit, db), build_layers(spark, topic, db)

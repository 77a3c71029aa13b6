"""The layers as streams: every run takes over the messages that came since the last one.

The batch job reads the topic from its beginning each time. Here the same projections run over
the same source as streams that stop when they have caught up; their checkpoints remember what was
read and the file sink commits each micro-batch once, so a lost executor or a repeated run
neither loses nor repeats a message. A new message is parsed once for each silver table and never
again. Gold comes from totals that are merged with those of the new silver files (`plans/totals.py`).
A database is filled either this way or by the batch job, which would replace the tables the
streams append to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from invoicelake import contract
from invoicelake.operators import gold
from invoicelake.operators.messages import bronze_messages, parse_messages
from invoicelake.operators.silver import silver_header, silver_item
from invoicelake.plans.jobs import HEADER_SECTIONS, ITEM_SECTIONS, Topic
from invoicelake.plans.tables import create_database, overwrite_table, row_counts
from invoicelake.plans.totals import updated_totals
from invoicelake.sources import files


def _append(rows: DataFrame, table: str, checkpoint: str) -> None:
    """Append what is new in a stream to a table."""
    rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).toTable(table).awaitTermination()


def append_bronze(spark: SparkSession, topic: Topic, db: str, checkpoint: str) -> None:
    """Append all messages not yet taken over to the bronze table."""
    create_database(spark, db)
    _append(bronze_messages(topic.read_stream(spark)), f"{db}.{contract.BRONZE}", checkpoint)


def append_silver(spark: SparkSession, db: str, checkpoint: str, strict: bool = False) -> None:
    """Append the invoices and lines of all bronze messages not yet parsed to the silver tables.

    `strict` holds for the messages of this run. A silver table that no stream has written yet, as one of
    the batch job, is replaced.
    """
    for table, columns, sections in (
        (contract.SILVER_HEADER, silver_header, HEADER_SECTIONS),
        (contract.SILVER_ITEM, silver_item, ITEM_SECTIONS),
    ):
        if not files.exists(spark, f"{checkpoint}/{table}"):
            spark.sql(f"DROP TABLE IF EXISTS {db}.{table}")
        bronze = spark.readStream.table(f"{db}.{contract.BRONZE}")
        _append(columns(parse_messages(bronze, sections, strict)), f"{db}.{table}", f"{checkpoint}/{table}")


def update_gold(spark: SparkSession, db: str, checkpoint: str) -> dict[str, int]:
    """The four gold tables from the totals kept so far and the silver files that came since."""
    folder = f"{checkpoint}/totals"
    issuers, states = updated_totals(
        spark, f"{db}.{contract.SILVER_HEADER}", (gold.ISSUER_TOTALS, gold.STATE_TOTALS), f"{folder}/header")
    (products,) = updated_totals(
        spark, f"{db}.{contract.SILVER_ITEM}", (gold.PRODUCT_TOTALS,), f"{folder}/item")
    tables = {
        contract.GOLD_EMITENTE: issuers,
        contract.GOLD_UF_DESTINO: states,
        contract.GOLD_TOP_VALOR: gold.top_products(products, "valor_total"),
        contract.GOLD_TOP_QUANTIDADE: gold.top_products(products, "quantidade_total"),
    }
    return {name: overwrite_table(rows, f"{db}.{name}") for name, rows in tables.items()}


def update_layers(
    spark: SparkSession, topic: Topic, db: str, checkpoint: str, strict: bool = False
) -> dict[str, int]:
    """Bring all layers up to date; the work goes with the new messages and the number of groups.

    Returns the rows that each silver and gold table has now; an empty topic leaves them untouched.
    """
    append_bronze(spark, topic, db, checkpoint)
    if spark.table(f"{db}.{contract.BRONZE}").isEmpty():
        return {}
    append_silver(spark, db, checkpoint, strict)
    silver = row_counts(spark, db, (contract.SILVER_HEADER, contract.SILVER_ITEM)).collect()
    return {r.layer: r.row_count for r in silver} | update_gold(spark, db, checkpoint)

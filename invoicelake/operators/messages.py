"""Contract documents <-> keyed JSON messages, and the bronze layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from invoicelake import contract
from invoicelake.operators.barrier import evaluate_once


def encode_messages(documents: DataFrame) -> DataFrame:
    """(source_file, document) -> (key, value): key = access key or file name, value = JSON.

    Missing fields are written as explicit nulls.
    """
    key = F.coalesce(F.nullif(F.col("document.chave_nfe"), F.lit("")), F.col("source_file"))
    return documents.select(
        key.alias("key"), F.to_json("document", {"ignoreNullFields": "false"}).alias("value")
    )


def bronze_messages(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """Raw messages with their place in the topic and the time they were taken over."""
    return messages.select(
        "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("payload_json"),
        (F.current_timestamp() if now is None else now).alias("processed_at"),
    )


def parse_messages(
    bronze: DataFrame, sections: tuple[str, ...] | None = None, strict: bool = False
) -> DataFrame:
    """Bronze rows with the payload as a document `data`.

    Missing and blank payloads are dropped. Other unreadable ones are kept with whatever fields
    could be read, all null in the worst case; `strict` drops them instead. `sections` limits
    the parse to what the caller reads: a wide parse is not narrowed by the optimizer once two
    of its fields are used.
    """
    schema = contract.document_schema(sections)
    options = {}
    if strict:
        schema = schema.add("corrupt", "string")
        options["columnNameOfCorruptRecord"] = "corrupt"
    parsed = evaluate_once(
        bronze, *contract.LINEAGE, "message_key",
        data=F.from_json("payload_json", schema, options),
    ).where(F.col("data").isNotNull())
    if strict:
        parsed = parsed.where(F.col("data.corrupt").isNull())
    return parsed

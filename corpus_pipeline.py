"""The corpus pipeline: stages over `documents`, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from invoicelake.llm.decontaminate import decontaminate
from invoicelake.llm.mixing import mixed_documents
from invoicelake.llm.near_duplicates import without_near_duplicates
from invoicelake.llm.sharding import shard_rows
from invoicelake.llm.shared import stored
from invoicelake.llm.toxicity import labelled_model, without_toxic

SHARDS = 40


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not find toxic."""
    everything = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without_toxic(docs, labelled_model(everything, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark stands, of items without an id neither."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").withColumn(
        "item_id", F.coalesce(F.col("item_id").cast("string"), F.lit("")))
    return decontaminate(docs, items).filter("NOT contaminated").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources near their target weights: whole documents, repeated or left out."""
    return mixed_documents(docs, whole=True)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their `shard` and their `slot` in it."""
    return shard_rows(docs, ["doc_id", "text"], SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# A trained classifier and a hash ring are beyond SQL. Tests hold the rows of mixing to a plan of `mix`;
# of the other stages they compare columns, falling row counts and a few documents.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

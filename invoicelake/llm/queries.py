"""Registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from invoicelake.llm import quality
from invoicelake.llm.conversation_repair import repair, with_digests
from invoicelake.llm.decontaminate import decontaminate
from invoicelake.llm.exact_dedup import exact_duplicates
from invoicelake.llm.labelled import fold
from invoicelake.llm.line_dedup import line_dedup
from invoicelake.llm.line_rules import quality_rules
from invoicelake.llm.mixing import mix
from invoicelake.llm.near_duplicates import near_duplicates
from invoicelake.llm.prefix_trie import ordered_turns, prefix_trie
from invoicelake.llm.sharding import shard_rows
from invoicelake.llm.shared import stored, utf8_size
from invoicelake.llm.suffix_dedup import suffix_dedup
from invoicelake.llm.toxicity import labelled_model, scored
from invoicelake.llm.url_filter import domains_of, host_of, judged

SHARDS = 40
ROW_BYTES = 16  # what a row costs besides its text


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_linked", "n_links", "n_removed")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (utf8_size(F.col("text")) + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    return shard_rows(docs, ["doc_id", "size", "text_crc32"], SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.labelled_model(docs, labels)
    return quality.scored(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold() == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def _number(text, most: int):
    """A number below `most` drawn from a text by its md5."""
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int") % most


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages have no fetch time and come with no list; both are drawn from the tables' own values.

    Every page was fetched on some day of 2024. Every host and every domain above it has up to four
    entries in that year, each of one of three lists, which puts it on that list or takes it off.
    """
    pages = _table(spark, sf_dir, "pages")
    day = lambda x: F.date_add(F.lit("2024-01-01").cast("date"), _number(x, 366))
    captures = pages.select(
        "page_id", "url", day(F.concat(F.lit("fetch "), F.col("page_id"))).alias("fetched"))
    domains = pages.select(F.explode(domains_of(host_of(F.col("url")))).alias("domain")).distinct()
    turns = domains.select("domain", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("turn"))
    seed = F.concat_ws(" ", "domain", "turn")
    entries = turns.filter(_number(F.concat(F.lit("has "), seed), 3) == 0).select(
        "domain", (F.col("turn") % 2 == 0).alias("listed"), day(seed).alias("dated"),
        F.concat(F.lit("list"), _number(F.concat(F.lit("why "), seed), 3)).alias("list"))
    return judged(captures, entries.withColumn("reason", F.col("list")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return scored(docs.select("doc_id", "text"), labelled_model(docs, labels)).select(
        "doc_id", (fold() == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return near_duplicates(docs, shingle=2).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, repaired after a damage that the hash of a row's id and turn decides."""
    space = F.lit(" ")
    damage = F.crc32(F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space))) % 20
    rows = _table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), damage.alias("damage"),
    ).select(
        "conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("damage") == 0, 0).when(F.col("damage") == 3, 2).otherwise(1).alias("copies"),
    )
    return with_digests(*repair(rows, F.col("copies")))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower half of the ids is the history, in which the documents of the upper half are looked up."""
    docs = _table(spark, sf_dir, "documents")
    middle = docs.agg(F.floor((F.min("doc_id") + F.max("doc_id")) / 2).cast("long")).first()[0]
    return exact_duplicates(docs, F.col("doc_id") <= F.lit(middle)).drop("in_history")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation begins with the first turns of the one that opens its hundred."""
    own = ordered_turns(_table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string")) % 6  # turns taken from there, five at most
    lengths = own.groupBy("conv_id").agg(F.max("number").alias("length"))
    first = F.col("conv_id") - F.col("conv_id") % 100
    members = stored(lengths.withColumn("head", head).withColumn("first", first).join(
        lengths.select(F.col("conv_id").alias("first"), F.col("length").alias("there")), "first", "left"
    ).select("conv_id", "head", "first",
             F.least("head", F.coalesce("there", F.lit(0))).alias("taken")))
    heads = own.filter("number <= 5").withColumnRenamed("conv_id", "first").join(
        members, "first").filter("number <= head").select(
        "conv_id", F.col("number").alias("depth"), "mark", "chars")
    rests = own.join(members, "conv_id").filter("number > head").select(
        "conv_id", (F.col("number") - F.col("head") + F.col("taken")).alias("depth"), "mark", "chars")
    return prefix_trie(heads.unionByName(rests), members.select("conv_id"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_line_dedup": op2_line_dedup,
        "op3_sharding": op3_sharding,
        "op4_mixing": op4_mixing,
        "op5_quality": op5_quality,
        "op6_url_filter": op6_url_filter,
        "op7_quality_rules": op7_quality_rules,
        "op8_decontamination": op8_decontamination,
        "op9_toxicity": op9_toxicity,
        "op10_near_duplicates": op10_near_duplicates,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_prefix_trie": op13_prefix_trie,
    }

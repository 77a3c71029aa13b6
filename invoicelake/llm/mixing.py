"""Mixing sources to target weights: random order within a source, cut at its exact budget."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from invoicelake.llm.shared import BLANKS, named_apart, numbered, restored, words

CELL_DIGITS = 3  # hex digits of the key that cut the random order of each source into cells


@dataclass(frozen=True)
class MixRule:
    """Weights by the rank of a source (by code point, null last), repeating; caps in epochs."""

    weights: tuple[int, ...] = (5, 2, 1)
    share_percent: int = 100
    max_epochs: int = 3


def targets(source_sizes: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one small row per source.

    Targets are proportional to the weights until they would exceed `max_epochs` times their
    source; the excess is shared again by weight. The sources that reach their cap are those with
    the smallest cap for their weight, so one pass in that order finds them: a source is capped
    if its cap is below its share of what the ones before it leave over.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in rule.weights])
    ranked = source_sizes.select(
        "source", "source_size",
        F.element_at(
            weights, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(rule.weights))) + 1)
            .cast("int"),
        ).cast("long").alias("weight"),
        (F.col("source_size") * rule.max_epochs).alias("cap"),
    )
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor(F.sum("source_size").over(everything) * rule.share_percent / 100)
    left = ranked.withColumns({
        "left_words": budget - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "left_weight": F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)),
    })
    capped = F.col("cap") * F.col("left_weight") < F.col("left_words") * F.col("weight")
    # The first source that is not capped, with the most words left, fixes the share of the others.
    flagged = left.withColumn("capped", capped)
    free_words = F.max(F.when(~F.col("capped"), F.col("left_words"))).over(everything)
    free_weight = F.max(F.when(~F.col("capped"), F.col("left_weight"))).over(everything)
    return flagged.select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise((free_words * F.col("weight")).cast("double") / free_weight)
        .alias("target"),
    )


def mix(
    docs: DataFrame, rule: MixRule = MixRule(), seed: int = 42, key: str = "doc_id"
) -> DataFrame:
    """The rows of `docs` with their part in the mix.

    Added columns: `size` (words of the text, 0 for null), `source_size` and `target` (of the
    row's source), `copies` (whole copies that the mix takes), `part` (words that it takes of one
    more copy; at most one row of a source has a part between 0 and its size) and `taken` (words in
    all). A source's `taken` add up to its target, rounded down, unless it has no words. Rows without
    words have no copies, in whatever source.

    Within a source rows come in an order drawn from `seed`, `key` and the text; equal rows are
    interchangeable, so reruns agree. A null source is a source of its own, and last; a null key or
    text is a value like any other. An empty table gives an empty table. Other columns pass through,
    but names of added columns are refused.
    """
    named_apart(docs, key, "text", "source")
    added = {"size", "source_size", "target", "copies", "part", "taken"}
    if added & set(docs.columns):
        raise ValueError(f"the table already has one of the columns {sorted(added)}")
    slim, names = numbered(docs, "text", "source")
    id_ = names[key]
    keyed = slim.select(
        "*", F.size(words(F.col("text"))).cast("long").alias("size"),
        F.md5(F.concat_ws("/", F.lit(seed), F.col(id_), F.col("text"))).alias("_key"),
        _name("source").alias("_name"),
    ).withColumn("_cell", F.substring("_key", 1, CELL_DIGITS))
    # Prefix sums in three steps: cells of the order, rows of a cell, and their sum. The cells of
    # a source are at most 16**CELL_DIGITS small rows, a cell has that share of its rows.
    cells = keyed.groupBy("source", "_name", "_cell").agg(F.sum("size").alias("_cell_size"))
    of_source = cells.groupBy("source").agg(F.sum("_cell_size").alias("source_size"))
    in_source = Window.partitionBy("_name").orderBy("_cell")
    starts = cells.select(
        "_name", "_cell",
        (F.sum("_cell_size").over(in_source) - F.col("_cell_size")).alias("_cell_start"),
    ).join(
        targets(of_source, rule).withColumn("_name", _name("source")).drop("source"), "_name"
    )
    in_cell = Window.partitionBy("_name", "_cell").orderBy(
        "_key", F.col(id_).asc_nulls_last(), "size"
    )
    placed = keyed.withColumn("_upto", F.sum("size").over(
        in_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )).join(starts, ["_name", "_cell"])
    start = F.col("_cell_start") + F.col("_upto") - F.col("size")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - F.col("_epochs") * F.col("source_size") - start
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    whole = (F.col("_part") == F.col("size")) & (F.col("size") > 0)
    return (
        placed.withColumn("_epochs", epochs.cast("long"))
        .withColumn("_part", part.cast("long"))
        .select(
            *restored(names), "size", "source_size", "target",
            F.when(F.col("size") > 0, F.col("_epochs") + whole.cast("long"))
            .otherwise(F.lit(0).cast("long")).alias("copies"),
            F.when(whole, F.lit(0).cast("long")).otherwise(F.col("_part")).alias("part"),
            (F.col("_epochs") * F.col("size") + F.col("_part")).alias("taken"),
        )
    )


def _name(source: str) -> Column:
    """A key for a source that is never null, so that joins and windows share one shuffle."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def first_words(text: Column, count: Column) -> Column:
    """`text` up to the end of its `count`-th word, blanks before that included."""
    pieces = F.split(text, rf"(?<=[^{BLANKS}])(?=[{BLANKS}])")
    return F.array_join(F.slice(pieces, 1, count), "")


def mixed_documents(
    docs: DataFrame, rule: MixRule = MixRule(), seed: int = 42, key: str = "doc_id",
    whole: bool = False,
) -> DataFrame:
    """The documents of the mix: each as often as it is taken, the last of a source cut short.

    With `whole` that last one is not cut but taken whole, so a source exceeds its target by less
    than one document. Documents without words are not part of a mix; the columns are those of `docs`.
    """
    named_apart(docs, key, "text", "source")
    slim, names = numbered(docs, "text", "source")
    mixed = mix(slim, rule, seed, names[key])
    if whole:
        mixed = mixed.withColumn("copies", F.col("copies") + (F.col("part") > 0).cast("long")).withColumn(
            "part", F.lit(0).cast("long"))
    texts = F.array_repeat(F.col("text"), F.col("copies").cast("int"))
    cut = F.when(
        F.col("part") > 0, F.array(first_words(F.col("text"), F.col("part").cast("int")))
    ).otherwise(F.array().cast("array<string>"))
    return mixed.withColumn("text", F.explode(F.concat(texts, cut))).select(*restored(names))

"""Quality rules: lines that too many documents of a host share are removed, depleted texts rejected.

Per document the rules also give counts of symbols, repeated lines and repeated words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from invoicelake.llm.shared import BLANKS, lower_ascii, named_apart, numbered, restored, words
from invoicelake.operators.barrier import evaluate_once

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRule:
    """A line goes if at least `min_documents` different texts of a host have it.

    In a small host it also goes at `min_in_small` texts, if they are over `share` of the host's.
    """

    min_documents: int = 20
    min_in_small: int = 5
    share: float = 0.2
    min_words: int = 50
    max_repeated_share: float = 0.5
    min_words_left: float = 0.5


def _text_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` and the counts of one text each; nothing is shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(rf"[^{BLANKS}]"))
    split = evaluate_once(
        docs, *keep, _words=words(F.col("text")), _lines=lines,
        word_chars=F.char_length(F.regexp_replace(text, f"[{BLANKS}]+", "")).cast("long"),
        n_symbols=F.char_length(F.regexp_replace(text, rf"[^{SYMBOLS}]+", "")).cast("long"),
    )
    # A window of three words is known by its hash; most texts repeat none.
    n = F.size("_words")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(
        F.element_at("_words", i), F.element_at("_words", i + 1), F.element_at("_words", i + 2)
    ))).otherwise(F.array().cast("array<bigint>"))
    hashed = evaluate_once(
        split, *keep, "word_chars", "n_symbols", n_words=n.cast("long"), _windows=windows,
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    )
    repeats = F.size("_windows") > F.size(F.array_distinct("_windows"))
    in_order = F.when(repeats, F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    ))
    ordered = evaluate_once(
        hashed, *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", _sorted=in_order
    )
    last = F.size("_sorted") - 1
    same = lambda k, other: F.get("_sorted", k)["h"] == F.get("_sorted", other)["h"]
    at = F.sort_array(F.transform(
        F.filter(
            F.sequence(F.lit(0), last),
            lambda k: F.coalesce(same(k, k - 1), F.lit(False))
            | F.coalesce(same(k, k + 1), F.lit(False)),
        ),
        lambda k: F.get("_sorted", k)["at"],
    ))
    # Words covered by the repeated windows: each adds what the one before it has not covered.
    covered = F.aggregate(
        at, F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda sofar, x: F.struct(
            x.alias("at"), (sofar["n"] + F.least(F.lit(3), x - sofar["at"])).alias("n")
        ),
        lambda sofar: sofar["n"],
    )
    return ordered.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("_sorted").isNull(), F.lit(0)).otherwise(covered).cast("long")
        .alias("n_repeat_words"),
    )


def normal_line(line: Column) -> Column:
    """A-Z in lower case, blanks as one space each, none at the ends."""
    return F.trim(F.regexp_replace(lower_ascii(line), f"[{BLANKS}]+", " "))


def _never_null(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


_TEXT = ["_host", "_a", "_b"]


def _identity(host: str) -> list[Column]:
    """Host and text of a row, by hashes: copies have them in common, a null text is an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(_never_null(host)).alias("_host"), F.xxhash64(text).alias("_a"),
            F.hash(text).alias("_b")]


def host_lines(docs: DataFrame, host: str) -> DataFrame:
    """(_host, _a, _b, _line): the lines that the texts of a host have, each once."""
    exploded = docs.select(*_identity(host), F.explode(F.split("text", "\n")).alias("_raw"))
    return exploded.filter(F.col("_raw").rlike(rf"[^{BLANKS}]")).select(
        *_TEXT, F.xxhash64(normal_line(F.col("_raw"))).alias("_line")).distinct()


def frequent_lines(docs: DataFrame, lines: DataFrame, rule: LineRule, host: str) -> DataFrame:
    """(_host, _line) of the lines above the limits of the host."""
    per_host = docs.select(*_identity(host)).distinct().groupBy("_host").agg(
        F.count("*").alias("_texts"))
    # Counted with partial sums: a line that a third of all texts share is a few rows per task.
    found = lines.groupBy("_host", "_line").agg(F.count("*").alias("_with_line"))
    # A host in which the share decides has fewer texts than these; only lines of such hosts are joined.
    small = per_host.filter(F.col("_texts") * rule.share < rule.min_documents)
    return (
        found.filter(F.col("_with_line") >= min(rule.min_in_small, rule.min_documents))
        .join(small, "_host", "left")
        .filter((F.col("_with_line") >= rule.min_documents)
                | (F.col("_with_line") > F.col("_texts") * rule.share))
        .select("_host", "_line")
    )


def _without(lines: Column) -> Column:
    """The text without those of its lines that are among `lines`."""
    left = F.filter(
        F.split("text", "\n"), lambda x: ~F.array_contains(lines, F.xxhash64(normal_line(x))))
    return F.array_join(left, "\n")


def quality_rules(
    docs: DataFrame, rule: LineRule = LineRule(), host: str = "source"
) -> DataFrame:
    """The rows of `docs` with their counts, `clean_text`, `removed_words`, `base_failed` and `kept`.

    Counts are those of the whole text. `clean_text` is the text without the lines that are frequent
    in its host; it must have enough of the words for the document to be kept, and `removed_words` are
    those that it lacks. Equal texts of a host count as one document, whatever their ids,
    and all get the same answer: copies do not make their own lines frequent. A null text has no
    words and fails the base rules; a null host is a host of its own; an empty table gives an empty
    table. Other columns pass through; names of added columns are refused.
    """
    named_apart(docs, "text", host)
    added = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "clean_text", "removed_words", "base_failed", "kept"}
    if added & set(docs.columns):
        raise ValueError(f"the table already has one of the columns {sorted(added)}")
    lines = host_lines(docs, host)
    frequent = frequent_lines(docs, lines, rule, host)
    gone = lines.join(frequent, ["_host", "_line"], "left_semi").groupBy(*_TEXT).agg(
        F.collect_set("_line").alias("_gone"))
    slim, names = numbered(docs, "text")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counted = _text_counts(
        slim.select("*", *_identity(names[host])), [*names.values(), *_TEXT])
    # A text with a third of all rows has one row on the right; adaptive execution splits the left.
    marked = counted.join(gone, _TEXT, "left")
    own = [*names.values(), *counts]
    cleaned = evaluate_once(
        marked, *own, "_gone",
        clean_text=F.when(F.col("_gone").isNull(), F.col("text")).otherwise(_without(F.col("_gone"))))
    left = evaluate_once(
        cleaned, *own, "clean_text", _left=F.when(F.col("_gone").isNull(), F.col("n_words"))
        .otherwise(F.size(words(F.col("clean_text"))).cast("long")))
    base_failed = (F.col("n_words") < rule.min_words) | (
        F.col("n_repeat_words") > F.col("n_words") * rule.max_repeated_share
    )
    enough_left = F.col("_left") >= F.col("n_words") * rule.min_words_left
    return left.select(
        *restored(names), *counts, "clean_text",
        (F.col("n_words") - F.col("_left")).alias("removed_words"), base_failed.alias("base_failed"),
        (~base_failed & enough_left).alias("kept"),
    )


def without_frequent_lines(
    docs: DataFrame, rule: LineRule = LineRule(), host: str = "source"
) -> DataFrame:
    """The kept documents with the frequent lines of their host taken out of the text."""
    named_apart(docs, "text", host)
    slim, names = numbered(docs, "text")
    kept = quality_rules(slim, rule, names[host]).filter("kept")
    return kept.withColumn("text", F.col("clean_text")).select(*restored(names))

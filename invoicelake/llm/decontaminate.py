"""Benchmark decontamination with a distributed positional inverted index.

Every run of `window` consecutive words of a benchmark item is a phrase to be found. The corpus
counts of the benchmark's terms tell which terms of a phrase are rarest. The index stores postings
(term, document, position) of these terms. A search starts from the postings of the rarest term of
each phrase, turns positions into starts of the phrase, and keeps those that the postings of the
next terms confirm at their offsets: exactly there for a phrase match, within `slop` positions for a
proximity match. What remains is compared word by word with the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from invoicelake.llm.shared import ALNUM_WORD, lower_ascii, named_apart, numbered, restored, stored
from invoicelake.operators.barrier import evaluate_once


@dataclass(frozen=True)
class PhraseRule:
    window: int = 10  # words of a phrase
    lists: int = 3  # posting lists that are intersected for a phrase


def phrase_words(text: Column) -> Column:
    """Words as they stand; none for null. A word is compared in ASCII lower case."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(ALNUM_WORD), F.lit(0)), F.array())


def _document(key: str) -> Column:
    """Key and text tell documents apart; neither part is null."""
    return F.struct(
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("key"),
        F.xxhash64(F.col("text")).alias("text"),
    )


def _with_words(docs: DataFrame, key: str) -> DataFrame:
    return evaluate_once(docs, _doc=_document(key), _words=phrase_words(F.col("text")))


def phrases(items: DataFrame, rule: PhraseRule, item_key: str = "item_id") -> DataFrame:
    """(_phrase, _items): each different phrase with the ids of the items it comes from."""
    cut = evaluate_once(
        items, _item=F.col(item_key).cast("string"),
        _words=F.transform(phrase_words(F.col("text")), lower_ascii),
    )
    n = F.size("_words")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), n - rule.window + 1))
    return (
        cut.filter(n > 0).select("_item", "_words", F.explode(starts).alias("_start"))
        .select("_item", F.slice("_words", F.col("_start"), rule.window).alias("_phrase"))
        .groupBy("_phrase").agg(F.sort_array(F.collect_set("_item")).alias("_items"))
    )


def rarest_terms(docs: DataFrame, wanted: DataFrame, rule: PhraseRule, key: str) -> DataFrame:
    """`wanted` with `_terms`: up to `lists` (term, offset) of the phrase, rarest in `docs` first.

    Phrases with a term that no document has are left out.
    """
    term_rows = wanted.select("_phrase", F.posexplode("_phrase").alias("_offset", "_term"))
    vocabulary = stored(term_rows.select("_term").distinct())
    counts = stored(
        _with_words(docs, key).select(F.explode("_words").alias("_word"))
        .select(lower_ascii(F.col("_word")).alias("_term"))
        .join(vocabulary, "_term", "left_semi")
        .groupBy("_term").agg(F.count("*").alias("_count"))
    )
    ranked = (
        term_rows.join(counts, "_term")
        .groupBy("_phrase").agg(
            F.sort_array(F.collect_list(F.struct("_count", "_offset", "_term"))).alias("_all")
        )
        .filter(F.size("_all") == F.size("_phrase"))
    )
    return ranked.join(wanted, "_phrase").select(
        "_phrase", "_items", F.slice("_all", 1, rule.lists).alias("_terms")
    )


def posting_index(docs: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """The stored index: (_term, _doc, _at) of the given terms in all documents."""
    return stored(
        _with_words(docs, key).select("_doc", F.posexplode("_words").alias("_at", "_word"))
        .select("_doc", "_at", lower_ascii(F.col("_word")).alias("_term"))
        .join(terms, "_term", "left_semi")
    )


def find_phrases(
    docs: DataFrame, items: DataFrame, rule: PhraseRule = PhraseRule(), slop: int = 0,
    key: str = "doc_id", item_key: str = "item_id",
) -> DataFrame:
    """(_doc, _start, _phrase, _items): where the rarest terms of a phrase stand in documents.

    With `slop` 0 the terms stand at their offsets from `_start`; else each may be up to `slop`
    positions off. Searches begin at the rarest term and each step can only lose candidates.
    """
    wanted = stored(phrases(items, rule, item_key))
    probes = stored(rarest_terms(docs, wanted, rule, key))
    terms = stored(probes.select(F.explode("_terms._term").alias("_term")).distinct())
    index = posting_index(docs, terms, key)
    probe = F.get("_terms", F.lit(0))
    found = index.join(
        probes.select("_phrase", "_items", "_terms", probe["_term"].alias("_term"),
                      probe["_offset"].alias("_offset")), "_term",
    ).withColumn("_start", F.col("_at") - F.col("_offset")).drop("_term", "_at", "_offset")
    if not slop:
        found = found.filter("_start >= 0")
    for step in range(1, rule.lists):
        term = F.get("_terms", F.lit(step))
        open_, done = found.filter(F.size("_terms") > step), found.filter(F.size("_terms") <= step)
        aim = open_.withColumn("_term", term["_term"])
        at = F.col("_start") + term["_offset"]
        if slop:
            aim = aim.withColumn("_off", F.explode(F.sequence(F.lit(-slop), F.lit(slop))))
            at = at + F.col("_off")
        hits = aim.withColumn("_at", at).join(index, ["_doc", "_term", "_at"], "left_semi")
        if slop:
            hits = hits.drop("_off").dropDuplicates(["_doc", "_start", "_phrase"])
        found = hits.drop("_term", "_at").unionByName(done)
    return found.drop("_terms")


def decontaminate(
    docs: DataFrame, items: DataFrame, rule: PhraseRule = PhraseRule(),
    key: str = "doc_id", item_key: str = "item_id",
) -> DataFrame:
    """The rows of `docs` with `n_words`, `n_hit`, `n_items`, `items` and `contaminated`.

    A word is hit if it lies in an occurrence of a phrase; `items` are the ids, as sorted strings,
    of the items with a phrase in the document. Texts without words, null ones included, have no
    hits; items without words have no phrase. Items without an id are searched as all others, so their
    words are hit; having no id, they are in neither `items` nor `n_items`. Repeated rows
    get equal answers. An empty table gives an empty table, an empty benchmark no hits. Other
    columns pass through; names of added columns are refused.
    """
    named_apart(docs, key, "text")
    named_apart(items, item_key, "text")
    added = {"n_words", "n_hit", "n_items", "items", "contaminated"}
    if added & set(docs.columns):
        raise ValueError(f"the table already has one of the columns {sorted(added)}")
    slim, names = numbered(docs, "text")
    docs_in = slim.withColumn("_doc", _document(names[key]))
    candidates = find_phrases(docs, items, rule, 0, key, item_key).groupBy("_doc").agg(
        F.collect_set(F.struct("_start", "_phrase", "_items")).alias("_found")
    )
    joined = evaluate_once(
        docs_in.join(candidates, "_doc", "left"), *names.values(), "_found",
        _words=phrase_words(F.col("text")),
    )
    # The text decides: terms between the intersected ones are compared here.
    sure = F.sort_array(F.filter("_found", lambda c: F.transform(F.slice(
        "_words", c["_start"] + 1, F.size(c["_phrase"])), lower_ascii) == c["_phrase"]))
    checked = evaluate_once(
        joined, *names.values(), n_words=F.size("_words").cast("long"),
        _sure=F.when(F.col("_found").isNotNull(), sure),
    )
    covered = F.aggregate(
        "_sure", F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda sofar, c: F.struct(
            F.greatest(sofar["upto"], c["_start"] + F.size(c["_phrase"])).alias("upto"),
            (sofar["n"] + F.greatest(F.lit(0), c["_start"] + F.size(c["_phrase"])
             - F.greatest(sofar["upto"], c["_start"]))).alias("n"),
        ),
        lambda sofar: sofar["n"],
    )
    items_hit = F.array_sort(F.array_distinct(F.flatten("_sure._items")))
    none = F.array().cast("array<string>")
    with_items = checked.select(
        *names.values(), "n_words",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(items_hit, none).alias("items"),
    )
    return with_items.select(
        *restored(names), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        "items", (F.col("n_hit") > 0).alias("contaminated"),
    )

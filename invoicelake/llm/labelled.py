"""Labelled documents for training: folds by document id, in a sample of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from invoicelake.llm.shared import named_apart

FOLDS = 5  # fold 0 is held out: nothing is learned from it
_GRAINS = 1_000_000


def fold(key: str = "doc_id") -> Column:
    """crc32 of the key's decimal text, modulo FOLDS; a null key is in no fold (-1)."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS, F.lit(-1)).cast("int")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, key: str = "doc_id"
) -> DataFrame:
    """(key, text, label, fold) of labelled documents outside fold 0: about `max_rows` at most.

    Above that number a share of the documents is taken, by the hash of the key, so that reruns
    agree. Rows without key or label are left out; of contradicting labels the larger counts, of
    repeated documents each row.
    """
    named_apart(docs, key, "text")
    named_apart(labels, key, label)
    known = labels.filter(F.col(label).isNotNull() & (fold(key) > 0)).groupBy(key).agg(
        F.max(label).cast("double").alias("label"))
    share = min(1.0, max_rows / max(1, known.count()))
    taken = F.pmod(F.xxhash64(F.lit(5), F.col(key)), F.lit(_GRAINS)) < int(share * _GRAINS)
    return docs.filter((fold(key) > 0) & taken).select(key, "text").join(
        known.filter(taken), key).withColumn("fold", fold(key))

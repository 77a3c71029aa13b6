"""Exact duplicates: digests looked up in a minimal perfect hash over those of a history.

The history's distinct digests are dealt to buckets of some thousand. Each bucket gets a minimal
perfect hash: level after level, digests that hash to a position of their own are settled and the
others go on, and the rank of a digest's position among all settled ones is its slot. Slots hold the
full digest, the locator of the row that stays, and the number of rows. New digests are looked up
in their bucket, and a slot counts only if its digest has the same bytes; those that are in no
slot form groups of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from invoicelake.llm.byte_words import mixed
from invoicelake.llm.shared import BLANKS, named_apart, stored

BUCKET_KEYS = 4096  # digests of a bucket; they are uniform, so no bucket grows far beyond
_ROOM = 2  # positions of a level for each digest that comes to it
_DIGEST_BYTES = 32
# Every run of blanks but a single space, which stays as it is.
_RUNS = rf"[\x09-\x0D][{BLANKS}]*|\x20[{BLANKS}]+"

Levels = tuple[np.ndarray, np.ndarray]  # size of each level, bits of all levels


def normalised(text: Column) -> Column:
    """Each run of blanks as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def exact_duplicates(docs: DataFrame, history: Column, key: str = "doc_id") -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256, in_history) for every row of `docs`.

    `history` says which rows are known already; the others are looked up in them. Rows are equal
    when their texts are, runs of blanks counted as one space and null as empty. Of equal rows one
    is kept, the one with the smallest key whether known or new; a row without key only where none
    has one. Of several rows with that key, exactly one is kept. `in_history` says whether
    the text is in the history; a null condition is not. An empty table gives no row. Other
    columns are not read, whatever their names; texts may have any length, as only
    digests are compared.
    """
    named_apart(docs, key, "text")
    rows = stored(docs.select(
        F.col(key).alias("id"),
        F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)).alias("digest"),
        F.coalesce(history, F.lit(False)).alias("old"),
    ).withColumn("row", F.monotonically_increasing_id()))
    buckets = math.ceil(max(1, rows.count()) / BUCKET_KEYS)
    groups = groups_of(
        perfect_hash(_winners(rows.filter("old"), buckets)),
        _winners(rows.filter("NOT old"), buckets),
    )
    return rows.join(groups, "digest").select(
        F.col("id").alias(key), F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "in_history",
    )


def _winners(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, digest, winner, size): one row for each distinct digest, however many rows have it."""
    missing = F.when(F.col("id").isNull(), 1).alias("missing")  # null sorts first
    locator = F.struct(missing, "id", "row")
    return rows.groupBy("digest").agg(
        F.min(locator).alias("winner"), F.count("*").alias("size")
    ).withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))


def perfect_hash(winners: DataFrame) -> DataFrame:
    """The index: (bucket, levels, bits, digests, winners, sizes), one row for each bucket.

    `digests` holds the digest of each slot one after another, `winners` and `sizes` an element
    for each slot.
    """
    kind = winners.schema["winner"].dataType.simpleString()
    return stored(winners.groupBy("bucket").applyInArrow(
        _index,
        f"bucket bigint, levels array<bigint>, bits binary, digests binary, "
        f"winners array<{kind}>, sizes array<bigint>",
    ))


def groups_of(index: DataFrame, winners: DataFrame) -> DataFrame:
    """(digest, keep, group_size, in_history) of all groups, known and new ones."""
    kind = winners.schema["winner"].dataType.simpleString()
    found = index.groupBy("bucket").cogroup(winners.groupBy("bucket")).applyInArrow(
        _lookup(winners),
        f"digest binary, known {kind}, n_known bigint, added {kind}, n_added bigint",
    )
    return found.select(
        "digest", F.least("known", "added").alias("keep"),
        (F.col("n_known") + F.col("n_added")).alias("group_size"),
        F.col("known").isNotNull().alias("in_history"),
    )


def _numbers(digests: bytes) -> np.ndarray:
    """Four 64-bit numbers for each digest."""
    return np.frombuffer(digests, dtype="<u8").reshape(-1, _DIGEST_BYTES // 8)


def _positions(numbers: np.ndarray, level: int, size: int) -> np.ndarray:
    out = np.full(len(numbers), level + 1, dtype=np.uint64)
    for part in numbers.T:
        out = mixed(out ^ part)
    return (out % np.uint64(size)).astype(np.int64)


def build_levels(numbers: np.ndarray) -> tuple[Levels, np.ndarray]:
    """The levels for distinct digests, and the slot of each."""
    left, sizes, places, start = np.arange(len(numbers)), [], np.empty(len(numbers), np.int64), 0
    while len(left):
        size = _ROOM * len(left)
        at = _positions(numbers[left], len(sizes), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        places[left[alone]] = start + at[alone]
        left, start = left[~alone], start + size
        sizes.append(size)
    bits = np.zeros(start, dtype=np.uint8)
    bits[places] = 1
    return (np.array(sizes, np.int64), bits), np.cumsum(bits, dtype=np.int64)[places] - 1


def find_slots(levels: Levels, numbers: np.ndarray) -> np.ndarray:
    """The only slot that each digest can have, -1 if none."""
    sizes, bits = levels
    slots, left, start = np.full(len(numbers), -1, np.int64), np.arange(len(numbers)), 0
    ranks = np.cumsum(bits, dtype=np.int64) - 1
    for level, size in enumerate(sizes):
        at = start + _positions(numbers[left], level, int(size))
        here = bits[at] == 1
        slots[left[here]] = ranks[at[here]]
        left, start = left[~here], start + int(size)
    return slots


def _index(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    digests = b"".join(table["digest"].to_pylist())
    (sizes, bits), slots = build_levels(_numbers(digests))
    order = np.argsort(slots)
    by_slot = table.take(pa.array(order))
    listed = lambda c: pa.ListArray.from_arrays(
        pa.array([0, len(order)], pa.int32()), by_slot[c].combine_chunks())
    return pa.table({
        "bucket": table["bucket"].slice(0, 1),
        "levels": pa.array([sizes.tolist()], pa.list_(pa.int64())),
        "bits": [np.packbits(bits).tobytes()],
        "digests": [b"".join(by_slot["digest"].to_pylist())],
        "winners": listed("winner"),
        "sizes": listed("size"),
    })


def _lookup(winners: DataFrame) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(index: pa.Table, added: pa.Table) -> pa.Table:
        added = added.combine_chunks()
        digests = b"".join(added["digest"].to_pylist())
        numbers = _numbers(digests)
        if index.num_rows:
            sizes = np.array(index["levels"][0].as_py(), np.int64)
            bits = np.unpackbits(np.frombuffer(index["bits"][0].as_py(), np.uint8),
                                 count=int(sizes.sum()))
            held = index["digests"][0].as_py()
            slots = find_slots((sizes, bits), numbers)
            of_slot = _numbers(held)
            same = (of_slot[slots] == numbers).all(axis=1) & (slots >= 0)
            known, n_known = index["winners"][0].values, index["sizes"][0].values
        else:
            held, slots, same = b"", np.full(len(numbers), -1), np.zeros(len(numbers), bool)
            known, n_known = added["winner"].combine_chunks().slice(0, 0), pa.array([], pa.int64())
        n = len(held) // _DIGEST_BYTES
        row_of = np.full(n, -1)  # the new row of each slot
        row_of[slots[same]] = np.flatnonzero(same)
        fresh = np.flatnonzero(~same)
        none = np.full(len(fresh), -1)
        at_old = _or_null(np.concatenate([np.arange(n), none]))
        at_new = _or_null(np.concatenate([row_of, fresh]))
        all_digests = [held[i * _DIGEST_BYTES : (i + 1) * _DIGEST_BYTES] for i in range(n)]
        all_digests += [digests[i * _DIGEST_BYTES : (i + 1) * _DIGEST_BYTES] for i in fresh]
        return pa.table({
            "digest": pa.array(all_digests, pa.binary()),
            "known": known.take(at_old),
            "n_known": n_known.take(at_old).fill_null(0),
            "added": added["winner"].combine_chunks().take(at_new),
            "n_added": added["size"].combine_chunks().take(at_new).fill_null(0),
        })

    return run


def _or_null(at: np.ndarray) -> pa.Array:
    return pa.array(at, pa.int64(), mask=at < 0)

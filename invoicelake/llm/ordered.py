"""Order within groups of any size: numbers from sorted ranges, and digests of ordered texts."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from invoicelake.llm.shared import stored

CHUNK_BYTES = 1 << 20  # text of a chunk; one longer text is a chunk of its own
_ROW_BYTES = 64  # what a short row costs besides its text
EMPTY_SHA256 = sha256(b"").hexdigest()


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """`df` with the number (from 1) of each row in its group, nulls first; written and read again.

    Rows are sorted in ranges of (group, order), so a group of any size is spread over tasks. Only the
    ranges' row numbers are counted per group, as many as ranges hold it. Rows that agree
    in all of `order` are numbered one after another in no fixed order.
    """
    part, at = f"{name}_part", f"{name}_at"
    ranged = stored(
        df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
        .withColumn(part, F.spark_partition_id())
        .withColumn(at, F.monotonically_increasing_id())
    )
    first, count, before = f"{name}_first", f"{name}_count", f"{name}_before"
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(
        Window.unboundedPreceding, -1)
    held = ranged.groupBy(group, part).agg(
        F.min(at).alias(first), F.count("*").alias(count)
    ).withColumn(before, F.coalesce(F.sum(count).over(earlier), F.lit(0))).drop(count)
    a, b = ranged.alias("a"), held.alias("b")
    same = F.col(f"a.{group}").eqNullSafe(F.col(f"b.{group}")) & (
        F.col(f"a.{part}") == F.col(f"b.{part}"))
    number = F.col(f"a.{at}") - F.col(f"b.{first}") + F.col(f"b.{before}") + 1
    return a.join(b, same).select(
        *(F.col(f"a.{c}") for c in df.columns), number.cast("long").alias(name))


def ordered_sha256(
    df: DataFrame, group: list[str], order: list[str], text: str, separator: str, name: str
) -> DataFrame:
    """(group, name): SHA-256 in hex of each group's texts in order, joined by `separator`.

    A SHA-256 is a chain, so a group's bytes must pass one hash in order. All else is done before, in
    sorted ranges: they join the texts to chunks of some CHUNK_BYTES, and the task that
    hashes a group streams its chunks and holds one of them. Texts must not be null.
    """
    keys = [*group, *order]
    ranged = df.select(*keys, text).repartitionByRange(*keys).sortWithinPartitions(*keys)
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in group)
    chunks = ranged.select(*group, F.col(text).alias("text_")).mapInArrow(
        lambda batches: _chunks(batches, group, separator),
        f"{fields}, part_ bigint, seq_ bigint, text_ string",
    )
    # Adaptive execution merges small partitions and keeps them in order, so `part_` orders ranges.
    placed = chunks.repartition(*group).sortWithinPartitions(*group, "part_", "seq_")
    return placed.mapInArrow(
        lambda batches: _digests(batches, group, separator, name), f"{fields}, `{name}` string")


def _runs(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.Schema, tuple, str]]:
    """(types of the key, key, text) of each row; the key is the first `n` columns, the text the last."""
    for batch in batches:
        kinds = pa.schema([batch.schema.field(i) for i in range(n)])
        keys = zip(*(batch.column(i).to_pylist() for i in range(n)))
        for key, text in zip(keys, batch.column(batch.num_columns - 1)):
            yield kinds, key, text.as_py()


def _chunks(
    batches: Iterator[pa.RecordBatch], group: list[str], separator: str
) -> Iterator[pa.RecordBatch]:
    part, seq, size, ready = TaskContext.get().partitionId(), 0, 0, 0
    current, held, out, schema = None, [], [], None
    for kinds, key, text in _runs(batches, len(group)):
        schema = schema or _with(kinds, part_=pa.int64(), seq_=pa.int64(), text_=pa.string())
        if held and (key != current or size > CHUNK_BYTES):
            out.append((*current, part, seq, separator.join(held)))
            seq, ready, held, size = seq + 1, ready + size, [], 0
            if ready > 4 * CHUNK_BYTES:
                yield _batch(out, schema)
                out, ready = [], 0
        current = key
        held.append(text)
        size += len(text) + _ROW_BYTES
    if held:
        out.append((*current, part, seq, separator.join(held)))
        yield _batch(out, schema)


def _digests(
    batches: Iterator[pa.RecordBatch], group: list[str], separator: str, name: str
) -> Iterator[pa.RecordBatch]:
    current, digest, out, schema = None, None, [], None
    for kinds, key, text in _runs(batches, len(group)):
        schema = schema or _with(kinds, **{name: pa.string()})
        if digest is None or key != current:
            if digest is not None:
                out.append((*current, digest.hexdigest()))
            current, digest = key, sha256(text.encode())
        else:
            digest.update((separator + text).encode())
        if len(out) >= 4096:
            yield _batch(out, schema)
            out = []
    if digest is not None:
        out.append((*current, digest.hexdigest()))
        yield _batch(out, schema)


def _with(schema: pa.Schema, **more: pa.DataType) -> pa.Schema:
    for name, kind in more.items():
        schema = schema.append(pa.field(name, kind))
    return schema


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(map(list, zip(*rows)), schema)], schema=schema)

"""Exact substring deduplication with a distributed, sampled suffix array.

A byte goes if a string of `length` bytes that covers it also starts elsewhere, in the same text or in
another. Not every suffix is sorted at once. Every string of `length` bytes has one anchor: the place
in it where the hash of the next `GRAM` bytes is smallest. Equal strings have equal anchors, so
consecutive strings with one anchor form a family, known by its anchor's suffix.

1. Families are range-partitioned by the leading bytes of the anchor's suffix (Spark samples the
   splitters), sorted in their buckets and compared with their neighbours. Runs that lie at a bucket's
   edge are compared across the boundary. A gram that stands once rules its family out; equal
   families are repeated as a whole.
2. Only families that share a gram but differ go on, with their bytes, in parts of up to `PART` strings
   cut at fixed distances from the anchor. Bytes that all strings of a part have in common are its core;
   a core that stands once rules its part out. The others are again range-partitioned by leading bytes,
   all suffixes of a bucket are sorted by a multikey quicksort on eight-byte symbols, and equal strings
   found. Again the runs at the edges are compared across boundaries.

Sort keys end with the document and place, so that a run of equal keys, as of a passage that a third
of all texts share, is spread over many buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from invoicelake.llm.byte_words import SLICE_BYTES, span_hashes, text_slices
from invoicelake.llm.shared import named_apart, stored

LENGTH = 200
GRAM = 64
PART = 32
_PLACE = np.uint64((1 << 24) - 1)  # low bits of a gram's hash that hold its place in the slice
_DOC = "struct<key: string, text: bigint>"


def _document(key: str) -> Column:
    """Key and text; equal rows are copies of each other and get equal answers."""
    return F.struct(
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("key"),
        F.xxhash64(F.col("text")).alias("text"),
    )


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def symbols(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as one number that sorts like the bytes."""
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | data[at + i]
    return out


def families(data: np.ndarray, starts: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Row, first start, number of starts, and hashes of the families in a slice of texts."""
    windows = len(data) - length + 1
    if windows <= 0:
        return {}
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[:windows]
    valid = np.arange(windows) + length <= starts[row + 1]
    every = np.arange(len(data) - GRAM + 1)
    grams = span_hashes(data, every, every + GRAM)
    ranked = (grams & ~_PLACE) | every.astype(np.uint64)
    anchor = (_smallest(ranked, length - GRAM + 1) & _PLACE).astype(np.int64)
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    if not len(first):
        return {}
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | fresh[1:]
    n = np.flatnonzero(ends) - first + 1
    at = anchor[first]
    return {
        "row": row[first], "first": first, "n": n, "ahead": at - first, "gram": grams[at],
        "lead": symbols(data, at),
        "span": span_hashes(data, first, first + n - 1 + length),
    }


def _pieces(
    texts: pa.Array, length: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, offset in its text, bytes, row starts); long texts in overlapping pieces."""
    for first, data, starts in text_slices(texts):
        if len(data) <= 2 * SLICE_BYTES:
            yield first, 0, data, starts
            continue
        for at in range(0, len(data), SLICE_BYTES):  # one long text
            part = data[at : at + SLICE_BYTES + length - 1]
            yield first, at, part, np.array([0, len(part)])


def _all_families(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("_doc")
            for row, offset, data, starts in _pieces(batch.column("text"), length):
                f = families(data, starts, length)
                if f:
                    yield pa.RecordBatch.from_arrays(
                        [
                            docs.take(pa.array(f["row"] + row)),
                            pa.array(f["first"] - starts[f["row"]] + offset),
                            pa.array(f["n"]), pa.array(f["ahead"], pa.int32()), _ordered(f["lead"]),
                            pa.array(f["gram"].view(np.int64)), pa.array(f["span"].view(np.int64)),
                        ],
                        names=["_doc", "first", "n", "ahead", "lead", "gram", "span"],
                    )

    return run


def _ordered(symbol: np.ndarray) -> pa.Array:
    """Unsigned symbols as signed longs of the same order."""
    return pa.array((symbol ^ np.uint64(1 << 63)).view(np.int64))


def _bucket(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """A whole bucket: its size is set by the number of partitions, not by any key."""
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def _same_as_before(*columns: np.ndarray) -> np.ndarray:
    out = np.ones(len(columns[0]), dtype=bool)
    out[0] = False
    for c in columns:
        out[1:] &= c[1:] == c[:-1]
    return out


def _next(same: np.ndarray) -> np.ndarray:
    return np.append(same[1:], False)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`state` of sorted families: 0 gram stands once, 1 it is repeated, 2 the family is."""
    table = _bucket(batches)
    if table is None:
        return
    lead, gram, span = (table.column(c).to_numpy() for c in ("lead", "gram", "span"))
    as_gram = _same_as_before(lead, gram)
    as_span = as_gram & _same_as_before(span)
    state = (as_gram | _next(as_gram)).astype(np.int8)
    state[as_span | _next(as_span)] = 2
    run = np.cumsum(~as_gram)
    # What the bucket could not settle, and one of each set of equal families as their partner.
    edge = ((run == run[0]) | (run == run[-1])) & ((state < 2) | ~as_span)
    out = table.append_column("state", pa.array(state)).append_column(
        "shown", pa.array(~as_span)  # one of equal families stands for all
    ).append_column("edge", pa.array(edge))
    yield from out.filter(pa.array(edge | (state > 0))).to_batches()


def _repeated_families(docs: DataFrame, length: int) -> DataFrame:
    """The families whose gram is repeated, with `state` 1 or 2 and `shown`."""
    found = stored(docs.mapInArrow(
        _all_families(length),
        f"_doc {_DOC}, first bigint, n bigint, ahead int, lead bigint, gram bigint, span bigint",
    ))
    order = ["lead", "gram", "span", "_doc", "first"]
    compared = stored(
        found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _compared, T.StructType([
                *found.schema.fields, T.StructField("state", T.ByteType()),
                T.StructField("shown", T.BooleanType()), T.StructField("edge", T.BooleanType()),
            ]))
    )
    inner = compared.filter("NOT edge").drop("edge")
    edges = compared.filter("edge").drop("edge").withColumnRenamed("state", "found")
    spans = edges.groupBy("lead", "gram", "span").agg(F.count("*").alias("_same"))
    grams = spans.groupBy("lead", "gram").agg(F.sum("_same").alias("_all"))
    across = edges.join(spans, ["lead", "gram", "span"]).join(grams, ["lead", "gram"]).withColumn(
        "state", F.when((F.col("found") == 2) | (F.col("_same") > 1), 2)
        .when((F.col("found") == 1) | (F.col("_all") > 1), 1).otherwise(0).cast("byte")
    ).filter("state > 0")
    return stored(inner.unionByName(across.select(*inner.columns)))


def _family_bytes(length: int):
    """The bytes of the wanted families, and hashes of the cores of their parts, nearest to the anchor first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, texts = batch.column("_doc"), batch.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts)]
            held = np.frombuffer(texts.buffers()[2], np.uint8)
            wanted = batch.column("wanted")
            row_of = np.repeat(np.arange(len(docs)), wanted.value_lengths().to_numpy())
            fields = dict(zip(("first", "n", "ahead"), wanted.flatten().flatten()))
            upto = np.cumsum(fields["n"].to_numpy() - 1 + length)
            begin = 0
            while begin < len(row_of):  # some SLICE_BYTES at a time
                sofar = upto[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(upto, sofar + SLICE_BYTES)))
                some, rows = slice(begin, end), row_of[begin:end]
                first, n, ahead = (fields[c].to_numpy()[some] for c in ("first", "n", "ahead"))
                sizes = n - 1 + length
                starts = np.cumsum(sizes) - sizes
                data = held[np.repeat(offsets[rows] + first - starts, sizes) + np.arange(sizes.sum())]
                last = (ahead - n + 1) // PART
                parts = ahead // PART - last + 1
                ends = np.cumsum(parts)
                family = np.repeat(np.arange(len(parts)), parts)
                part = last[family] + np.arange(len(family)) - (ends - parts)[family]
                at = starts[family] + ahead[family] - PART * part
                cores = span_hashes(data, at, at + length - PART + 1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [docs.take(pa.array(rows)), pa.array(first), pa.array(n), pa.array(ahead, pa.int32()),
                     pa.LargeBinaryArray.from_buffers(
                         pa.large_binary(), len(n),
                         [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]
                     ).cast(pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(cores))],
                    names=["_doc", "first", "n", "ahead", "bytes", "cores"])
                begin = end

    return run


def _open_parts(families: DataFrame, length: int) -> DataFrame:
    """(_doc, first, n, lead, core, bytes) of the parts whose core stands more than once."""
    cores = families.select("_doc", "first", F.explode("cores").alias("core"))
    repeated = cores.groupBy("core").agg(F.count("*").alias("_times")).filter("_times > 1")
    kept = cores.join(repeated, "core", "left_semi").groupBy("_doc", "first").agg(
        F.collect_set("core").alias("kept"))
    part = F.expr(f"floor((ahead - n + 1) / {PART}) + at").cast("long")
    return families.join(kept, ["_doc", "first"]).select(
        "_doc", "first", "n", "ahead", "bytes", "kept", F.posexplode("cores").alias("at", "core")
    ).filter(F.array_contains("kept", F.col("core"))).withColumn("part", part).withColumn(
        "far", F.least("ahead", (F.col("part") + 1) * PART - 1)
    ).withColumn("near", F.greatest(F.expr("ahead - n + 1"), F.col("part") * PART)).selectExpr(
        "_doc", "first + ahead - far AS first", "far - near + 1 AS n",
        f"substring(bytes, int(ahead - part * {PART} + 1), 8) AS lead", "core",
        f"substring(bytes, int(ahead - far + 1), int(far - near + {length})) AS bytes")


def multikey_groups(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A number for each suffix, equal for suffixes that agree in their first `length` bytes.

    Multikey quicksort, all parts at once: suffixes that agree so far are sorted by their next
    symbol of eight bytes; those that are alone are done. -1: no other suffix is equal.
    """
    group = np.zeros(len(at), dtype=np.int64)
    left = np.arange(len(at))
    depth = 0
    while depth < length and len(left):
        step = min(depth, length - 8)  # the last symbol may overlap the one before it
        symbol = symbols(data, at[left] + step)
        order = np.lexsort((symbol, group[left]))
        left, symbol = left[order], symbol[order]
        mine = group[left]
        new = np.ones(len(left), dtype=bool)
        new[1:] = (mine[1:] != mine[:-1]) | (symbol[1:] != symbol[:-1])
        number = np.cumsum(new) - 1
        alone = new & np.append(new[1:], True)
        group[left] = number
        group[left[alone]] = -1
        left = left[~alone]
        depth += 8
    return group


def _equal_strings(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of repeated strings (hash null); of edge runs the strings that are still alone, and
        one of each set of equal ones as their partner, with their hash."""
        table = _bucket(batches)
        if table is None:
            return
        first, n, core = (table.column(c).to_numpy() for c in ("first", "n", "core"))
        docs = table.column("_doc").combine_chunks()
        run_of = np.cumsum(~_same_as_before(core))
        edges = np.flatnonzero(np.diff(run_of, append=run_of[-1] + 1)) + 1
        begin = 0
        while begin < len(n):  # whole runs, of about a million strings at a time
            some = edges[edges > begin]
            sizes = np.cumsum(n[begin:])[some - begin - 1]
            end = int(some[max(0, np.searchsorted(sizes, 1_000_000) - 1)])
            part = slice(begin, end)
            held = table.column("bytes").slice(begin, end - begin)
            data = np.frombuffer(b"".join(x.as_py() for x in held), dtype=np.uint8)
            starts = np.concatenate([[0], np.cumsum(n[part] - 1 + length)])[:-1]
            family = np.repeat(np.arange(end - begin), n[part])
            inside = np.arange(len(family)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
            at = starts[family] + inside
            group = multikey_groups(data, at, length)
            again = group >= 0
            edge = ((run_of[part] == run_of[0]) | (run_of[part] == run_of[-1]))[family]
            place = first[part][family] + inside
            # Consecutive repeated strings of a family are one interval.
            opens = again.copy()
            opens[1:] &= ~again[:-1] | (family[1:] != family[:-1])
            closes = again.copy()
            closes[:-1] &= ~again[1:] | (family[1:] != family[:-1])
            o, c = np.flatnonzero(opens), np.flatnonzero(closes)
            yield _strings(docs, core, begin + family[o], place[o], place[c] + length, None, False)
            partners = np.unique(group, return_index=True)[1]
            partners = partners[edge[partners] & again[partners]]
            for e, alone in ((np.flatnonzero(edge & ~again), True), (partners, False)):
                yield _strings(docs, core, begin + family[e], place[e], place[e] + length,
                               span_hashes(data, at[e], at[e] + length).view(np.int64), alone)
            begin = end

    return run


def _strings(docs, core, rows, begin, end, hashes, alone: bool) -> pa.RecordBatch:
    hashed = pa.nulls(len(rows), pa.int64()) if hashes is None else pa.array(hashes, pa.int64())
    return pa.RecordBatch.from_arrays(
        [docs.take(pa.array(rows, pa.int64())), pa.array(begin, pa.int64()),
         pa.array(end, pa.int64()), pa.array(core[rows]), hashed, pa.array(np.full(len(rows), alone))],
        names=["_doc", "begin", "end", "core", "hash", "alone"])


def repeated_intervals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(_doc, begin, end): bytes of repeated strings; intervals may overlap. `docs`: _doc, text."""
    kept = _repeated_families(docs, length)
    whole = kept.filter("state = 2").select(
        "_doc", F.col("first").alias("begin"), (F.col("first") + F.col("n") - 1 + length).alias("end"))
    # Families that differ though they share a gram: grams of which some family is not repeated.
    open_grams = kept.filter("state = 1").select("lead", "gram").distinct()
    wanted = kept.filter("state = 1 OR shown").join(open_grams, ["lead", "gram"], "left_semi")
    per_doc = wanted.groupBy("_doc").agg(
        F.collect_list(F.struct("first", "n", "ahead")).alias("wanted"))
    with_bytes = stored(docs.join(per_doc, "_doc").mapInArrow(
        _family_bytes(length),
        f"_doc {_DOC}, first bigint, n bigint, ahead int, bytes binary, cores array<bigint>"))
    order = ["lead", "core", "bytes", "_doc", "first"]
    strings = stored(
        _open_parts(with_bytes, length).repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_equal_strings(length),
                    f"_doc {_DOC}, begin bigint, end bigint, core bigint, hash bigint, alone boolean"))
    singles = strings.filter("hash IS NOT NULL")
    across = singles.filter("alone").join(
        singles.groupBy("core", "hash").agg(F.count("*").alias("_times")).filter("_times > 1"),
        ["core", "hash"], "left_semi")
    columns = ["_doc", "begin", "end"]
    return whole.unionByName(strings.filter("hash IS NULL").select(*columns)).unionByName(
        across.select(*columns))


def _merged(spans: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        sizes, removed, spans, kept, hashes = [], [], [], [], []
        for row, found in enumerate(batch.column("found")):
            text = texts[row].as_py() or b""
            gone = _merged([(f["begin"], f["end"]) for f in found.as_py()] if found.is_valid else [])
            left, at = [], 0
            for begin, end in gone:
                left.append(text[at:begin])
                at = end
            left.append(text[at:])
            rest = b"".join(left)
            sizes.append(len(text))
            removed.append(len(text) - len(rest))
            spans.append(gone)
            kept.append(rest)
            hashes.append(sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array([[{"begin": b, "end": e} for b, e in s] for s in spans],
                      pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
             pa.array(kept, pa.binary()), pa.array(hashes)],
            names=[batch.schema.names[0], "n_bytes", "n_removed", "spans", "kept", "kept_sha256"])


def suffix_dedup(docs: DataFrame, length: int = LENGTH, key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept, kept_sha256): one row per row of `docs`.

    `spans` are the removed bytes as maximal runs [begin, end) of the UTF-8 text, `kept` the bytes
    that stay. Texts are judged as they came, not as others leave them, so all copies of a string go.
    Null texts are empty; texts shorter than `length` lose nothing; repeated rows are copies of each
    other. An empty table gives an empty table; columns other than `key` and `text` are not read.
    """
    named_apart(docs, key, "text")
    if length < GRAM + 8:
        raise ValueError(f"length must be {GRAM + 8} at least")
    slim = docs.select(key, "text", _document(key).alias("_doc"))
    found = repeated_intervals(slim.select("_doc", "text"), length).groupBy("_doc").agg(
        F.collect_set(F.struct("begin", "end")).alias("found"))
    return slim.join(found, "_doc", "left").select(key, "text", "found").mapInArrow(
        _cut, T.StructType([
            docs.schema[key], T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType([
                T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
            T.StructField("kept", T.BinaryType()), T.StructField("kept_sha256", T.StringType()),
        ]))

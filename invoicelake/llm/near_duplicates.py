"""Near duplicates: MinHash signatures joined by a multi-index Hamming search.

A signature has `SLOTS` slots of 8 bits, each the low bits of the smallest hash of the shingle set
under one of as many orders; two slots agree with about the probability of the sets' similarity.
Signatures are cut into chunks of `CHUNK` slots. If two differ in at most `2 * CHUNKS - 1` slots, some
chunk differs in at most one (pigeonhole). All allowed errors of a chunk are enumerated by leaving
out each of its slots in turn, so such a pair always meets under an equal key. A pair of similarity
exactly 0.8 exceeds that distance with probability 2e-5; more similar pairs far more rarely.

Equal sets are one node. Under a key with few nodes all pairs are candidates. Under a key with many,
nodes are first compared with one node of the key, then with another, and links found so far are
gathered into components; nodes that are still in different components then meet by an exact prefix
filter on their shingles. So a large group of near copies costs some comparisons per member, and no pair is
left out whose link could still matter. Candidates within the distance are confirmed on the full sets. Before
that they must pass an exact bound: each shingle of a set flips one of `PARITIES` bits, so two sets differ in at least as many
shingles as their bits differ. It leaves no link out and stops most pairs of texts of usual length.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from invoicelake.llm.byte_words import mixed, shingle_sets
from invoicelake.llm.graph import components
from invoicelake.llm.shared import bucketed, named_apart, stored

SLOTS, CHUNK = 80, 5
CHUNKS = SLOTS // CHUNK
DISTANCE = 2 * CHUNKS - 1
PARITIES = 1024  # bits that a set's shingles flip
FEW = 8  # nodes under a key of which all pairs are compared at once

_ORDERS = mixed(np.arange(1, SLOTS + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 8-bit slots of the signature of a set that is not empty, worked on in blocks."""
    least = np.full(SLOTS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        block = shingles[at : at + 1024]
        np.minimum(least, (_ORDERS[:, None] * block[None, :]).min(axis=1), out=least)
    return (mixed(least) & np.uint64(255)).astype(np.uint8)


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each bit, as PARITIES / 8 bytes."""
    place = (shingles & np.uint64(PARITIES - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=PARITIES) & 1).astype(bool))


def _signed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, prints, slots = [], [], [np.empty((0, SLOTS), np.uint8)]
            bits = [np.empty((0, PARITIES // 8), np.uint8)]
            for shingles in shingle_sets(batch.column("text"), size):
                counts.append(len(shingles))
                if len(shingles):
                    prints.append(blake2b(shingles.tobytes(), digest_size=16).digest())
                    slots.append(signature(shingles)[None, :])
                    bits.append(parity_bits(shingles)[None, :])
                else:
                    prints.append(None)
            slots, filled = np.concatenate(slots), np.minimum(1, counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column("th"), pa.array(counts, pa.int64()),
                    pa.array(prints, pa.binary()),
                    _longs(slots, filled, CHUNK), _longs(np.concatenate(bits), filled, 8),
                ],
                names=["id", "th", "n", "print", "sig", "parity"],
            )

    return run


def _longs(slots: np.ndarray, filled: np.ndarray, wide: int) -> pa.Array:
    """`wide` slots to a long; one list of longs for each row that is filled, else an empty one."""
    longs = slots.shape[1] // wide
    padded = np.zeros((len(slots), longs, 8), dtype=np.uint8)
    padded[:, :, :wide] = slots.reshape(len(slots), longs, wide)
    starts = np.concatenate([[0], np.cumsum(filled)]) * longs
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(padded.view(np.int64).ravel()))


def _chunk_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = batch.column("node").to_numpy()
        slots = batch.column("sig").flatten().to_numpy().view(np.uint8)
        slots = slots.reshape(len(nodes), CHUNKS, 8)[:, :, :CHUNK].reshape(len(nodes), SLOTS)
        keys = np.empty((len(nodes), SLOTS), dtype=np.int64)
        for at in range(SLOTS):
            first = at - at % CHUNK
            rest = [s for s in range(first, first + CHUNK) if s != at]
            key = np.full(len(nodes), at, dtype=np.int64)
            for s in rest:
                key = (key << 8) | slots[:, s]
            keys[:, at] = key
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(nodes, SLOTS)), pa.array(keys.ravel())], names=["node", "key"]
        )


def differing(a: Column, b: Column) -> Column:
    """The number of slots in which two longs of slots differ."""
    x = a.bitwiseXOR(b)
    for shift in (4, 2, 1):
        x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
    return F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))


def distance(a: Column, b: Column) -> Column:
    """The number of slots in which two signatures differ, spelled out for generated code."""
    total = F.lit(0)
    for chunk in range(CHUNKS):
        total = total + differing(F.get(a, F.lit(chunk)), F.get(b, F.lit(chunk)))
    return total


def may_be_linked(percent: int, n_a: Column, n_b: Column, a: Column, b: Column) -> Column:
    """Whether the sizes and parity bits of two sets leave them a similarity of `percent`."""
    differ = F.lit(0)
    for at in range(PARITIES // 64):
        differ = differ + F.bit_count(F.get(a, F.lit(at)).bitwiseXOR(F.get(b, F.lit(at))))
    return (100 - percent) * (n_a + n_b) >= (100 + percent) * differ


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.tobytes() for s in shingle_sets(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(found, pa.binary())], names=["node", "shingles"]
            )

    return run


def _each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(s.as_buffer(), dtype=np.int64) for s in batch.column("shingles")]
        for at in range(0, len(sets), 1000):  # some 1000 sets at a time
            part = sets[at : at + 1000]
            nodes = batch.column("node").to_numpy()[at : at + 1000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(nodes, [len(s) for s in part])), pa.array(np.concatenate(part))],
                names=["node", "shingle"])


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


class _Links:
    """Confirms candidate pairs of nodes, on full sets that are fetched once."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> None:
        self.docs, self.nodes, self.size, self.percent = docs, nodes, size, percent

    def near(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and signatures allow a link."""
        side = lambda s: self.nodes.select(
            F.col("node").alias(s), F.col("sig").alias(f"sig_{s}"), F.col("n").alias(f"n_{s}"),
            F.col("parity").alias(f"parity_{s}"))
        return stored(pairs.join(side("a"), "a").join(side("b"), "b").filter(
            (100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
            & (distance(F.col("sig_a"), F.col("sig_b")) <= DISTANCE)
            & may_be_linked(self.percent, *map(F.col, ("n_a", "n_b", "parity_a", "parity_b")))
        ).select("a", "b"))

    def fetch(self, wanted: DataFrame) -> None:
        """Makes the sets of the nodes in `wanted` (node), the only ones that pairs may name later.

        The texts are moved for this, so it is done once; the sets are kept in buckets of their
        node, so that no later join moves them. The wanted rows grow with the corpus: never broadcast.
        """
        reps = wanted.distinct().join(self.nodes, "node").select(
            "node", F.col("rep.id").alias("_id"), F.col("rep.th").alias("_th"))
        self.sets, self.table = bucketed(
            self.docs.join(reps.hint("merge"), F.expr("th = _th AND id <=> _id"))
            .dropDuplicates(["node"]).select("node", "text")
            .mapInArrow(_sets(self.size), "node bigint, shingles binary"), "node")

    def close(self) -> None:
        """Forgets the table of the sets; all that was asked of it is stored by now."""
        self.nodes.sparkSession.sql(f"DROP TABLE {self.table}")

    def confirmed(self, near: DataFrame) -> DataFrame:
        """The links among pairs whose sizes and signatures have been compared."""
        side = lambda s: self.sets.select(
            F.col("node").alias(s), F.col("shingles").alias(f"s{s}"))
        return stored(
            near.join(side("a"), "a").join(side("b"), "b")
            .mapInArrow(_confirmed(self.percent), "a bigint, b bigint")
        )

    def postings(self, members: DataFrame) -> DataFrame:
        """(node, shingle, nodes): every shingle of `members` (node), and how many of them have it."""
        each = self.sets.join(members, "node", "left_semi").mapInArrow(
            _each_shingle, "node bigint, shingle bigint").repartition("shingle")
        common = each.groupBy("shingle").agg(F.count("*").alias("nodes"))
        return each.join(common, "shingle")


def _members(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, th, n, root) of every row; root is null where there is no shingle."""
    signed = docs.mapInArrow(_signed(size), T.StructType([
        T.StructField("id", docs.schema["id"].dataType), T.StructField("th", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("print", T.BinaryType()),
        T.StructField("sig", T.ArrayType(T.LongType())),
        T.StructField("parity", T.ArrayType(T.LongType())),
    ]))
    rows = stored(signed)
    # Stored with their numbers, so that a repeated task cannot number nodes anew.
    nodes = stored(
        rows.filter("n > 0").groupBy("print").agg(
            F.first("sig").alias("sig"), F.first("parity").alias("parity"), F.first("n").alias("n"),
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "th")).alias("rep"),
        ).withColumn("node", F.monotonically_increasing_id())
    )
    # Counted and joined in the partitions of one shuffle.
    keys = nodes.select("node", "sig").mapInArrow(
        _chunk_keys, "node bigint, key bigint").repartition("key")
    shared_keys = keys.groupBy("key").agg(
        F.count("*").alias("members"), F.min("node").alias("first")
    ).filter("members > 1")
    busy = stored(keys.join(shared_keys, "key"))
    # Signatures are moved once; after that only those of nodes that share a key.
    met = stored(nodes.join(busy.select("node").distinct(), "node", "left_semi"))
    links = _Links(docs, met, size, percent)

    few = busy.filter(F.col("members") <= FEW).groupBy("key").agg(
        F.sort_array(F.collect_list("node")).alias("all"))
    few_pairs = few.select(F.explode(F.flatten(F.transform(
        "all", lambda x, i: F.transform(
            F.slice("all", i + 2, FEW), lambda y: F.struct(x.alias("a"), y.alias("b")))
    ))).alias("p")).select("p.*")
    many = busy.filter(F.col("members") > FEW)
    stars = many.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    near = links.near(few_pairs.unionByName(stars).distinct())
    links.fetch(near.select(F.explode(F.array("a", "b")).alias("node")).unionByName(
        many.select("node")))
    roots = components(links.confirmed(near))
    if not many.isEmpty():
        placed = _in_components(many, roots)
        others = many.groupBy("key").agg(F.min_by("node", F.xxhash64("node", "key")).alias("other"))
        again = _in_components(
            placed.withColumnsRenamed({"root": "node_root"}).join(others, "key"), roots, of="other"
        ).filter("node_root <> root").select(
            F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        roots = _grown(roots, links.confirmed(links.near(again)))
        roots = _grown(roots, links.confirmed(links.near(
            _still_apart(_in_components(many, roots), links))))
    links.close()
    members = nodes.join(roots, "node", "left").select(
        "print", F.coalesce("root", "node").alias("root"))
    return rows.select("id", "th", "n", "print").join(members, "print", "left").drop("print")


def _in_components(table: DataFrame, roots: DataFrame, of: str = "node") -> DataFrame:
    return table.join(
        roots.select(F.col("node").alias(of), F.col("root")), of, "left"
    ).withColumn("root", F.coalesce("root", of))


def _grown(roots: DataFrame, more: DataFrame) -> DataFrame:
    """The components after more links."""
    if more.isEmpty():
        return roots
    return components(more.unionByName(
        roots.filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))))


def _open(placed: DataFrame, key: str) -> DataFrame:
    """The rows of the keys whose nodes are in more than one component."""
    keys = placed.groupBy(key).agg(
        F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select(key)
    return placed.join(keys, key, "left_semi")


def _still_apart(placed: DataFrame, links: _Links) -> DataFrame:
    """Pairs of nodes in different components that share a key and may be similar enough.

    Keys all of whose nodes are in one component are done. The nodes of the others meet by an exact prefix
    filter instead of in pairs: shingles are ordered by how many of these nodes have them, rare ones first. A set
    of n shingles has at least t n in common with a larger set of similarity t, and 2t / (1 + t) n with one that
    is not smaller; so the smaller set's first n - 2t / (1 + t) n + 1 shingles and the larger one's first
    n - t n + 1 have one in common. Pages that share a template but not enough of it have only
    shingles of their own there, and meet nobody. Sizes and parity bits are compared where two meet.
    """
    percent = links.percent
    undecided = stored(
        _open(placed.select("key", "node", "root"), "key").select("node", "root").distinct())
    here = Window.partitionBy("node")
    common = links.postings(undecided.select("node")).filter("nodes > 1").select(
        "node", "shingle", F.count("*").over(here).alias("common"),
        F.row_number().over(here.orderBy("nodes", "shingle")).alias("place"))
    # Shingles that a node has for itself come before all others, and bound what it can have in common.
    ranked = common.join(undecided, "node").join(links.nodes.select("node", "n", "parity"), "node").filter(
        100 * F.col("common") >= percent * F.col("n")
    ).withColumn("rank", F.col("n") - F.col("common") + F.col("place"))
    # Of a set, how many first shingles are looked up by larger ones, and how many it looks up.
    held = F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)) + 1
    asked = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    prefixes = stored(_open(ranked.filter(F.col("rank") <= asked).select(
        "shingle", "node", "root", "n", "common", "parity", (F.col("rank") <= held).alias("held")
    ), "shingle"))
    side = lambda s: prefixes.select(
        "shingle", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "root", "n", "common", "parity", "held")))
    a, b = side("a").filter("held_a").alias("a"), side("b").alias("b")
    most = F.least("common_a", "common_b")
    meet = (
        (F.col("a.shingle") == F.col("b.shingle")) & (F.col("root_a") != F.col("root_b"))
        & ((F.col("n_a") < F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b")))
        & (100 * F.col("n_a") >= percent * F.col("n_b"))
        & (100 * most >= percent * (F.col("n_a") + F.col("n_b") - most))
        & may_be_linked(percent, *map(F.col, ("n_a", "n_b", "parity_a", "parity_b")))
    )
    return a.join(b, meet).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id"
) -> DataFrame:
    """(key, th, n_shingles, component_id, kept): one row per row of `docs`.

    `th` is xxhash64 of the text. Documents are linked if 100 times the common shingles are at
    least `percent` times all shingles of both; `component_id` is the smallest key reachable over
    links (null if no document of the component has a key) and `kept` says that it is the row's own.
    Texts without words, null ones included, have no shingles and are linked with nothing. Repeated
    rows are links of one component and get equal answers. An empty table gives an empty table;
    columns other than `key` and `text` are not read.
    """
    rows = _clustered(docs, shingle, percent, key)
    smallest = rows.groupBy("root").agg(F.min("id").alias("smallest"))
    own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("smallest"))
    return rows.join(smallest, "root", "left").withColumn("component_id", own).select(
        F.col("id").alias(key), "th", F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _clustered(docs: DataFrame, shingle: int, percent: int, key: str) -> DataFrame:
    named_apart(docs, key, "text")
    slim = docs.select(F.col(key).alias("id"), F.xxhash64(F.col("text")).alias("th"), "text")
    return _members(slim, shingle, percent)


def without_near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id"
) -> DataFrame:
    """The rows of `docs` but for all but one of each group of linked documents.

    The one that stays is that with the smallest key (no key: last), then the smallest text hash;
    of repeated rows one stays. Texts without shingles all stay.
    """
    rows = _clustered(docs, shingle, percent, key)
    ranked = F.struct(F.col("id").isNull().alias("no_id"), "id", "th")
    stay = rows.filter("n > 0").groupBy("root").agg(F.min(ranked).alias("best")).select(
        F.col("best.id").alias("_id"), F.col("best.th").alias("_th"))
    empty = rows.filter("n = 0").select("id", "th").distinct()
    # The user's columns travel as one, so that no name of theirs meets one of ours.
    carried = docs.select(F.struct("*").alias("doc")).select(
        "doc", F.col(f"doc.`{key}`").alias("doc_key"), F.xxhash64("doc.text").alias("doc_th"))
    same = F.expr("doc_th = _th AND doc_key <=> _id")
    whole = carried.join(
        empty.select(F.col("id").alias("_id"), F.col("th").alias("_th")), same, "left_semi")
    one = carried.join(stay, same).dropDuplicates(["doc_key", "doc_th"])
    return one.select("doc.*").unionByName(whole.select("doc.*"))

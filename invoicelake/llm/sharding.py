"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard has many virtual nodes on a ring of `POINTS` points; a row belongs to the first virtual
node at or after its own point. A shard takes no more rows than its bound; what overflows goes on
clockwise to the next virtual node whose shard has room. The bounds are the row count divided by the
number of shards, rounded down for some and up for the others, so counts differ by one at most.

Rows are never brought together to count them: they are counted per ring point, the counts are
summed per virtual node, and the walk round the ring moves only these sums (at most shards times
virtual nodes, whatever the input). A row finds its place by its rank among the rows of its point.
"""

from __future__ import annotations

from bisect import bisect_left
from hashlib import blake2b

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from invoicelake.llm.shared import named_apart, numbered, restored, stored

POINTS = 1 << 20
VIRTUAL_NODES = 64


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(point, shard) of the virtual nodes in ring order; a point is taken by the lower shard."""
    if shards < 1:
        raise ValueError("there must be a shard")
    points: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
            points.setdefault(int.from_bytes(digest, "big") % POINTS, shard)
    return sorted(points.items())


def walk(
    nodes: list[tuple[int, int]], loads: list[int], shards: int
) -> list[tuple[int, int, int, int]]:
    """Pieces (node, first rank, rows, shard): which shard takes which rows of a virtual node.

    `loads` are the rows that belong to each node. In the first turn every node offers its rows to
    its own shard; what a full shard refuses moves one node on, turn by turn.
    """
    total = sum(loads)
    low, more = divmod(total, shards)
    room = [low + (s < more) for s in range(shards)]
    pieces: list[tuple[int, int, int, int]] = []
    waiting = [[(n, 0, load)] if load else [] for n, load in enumerate(loads)]
    while any(waiting):
        moved: list[list[tuple[int, int, int]]] = [[] for _ in nodes]
        for at, (_, shard) in enumerate(nodes):
            for node, first, rows in waiting[at]:
                taken = min(rows, room[shard])
                if taken:
                    room[shard] -= taken
                    pieces.append((node, first, taken, shard))
                if rows > taken:
                    moved[(at + 1) % len(nodes)].append((node, first + taken, rows - taken))
        waiting = moved
    return sorted(pieces)


def ring_point(*key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(POINTS)).cast("int")


def shard_rows(
    df: DataFrame, key: list[str], shards: int, virtual_nodes: int = VIRTUAL_NODES
) -> DataFrame:
    """The rows of `df` with `shard` (0 to shards - 1) and `slot` (0, 1, ... in each shard).

    `key` names the columns that place a row on the ring; rows of one point are ranked by all key
    columns, so equal rows are interchangeable and reruns agree. Null keys are a key like any other.
    An empty table gives an empty table. Columns of `df` named `shard` or `slot` are refused; all others pass
    through, whatever they are called.
    Repeated rows all belong to one point: they are ranked together, so `key` should tell rows apart.
    """
    named_apart(df, *key)
    if {"shard", "slot"} & set(df.columns):
        raise ValueError("the table already has a column shard or slot")
    spark = df.sparkSession
    # (point, rank in the point): one shuffle of the rows, which ring points spread evenly.
    rows, names = numbered(df)
    at_point = Window.partitionBy("_point").orderBy(*[F.col(names[c]).asc_nulls_last() for c in key])
    ranked = rows.withColumn("_point", ring_point(*[F.col(names[c]) for c in key]))
    counts = stored(ranked.groupBy("_point").agg(F.count("*").alias("_rows")))

    nodes = ring(shards, virtual_nodes)
    node_of = _node_of_point(spark, nodes)
    by_node = counts.join(F.broadcast(node_of), "_point")  # POINTS rows at most
    # Bounded by shards * virtual nodes, however many rows there are.
    loads = [0] * len(nodes)
    for row in by_node.groupBy("_node").agg(F.sum("_rows").alias("n")).collect():
        loads[row["_node"]] = row["n"]
    # Ring order inside a node runs from the point after the previous node.
    in_node = Window.partitionBy("_node").orderBy("_order")
    offsets = by_node.select(
        "_point", "_node",
        (F.sum("_rows").over(in_node) - F.col("_rows")).alias("_before"),
    )
    pieces = _with_slots(walk(nodes, loads, shards))
    per_node = spark.createDataFrame(
        [(n, p) for n, p in sorted(pieces.items())],
        "_node int, _pieces array<struct<first: bigint, rows: bigint, shard: int, slot: bigint>>",
    )
    placed = offsets.join(F.broadcast(per_node), "_node").drop("_node")
    ranked = ranked.withColumn("_rank", F.row_number().over(at_point) - 1)
    rank = F.col("_before") + F.col("_rank")
    piece = F.element_at(
        F.filter("_pieces", lambda p: (rank >= p["first"]) & (rank < p["first"] + p["rows"])), 1
    )
    return (
        ranked.join(placed, "_point")
        .withColumn("_piece", piece)
        .select(
            *restored(names),
            F.col("_piece.shard").alias("shard"),
            (F.col("_piece.slot") + rank - F.col("_piece.first")).alias("slot"),
        )
    )


def _node_of_point(spark: SparkSession, nodes: list[tuple[int, int]]) -> DataFrame:
    """(_point, _node, _order) of every ring point, made from the few points of the nodes."""
    points = [p for p, _ in nodes]
    starts = [0, *(p + 1 for p in points)]  # the arc that ends in node n; the last one wraps round
    arcs = [
        (first, last, n % len(points), 0 if n < len(points) else -POINTS)
        for n, (first, last) in enumerate(zip(starts, [*points, POINTS - 1]))
        if first <= last
    ]
    table = spark.createDataFrame(arcs, "first int, last int, _node int, shift int")
    return table.select(
        F.explode(F.sequence("first", "last")).alias("_point"), "_node", "shift"
    ).select("_point", "_node", (F.col("_point") + F.col("shift")).alias("_order"))


def _with_slots(
    pieces: list[tuple[int, int, int, int]],
) -> dict[int, list[tuple[int, int, int, int]]]:
    filled: dict[int, int] = {}
    by_node: dict[int, list[tuple[int, int, int, int]]] = {}
    for node, first, rows, shard in pieces:
        slot = filled.get(shard, 0)
        filled[shard] = slot + rows
        by_node.setdefault(node, []).append((first, rows, shard, slot))
    return by_node


def node_of(point: int, nodes: list[tuple[int, int]]) -> int:
    """The index of the node that a point belongs to (the law of the ring, for tests)."""
    return bisect_left([p for p, _ in nodes], point) % len(nodes)

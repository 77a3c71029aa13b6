"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from invoicelake.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    Each round hangs the larger neighbours of a node on its smallest one, then the smaller ones.
    Edges never grow in number, rounds grow with the logarithm of a component's size, and each
    round is written to the shared folder. Nothing but two sums comes to the driver.
    """
    now = stored(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(
            F.inline(F.array(
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            ))
        ).filter("a <> b").distinct()
        now = stored(small)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple[int, int, int]:
    """Equal for equal sets of edges; two independent checksums of the edges and their number."""
    sums = edges.agg(
        F.count("*"),
        F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)),
        F.coalesce(F.bit_xor(F.xxhash64("b", F.lit(7), "a")), F.lit(0)),
    ).first()
    return tuple(sums)

"""The trie of conversation prefixes, with totals of every subtree.

A node is a distinct sequence of first turns. Its key is the exclusive or of the hashes of its turns at
their depths, so that keys of long conversations are made from those of their pieces.

Totals of subtrees come from a rollup in bands of BAND depths. Within a band every node adds its value
to its ancestors there, at most BAND of them. The roots of bands, with what their bands add up to, form a
tree that is BAND times lower, on which the same is done; its totals then go back to
the nodes of the bands above. So the number of rounds is the logarithm of the depth to the base BAND.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from invoicelake.llm.ordered import EMPTY_SHA256, numbered, ordered_sha256
from invoicelake.llm.shared import named_apart, stored

BAND = 32  # keys are (a, b); that of the root is (0, 0)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, number, mark, chars): the turns of each conversation, numbered from 1.

    By turn (null first), then role and text digest; a null role or text is empty. `mark` is the
    same for turns of equal role and text, `chars` counts the text's code points. Rows without
    conv_id belong to no conversation and are left out; repeated rows are turns of their own.
    """
    named_apart(conversations, "conv_id", "turn", "role", "text")
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return numbered(
        conversations.filter("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
            F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
                           .cast("binary"), 256)).alias("mark"),
            F.char_length(text).cast("bigint").alias("chars"),
        ), "conv_id", ["turn", "role", "mark"], "number",
    ).drop("turn", "role")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row for each node of the trie of all `members`.

    `turns` has (conv_id, depth, mark, chars) with depths from 1 without gaps, `members` every
    conv_id once, those without turns too. Returns (conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256): the smallest member; the depth; the parent's smallest
    member (the root: null); members; children; childless nodes of the subtree; the sum over the
    subtree of (members - 1) * chars of the last turn; the SHA-256 of the members that end here. Without
    members there is no node, not even the root. Texts of any length count by mark and chars alone.
    """
    rows = stored(_keyed(turns))
    nodes = stored(_nodes(rows, members))
    n_children = nodes.filter("depth > 0").groupBy("up_a", "up_b").agg(
        F.count("*").alias("n_children")).select(
        F.col("up_a").alias("a"), F.col("up_b").alias("b"), "n_children")
    counted = stored(nodes.join(n_children, ["a", "b"], "left").select(
        nodes["*"], F.coalesce("n_children", F.lit(0)).alias("n_children")))
    values = counted.select(
        "a", "b", "depth", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    totals = _subtree_totals(rows, values, ["n_leaves", "saved_tokens"])
    parents = nodes.select(
        F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    return counted.join(totals, ["a", "b"]).join(_ends(rows, members), ["a", "b"], "left").join(
        parents, ["up_a", "up_b"], "left"
    ).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def _keyed(turns: DataFrame) -> DataFrame:
    """`turns` with the node (a, b) that each leads to, the one before it (up_a, up_b), and the band."""
    hashed = turns.select(
        "conv_id", "depth", "chars", _band(F.col("depth"), 1).alias("band"),
        F.xxhash64(F.lit(1), "depth", "mark").alias("x"),
        F.xxhash64(F.lit(2), "mark", "depth").alias("y"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(
        Window.unboundedPreceding, -1)
    bands = hashed.groupBy("conv_id", "band").agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")
    ).select("conv_id", "band", *(
        F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("x", "y")))
    here = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0)
    keyed = hashed.join(bands, ["conv_id", "band"]).select(
        "conv_id", "depth", "chars", "x", "y",
        *(F.bit_xor(c).over(here).bitwiseXOR(F.col(f"{c}0")).alias(k)
          for c, k in (("x", "a"), ("y", "b"))))
    return keyed.select(
        "conv_id", "depth", "chars", "a", "b",
        F.col("a").bitwiseXOR(F.col("x")).alias("up_a"), F.col("b").bitwiseXOR(F.col("y")).alias("up_b"))


def _nodes(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b, conv_id, depth, n_convs, chars, up_a, up_b) of all nodes."""
    zero = F.lit(0).cast("bigint")
    below = rows.groupBy("a", "b", "depth", "up_a", "up_b", "chars").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter(
        "n_convs > 0").select(
        zero.alias("a"), zero.alias("b"), zero.alias("depth"), zero.alias("up_a"), zero.alias("up_b"),
        zero.alias("chars"), "conv_id", "n_convs")
    # The root is its own parent here, and no other node is: only depths tell, so it gets none.
    return below.unionByName(root.withColumn("up_a", F.lit(None).cast("bigint")).withColumn(
        "up_b", F.lit(None).cast("bigint")))


def _band(depth: Column, stride: int) -> Column:
    """The band of a depth that is a multiple of `stride`, in bands of BAND such depths."""
    return F.floor((depth / stride - 1) / BAND)


def _ends(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the nodes at which a member ends."""
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "a", "b")).alias("last"))
    ends = members.join(last, "conv_id", "left").select(
        *(F.coalesce(f"last.{k}", F.lit(0)).alias(k) for k in ("a", "b")), "conv_id",
        F.col("conv_id").cast("string").alias("text"))
    return ordered_sha256(ends, ["a", "b"], ["conv_id"], "text", ",", "ends_sha256")


def _paths(rows: DataFrame, stride: int) -> DataFrame:
    """(a, b, depth, path, top_a, top_b) of the nodes at multiples of `stride`.

    `path` holds the keys from the first depth of the node's band down to itself, `top` is the root of
    the band. `rows` has the node one stride higher as (up_a, up_b).
    """
    here = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0)
    walked = rows.withColumn("band", _band(F.col("depth"), stride)).select(
        "conv_id", "depth", "a", "b", F.collect_list(F.struct("a", "b")).over(here).alias("path"),
        F.first("up_a").over(here).alias("top_a"), F.first("up_b").over(here).alias("top_b"))
    return walked


def _subtree_totals(rows: DataFrame, values: DataFrame, names: list[str]) -> DataFrame:
    """(a, b, names): the sums of `values` over every node's subtree."""
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    sums = [F.sum(n).alias(n) for n in names]
    levels, stride = [], 1
    while True:
        paths = _paths(rows, stride)
        one = stored(paths.groupBy("a", "b").agg(
            F.any_value(F.struct("path", "top_a", "top_b")).alias("way")))
        held = values.join(one, ["a", "b"], "left")
        wide = stride * BAND
        bottom = F.col("depth") % wide == 0
        inner = held.filter(~bottom).groupBy(
            F.col("way.top_a").alias("a"), F.col("way.top_b").alias("b")).agg(*sums)
        levels.append((values, one, wide))
        roots = values.filter(bottom)
        values = stored(roots.select("a", "b", "depth", *names).unionByName(
            inner.withColumn("depth", F.lit(None).cast("bigint"))
        ).groupBy("a", "b").agg(F.max("depth").alias("depth"), *sums))
        rows = paths.filter(bottom).select(
            "conv_id", "depth", "a", "b", F.col("top_a").alias("up_a"), F.col("top_b").alias("up_b"))
        stride = wide
        if deepest < stride:
            break
        rows = stored(rows)
    totals = values.drop("depth")
    for values, one, wide in reversed(levels):
        bottom = F.col("depth") % wide == 0
        own = values.filter(~bottom).join(one, ["a", "b"]).select(
            F.explode("way.path").alias("node"), *names)
        below = totals.join(one, ["a", "b"]).select(
            F.explode(F.expr("slice(way.path, 1, size(way.path) - 1)")).alias("node"), *names)
        inside = own.unionByName(below).groupBy("node.a", "node.b").agg(*sums)
        totals = stored(totals.unionByName(inside))
    return totals

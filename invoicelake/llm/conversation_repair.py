"""Repair of conversations: the cheapest edits that give a legal order of roles.

A conversation is legal if its roles are those of the grammar C -> e | T | s T, T -> u a | T u a (s, u, a:
the initials of system, user and assistant). A generalised LR parser reads the rows and keeps every
stack that some edits lead to. Stacks share their lower cells, and equal ones are merged by the least
(cost, audit). Long conversations are cut into blocks that are parsed in parallel from every stack
that can stand before them; the results of the blocks are joined in order.

Edits and costs: Keep 0, Rerole 1 (to user or assistant), Delete 2, Insert 5 (an empty user or
assistant turn, anywhere). A row that is blank or repeats an earlier one must be deleted; a truncated
one that stays costs 5 more. The audit has an edit's initial for each row and each insertion, in
order; of edits at the same cost the one with the least audit is taken, which settles them fully.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from invoicelake.llm.ordered import EMPTY_SHA256, numbered, ordered_sha256
from invoicelake.llm.shared import BLANKS, named_apart, stored

BLOCK = 2048  # distinct rows of a block
KEEP, REROLE, DELETE, INSERT = "KRDI"
RULE_COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
ROLE_OF = {"u": "user", "a": "assistant"}

# LR tables of the grammar. States 5 and 7 end a pair; the pair becomes a T at once.
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 5, (3, "u"): 6, (4, "u"): 6, (6, "a"): 7}
_REDUCE = {5: 2, 7: 3}  # cells that the rule takes off
_GOTO = {0: 3, 1: 4}
_ACCEPTING = (0, 3, 4)

Stack = tuple  # (state, cells below)
Best = tuple[int, str]  # cost and audit
_BOTTOM: Stack = (0, ())

# One letter stands for a row: s, u, a or x (any other initial), in capitals if it is truncated; d if it
# must be deleted.
MUST_GO = "d"


@lru_cache(maxsize=None)
def advance(stack: Stack, initial: str) -> Stack | None:
    """The stack after a turn of this role, None if the grammar has none here."""
    state = _SHIFT.get((stack[0], initial))
    if state is None:
        return None
    stack = (state, stack)
    if state in _REDUCE:
        for _ in range(_REDUCE[state]):
            stack = stack[1]
        stack = (_GOTO[stack[0]], stack)
    return stack


def _all_stacks() -> list[Stack]:
    found = [_BOTTOM]
    for stack in found:
        for initial in "sua":
            after = advance(stack, initial)
            if after is not None and after not in found:
                found.append(after)
    return found


STACKS = _all_stacks()
_NUMBER = {stack: i for i, stack in enumerate(STACKS)}


def _put(tops: dict[Stack, Best], stack: Stack | None, cost: int, audit: str) -> bool:
    if stack is None or (stack in tops and tops[stack] <= (cost, audit)):
        return False
    tops[stack] = (cost, audit)
    return True


def _with_inserts(tops: dict[Stack, Best]) -> dict[Stack, Best]:
    open_ = list(tops)
    while open_:
        stack = open_.pop()
        cost, audit = tops[stack]
        for initial in ROLE_OF:
            after = advance(stack, initial)
            if _put(tops, after, cost + RULE_COST[INSERT], audit + INSERT):
                open_.append(after)
    return tops


def parse(symbols: str, start: Stack, first: bool) -> dict[Stack, Best]:
    """The cheapest (cost, audit) for every stack that edits of these rows can lead to from `start`.

    Insertions come after a row, before it only in the first block of a conversation.
    """
    tops = {start: (0, "")}
    if first:
        _with_inserts(tops)
    for symbol in symbols:
        after: dict[Stack, Best] = {}
        initial = symbol.lower()
        extra = 0 if initial == symbol else TRUNCATED_COST
        for stack, (cost, audit) in tops.items():
            _put(after, stack, cost + RULE_COST[DELETE], audit + DELETE)
            if symbol != MUST_GO:
                _put(after, advance(stack, initial), cost + extra, audit + KEEP)
                for role in ROLE_OF:
                    _put(after, advance(stack, role), cost + extra + RULE_COST[REROLE], audit + REROLE)
        tops = _with_inserts(after)
    return tops


@lru_cache(maxsize=1 << 16)
def _short_paths(symbols: str, first: bool) -> tuple[dict, ...]:
    return _paths(symbols, first)


def _paths(symbols: str, first: bool) -> tuple[dict, ...]:
    return tuple(
        {"entry": _NUMBER[start], "exit": _NUMBER[stack], "cost": cost, "audit": audit}
        for start in (STACKS[:1] if first else STACKS)
        for stack, (cost, audit) in parse(symbols, start, first).items()
    )


def _block_paths(symbols: pd.Series, first: pd.Series) -> pd.Series:
    return pd.Series([
        (_short_paths if len(s) <= 64 else _paths)(s, f) for s, f in zip(symbols, first)])


def _faults(rows: DataFrame) -> DataFrame:
    """One row for each distinct (conv, turn, role, text): its faults and how often it stands."""
    blank = ~F.col("text").rlike(rf"[^{BLANKS}]")
    cut = ~F.col("text").rlike(rf"[.!?][{BLANKS}]*\z")
    thin = rows.select(
        "conv", "turn", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        blank.alias("blank"), cut.alias("cut"), "copies",
    ).groupBy("conv", "turn", "role", "digest", "blank", "cut").agg(F.sum("copies").alias("copies"))
    return stored(thin)


def _rows_in_order(thin: DataFrame, block: int) -> DataFrame:
    """The distinct rows with their number in the conversation and the letters of their copies."""
    there = thin.filter("copies > 0")
    place = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = there.groupBy("conv", "role", "digest").agg(F.min(place).alias("earliest"))
    a, b = there.alias("a"), firsts.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("conv", "role", "digest")]
    repeats = ~F.col("a.turn").eqNullSafe(F.col("b.earliest.turn"))
    seen = a.join(b, same[0] & same[1] & same[2]).select("a.*", repeats.alias("repeats"))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    first = F.when(F.col("blank") | F.col("repeats"), MUST_GO).when(
        F.col("cut"), F.upper(letter)).otherwise(letter)
    more = F.col("copies") - 1
    return numbered(seen, "conv", ["turn", "role", "digest"], "number").select(
        "*", F.floor((F.col("number") - 1) / block).alias("block"),
        F.concat(first, F.expr("repeat('d', int(copies - 1))")).alias("symbols"),
        F.expr("repeat(if(substring(role, 1, 1) IN ('s', 'u', 'a'), substring(role, 1, 1), 'x'), int(copies))")
        .alias("initials"),
        F.when(F.col("blank"), F.col("copies")).otherwise(0).alias("n_blank"),
        F.when(F.col("blank"), 0).when(F.col("repeats"), F.col("copies")).otherwise(more)
        .alias("n_repeats"),
        F.when(F.col("blank") | F.col("repeats") | ~F.col("cut"), 0).otherwise(1).alias("n_cut"),
    )


def _blocks(rows: DataFrame) -> DataFrame:
    """One row for each block of a conversation, with its paths through the parser."""
    in_order = F.array_sort(F.collect_list(F.struct("number", "symbols", "initials", "copies")))
    blocks = rows.groupBy("conv", "block").agg(
        in_order.alias("rows"), F.min("turn").alias("low"), F.max("turn").alias("high"),
        F.size(F.collect_set("turn")).alias("turns"), F.sum("n_blank").alias("blank"),
        F.sum("n_repeats").alias("duplicate"), F.sum("n_cut").alias("truncated"),
    ).select(
        "*", F.array_join("rows.symbols", "").alias("symbols"),
        F.array_join("rows.initials", "").alias("initials"),
        F.col("rows.copies").alias("copies"),
    ).drop("rows")
    paths = F.pandas_udf(
        _block_paths, "array<struct<entry:int, exit:int, cost:bigint, audit:string>>")
    return blocks.withColumn("paths", paths("symbols", F.col("block") == 0)).drop("symbols")


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LEGAL = ("su", "ua", "au")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the sorted blocks of each conversation: a row of totals, and the edits of each block."""
    held: list[dict] = []
    out: list[dict] = []
    size = 0
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv"] != held[0]["conv"]:
                out += _conversation(held)
                size += sum(len(b["initials"]) for b in held)
                held = []
            held.append(row)
            if size > 1 << 20:
                yield _result(out)
                out, size = [], 0
    if held:
        out += _conversation(held)
    if out:
        yield _result(out)


_NO_ROLE = "-"
_RESULT = pa.schema([
    ("conv", pa.int64()), ("block", pa.int64()), ("edits", pa.string()), ("roles", pa.string()),
    ("copies", pa.list_(pa.int64())), *((c, pa.int64()) for c in _COUNTS),
])
_RESULT_FIELDS = "conv bigint, block bigint, edits string, roles string, copies array<bigint>, " + (
    ", ".join(f"{c} bigint" for c in _COUNTS))
_TURN = pa.schema([
    ("conv", pa.int64()), ("number", pa.int64()), ("place", pa.int64()), ("edit", pa.string()),
    ("set_role", pa.string()),
])
_TURN_FIELDS = "conv bigint, number bigint, place bigint, edit string, set_role string"


def _result(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _RESULT)


def _conversation(blocks: list[dict]) -> list[dict]:
    best: dict[int, Best] = {0: (0, "")}
    illegal, turns, last, high = 0, 0, "", None
    for block in blocks:
        after: dict[int, Best] = {}
        for path in block["paths"]:
            if path["entry"] in best:
                cost, audit = best[path["entry"]]
                _put(after, path["exit"], cost + path["cost"], audit + path["audit"])
        best = after
        line = last + block["initials"]
        illegal += max(0, len(line) - 1) - sum(map(line.count, _LEGAL))
        turns += block["turns"] - (block["low"] is not None and block["low"] == high)
        last, high = line[-1:], block["high"] if block["high"] is not None else high
    cost, audit = min(v for i, v in best.items() if STACKS[i][0] in _ACCEPTING)
    lows = [b["low"] for b in blocks if b["low"] is not None]
    out = [{
        "conv": blocks[0]["conv"], "block": None, "edits": audit, "cost": cost, "illegal": illegal,
        "gaps": high - lows[0] + 1 - turns if lows else 0,
        **{c: sum(b[c] for b in blocks) for c in ("blank", "duplicate", "truncated")},
    }]
    at, role = 0, ""
    for block in blocks:
        stop = _end_of(audit, at, len(block["initials"]))
        roles = _roles(audit[at:stop], block["initials"], role)
        out.append({"conv": block["conv"], "block": block["block"], "edits": audit[at:stop],
                    "roles": roles, "copies": block["copies"]})
        role = (role + roles.replace(_NO_ROLE, ""))[-1:]
        at = stop
    return out


def _end_of(audit: str, at: int, rows: int) -> int:
    """Where the edits of the next `rows` rows end, with the insertions after them."""
    while rows:
        rows -= audit[at] != INSERT
        at += 1
    while audit[at : at + 1] == INSERT:
        at += 1
    return at


def _roles(edits: str, initials: str, role: str) -> str:
    """The initial of each edit's turn; a changed or inserted turn is what follows the one before it."""
    out, row = [], 0
    for edit in edits:
        if edit == DELETE:
            out.append(_NO_ROLE)
        else:
            role = initials[row] if edit == KEEP else "a" if role == "u" else "u"
            out.append(role)
        row += edit != INSERT
    return "".join(out)


def _unfolded(
    batches: Iterator[pa.RecordBatch], rows_of_block: int
) -> Iterator[pa.RecordBatch]:
    """A row for each turn of the repaired conversations, without its text."""
    for batch in batches:
        for block in batch.to_pylist():
            number, left, out = block["block"] * rows_of_block, 0, []
            copies = iter(block["copies"])
            for i, (edit, role) in enumerate(zip(block["edits"], block["roles"])):
                if edit != INSERT:
                    if not left:
                        number, left = number + 1, next(copies)
                    left -= 1
                if edit != DELETE:
                    out.append((block["conv"], None if edit == INSERT else number,
                                (block["block"] << 32) + i, edit, ROLE_OF.get(role)))
            if out:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(_TURN.names, row)) for row in out], _TURN)


def repair(
    rows: DataFrame, copies: Column | None = None, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Repairs all conversations of `rows` (conv_id, turn, role, text); returns two tables.

    Conversations: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row for
    each conv_id. Turns: (conv_id, place, edit, role, text), the repaired conversations; `place` orders
    the turns of one.

    Rows are taken by turn (null first), then by role and the SHA-256 of the text. A null role or text
    is one space: no legal role, and blank. All rows without conv_id are one conversation.
    `copies` says how often a row stands, once if it is not given; a conversation whose rows all
    stand 0 times has zeros, an empty audit and no turns, and repeated rows are duplicates.
    Texts may have any length: only their digests are compared, and they are fetched once for
    the turns that stay. Other columns are not read; an empty table gives two.
    """
    named_apart(rows, "conv_id", "turn", "role", "text")
    known = rows.select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("bigint").alias("copies"),
    )
    thin = _faults(known)
    in_order = stored(_rows_in_order(thin, block))
    blocks = _blocks(in_order).repartition("conv").sortWithinPartitions("conv", "block")
    results = stored(blocks.mapInArrow(_joined, _RESULT_FIELDS))
    return _conversations(thin, results), _turns(known, in_order, results, block)


def _conversations(thin: DataFrame, results: DataFrame) -> DataFrame:
    a = thin.select("conv").distinct().alias("a")
    b = results.filter("block IS NULL").alias("b")
    return a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv")), "left").select(
        F.col("a.conv").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS),
        F.coalesce("edits", F.lit("")).alias("audit"),
    )


def _turns(
    known: DataFrame, in_order: DataFrame, results: DataFrame, block: int
) -> DataFrame:
    edits = results.filter("block IS NOT NULL").select(
        "conv", "block", "edits", "roles", "copies").mapInArrow(
        lambda batches: _unfolded(batches, block), _TURN_FIELDS)
    a, b = edits.alias("a"), in_order.select("conv", "number", "turn", "role", "digest").alias("b")
    of_row = F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.number") == F.col("b.number"))
    placed = a.join(b, of_row, "left").select("a.*", "b.turn", "b.role", "b.digest")
    keys = ["conv", "turn", "role", "digest"]
    texts = known.filter("copies > 0").withColumn(
        "digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    ).groupBy(*keys).agg(F.any_value("text").alias("text"))
    a, b = placed.alias("a"), texts.alias("b")
    same = F.lit(True)
    for key in keys:
        same &= F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    return a.join(b, same & (F.col("a.edit") != INSERT), "left").select(
        F.col("a.conv").alias("conv_id"), "place", "edit",
        F.when(F.col("edit") == KEEP, F.col("a.role")).otherwise(F.col("set_role")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def with_digests(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """`conversations` with `repaired_sha256`, that of the repaired `role:text` lines."""
    lines = turns.select(
        F.col("conv_id").alias("conv"), "place", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = ordered_sha256(lines, ["conv"], ["place"], "line", "\n", "repaired_sha256")
    a, b = conversations.alias("a"), digests.alias("b")
    return a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv")), "left").select(
        "a.*", F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))

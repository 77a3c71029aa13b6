"""Text operators on small invented tables, against plain versions of the same rules."""

from __future__ import annotations

import random
import re
import tracemalloc
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("invoicelake.llm")

from invoicelake.llm import line_dedup as line_dedup_module, quality, sharding, toxicity  # noqa: E402
from invoicelake.llm.byte_words import shingle_sets, text_slices  # noqa: E402
from invoicelake.llm.decontaminate import decontaminate, find_phrases  # noqa: E402
from invoicelake.llm.graph import components  # noqa: E402
from invoicelake.llm.line_dedup import line_dedup, line_links, within  # noqa: E402
from invoicelake.llm.line_rules import LineRule, quality_rules, without_frequent_lines  # noqa: E402
from invoicelake.llm.mixing import mix, mixed_documents  # noqa: E402
from invoicelake.llm.near_duplicates import (  # noqa: E402
    DISTANCE, SLOTS, near_duplicates, parity_bits, signature, without_near_duplicates,
)
from invoicelake.llm.suffix_dedup import suffix_dedup  # noqa: E402
from invoicelake.llm.url_filter import judged  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, id string"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [words(rng, n) for n in (80, 120, 300, 60, 61)]
    shared = words(rng, 70)
    texts += [texts[0], texts[0], texts[2] + " tail", shared + "\n" + words(rng, 30),
              words(rng, 20) + "\n" + shared, "ab " * 400, "É" * 300, "", " \n\t", "one", "Ünë ÖÄ x"]
    out = [(i, t, "en", f"s{i % 3}", len(t), i, "x") for i, t in enumerate(texts)]
    out += [(100, None, None, None, None, None, None), (None, texts[1], "en", None, 1, 1, "y"),
            (None, None, "en", "s0", 1, 1, "y"), out[3], out[3], (3, "other text of 3", "en", "s1", 1, 1, "z")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_suffix_dedup_against_all_substrings(docs, nothing, rows):
    texts = [(r[1] or "").encode() for r in rows]
    seen: dict[bytes, int] = {}
    for t in texts:
        for s in range(len(t) - 199):
            seen[t[s : s + 200]] = seen.get(t[s : s + 200], 0) + 1
    want = []
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for s in range(len(t) - 199):
            if seen[t[s : s + 200]] > 1:
                gone[s : s + 200] = b"\1" * 200
        rest = bytes(b for b, g in zip(t, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        want.append((r[0], len(t), sum(gone), runs, sha256(rest).hexdigest()))
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256)
           for r in suffix_dedup(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert suffix_dedup(nothing).count() == 0


@pytest.mark.parametrize("length, seed", [(200, 1), (72, 2), (111, 3)])
def test_suffix_dedup_of_passages_in_many_contexts(spark, length, seed):
    """Passages just under and over the length, whole and in part, many of them, over many buckets."""
    rng = random.Random(seed)
    passages = [words(rng, 90)[: length + d] for d in (-30, -3, -1, 0, 1, 2, 40, 300)]
    texts = []
    for i in range(220):
        text = words(rng, rng.randint(0, 12))
        for passage in rng.choices(passages, k=rng.randint(1, 3)):
            a, b = sorted(rng.choice([(0, len(passage)), rng.choices(range(len(passage) + 1), k=2)]))
            text += passage[a:b] + rng.choice(["", "é", " " + words(rng, 3)])
        texts.append(text * rng.choice([1, 1, 1, 2]))
    data = [t.encode() for t in texts]
    seen: dict[bytes, int] = {}
    for t in data:
        for s in range(len(t) - length + 1):
            seen[t[s : s + length]] = seen.get(t[s : s + length], 0) + 1
    want = []
    for i, t in enumerate(data):
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        want.append((i, sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(7)
        got = sorted((r.doc_id, r.kept_sha256) for r in suffix_dedup(table, length).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == want


def test_suffix_dedup_of_a_text_of_several_slices(spark):
    rng = random.Random(6)
    text = rng.randbytes(2_600_000).hex()
    at = (1 << 21) - 150  # over the end of a slice
    table = spark.createDataFrame([(1, text), (2, f"- {text[at : at + 300]} -")], "doc_id int, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in suffix_dedup(table).select("doc_id", "spans").collect()}
    assert got == {1: [(at, at + 300)], 2: [(2, 302)]}


def test_near_duplicates_against_all_pairs(docs, nothing, rows):
    def shingles(text):
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return frozenset(tuple(w[i : i + 2]) for i in range(len(w) - 1)) or frozenset([tuple(w)] if w else [])

    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    want = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        smallest = (min(ids) if ids else None) if sets[i] else r[0]
        want.append((r[0], len(sets[i]), smallest, r[0] == smallest))
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, 2).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert near_duplicates(nothing, 2).count() == 0


def test_one_of_each_near_group_stays(docs):
    stay = without_near_duplicates(docs, 2).select("doc_id", "text", "id").collect()
    assert len([r for r in stay if r.doc_id == 3 and r.id == "x"]) == 1
    assert {0, 5, 6} & {r.doc_id for r in stay} == {0}
    assert 12 in {r.doc_id for r in stay} and 100 in {r.doc_id for r in stay}


def test_a_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(9)
    base = words(rng, 120).split()
    copies = []
    for i in range(40):
        mine = list(base)
        for _ in range(2):
            mine[rng.randrange(len(mine))] = words(rng, 1)
        copies.append((i, " ".join(mine)))
    found = near_duplicates(spark.createDataFrame(copies, "doc_id bigint, text string"), 2)
    assert {r.component_id for r in found.collect()} == {0}


def test_pages_of_a_template_meet_nobody(spark):
    """Alike in 0.72: many under each key, no link, and no pair is made of them."""
    template = " ".join(f"t{j}" for j in range(100))
    pages = [(i, template + " " + " ".join(f"p{i}w{j}" for j in range(19))) for i in range(600)]
    pages += [(1000 + i, pages[i][1] + f" one{i}") for i in range(3)]
    found = near_duplicates(spark.createDataFrame(pages, "doc_id bigint, text string"), 1)
    assert {r.doc_id: r.component_id for r in found.collect()} == {
        i: i - 1000 if i >= 1000 else i for i, _ in pages}


def test_one_of_each_near_group_stays_whatever_columns_are_called(spark, docs):
    names = ["_th2", "_th", "_id", "th", "n", "root", "sig", "node", "doc", "doc_key", "doc_th", "a.b"]
    plain = docs.select("doc_id", "text")
    clashing = plain.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names))
    left = without_near_duplicates(clashing, 2)
    assert left.columns == clashing.columns
    got = left.collect()
    assert sorted(r.doc_id or -1 for r in got) == sorted(
        r.doc_id or -1 for r in without_near_duplicates(plain, 2).collect())
    assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for r in got for n in names)


def test_pairs_that_signatures_let_meet_are_all_confirmed(spark):
    texts = []
    for i in range(40):  # pairs at similarity 2/3
        names = [f"p{i}w{j}" for j in range(120)]
        texts += [" ".join(names[:100]), " ".join(names[20:])]
    slots = [signature(s)[:SLOTS] for s in shingle_sets(pa.array(texts), 1)]
    meet = [int((a != b).sum()) <= DISTANCE for a, b in zip(slots[::2], slots[1::2])]
    assert sum(meet) > 20
    found = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 1, 60)
    roots = {r.doc_id: r.component_id for r in found.collect()}
    assert [roots[2 * i + 1] == 2 * i for i in range(40)] == meet


def test_keys_of_many_nodes_in_several_components_against_all_pairs(spark):
    rng = random.Random(12)
    sets = []
    for i in range(5):  # groups alike in 0.75, their members in over 0.9
        group = [f"w{j}" for j in range(180)] + [f"g{i}w{j}" for j in range(30)]
        sets += [frozenset(group[:-3] + [f"x{i}y{k}z{j}" for j in range(rng.randint(1, 3))]) for k in range(5)]
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 80 * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    want = [group.index(g) for g in group]
    texts = [" ".join(sorted(s)) for s in sets]
    keys = {}
    for i, s in enumerate(shingle_sets(pa.array(texts), 1)):
        slots = signature(s)[:SLOTS]
        for at in range(SLOTS):
            first = at - at % 5
            rest = tuple(slots[k] for k in range(first, first + 5) if k != at)
            keys.setdefault((at, rest), []).append(want[i])
    assert len(set(want)) == 5 and any(len(k) > 8 and len(set(k)) > 1 for k in keys.values())
    found = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 1)
    assert [r.component_id for r in sorted(found.collect())] == want


def test_parity_bits_never_count_more_than_the_difference():
    rng = np.random.default_rng(4)
    for common, own in ((0, 0), (0, 1), (1, 0), (100, 11), (100, 30), (5000, 700)):
        every = rng.integers(0, 2**63, common + 2 * own, dtype=np.uint64)
        a, b = every[: common + own], np.concatenate([every[:common], every[common + own :]])
        bits = np.unpackbits(parity_bits(a) ^ parity_bits(b)).sum()
        assert bits <= len(np.setxor1d(a, b))
        assert bits > 0 or own == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert {roots[i] for i in range(61)} == {0} and roots[101] == 100


def test_line_dedup(spark, docs, nothing):
    line = "the quick brown fox jumps over the lazy dog again and again"
    table = spark.createDataFrame([
        (1, line + "\nshort"), (2, line.replace("quick", "quack")), (3, line[1:] + "x\nshort"),
        (4, line + "\n" + line), (5, None), (6, ""), (6, ""), (None, line[::-1]),
    ], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_lines, r.n_linked, r.n_removed) for r in line_dedup(table).collect()}
    assert got == {1: (2, 1, 0), 2: (1, 1, 1), 3: (2, 1, 2), 4: (2, 2, 2), 5: (0, 0, 0),
                   6: (0, 0, 0), None: (1, 0, 0)}
    assert line_dedup(nothing).count() == 0
    assert line_dedup(docs).count() == docs.select("doc_id", "text").distinct().count()


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(1)
    pairs = [(bytes(rng.choices(b"ab", k=rng.randint(0, 9))), bytes(rng.choices(b"ab", k=rng.randint(0, 9))))
             for _ in range(600)]
    for errors in (1, 2, 3):
        assert list(within(pairs, errors)) == [plain(a, b) <= errors for a, b in pairs]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_of_long_pairs(monkeypatch):
    rng = random.Random(3)
    pairs = []
    for _ in range(1500):
        a = rng.choices("ab’", k=rng.randint(0, 24))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choices("ab’", k=rng.randint(0, 1))
        pairs.append(("".join(a).encode(), "".join(b).encode()))
    for cut, long, padded in ((0, 0, 64), (0, 5, 64), (9, 12, 30), (99, 99, 64)):
        monkeypatch.setattr(line_dedup_module, "CUT", cut)
        monkeypatch.setattr(line_dedup_module, "LONG", long)
        monkeypatch.setattr(line_dedup_module, "PADDED", padded)
        for errors in (1, 2, 3):
            assert list(within(pairs, errors)) == [edits(a.decode(), b.decode()) <= errors for a, b in pairs]


def test_two_huge_lines_beside_short_ones_need_little_memory():
    rng = random.Random(9)
    huge = rng.randbytes(3_000_000).translate(bytes(97 + i % 26 for i in range(256)))
    near = b"x" + huge[1:1_500_000] + huge[1_500_001:]
    short = [(b"%04d" % i, b"%04d" % (i + 1)) for i in range(1000)]
    tracemalloc.start()
    got = within([(huge, near), *short, (huge, near[:-9] + b"aaaaaaaaa")], 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0] and not got[-1] and peak < 100_000_000
    assert list(got[1:-1]) == [edits(a, b) <= 2 for a, b in short]


def test_short_lines_against_all_pairs(spark):
    rng = random.Random(12)
    lines = sorted({"".join(rng.choices("01é", k=rng.randint(1, 11))) for _ in range(300)})
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").repartition(3)
    texts = {r.line: r.text for r in table.select("text", F.xxhash64("text").alias("line")).collect()}
    for errors in (1, 2):
        got = sorted(tuple(sorted((texts[r.a], texts[r.b]))) for r in line_links(table, errors).collect())
        assert got == [(a, b) for a in lines for b in lines if a < b and edits(a, b) <= errors]


def test_many_page_numbers_finish(spark):
    table = spark.range(6_000).selectExpr("id AS doc_id", "CAST(10000 + 4 * id AS STRING) AS text")
    found = line_links(table)
    degrees = found.select(F.explode(F.array("a", "b")).alias("line")).groupBy("line").count()
    one = degrees.where(F.col("line") == F.xxhash64(F.lit("20000"))).first()["count"]
    assert one == sum(edits("20000", str(n)) <= 2 for n in range(10000, 34000, 4)) - 1


def test_line_links_against_all_pairs(spark):
    rng = random.Random(6)
    lines = {"".join(rng.choices("ab’字🙂", k=rng.randint(1, 9))) for _ in range(60)}
    for n in (1, 2, 3, 6, 20, 39, 40, 41, 60):
        base = "".join(rng.choices("abcdé’", k=n))
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(copy) + 1)
                copy[at : at + rng.randint(0, 1)] = rng.choices("ab’字🙂", k=rng.randint(0, 1))
            lines.add("".join(copy))
    lines = sorted(lines - {""})
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").repartition(3)
    texts = {r.line: r.text for r in table.select("text", F.xxhash64("text").alias("line")).collect()}
    for errors in (1, 2):
        got = sorted(tuple(sorted((texts[r.a], texts[r.b]))) for r in line_links(table, errors).collect())
        assert got == [(a, b) for a in lines for b in lines if a < b and edits(a, b) <= errors]
    found = {r.doc_id: r.n_links for r in line_dedup(table).collect()}
    assert found == {i: sum(a != b and edits(a, b) <= 2 for b in lines) for i, a in enumerate(lines)}


def test_edits_change_few_parities():
    rng = random.Random(8)
    alphabet = "abcdefghijklmnopqrstuvwxyzéèß’字🙂"
    for errors in (1, 2, 3):
        for _ in range(300):
            a = rng.choices(alphabet, k=rng.randint(1, 30))
            b = list(a)
            for _ in range(errors):
                at = rng.randrange(len(b) + 1)
                b[at : at + rng.randint(0, 1)] = rng.choices(alphabet, k=rng.randint(0, 1))
            _, data, starts = next(text_slices(pa.array(["".join(a), "", "".join(b)])))
            odd = line_dedup_module.parities(data, *line_dedup_module.character_starts(data, starts))
            assert odd[1] == 0 and int(odd[0] ^ odd[2]).bit_count() <= 2 * errors
            assert int(odd[0]) < 1 << line_dedup_module.LOW and odd[0] % 2 == 0


def test_lines_that_share_a_passage_meet_only_if_they_are_alike(spark):
    rng = random.Random(21)
    passage = words(rng, 60)
    lines = {passage + " " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(390)}
    for line in sorted(lines)[:10]:
        lines.add(line[:-5] + "!" + line[-4:])
        lines.add("?" + line[:300] + line[301:])
    lines = sorted(lines)
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").repartition(3)
    texts = {r.line: r.text for r in table.select("text", F.xxhash64("text").alias("line")).collect()}
    pairs = [(a, b) for i, a in enumerate(lines) for b in lines[i + 1 :]]
    near = within([(a.encode(), b.encode()) for a, b in pairs], 2)
    got = sorted(tuple(sorted((texts[r.a], texts[r.b]))) for r in line_links(table).collect())
    assert got == [pair for pair, good in zip(pairs, near) if good] and len(got) >= 20
    distinct = table.select(F.xxhash64("text").alias("line"), "text")
    assert line_dedup_module._met(distinct, 2).count() < len(pairs) / 20


def test_first_of_a_class_without_ids_and_with_repeated_lines(spark):
    line, near, other = "a line of some length that stands often", "a line of some length that stand often", "alone here, only once"
    table = spark.createDataFrame(
        [(None, line), (None, line + "\n" + other), (None, line), (7, "x y\n" + near + "\n" + near), (8, "x y"), (9, None)],
        "doc_id bigint, text string").repartition(2)
    got = sorted(map(tuple, line_dedup(table).select("doc_id", "n_lines", "n_linked", "n_links", "n_removed").collect()), key=str)
    assert got == sorted([(None, 1, 1, 1, 1), (None, 2, 1, 1, 1), (7, 3, 2, 2, 1), (8, 1, 0, 0, 1), (9, 0, 0, 0, 0)], key=str)
    kept = {(r.line, r["class"]): r.kept for r in line_dedup(table).filter("doc_id IS NULL AND n_lines = 2").selectExpr("inline(lines)").collect()}
    assert sorted(kept.values()) == [False, True] and [a == b for (a, b), k in kept.items() if k] == [True]


def test_texts_of_lines_are_shuffled_once_and_not_stored(spark):
    rng = random.Random(22)
    text = lambda: "\n".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=400)) for _ in range(20))
    rows = [(i, text()) for i in range(149)]
    rows.append((149, rows[0][1].replace("a", "", 1)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    # Left to Spark, so small a table would be broadcast instead of shuffled.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = line_dedup_module._links(table, 2)
        assert len(found.collect()) == 1
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_line = [x for x in plan.split("\n") if "hashpartitioning(line#" in x]
    assert len([x for x in by_line if "ReusedExchange" not in x]) == 1 and "Reused" in plan
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    held = lambda: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    before = held()
    assert line_dedup(table).agg(F.sum("n_lines")).first()[0] == 3000
    assert held() - before < sum(len(t) for _, t in rows) / 4


def test_shards_differ_by_one_and_follow_the_ring(spark, docs, nothing):
    table = spark.range(1003).withColumn("payload", F.col("id") * 2)
    got = sharding.shard_rows(table, ["id"], 7).collect()
    slots: dict[int, list[int]] = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(len(s) for s in slots.values()) == [143] * 5 + [144] * 2
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Rows are where the ring puts them, but for those that a full shard sends on.
    nodes = sharding.ring(7)
    point = {r.id: r.p for r in table.select("id", sharding.ring_point(F.col("id")).alias("p")).collect()}
    own = sum(nodes[sharding.node_of(point[r.id], nodes)][1] == r.shard for r in got)
    assert own > 0.75 * len(got)
    assert [tuple(r) for r in sharding.shard_rows(table.repartition(5), ["id"], 7).orderBy("id").collect()] == [
        tuple(r) for r in sorted(got)]
    assert sharding.shard_rows(docs, ["doc_id", "text"], 4).count() == docs.count()
    assert sharding.shard_rows(nothing, ["doc_id"], 4).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_rows(table.withColumn("slot", F.lit(1)), ["id"], 2)


def test_walk_against_single_rows():
    rng = random.Random(3)
    nodes = sharding.ring(5, 4)
    loads = [rng.randint(0, 9) for _ in nodes]
    pieces = sharding.walk(nodes, loads, 5)
    counts = [0] * 5
    for node, first, n, shard in pieces:
        counts[shard] += n
    assert max(counts) - min(counts) <= 1 and sum(counts) == sum(loads)
    for node, load in enumerate(loads):
        mine = sorted((f, n) for p, f, n, _ in pieces if p == node)
        assert [f for f, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))]
        assert sum(n for _, n in mine) == load


def test_mix_meets_its_targets(docs, nothing):
    got = mix(docs).collect()
    total = sum(r.size for r in got)
    per_source: dict = {}
    for r in got:
        per_source.setdefault(r.source, []).append(r)
    assert abs(sum(v[0].target for v in per_source.values()) - total) < 1e-6
    for source_rows in per_source.values():
        assert sum(r.taken for r in source_rows) == int(source_rows[0].target)
        assert all(r.taken <= 3 * r.size for r in source_rows)
        assert sum(0 < r.part < r.size for r in source_rows) <= 1
    made = mixed_documents(docs)
    n_words = made.select(F.sum(F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))).first()[0]
    assert n_words == sum(r.taken for r in got) and made.columns == docs.columns
    assert mix(nothing).count() == 0 and mixed_documents(nothing).count() == 0


def test_mix_of_whole_documents(spark, docs, rows):
    blank = [(200 + i, t, "en", f"s{i % 3}", 0, 0, "b") for i, t in enumerate([None, "", " \n"] * 3)]
    table = docs.unionByName(spark.createDataFrame(blank, SCHEMA))
    planned = mix(table).collect()
    assert any(0 < r.part < r.size for r in planned) and any(r.taken > r.size for r in planned)
    want = sorted([(r.doc_id, r.text) for r in planned for _ in range(r.copies + (r.part > 0)) if r.size], key=repr)
    got = sorted([(r.doc_id, r.text) for r in mixed_documents(table, whole=True).collect()], key=repr)
    assert got == want and {t for _, t in got} <= {r[1] for r in rows}
    # Documents without words are in no source's mix, cut or not.
    assert not any(r.copies for r in planned if not r.size)
    assert not [r for r in mixed_documents(table).collect() if not (r.text or "").strip()]


def test_quality_rules(spark, docs, nothing):
    footer = "all rights reserved"
    table = spark.createDataFrame(
        [(i, f"{words(random.Random(i), 60)}\nAll  rights reserved", "h") for i in range(30)]
        + [(50, "\n".join([footer] * 40), "h"), (51, None, None), (52, "a b c " * 40, "h")],
        "doc_id bigint, text string, source string")
    rule = LineRule(min_documents=5)
    got = {r.doc_id: r for r in quality_rules(table, rule).collect()}
    assert all(got[i].kept and got[i].removed_words == 3 for i in range(30))
    assert got[50].n_dup_lines == 39 and not got[50].kept and got[50].removed_words == 120
    assert got[51].base_failed and got[51].n_words == 0
    assert got[52].n_repeat_words == 120 and got[52].base_failed
    assert quality_rules(docs).count() == docs.count() and quality_rules(nothing).count() == 0
    left = {r.doc_id: r.text for r in without_frequent_lines(table, rule).collect()}
    assert set(left) == set(range(30)) and "rights" not in "".join(left.values())


def test_lines_are_frequent_by_count_and_by_share_only_in_small_hosts(spark):
    """Against the rule in plain words: different texts are counted, copies once, hosts apart."""
    rng = random.Random(21)
    table, pool = [], [words(rng, 4) for _ in range(12)]
    for host, size, lines in (("big", 150, 12), ("small", 14, 4), (None, 30, 12)):
        for _ in range(size):
            own = words(rng, 60) + "\n" + "\n".join(rng.sample(pool[:lines], rng.randint(0, 3)))
            table += [(host, own)] * rng.choice([1, 1, 1, 25])
    alone = words(rng, 60) + "\na line of copies only"
    table += [("big", alone)] * 40 + [("big", None), ("big", ""), (None, None)]
    having: dict[tuple, set] = {}
    texts: dict[object, set] = {}
    for host, text in table:
        texts.setdefault(host, set()).add(text or "")
        for line in (text or "").split("\n"):
            having.setdefault((host, line), set()).add(text)
    rule = LineRule(min_documents=20, min_in_small=4, share=0.25)
    gone = {k for k, t in having.items()
            if k[1] and (len(t) >= 20 or len(t) >= 4 and len(t) > 0.25 * len(texts[k[0]]))}
    assert {"big", "small"} <= {h for h, _ in gone} and len(gone) < len(having)
    want = sorted((str(h), t or "", sum(len(x.split()) for x in (t or "").split("\n") if (h, x) in gone))
                  for h, t in table)
    df = spark.createDataFrame(table, "source string, text string")
    got = sorted((str(r.source), r.text or "", r.removed_words) for r in quality_rules(df, rule).collect())
    assert got == want and ("big", alone, 0) in got
    cleaned = sorted((str(r.source), r.text) for r in without_frequent_lines(df, rule).collect())
    assert cleaned == sorted((str(h), "\n".join(x for x in t.split("\n") if (h, x) not in gone)) for h, t in table if t)


def test_quality_rules_judge_the_text_without_frequent_lines(spark):
    """The lines are taken out by the rules themselves, which judge what is left."""
    rng = random.Random(22)
    few, many, menu = words(rng, 50), words(rng, 200), f" HOME\x0b{words(rng, 80)}  \t"
    table = [(i, f"{many} {i}\n\n{menu}\nend {i}", "h") for i in range(6)]
    table += [(10, f"{few}\n{menu.lower()}", "h"), (11, f"{few}\n{menu}", "other"), (12, None, "h")]
    df = spark.createDataFrame(table, "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in quality_rules(df, LineRule(min_documents=5)).collect()}
    assert all(got[i].clean_text == f"{many} {i}\n\nend {i}" and got[i].kept for i in range(6))
    assert got[10].clean_text == few and not got[10].base_failed and not got[10].kept
    assert got[11].clean_text == got[11].text and got[11].kept and got[11].removed_words == 0
    assert got[12].clean_text is None and got[12].removed_words == 0 and not got[12].kept
    assert all(len((r.clean_text or "").split()) == r.n_words - r.removed_words for r in got.values())


def test_decontamination(spark, docs, nothing):
    rng = random.Random(8)
    item = words(rng, 14).split()
    other = words(rng, 40).split()
    table = spark.createDataFrame([
        (1, " ".join(other[:20] + item[2:13] + other[20:])), (2, " ".join(other)), (3, None),
        (4, " ".join(item[:9])), (5, "x, TINY; y"), (5, "x, TINY; y"), (6, " ".join(item).upper()),
    ], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, "tiny"), (3, ""), (4, None), (None, "x")],
                                  "item_id bigint, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.items) for r in decontaminate(table, items).collect())
    assert got == [(1, 51, 11, ["1"]), (2, 40, 0, []), (3, 0, 0, []), (4, 9, 0, []), (5, 3, 2, ["2"]),
                   (5, 3, 2, ["2"]), (6, 14, 14, ["1"])]
    assert decontaminate(nothing, items).count() == 0
    assert decontaminate(docs, items.limit(0)).filter("contaminated").count() == 0
    # One word more in the middle: no phrase any more, but near one.
    far = spark.createDataFrame([(1, " ".join(item[:7] + ["zzz"] + item[7:]))], "doc_id bigint, text string")
    assert find_phrases(far, items.filter("item_id = 1"), slop=2).count() > 0


def test_columns_pass_through_whatever_they_are_called(spark, docs):
    """Extra columns called as the operators' own ones keep their values and change no result."""
    items = spark.createDataFrame([("a", "one"), (None, "ab ab ab")], "item_id string, text string")
    rule = LineRule(min_documents=2)
    cases = {  # operator: the names it makes inside
        lambda d: sharding.shard_rows(d, ["doc_id", "text"], 3):
            "_point _rank _rows _node _order _before _pieces _piece first rows shift",
        mix: "_key _name _cell _cell_size _cell_start _upto _epochs _part cap weight capped free_words free_weight",
        lambda d: mixed_documents(d, whole=True): "_key _name _cell _epochs _part _upto",
        lambda d: quality_rules(d, rule):
            "_text _host _line _n _raw _words _lines _windows _sorted _all _rows _removed _texts _with_line",
        lambda d: without_frequent_lines(d, rule): "_text _gone _host _line _words _removed",
        lambda d: decontaminate(d, items): "_doc _words _found _sure _start _phrase _items _term _terms _at _count",
    }
    for operator, own in cases.items():
        own = [*own.split(), "c0", "c1", "c2", "a.b"]
        plain = operator(docs)
        extra = operator(docs.select("*", *(F.concat_ws("/", F.lit(c), "doc_id").alias(c) for c in own)))
        assert extra.columns[: len(docs.columns) + len(own)] == [*docs.columns, *own]
        rows = extra.collect()
        assert all(r[c] == (c if r.doc_id is None else f"{c}/{r.doc_id}") for r in rows for c in own)
        assert sorted(map(str, extra.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_url_filter(spark):
    captures = spark.createDataFrame([
        (1, "https://a.bad.example/x", "2024-03-01"), (2, "http://u@BAD.example:80", "2024-01-01"),
        (3, "https://bad.example.", "2024-05-01"), (4, "https://verybad.example/", "2024-03-01"),
        (5, None, "2024-03-01"), (6, "https://bad.example/", None), (1, "https://a.bad.example/x", "2024-03-01"),
    ], "page_id bigint, url string, fetched string").withColumn("fetched", F.to_date("fetched"))
    entries = spark.createDataFrame([
        ("bad.example", True, "2024-02-01", "spam"), ("bad.example", False, "2024-04-01", "spam"),
        ("a.bad.example", True, "2024-03-01", "ads"), (None, True, "2024-01-01", "x"),
    ], "domain string, listed boolean, dated string, reason string").withColumn("dated", F.to_date("dated"))
    got = sorted(((r.page_id, r.n_active, r.reason, r.blocked) for r in judged(captures, entries).collect()), key=repr)
    assert got == [(1, 2, "ads", True), (1, 2, "ads", True), (2, 0, None, False), (3, 0, None, False),
                   (4, 0, None, False), (5, 0, None, False), (6, 0, None, False)]
    assert judged(captures, entries.limit(0)).filter("blocked").count() == 0


def test_url_filter_keeps_lists_apart(spark):
    days = [f"2024-{m:02}-15" for m in range(1, 13)]
    captures = spark.createDataFrame(
        [(i, "https://www.a.bad.example/", d) for i, d in enumerate(days)], "page_id bigint, url string, fetched string",
    ).withColumn("fetched", F.to_date("fetched"))
    history = [
        ("list0", "bad.example", True, "2024-02-01", "spam"), ("list1", "bad.example", True, "2024-03-01", "ads"),
        ("list1", "bad.example", False, "2024-04-01", "ads"), (None, "bad.example", True, "2024-06-01", "none"),
        ("list0", "bad.example", False, "2024-08-01", "spam"), (None, "bad.example", False, "2024-09-01", None),
        ("list1", "example", True, "2024-08-01", "tld"), ("list2", "example", True, "2024-11-01", "top"),
    ]
    entries = spark.createDataFrame(history, "list string, domain string, listed boolean, dated string, reason string")
    entries = entries.withColumn("dated", F.to_date("dated"))
    want = []
    for i, day in enumerate(days):
        now = {}
        for name, domain, listed, dated, reason in sorted(history, key=lambda e: e[3]):
            if dated <= day:
                now[name, domain] = (len(domain), dated, reason) if listed else None
        active = [x for x in now.values() if x]
        want.append((i, len(active), max(active)[2] if active else None))
    got = sorted((r.page_id, r.n_active, r.reason) for r in judged(captures, entries).collect())
    assert got == want and [n for _, n, _ in got] == [0, 1, 2, 1, 1, 2, 2, 2, 1, 1, 2, 2]


def test_classifiers_learn_and_score_every_row(spark, docs, nothing):
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(300):
        bad, low = i % 5 == 0, i % 4 == 0
        text = words(rng, 60) + (" you stupid idiot, pathetic loser" if bad else "")
        texts.append((i, " | ".join(text.upper().split()) if low else text))
        labels.append((i, int(not low), int(bad)))
    table = spark.createDataFrame(texts, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.labelled_model(table, marks)
    scores = {r.doc_id: r.score for r in toxicity.scored(table, model).collect()}
    assert all((scores[i] >= 0.5) == bool(t) for i, _, t in labels)
    good = quality.labelled_model(table, marks)
    scores = {r.doc_id: r.score for r in quality.scored(table, good).collect()}
    assert all((scores[i] >= 0.3) == bool(q) for i, q, _ in labels)
    for module, fitted in ((toxicity, model), (quality, good)):
        every = module.scored(docs, fitted).collect()
        assert len(every) == docs.count() and all(0 <= r.score <= 1 for r in every)
        assert module.scored(nothing, fitted).count() == 0
    empty = toxicity.labelled_model(table, marks.limit(0))
    assert {r.score for r in toxicity.scored(table, empty).collect()} == {0.0}
    assert {r.score for r in quality.scored(table, quality.labelled_model(table, marks.limit(0))).collect()} == {0.0}

"""Sharding, quality and toxicity against plain versions of their rules, row by row."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("invoicelake.llm")

from invoicelake.llm import quality, sharding, toxicity  # noqa: E402
from invoicelake.llm.labelled import fold  # noqa: E402


def plain_shards(points: dict[int, int], shards: int) -> dict[int, tuple[int, int]]:
    """id: (shard, slot) by carrying every row round the ring until a shard has room."""
    nodes = sharding.ring(shards)
    low, more = divmod(len(points), shards)
    room = [low + (s < more) for s in range(shards)]
    waiting: list[list[int]] = [[] for _ in nodes]
    for id_, point in points.items():
        waiting[sharding.node_of(point, nodes)].append(id_)
    # Points after the last node belong to the first one, before its others.
    for rows in waiting:
        rows.sort(key=lambda i: (points[i] - (points[i] > nodes[-1][0]) * sharding.POINTS, i))
    order = {i: (at, rank) for at, rows in enumerate(waiting) for rank, i in enumerate(rows)}
    placed: dict[int, int] = {}
    while any(waiting):
        moved: list[list[int]] = [[] for _ in nodes]
        for at, (_, shard) in enumerate(nodes):
            for id_ in waiting[at]:
                if room[shard]:
                    room[shard] -= 1
                    placed[id_] = shard
                else:
                    moved[(at + 1) % len(nodes)].append(id_)
        waiting = moved
    out = {}
    for shard in range(shards):
        mine = sorted((i for i, s in placed.items() if s == shard), key=order.__getitem__)
        out |= {i: (shard, slot) for slot, i in enumerate(mine)}
    return out


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_against_a_walk_of_single_rows(spark, shards):
    table = spark.range(1500).repartition(5)
    points = {r.id: r.p for r in table.select("id", sharding.ring_point(F.col("id")).alias("p")).collect()}
    got = {r.id: (r.shard, r.slot) for r in sharding.shard_rows(table, ["id"], shards).collect()}
    assert got == plain_shards(points, shards)


def test_one_more_shard_moves_few_rows(spark):
    table = spark.range(8000)
    before, after = (
        {r.id: r.shard for r in sharding.shard_rows(table, ["id"], n).collect()} for n in (40, 41))
    assert sum(before[i] != after[i] for i in before) < 0.1 * len(before)  # 2.4 % is the least


TEXTS = [
    "", " \n", "ab", "Hello there, THIS is a text!\nWith two lines & some $igns.", "word " * 40,
    "Ünë ÖÄ été ça va?", "line\n" * 12, "a" * 3000, "ONE two\tTHREE, four; five... six? SEVEN!",
    "x y x y x y z", "日本語 テキスト 日本語",
]


def plain_vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = text.encode()
    counts = np.zeros(quality.BINS)
    for i in range(len(data) - 2):
        code = int.from_bytes(data[i : i + 3], "big") * 2654435761 % 2**32
        counts[code >> 21] += 1
    found = data.lower().split()
    if not found:
        return np.log1p(counts), np.zeros(quality.SHAPES)
    pairs = list(zip(found, found[1:]))
    signs = sum(33 <= c < 127 and not chr(c).isalnum() for c in data)
    return np.log1p(counts), np.array([
        np.mean([a == b for a, b in pairs]) if pairs else 0,
        1 - len(set(pairs)) / len(pairs) if pairs else 0,
        sum(65 <= c < 91 for c in data) / len(data), min(1, 4 * signs / len(data)),
        min(1, np.mean([len(w) for w in found]) / 16), min(1, math.log1p(len(found)) / 12),
        min(1, 20 * data.count(b"\n") / len(found)),
    ])


def test_quality_against_a_plain_vote(spark):
    rng = random.Random(12)
    rows = [(i, " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(40)))
            for i in range(160)]
    rows = [(i, t.upper().replace(" ", " | ") if i % 3 == 0 else t) for i, t in rows]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows], "doc_id bigint, quality int")
    model = quality.labelled_model(table, marks, quality.Voting(dimensions=20, neighbours=9))
    assert len(model.vectors) == table.filter(fold() > 0).count()  # nothing of the held-out fold
    texts = TEXTS + [t for _, t in rows] + [t[:50] + " ".join(TEXTS) for _, t in rows[:30]]
    want = []
    for text in texts:
        counts, shape = plain_vector(text)
        terms = counts * model.idf
        if not terms.any():
            want.append(0.0)
            continue
        vector = np.concatenate([
            terms / math.sqrt(sum(terms**2)), model.voting.shape_weight * (shape - model.shape_mean)])
        short = vector @ model.space
        cosines = sorted(((sum(v * short) / math.sqrt(sum(short**2)), label)
                          for v, label in zip(model.vectors.astype(float), model.labels)), reverse=True)
        near = [(max(0.0, c), label) for c, label in cosines[:9]]
        total = sum(c for c, _ in near)
        want.append(sum(c * label for c, label in near) / total if total else 0.0)
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "id int, text string")
    got = {r.id: r.score for r in quality.scored(df, model).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], want, atol=2e-3)
    assert got[len(texts)] == 0.0
    twice = quality.scored(df.union(df), model).groupBy("id").agg(F.count_distinct("score").alias("n"))
    assert twice.filter("n > 1").count() == 0


def plain_features(text: str, learned: dict[str, float]) -> list[float]:
    data = text.encode()
    raw = re.findall(rb"[A-Za-z0-9\x80-\xff]+", data)
    found = [w.lower() for w in raw]
    insults, second = ({w.encode() for w in x} for x in (toxicity.INSULTS, toxicity.SECOND_PERSON))
    worth = {w.encode(): x for w, x in learned.items()}
    bad = [w in insults or w in worth for w in found]
    meant = [b and any(w in second for w in found[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1])
             for i, b in enumerate(bad)]
    bare = data.translate(None, toxicity.SEPARATORS.encode())
    signs = "".join(toxicity.LOOKALIKES)
    read = bytes.maketrans(signs.encode(), "".join(toxicity.LOOKALIKES.values()).encode())
    hidden = sum(w.lower().translate(read) in insults for w in
                 re.findall(rb"[A-Za-z\x80-\xff" + re.escape(signs).encode() + rb"]+", bare))
    clear, n, size = sum(w in insults for w in found), max(1, len(found)), max(1, len(data))
    value = sum(worth.get(w, 0.0) for w in found)
    return [
        clear / n, value / n, 0.0, sum(bad) / n, math.log1p(clear), math.log1p(value), 0.0, sum(meant) / n,
        sum(w in second for w in found) / n, sum(65 <= c < 91 for c in data) / size,
        sum(len(w) > 1 and re.fullmatch(rb"[A-Z]+", w) is not None for w in raw) / n,
        len(re.findall(rb"[^A-Za-z0-9\x80-\xff \t\n\r\x0b\x0c]", data)) / size, data.count(b"!") / size,
        max(0, hidden - clear) / n, math.log1p(len(found)),
    ]


def test_toxicity_features_against_plain_ones():
    rng = random.Random(5)
    parts = ["you", "YOU", "idiot", "1d10t", "i.d.i.o.t", "$tupid", "Versager", "miststück", "zig", "zag!",
             "a-b", "ok", "word", "du", "tu", "\n", "NOISE", "42", "merde!!", "s-h-i-t", "x_y"]
    texts = TEXTS + [" ".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(80)]
    learned = {"zig": 2.5, "zag": 1.25}
    hashes = {int(toxicity._hashes_of([w])[0]): x for w, x in learned.items()}
    lexicon = toxicity.Lexicon(np.array(sorted(hashes), np.uint64), np.array([hashes[h] for h in sorted(hashes)]))
    got = toxicity.features(pa.array([*texts, None]), lexicon)
    assert np.allclose(got[:-1], [plain_features(t, learned) for t in texts])
    assert not got[-1].any()


def pooled(rows: list[tuple[float, float]]) -> dict[float, float]:
    """margin: calibrated value, by pooling adjacent violators."""
    blocks: list[list] = []
    for margin in sorted({m for m, _ in rows}):
        labels = [y for m, y in rows if m == margin]
        blocks.append([sum(labels), len(labels), [margin]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            total, n, margins = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + n, blocks[-1][2] + margins]
    return {m: total / n for total, n, margins in blocks for m in margins}


def test_toxicity_calibration_against_pooled_violators(spark):
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(600):
        toxic = i % 4 == 0
        wrong = rng.random() < 0.15  # labels that the features cannot explain
        text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(30))
        rows.append((i, text + (" you stupid idiot" if toxic != wrong else "")))
        marks.append((i, int(toxic)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    model = toxicity.labelled_model(table, labels)
    shown = toxicity._margin(model.trees, table.withColumn(
        "features", toxicity.feature_column(F.col("text"), model.lexicon)))
    margin = {r.doc_id: r.margin for r in shown.select("doc_id", "margin").collect()}
    last = {r.doc_id for r in table.filter(fold() == 4).select("doc_id").collect()}
    want = pooled([(margin[i], y) for i, y in marks if i in last])
    scores = {r.doc_id: r.score for r in toxicity.scored(table, model).collect()}
    assert all(math.isclose(scores[i], want[margin[i]] * 0.999 + margin[i] * 0.001, abs_tol=1e-9) for i in last)

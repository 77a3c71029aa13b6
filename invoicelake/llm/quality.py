"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text is a vector of weighted byte trigrams (hashed) and of a few measures of its shape. A singular
value decomposition of a bounded, balanced sample of labelled texts gives the latent space. The
sample's vectors, bounded by `max_rows * dimensions`, go to every task; there every document is
compared with all of them, in blocks of exact cosine products, and its nearest neighbours vote with
their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from invoicelake.llm.byte_words import LOWER, span_hashes, text_slices, word_spans
from invoicelake.llm.labelled import labelled_sample
from invoicelake.llm.shared import named_apart

BINS = 2048
SHAPES = 7
ROWS = 256  # documents of one block


@dataclass(frozen=True)
class Voting:
    max_rows: int = 4_000  # labelled documents that are learned from, half of each label
    dimensions: int = 64
    neighbours: int = 25
    shape_weight: float = 1.5


@dataclass(frozen=True)
class QualityModel:
    idf: np.ndarray
    shape_mean: np.ndarray
    space: np.ndarray  # (terms, dimensions)
    vectors: np.ndarray  # (labelled, dimensions), of length one
    labels: np.ndarray
    voting: Voting


def raw_vectors(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(log counts of hashed trigrams, shapes) for blocks of rows."""
    for _, data, starts in text_slices(texts, ROWS):
        rows = len(starts) - 1
        counts = np.zeros((rows, BINS), dtype=np.float32)
        if len(data) >= 3:
            code = data[:-2].astype(np.uint32) << 16 | data[1:-1].astype(np.uint32) << 8 | data[2:]
            code = (code * np.uint32(2654435761)) >> np.uint32(32 - 11)
            row = np.repeat(np.arange(rows), np.diff(starts))[:-2]
            whole = np.arange(len(code)) + 3 <= starts[row + 1]
            counts = np.bincount(
                row[whole] * BINS + code[whole], minlength=rows * BINS
            ).reshape(rows, BINS).astype(np.float32)
        yield np.log1p(counts), _shapes(data, starts)


_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def _shapes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    rows = len(starts) - 1
    out = np.zeros((rows, SHAPES), dtype=np.float32)
    begin, end = word_spans(data, starts)
    words = span_hashes(LOWER[data], begin, end)
    at = np.searchsorted(begin, starts)
    upper, sign = (np.concatenate([[0], np.cumsum(t[data])]) for t in (_UPPER, _SIGN))
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    for r in range(rows):
        a, b = at[r], at[r + 1]
        size, n = starts[r + 1] - starts[r], b - a
        if not n:
            continue
        mine = words[a:b]
        pairs = mine[1:] * np.uint64(3) ^ mine[:-1]
        out[r] = (
            np.mean(mine[1:] == mine[:-1]) if n > 1 else 0.0,
            1 - len(np.unique(pairs)) / len(pairs) if n > 1 else 0.0,
            (upper[starts[r + 1]] - upper[starts[r]]) / size,
            min(1.0, 4 * (sign[starts[r + 1]] - sign[starts[r]]) / size),
            min(1.0, np.mean(end[a:b] - begin[a:b]) / 16),
            min(1.0, np.log1p(n) / 12),
            min(1.0, 20 * (lines[starts[r + 1]] - lines[starts[r]]) / n),
        )
    return out


def _weighted(counts: np.ndarray, shapes: np.ndarray, idf, mean, weight: float) -> np.ndarray:
    terms = counts * idf
    terms /= np.maximum(1e-9, np.linalg.norm(terms, axis=1, keepdims=True))
    return np.concatenate([terms, weight * (shapes - mean)], axis=1).astype(np.float32)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(1e-9, np.linalg.norm(vectors, axis=1, keepdims=True))


def _sample_vectors(batches):
    for batch in batches:
        found = [np.concatenate(x, axis=1) for x in raw_vectors(batch.column("text"))]
        if found:
            flat = np.concatenate(found).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([v.tobytes() for v in flat], pa.binary())],
                names=["label", "vector"])


def labelled_model(
    docs: DataFrame, labels: DataFrame, voting: Voting = Voting(), key: str = "doc_id"
) -> QualityModel:
    """A model learned from `labels.quality`, never from rows of fold 0.

    At most about `max_rows` vectors come to the driver, whatever the size of the table. Without
    labels every score is 0.
    """
    named_apart(docs, key, "text")
    half = voting.max_rows // 2
    found = [
        row for label in (0, 1)
        for row in labelled_sample(docs, labels.filter(F.col("quality") == label), "quality", half, key)
        .orderBy(key).select("label", "text")
        .mapInArrow(_sample_vectors, "label double, vector binary").collect()
    ]
    terms = BINS + SHAPES
    if not found:
        return QualityModel(np.ones(BINS), np.zeros(SHAPES), np.zeros((terms, 1), np.float32),
                            np.zeros((0, 1), np.float32), np.zeros(0), voting)
    raw = np.stack([np.frombuffer(row["vector"], np.float16) for row in found]).astype(np.float32)
    counts, shapes = raw[:, :BINS], raw[:, BINS:]
    idf = np.log((1 + len(raw)) / (1 + (counts > 0).sum(axis=0))) + 0.05
    mean = shapes.mean(axis=0)
    matrix = _weighted(counts, shapes, idf, mean, voting.shape_weight)
    space = _latent_space(matrix, voting.dimensions)
    return QualityModel(idf, mean, space, _unit(matrix @ space),
                        np.array([row["label"] for row in found]), voting)


def _latent_space(matrix: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading right singular vectors, by randomised subspace iteration."""
    wide = min(dimensions + 16, *matrix.shape)
    basis = np.random.default_rng(3).standard_normal((matrix.shape[1], wide)).astype(np.float32)
    for _ in range(4):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ turn.T)[:, :dimensions], dtype=np.float32)


def votes(texts: pa.Array, model: QualityModel) -> np.ndarray:
    """The score of each text; 0 for texts without anything in common with the sample."""
    out = []
    k = min(model.voting.neighbours, len(model.vectors))
    for counts, shapes in raw_vectors(texts):
        if not k:
            out.append(np.zeros(len(counts)))
            continue
        some = counts.any(axis=1)
        matrix = _weighted(counts, shapes, model.idf, model.shape_mean, model.voting.shape_weight)
        near = _unit(matrix @ model.space) @ model.vectors.T
        best = np.argpartition(near, -k, axis=1)[:, -k:]
        weight = np.maximum(0, np.take_along_axis(near, best, axis=1)).astype(float)
        total = weight.sum(axis=1)
        score = (weight * model.labels[best]).sum(axis=1) / np.maximum(1e-9, total)
        out.append(np.where(some & (total > 0), np.clip(score, 0, 1), 0.0))
    return np.concatenate(out) if out else np.empty(0)


def score_column(spark, model: QualityModel, text: Column) -> Column:
    """The score as a column; the model goes to each executor once."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(votes(texts, shared.value), pa.float64())

    return run(text)


def scored(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of `docs` with `score`: 0 to 1, the higher the likelier of good quality.

    Null, empty and one- or two-byte texts score 0. An empty table gives an empty table; repeated
    rows get equal scores; other columns pass through, but a column `score` is refused.
    """
    named_apart(docs, "text")
    if "score" in docs.columns:
        raise ValueError("the table already has a column score")
    return docs.withColumn("score", score_column(docs.sparkSession, model, F.col("text")))

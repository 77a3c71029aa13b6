"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

The features are densities of insult words (a fixed list, and words and word beginnings learned
from training labels), their nearness to the second person, capitals, punctuation, and disguised
insults. One part of the training rows gives the learned list, one the trees, one the calibration.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from invoicelake.llm.byte_words import LOWER, span_hashes, text_slices, word_spans
from invoicelake.llm.labelled import labelled_sample
from invoicelake.llm.shared import named_apart, stored

# Common insults, and words of the second person, in four languages.
INSULTS = """
asshole bastard bitch clown coward cretin crap damn dickhead disgusting dumb dumbass fool freak
garbage hate idiot idiotic imbecile jerk liar loser lunatic maggot moron moronic parasite pathetic
pig pigs rat rats retard rubbish scum shit slut stupid sucker trash ugly useless vermin vile whore
worthless wretch arschloch bloed blödmann dreck dumm dummkopf ekelhaft idiota idioten miststück
scheisse scheiße schwein trottel versager wertlos abschaum abruti connard connasse crétin débile
ordure pourriture salaud salope imbécile merde minable raté asqueroso basura cabrón escoria
estúpido inútil mierda patético perdedor puta tonto
""".split()
SECOND_PERSON = """
you your yours yourself u ur du dich dir dein deine deiner euch ihr euer tu te toi ton ta tes vous
votre vos tú ti tus usted ustedes vosotros os vuestra vuestro
""".split()
# Signs that stand for letters, and signs put between them.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
SEPARATORS = "*._-'"

NEAR = 5  # words between an insult and the second person
BEGINNINGS = (4, 5)  # bytes of a word's beginning that are learned besides whole words
FEATURES = 15


def _table_of(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_LETTERS = _table_of(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGITS = _table_of(b"0123456789")
_ALNUM = _LETTERS | _DIGITS
_UPPER = _table_of(bytes(range(65, 91)))
_SIGNS = ~(_ALNUM | _table_of(b" \t\n\r\x0b\x0c"))
_DISGUISE = LOWER.copy()
for _sign, _letter in LOOKALIKES.items():
    _DISGUISE[ord(_sign)] = ord(_letter)
_DISGUISED_WORD = _LETTERS | _table_of("".join(LOOKALIKES).encode())
_SEPARATOR = _table_of(SEPARATORS.encode())


def _hashes_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return np.unique(span_hashes(data, *word_spans(data, np.array([0, len(data)]))))


_INSULTS, _SECOND = _hashes_of(INSULTS), _hashes_of(SECOND_PERSON)


@dataclass(frozen=True)
class Lexicon:
    """Learned hashes of words and beginnings, sorted, and what each is worth."""

    hashes: np.ndarray
    worth: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes) or not len(hashes):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.worth[at], 0.0)


NO_LEXICON = Lexicon(np.empty(0, np.uint64), np.empty(0))


def _beginnings(data: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the first bytes of the words that are longer; 0 for the others."""
    longer = end - begin > size
    out = np.zeros(len(begin), dtype=np.uint64)
    out[longer] = span_hashes(data, begin[longer], begin[longer] + size) ^ np.uint64(size)
    return out


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """A row of FEATURES numbers for each text; zeros for one without words."""
    rows = [_features(data, starts, lexicon) for _, data, starts in text_slices(texts)]
    return np.concatenate(rows) if rows else np.empty((0, FEATURES))


def _features(data: np.ndarray, starts: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    low = LOWER[data]
    begin, end = word_spans(data, starts, _ALNUM)
    at = np.searchsorted(begin, starts)
    words = span_hashes(low, begin, end)
    insult = np.isin(words, _INSULTS)
    learned = lexicon.of(words)
    started = np.zeros(len(words))
    for size in BEGINNINGS:
        started = np.maximum(started, lexicon.of(_beginnings(low, begin, end, size)))
    bad = insult | (learned > 0) | (started > 0)
    second = np.isin(words, _SECOND)
    near = _spread(second, at) & bad
    # Whole words in capitals: as many capital as all bytes, and more than one.
    capitals = _sums(_UPPER[data], np.stack([begin, end]))
    shout = (capitals == end - begin) & (end - begin > 1)

    def per_row(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return _sums(flags, np.stack([edges[:-1], edges[1:]]))

    n = np.maximum(1, np.diff(at)).astype(float)
    size = np.maximum(1, np.diff(starts)).astype(float)
    clear, hidden = per_row(insult, at), _disguised(data, starts)
    worth = per_row(learned, at)
    beginnings = per_row(started, at)
    hits = per_row(bad, at)
    return np.stack([
        clear / n, worth / n, beginnings / n, hits / n, np.log1p(clear), np.log1p(worth),
        np.log1p(beginnings), per_row(near, at) / n, per_row(second, at) / n,
        per_row(_UPPER[data], starts) / size, per_row(shout, at) / n,
        per_row(_SIGNS[data], starts) / size, per_row(data == ord("!"), starts) / size,
        np.maximum(0, hidden - clear) / n, np.log1p(np.diff(at)),
    ], axis=1)


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sofar = np.concatenate([[0], np.cumsum(values, dtype=float)])
    return sofar[edges[1]] - sofar[edges[0]]


def _spread(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Marks what is within NEAR words of a flag in the same row."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    out = flags.copy()
    for d in range(1, NEAR + 1):
        same = row[d:] == row[:-d]
        out[d:] |= flags[:-d] & same
        out[:-d] |= flags[d:] & same
    return out


def _disguised(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Insults of the fixed list per row, once separators are dropped and lookalikes read."""
    keep = ~_SEPARATOR[data]
    moved = np.concatenate([[0], np.cumsum(keep)])[starts]
    left = _DISGUISE[data[keep]]
    begin, end = word_spans(data[keep], moved, _DISGUISED_WORD)
    found = np.isin(span_hashes(left, begin, end), _INSULTS)
    at = np.searchsorted(begin, moved)
    return _sums(found, np.stack([at[:-1], at[1:]]))


# -- training --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Training:
    max_rows: int = 20_000  # labelled documents that are learned from, at most
    lexicon_size: int = 2_000
    min_documents: int = 3
    min_lift: float = 8.0
    trees: int = 20
    depth: int = 4


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None  # None: the training rows had one class only
    calibration: IsotonicRegressionModel | None
    constant: float = 0.0


def _terms(batches):
    for batch in batches:
        out_hash, out_toxic = [], []
        labels = batch.column("label").to_numpy()
        for first, data, starts in text_slices(batch.column("text")):
            low = LOWER[data]
            begin, end = word_spans(data, starts, _ALNUM)
            at = np.searchsorted(begin, starts)
            columns = [span_hashes(low, begin, end)]
            columns += [_beginnings(low, begin, end, size) for size in BEGINNINGS]
            for row in range(len(starts) - 1):
                mine = np.unique(np.concatenate([c[at[row] : at[row + 1]] for c in columns]))
                mine = mine[mine != 0]
                out_hash.append(mine)
                out_toxic.append(np.full(len(mine), labels[first + row]))
        if out_hash:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out_hash).view(np.int64)),
                 pa.array(np.concatenate(out_toxic))], names=["term", "label"])


def learned_lexicon(sample: DataFrame, training: Training) -> Lexicon:
    """Terms that stand in toxic documents far more often than in others.

    At most `lexicon_size` rows come to the driver.
    """
    sizes = sample.groupBy("label").count().collect()
    count = {row["label"]: row["count"] for row in sizes}
    toxic, clean = count.get(1.0, 0), count.get(0.0, 0)
    if not toxic or not clean:
        return NO_LEXICON
    lift = ((F.col("a") + 0.5) / (toxic + 1)) / ((F.col("b") + 0.5) / (clean + 1))
    best = (
        sample.mapInArrow(_terms, "term bigint, label double")
        .groupBy("term").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
        .filter(F.col("a") >= training.min_documents).withColumn("lift", lift)
        .filter(F.col("lift") >= training.min_lift)
        .orderBy(F.desc(F.col("lift") * F.sqrt("a")), "term").limit(training.lexicon_size)
        .collect()
    )
    terms = np.array([row["term"] for row in best], dtype=np.int64).view(np.uint64)
    worth = np.log([max(row["lift"], 1.0) for row in best]) if best else np.empty(0)
    order = np.argsort(terms)
    return Lexicon(terms[order], np.asarray(worth)[order])


def feature_column(text: Column, lexicon: Lexicon) -> Column:
    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        rows = features(texts, lexicon)
        starts = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * FEATURES)
        return pa.ListArray.from_arrays(starts, pa.array(rows.ravel()))

    return array_to_vector(run(text))


def labelled_model(
    docs: DataFrame, labels: DataFrame, training: Training = Training(), key: str = "doc_id"
) -> ToxicityModel:
    """A model learned from `labels.toxic`, never from rows of fold 0.

    Folds 1 and 2 give the lexicon, 2 and 3 the trees, 4 the calibration. Without any toxic or any
    clean training row the model answers with the one class it knows (0 if there is none).
    """
    sample = stored(labelled_sample(docs, labels, "toxic", training.max_rows, key))
    lexicon = learned_lexicon(sample.filter("fold IN (1, 2)"), training)
    shown = stored(sample.select(
        "label", "fold", vector_to_array(feature_column(F.col("text"), lexicon)).alias("x")
    )).coalesce(4).select("label", "fold", array_to_vector("x").alias("features"))
    grown = shown.filter("fold IN (2, 3)")
    classes = {row["label"] for row in grown.select("label").distinct().collect()}
    if classes != {0.0, 1.0}:
        return ToxicityModel(lexicon, None, None, max(classes, default=0.0))
    trees = GBTClassifier(
        maxIter=training.trees, maxDepth=training.depth, stepSize=0.2, seed=7, minInstancesPerNode=2
    ).fit(grown)
    margins = _margin(trees, shown.filter("fold = 4"))
    known = {row["label"] for row in margins.select("label").distinct().collect()}
    calibration = None
    if known == {0.0, 1.0}:
        calibration = IsotonicRegression(featuresCol="margin").fit(margins)
    return ToxicityModel(lexicon, trees, calibration)


def _margin(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn(
        "margin", F.get(vector_to_array("probability"), F.lit(1))
    ).drop("rawPrediction", "probability", "prediction")


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of `docs` with `score`: 0 to 1, the higher the likelier toxic.

    The calibrated score, with a thousandth of the trees' own so that ties of the calibration keep
    their order. Null and empty texts are scored as texts without words. An empty table gives an
    empty table; other columns pass through, but for names that the model uses.
    """
    named_apart(docs, "text")
    used = {"score", "features", "margin", "rawPrediction", "probability", "prediction"}
    if used & set(docs.columns):
        raise ValueError(f"the table already has one of the columns {sorted(used)}")
    if model.trees is None:
        return docs.withColumn("score", F.lit(model.constant))
    shown = _margin(model.trees, docs.withColumn(
        "features", feature_column(F.col("text"), model.lexicon)))
    calibrated = F.col("margin")
    if model.calibration is not None:
        shown = model.calibration.transform(shown)
        calibrated = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))
    return shown.withColumn("score", calibrated * 0.999 + F.col("margin") * 0.001).select(
        *docs.columns, "score")


def without_toxic(docs: DataFrame, model: ToxicityModel, limit: float = 0.5) -> DataFrame:
    """The rows of `docs` whose score is below `limit`."""
    return scored(docs, model).filter(F.col("score") < limit).select(*docs.columns)

"""Quality scores learned from preference pairs (Bradley-Terry).

A document is described by shares and logarithms that follow from its text alone (``FEATURES``). Every labelled document is
paired with ``PARTNERS`` random documents of the other class; the weights make the preferred document of a pair win: logistic loss
on the difference of the two documents' features, by Newton steps whose sums are taken in tasks. The threshold is the quantile of
all labelled documents' scores below which, going by the labels, those of class 0 lie. A score is the logistic
function of the distance from the threshold, so 0.5 is the threshold.

Cases: null and empty texts get a score like any other; equal texts get equal scores; texts of any length are
described whole. If one class has no labelled document, nothing can be compared: every score is 1 if only class 1 is known,
else 0 if only class 0 is, else 0.5.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabload.llm.common import slices, small_batches, tidy
from tabload.llm.labelled import known_labels
from tabload.operators.links import number_rows
from tabload.session import stage

PARTNERS = 4
RIDGE = 1e-3
STEPS = 25
SEED = 11
SLICE_BYTES = 1_000_000
PIECE = 1 << 16
BROADCAST_CLASS = 10_000  # documents up to which the partners of a class are broadcast
BINS = 4_096

# byte classes
_CLASSES = ["other", "lower", "upper", "digit", "space", "line", "stop", "loud", "bar", "symbol"]
FEATURES = [
    *(f"share of {name}" for name in _CLASSES), "words that end in a symbol", "words that repeat the one before",
    "distinct words", "distinct word pairs", "distinct lines", "log bytes", "log words", "bytes per word", "log words per line",
]


def _class_table() -> bytes:
    table = bytearray(256)
    for code in range(128):
        char = chr(code)
        name = (
            "lower" if char.islower() else "upper" if char.isupper() else "digit" if char.isdigit() else "line" if char == "\n"
            else "space" if char in " \t\x0b\x0c\r" else "stop" if char in ".,;:'\"()-" else "loud" if char in "!?"
            else "bar" if char == "|" else "symbol" if char.isprintable() else "other"
        )
        table[code] = _CLASSES.index(name)
    return bytes(table)


_TABLE = _class_table()


def _classes(text: bytes) -> tuple[np.ndarray, int]:
    """How many bytes of each class a text has, and how many loud or odd ones end a word; a few bytes of memory for each one of the text."""
    kind = np.frombuffer(text.translate(_TABLE), dtype=np.uint8)
    counts = np.zeros(len(_CLASSES), dtype=np.int64)
    for at in range(0, len(kind), PIECE):  # bincount widens what it counts to eight bytes each
        counts += np.bincount(kind[at: at + PIECE], minlength=len(_CLASSES))
    gap = (kind[1:] == _CLASSES.index("space")) | (kind[1:] == _CLASSES.index("line"))
    return counts, int(np.count_nonzero((kind[:-1] >= _CLASSES.index("loud")) & gap))


def describe(texts: list[bytes]) -> np.ndarray:
    """One row of features per UTF-8 text."""
    kinds = len(_CLASSES)
    out = np.zeros((len(texts), len(FEATURES)))
    for at, text in enumerate(texts):
        counts, loud_ends = _classes(text)
        words = text.split()
        lines = text.split(b"\n")
        n_words = max(1, len(words))
        out[at, :kinds] = counts / max(1, len(text))
        out[at, kinds:] = (
            loud_ends / n_words, sum(map(operator.eq, words, words[1:])) / n_words, len(set(words)) / n_words,
            (len(set(zip(words, words[1:]))) + 1) / n_words, len(set(lines)) / len(lines), np.log1p(len(text)),
            np.log1p(len(words)), min(50.0, len(text) / n_words), np.log1p(len(words) / len(lines)),
        )
    return out


@dataclass
class Model:
    """Score = logistic(scale * (features . weights - threshold))."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    constant: float | None = None

    def standard(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.centre) / self.spread, -8, 8)

    def strengths(self, features: np.ndarray) -> np.ndarray:
        # summed row by row, not as a matrix product, whose rounding depends on the other rows
        return (self.standard(features) * self.weights).sum(axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return _logistic(self.strengths(describe(texts)) - self.threshold)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _sums(ahead: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Number of pairs, slope and curvature of the pairs' log likelihood, in one vector."""
    lose = 1 - _logistic(ahead @ weights)
    curve = (ahead * (lose * (1 - lose))[:, None]).T @ ahead
    return np.concatenate(([len(ahead)], ahead.T @ lose, curve.reshape(-1)))


def _newton(sums: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The weights that make the pairs likeliest, less the ridge, from the sums over all pairs at given weights."""
    weights = np.zeros(size)
    for _ in range(STEPS):
        found = sums(weights)
        slope = found[1: size + 1] / found[0] - RIDGE * weights
        curve = found[size + 1:].reshape(size, size) / found[0] + RIDGE * np.eye(size)
        step = np.linalg.solve(curve, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _middle(inside: np.ndarray) -> float:
    """The middle of the widest gap of a few ascending scores."""
    gaps = np.diff(inside)
    return float(inside[gaps.argmax()] + gaps.max() / 2) if len(gaps) else float(inside[0])


def fit(features: np.ndarray, labels: np.ndarray, share_low: float) -> Model:
    """The model of a few documents at hand: weights from random pairs of the two classes, threshold at the quantile ``share_low``."""
    rng = np.random.default_rng(SEED)
    centre, spread = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-6)
    x = np.clip((features - centre) / spread, -8, 8)
    high, low = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    better = np.concatenate((np.repeat(high, PARTNERS), rng.choice(high, PARTNERS * len(low))))
    worse = np.concatenate((rng.choice(low, PARTNERS * len(high)), np.repeat(low, PARTNERS)))
    ahead = x[better] - x[worse]
    model = Model(centre, spread, _newton(lambda weights: _sums(ahead, weights), x.shape[1]), 0.0)
    # the classes may be here in other shares than among the labels: weigh the scores back before taking the quantile
    strength = model.strengths(features)
    weight = np.where(labels == 1, (1 - share_low) / len(high), share_low / len(low))
    order = np.argsort(strength, kind="stable")
    below = int(np.searchsorted(np.cumsum(weight[order]), share_low))
    model.threshold = _middle(strength[order][max(0, below - 1): below + 2])
    return model


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of feature lists, one row each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(matrix.reshape(-1), pa.float64()))


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of a short vector over all batches of a column of features: one vector per task reaches the driver."""
    @tidy
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [part(_matrix(batch.column(0))) for batch in batches if len(batch)]
        if held:
            yield pa.RecordBatch.from_arrays([_lists(np.sum(held, axis=0)[None, :])], ["v"])

    found = rows.mapInArrow(step, "v array<double>").toArrow()["v"].to_pylist()
    return np.sum(found, axis=0)


def _at_place(values: DataFrame, place: int) -> float:
    """The value (column ``s``) at a place in ascending order, counted from 0: the bin that holds it is narrowed until it has one value."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    while low < high:
        share = (F.col("s") - F.lit(low)) / F.lit(high - low)
        bins = values.filter(F.col("s").between(low, high)).groupBy(F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin"))
        found = bins.agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).toArrow().sort_by("bin")
        upto = np.cumsum(found["n"].to_numpy())
        at = int(np.searchsorted(upto, place, side="right"))
        place -= int(upto[at - 1]) if at else 0
        low, high = found["low"][at].as_py(), found["high"][at].as_py()
    return low


def _pairs(described: DataFrame, sizes: tuple[int, int], model: Model) -> DataFrame:
    """``ahead``: features of the preferred document less those of the other one, for each document and ``PARTNERS`` of the other class.

    Documents are numbered by class and a hash of their id; the numbers of the partners are drawn by a hash.
    """
    order = ["label", F.xxhash64("id"), "id", F.xxhash64("x")]
    numbered = stage(number_rows(described, order, "at", start=0).select("at", "label", "x"), "numbered")

    def ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            better = np.where(batch.column(2).to_numpy() == 1, 1.0, -1.0)
            apart = model.standard(_matrix(batch.column(0))) - model.standard(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([_lists(apart * better[:, None])], ["ahead"])

    found = []
    for label, other in ((0, 1), (1, 0)):
        draw = F.pmod(F.xxhash64("at", "turn", F.lit(SEED)), F.lit(sizes[other])) + F.lit(sizes[0] * other)
        drawn = (
            numbered.filter(F.col("label") == label).withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(PARTNERS))))
            .select("x", "label", draw.alias("partner"))
        )
        partners = numbered.filter(F.col("label") == other).select(F.col("at").alias("partner"), F.col("x").alias("other"))
        found.append(drawn.join(F.broadcast(partners) if sizes[other] <= BROADCAST_CLASS else partners, "partner").select("x", "other", "label"))
    return found[0].unionByName(found[1]).mapInArrow(tidy(ahead), "ahead array<double>")


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from all labelled documents. Driver state: sums of a few hundred numbers per task and ``BINS`` counts."""
    known, sizes = known_labels(labels, F.col(label_col), id_col)
    none = np.zeros(1)
    if not sizes.get(0) or not sizes.get(1):
        return Model(none, np.ones(1), none, 0.0, 1.0 if sizes.get(1) else 0.0 if sizes.get(0) else 0.5)
    small_batches()
    kind = dict(docs.dtypes)[id_col]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in slices([len(x) for x in texts], SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], _lists(describe(texts[part]))], ["id", "x"]
                )

    # features meet the labels, so that no text is shuffled
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    every = texts.filter(F.col("id").isNotNull()).mapInArrow(tidy(features), f"id {kind}, x array<double>")
    described = stage(every.join(known, F.col("id") == F.col("of")).select("id", "label", "x"), "features")
    here = {row["label"]: row["count"] for row in described.groupBy("label").count().collect()}
    if len(here) < 2:  # labels whose documents are not there
        return Model(none, np.ones(1), none, 0.0, float(next(iter(here), 0.5)))
    n = here[0] + here[1]
    centre = _summed(described.select("x"), lambda x: x.sum(axis=0)) / n
    spread = np.sqrt(_summed(described.select("x"), lambda x: ((x - centre) ** 2).sum(axis=0)) / n)
    model = Model(centre, np.maximum(spread, 1e-6), np.zeros(len(FEATURES)), 0.0)
    pairs = stage(_pairs(described, (here[0], here[1]), model), "pairs")
    model.weights = _newton(lambda weights: _summed(pairs, lambda ahead: _sums(ahead, weights)), len(FEATURES))

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.strengths(_matrix(batch.column(0))), pa.float64())], ["s"])

    strong = stage(described.select("x").mapInArrow(tidy(strengths), "s double"), "strengths")
    model.threshold = _middle(np.array([_at_place(strong, at) for at in range(max(0, here[0] - 2), here[0] + 1)]))
    return model


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """Score of a text column (0 to 1)."""
    small_batches()
    shared = spark.sparkContext.broadcast(model)  # a few hundred numbers

    @F.arrow_udf("double")
    @tidy
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [x or b"" for x in batch.to_pylist()]
            parts = [shared.value.scores(texts[part]) for part in slices([len(x) for x in texts], SLICE_BYTES)]
            yield pa.array(np.concatenate(parts or [np.empty(0)]), pa.float64())

    return scored(text.cast("binary"))

"""Toxicity by multiple-instance learning: labels are on documents, scores on sentences.

A sentence has probability p = logistic(bias + sum of the weights of its words); a document is toxic if any of its sentences
is: P = 1 - product of (1 - p), the noisy-or. The weights are fitted to document labels alone, by gradient steps on the
log-loss of P over a bounded sample; they then tell which sentences offend. A word's weight is the sum of the weights of its
features: the word and its first four, five and six letters, hashed into ``BUCKETS``. Part of the sample is kept
from the fit to choose the threshold with the fewest errors, and scores are shifted so that it lies at 0.5.

Cases: null and empty texts, and texts without a word, have no sentence and get the score of a document with P = 0; equal texts get
equal scores; texts of any length are scored whole. If one class has no labelled document, nothing can be learned: every
score is 1 if only class 1 is known, else 0 if only class 0 is, else 0.5.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabload.llm.common import slices, small_batches
from tabload.llm.labelled import sample_labelled

BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)
PER_CLASS = 3_000
KEPT_BACK = 4  # one in so many documents of the sample chooses the threshold
STEPS = 150
RATE = 1.0
LEAST_SURE, MOST_SURE = 2.0, 4.0  # standard errors of a difference in log odds between which a weight gains freedom
DECAY = 1e-5
FIRST_BIAS = -9.0
TABLE_WORDS = 300_000  # distinct words a task keeps the features of
SLICE_CHARS = 1_000_000

_TOKEN = re.compile(r"[^\W_]+|[.!?\n]")
_STOPS = ".!?\n"


class _Words(dict):
    """Numbers distinct tokens; the marks that end a sentence come first."""

    def __init__(self) -> None:
        super().__init__((mark, at) for at, mark in enumerate(_STOPS))
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = place = len(self)
        return place


def features_of(word: str) -> list[int]:
    """Buckets of a word and of its beginnings."""
    keys = [f"={word}", *(f"{size}{word[:size]}" for size in PREFIXES)]
    return [zlib.crc32(key.encode()) % BUCKETS for key in keys]


def sentences(tokens: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word token the number of its sentence, and the document of each sentence."""
    mark = tokens < len(_STOPS)
    cut = np.zeros(len(tokens), dtype=bool)
    cut[1:] = (owner[1:] != owner[:-1]) | mark[:-1]
    number = np.cumsum(cut)[~mark]
    if not len(number):
        return number, number
    _, dense = np.unique(number, return_inverse=True)  # sentences without words do not count
    first = np.concatenate(([True], dense[1:] != dense[:-1]))
    return dense, owner[~mark][first]


@dataclass
class Tokens:
    """Texts as numbers of distinct words, with the features of those words."""

    words: _Words = field(default_factory=_Words)
    buckets: np.ndarray = field(default_factory=lambda: np.zeros((len(_STOPS), 1 + len(PREFIXES)), dtype=np.int64))

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers of all texts, and the text of each."""
        found = [_TOKEN.findall(text.lower()) for text in texts]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        place = self.words.__getitem__
        tokens = np.fromiter((place(word) for some in found for word in some), dtype=np.int64, count=int(counts.sum()))
        new = self.words.new
        if new:
            self.buckets = np.concatenate((self.buckets, np.array([features_of(word) for word in new], dtype=np.int64)))
            new.clear()
        return tokens, np.repeat(np.arange(len(texts)), counts)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def noisy_or(logits: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """log(1 - P) of n documents, from the logits of their sentences."""
    return np.bincount(doc, weights=-np.logaddexp(0, np.clip(logits, -40, 40)), minlength=n)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    shift: float  # logit of the chosen threshold
    constant: float | None = None

    def sentence_logits(self, held: Tokens, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logit of each sentence that has a word, and its text."""
        tokens, owner = held.read(texts)
        sentence, doc = sentences(tokens, owner)
        by_word = self.weights[held.buckets].sum(axis=1)
        words = tokens[tokens >= len(_STOPS)]
        return self.bias + np.bincount(sentence, weights=by_word[words], minlength=len(doc)), doc

    def scores(self, held: Tokens, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        logits, doc = self.sentence_logits(held, texts)
        return _logistic(_logit(noisy_or(logits, doc, len(texts))) - self.shift)


def _logit(log_not: np.ndarray) -> np.ndarray:
    """log(P / (1 - P)) from log(1 - P)."""
    log_not = np.minimum(log_not, -1e-12)
    return np.log(-np.expm1(log_not)) - log_not


def reach_of(doc_words: np.ndarray, buckets: np.ndarray, labels: np.ndarray, learn: np.ndarray) -> np.ndarray:
    """How far the weight of each bucket may move (0 to 1), by how surely it tells the classes of whole documents apart.

    ``doc_words``: distinct pairs of document and word number, as ``document * len(buckets) + word``.
    """
    doc, word = np.divmod(doc_words, len(buckets))
    keep = learn[doc]
    doc, word = doc[keep], word[keep]
    held = [np.full(BUCKETS, 0.5), np.full(BUCKETS, 0.5)]
    for feature in range(buckets.shape[1]):  # one at a time: all pairs at once would take a few times the memory
        pairs = np.unique(doc * BUCKETS + buckets[word, feature])
        of_class = labels[pairs // BUCKETS] == 1
        for which in (0, 1):
            held[which] += np.bincount(pairs[of_class == which] % BUCKETS, minlength=BUCKETS)
    n = [((labels == which) & learn).sum() + 1.0 for which in (0, 1)]
    odds = [np.log(a / np.maximum(m - a + 0.5, 0.5)) for a, m in zip(held, n, strict=True)]
    sure = np.abs(odds[1] - odds[0]) / np.sqrt(1 / held[0] + 1 / held[1])
    return np.clip((sure - LEAST_SURE) / (MOST_SURE - LEAST_SURE), 0.0, 1.0)


def _read_parts(held: Tokens, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words, their sentences and the sentences' documents, read a few texts at a time."""
    before = 0
    for part in slices([len(x) for x in texts], SLICE_CHARS):
        tokens, owner = held.read(texts[part])
        sentence, doc = sentences(tokens, owner)
        yield tokens[tokens >= len(_STOPS)], sentence + before, doc + part.start
        before += len(doc)


def fit(texts: list[str], labels: np.ndarray, sizes: tuple[int, int]) -> Model:
    """Full-batch gradient steps with a rate per weight (Adagrad); ``sizes`` are the labelled documents of class 0 and 1."""
    held = Tokens()
    words, sentence, doc = (np.concatenate(x) for x in zip(*_read_parts(held, texts), strict=True))
    learn = np.ones(len(texts), dtype=bool)
    for which in (0, 1):
        learn[np.flatnonzero(labels == which)[KEPT_BACK - 1::KEPT_BACK]] = False
    in_fit = learn[doc[sentence]] if len(sentence) else np.zeros(0, bool)
    balance = np.where(labels == 1, 0.5 / max(1, (labels[learn] == 1).sum()), 0.5 / max(1, (labels[learn] == 0).sum())) * learn
    reach = reach_of(np.unique(doc[sentence] * len(held.buckets) + words), held.buckets, labels, learn)
    weights, bias = np.zeros(BUCKETS), FIRST_BIAS
    moved, moved_bias = np.full(BUCKETS, 1e-8), 1e-8
    own_words, own_sentences = words[in_fit], sentence[in_fit]
    for _ in range(STEPS):
        by_word = weights[held.buckets].sum(axis=1)
        logits = bias + np.bincount(sentence, weights=by_word[words], minlength=len(doc))
        chance = _logistic(logits)
        log_not = noisy_or(logits, doc, len(texts))
        toxic = np.maximum(-np.expm1(log_not), 1e-9)
        pull = np.where(labels == 1, np.exp(log_not) / toxic, -1.0) * balance
        slope = pull[doc] * chance
        word_slope = np.bincount(own_words, weights=slope[own_sentences], minlength=len(held.buckets))
        total = np.bincount(held.buckets.reshape(-1), weights=np.repeat(word_slope, held.buckets.shape[1]), minlength=BUCKETS)
        total -= DECAY * weights
        moved += total * total
        weights += RATE * reach * total / np.sqrt(moved)
        moved_bias += slope.sum() ** 2
        bias += RATE * slope.sum() / np.sqrt(moved_bias)
    model = Model(weights, float(bias), 0.0)
    by_word = weights[held.buckets].sum(axis=1)
    logits = bias + np.bincount(sentence, weights=by_word[words], minlength=len(doc))
    strength = _logit(noisy_or(logits, doc, len(texts)))[~learn]
    kept = labels[~learn]
    # errors as they would be among all labelled documents
    cost = np.where(kept == 1, sizes[1] / max(1, (kept == 1).sum()), sizes[0] / max(1, (kept == 0).sum()))
    order = np.argsort(strength, kind="stable")
    errors = np.cumsum(np.where(kept[order] == 1, cost[order], -cost[order]))
    errors = np.concatenate(([0.0], errors))  # by number of documents below the threshold
    least = np.flatnonzero(errors <= errors.min() + 1e-9)
    edges = np.concatenate(([strength.min() - 2.0], strength[order], [strength.max() + 2.0])) if len(order) else np.zeros(2)
    gaps = edges[least + 1] - edges[least]
    best = least[gaps.argmax()]
    model.shift = float((edges[best] + edges[best + 1]) / 2)
    return model


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Learn from labelled documents. Driver state: the texts of about twice ``per_class`` documents and ``BUCKETS`` weights."""
    sample, sizes = sample_labelled(docs, labels, F.col(label_col), per_class)
    none = np.zeros(1)
    if not sizes.get(0) or not sizes.get(1):
        return Model(none, 0.0, 0.0, 1.0 if sizes.get(1) else 0.0 if sizes.get(0) else 0.5)
    found = sample.orderBy(F.xxhash64("text", F.lit(3)), "label").toArrow()
    labelled = found["label"].to_numpy()
    if not len(labelled) or labelled.min() == labelled.max():  # labels whose documents are not there
        return Model(none, 0.0, 0.0, float(labelled[0]) if len(labelled) else 0.5)
    return fit(found["text"].to_pylist(), labelled, (sizes[0], sizes[1]))


def _tables() -> Iterator[Tokens]:
    """The token table of a task, a new one when it has grown large; that changes nothing but the time."""
    held = Tokens()
    while True:
        yield held
        if len(held.words) > TABLE_WORDS:
            held = Tokens()


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """Score of a text column (0 to 1)."""
    small_batches()
    shared = spark.sparkContext.broadcast(model)  # BUCKETS weights

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = _tables()
        for batch in batches:
            texts = [x or "" for x in batch.to_pylist()]
            parts = [shared.value.scores(next(tables), texts[part]) for part in slices([len(x) for x in texts], SLICE_CHARS)]
            yield pa.array(np.concatenate(parts or [np.empty(0)]), pa.float64())

    return scored(text)


def locate(spark: SparkSession, model: Model, text: Column, least: float = 0.5) -> Column:
    """The offending sentences of a text: array of (start, stop, score), in code points.

    A sentence's score is that of a document of this sentence alone. Where no sentence reaches ``least`` but all of them
    together do, the likeliest is given.
    """
    shared = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))

    @F.arrow_udf("array<struct<start:int,stop:int,score:double>>")
    def located(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = _tables()
        for batch in batches:
            yield pa.array([_offending(shared.value, next(tables), x or "", least) for x in batch.to_pylist()], kind)

    return located(text)


def _offending(model: Model, held: Tokens, text: str, least: float) -> list[dict]:
    if model.constant is not None:
        return []
    logits, doc = model.sentence_logits(held, [text])
    if not len(logits):
        return []
    spans = [found.span() for found in re.finditer(r"[^.!?\n]*[^\W_][^.!?\n]*[.!?]?", text)]
    chances = _logistic(logits - model.shift)
    if chances.max() < least <= _logistic(_logit(noisy_or(logits, doc, 1)) - model.shift)[0]:
        least = chances.max()
    return [
        {"start": start, "stop": stop, "score": float(chance)}
        for (start, stop), chance in zip(spans, chances, strict=True) if chance >= least
    ]

"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased; what is no letter counts as a space. N-grams of one to three characters that hold a
letter are hashed into ``BUCKETS``. Training counts buckets per language on a sample of labelled documents (at most
about ``PER_LANGUAGE`` of each language, chosen by a hash of the text). The matrix of log probabilities (languages x
buckets, a size fixed by the labels) is broadcast; a batch of texts is scored by summing, for each text, the columns
of the n-grams that it holds. The language is the one with the highest posterior on the full evidence; its score is the
posterior with the log odds of texts of more than ``WEIGHT_OF`` n-grams scaled down to that many.

Cases: a null text, an empty text or one without a letter is ``und`` with score 0, also where nothing was learned. Rows
without a label are not learned from. A text of any length is scored whole. Equal texts get equal results;
of equally likely languages the first in code-point order is given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabload.llm.common import bounded, slices, small_batches, tidy

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
PER_LANGUAGE = 5_000
SMOOTHING = 0.5
WEIGHT_OF = 100  # n-grams from which a score is tempered, so that it stays gradual in long texts; the language is not touched
SLICE_CHARS = 250_000
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the buckets of all n-grams that hold a letter, and the number of the text each is from."""
    low = [text.lower() for text in texts]
    codes = np.frombuffer(" ".join(low).encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32).astype(np.uint32)
    sizes = np.fromiter(map(len, low), dtype=np.int64, count=len(low))
    owner = np.repeat(np.arange(len(low)), sizes + 1)[: len(codes)]
    gap = np.cumsum(sizes + 1)[:-1] - 1  # the spaces that join the texts belong to none
    outside = np.zeros(len(codes), dtype=bool)
    outside[gap] = True
    rolled, useful, across = codes.copy(), letter.copy(), outside.copy()
    for order in range(1, max(ORDERS) + 1):
        if order > 1:
            shift = order - 1
            if len(codes) < order:
                return
            rolled = rolled[:-1] * np.uint32(0x01000193) ^ codes[shift:]
            useful = useful[:-1] | letter[shift:]
            across = across[:-1] | outside[shift:]
        if order in ORDERS:
            keep = useful & ~across
            mixed = (rolled[keep] + np.uint32(order)) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x85EBCA77)
            yield (mixed >> np.uint32(16)).astype(np.int64) % BUCKETS, owner[: len(rolled)][keep]


@dataclass
class Model:
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages
    log_prior: np.ndarray

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the number of its likeliest language (-1: none) and that language's probability."""
        total = np.zeros((len(texts), len(self.languages)))
        seen = np.zeros(len(texts))
        for buckets, owner in ngrams(texts):
            if len(owner):
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                which = owner[first]
                total[which] += np.add.reduceat(self.log_probability[buckets], first, axis=0, dtype=np.float64)
                seen[which] += np.diff(np.append(first, len(owner)))
        none = (seen == 0) | (not self.languages)
        if not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts))
        joint = total + self.log_prior
        joint -= joint.max(axis=1, keepdims=True)
        best = joint.argmax(axis=1)
        # tempering evidence and prior alike keeps the order of the languages
        chance = np.exp(joint * np.minimum(1.0, WEIGHT_OF / np.maximum(seen, 1.0))[:, None])
        chance /= chance.sum(axis=1, keepdims=True)
        return np.where(none, -1, best), np.where(none, 0.0, chance.max(axis=1))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Learn from rows with a label. Driver state: labels x buckets counts."""
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    place = {lang: at for at, lang in enumerate(languages)}
    spark = rows.sparkSession
    limits = spark.createDataFrame([(lang, per_language / n) for lang, n in sizes.items()], "of string, share double")
    chance = F.shiftrightunsigned(F.xxhash64("text"), 32) / F.lit(float(1 << 32))
    sample = rows.join(bounded(limits, len(sizes)), F.col("lang") == F.col("of")).filter(chance < F.col("share")).select("lang", "text")

    small_batches()

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            label = np.array([place[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            for part in slices([len(x) for x in texts], SLICE_CHARS):
                for buckets, owner in ngrams(texts[part]):
                    np.add.at(table.reshape(-1), label[part][owner] * BUCKETS + buckets, 1)
        for at in np.flatnonzero(table.any(axis=1)):
            used = np.flatnonzero(table[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), at), pa.int32()), pa.array(used, pa.int32()), pa.array(table[at][used], pa.int64())],
                ["label", "bucket", "n"],
            )

    counted = sample.mapInArrow(count, "label int, bucket int, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    counts = np.full((BUCKETS, len(languages)), SMOOTHING)
    found = counted.toArrow()
    counts[found["bucket"].to_numpy(), found["label"].to_numpy()] += found["n"].to_numpy()
    prior = np.array([sizes[lang] for lang in languages], dtype=np.float64)
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32), np.log(prior / prior.sum()))


def predict(spark: SparkSession, model: Model, text: Column) -> Column:
    """Struct of ``lang`` and ``score`` for a text column."""
    small_batches()
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    @tidy
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = shared.value
        names = np.array([*held.languages, UNKNOWN], dtype=object)
        for batch in batches:
            texts = [x or "" for x in batch.to_pylist()]
            best, score = np.empty(len(texts), dtype=np.int64), np.empty(len(texts))
            for part in slices([len(x) for x in texts], SLICE_CHARS):
                best[part], score[part] = held.score(texts[part])
            yield pa.StructArray.from_arrays(
                [pa.array(names[best], pa.string()), pa.array(score, pa.float64())], ["lang", "score"]
            )

    return scored(text)

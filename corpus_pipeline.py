"""The corpus pipeline: from documents to token ids.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the docs of the next one. All but
the last return the columns of ``docs``, whatever they are.

Rows with nulls in any column pass unless a stage says otherwise; an empty table stays empty. Documents whose language
cannot be told go (null and empty texts, texts without letters). Of rows equal in id and text one stays. A document all of whose
bytes are copies goes; of the others, whole characters go. Documents the mix does not take go, documents it takes more than once are
repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload.llm import language, mixing, pieces, resemblance, suffixes
from tabload.llm.common import fresh
from tabload.llm.queries import PIECE_MODEL, token_digests
from tabload.session import stage

LEAST_SCORE = 0.5  # a language less likely than this is not told


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language can be told."""
    model = language.train(docs)
    found = fresh(docs, "found")
    scored = docs.withColumn(found, language.predict(spark, model, F.col("text")))
    return scored.filter((F.col(f"{found}.lang") != language.UNKNOWN) & (F.col(f"{found}.score") >= LEAST_SCORE)).drop(found)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group, linked at a similarity of 0.8 of five-word shingles.

    SimHash fingerprints and MinHash keys propose the pairs, the exact sets of shingles decide.
    """
    groups = resemblance.near_duplicates(docs, words=5, least=0.8)
    first = groups.filter(F.col("id").eqNullSafe(F.col("component_id"))).select("id").distinct()
    key = fresh(docs, "first_id")
    kept = docs.join(first.toDF(key), F.col("doc_id").eqNullSafe(F.col(key)), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that a document with a smaller id has."""
    return suffixes.trim_texts(docs).withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as its source's budget of words asks for."""
    copies = fresh(docs, "copies")
    mixed = mixing.apply_mix(docs, mixing.plan_mix(docs), copies_col=copies)
    return mixing.repeat_copies(mixed, copies).select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and digests of the ids and of the text they decode to."""
    return token_digests(pieces.tokenize(docs, PIECE_MODEL), "ids")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("passages", drop_repeated_passages),
    ("mix", mix_sources),
    ("pieces", encode_pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

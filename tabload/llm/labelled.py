"""Labelled documents for the classifiers, all of them or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def known_labels(labels: DataFrame, label: Column, id_col: str = "doc_id") -> tuple[DataFrame, dict[int, int]]:
    """``of, label`` for every labelled id, and their number in each class.

    Rows without an id or label are left out; an id with several labels counts with the smallest.
    """
    known = (
        labels.select(F.col(id_col).alias("of"), label.cast("int").alias("label"))
        .filter(F.col("of").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("of").agg(F.min("label").alias("label"))
    )
    return known, {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}


def sample_labelled(
    docs: DataFrame, labels: DataFrame, label: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, dict[int, int]]:
    """``text, label`` for about ``per_class`` documents of each class, and the number of labelled ones in each.

    Documents are chosen by a hash of their id, so reruns agree. Rows without an id or label are left out; a
    document with several labels counts with the smallest. The chosen ids are at most about twice ``per_class``, so they
    are broadcast and the texts are scanned without a shuffle.
    """
    known, sizes = known_labels(labels, label, id_col)
    share = F.when(F.col("label") == 1, per_class / max(1, sizes.get(1, 0))).otherwise(per_class / max(1, sizes.get(0, 0)))
    chance = F.shiftrightunsigned(F.xxhash64("of"), 32) / F.lit(float(1 << 32))
    chosen = known.filter(chance < share)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), F.col("id") == F.col("of")).select("text", "label"), sizes

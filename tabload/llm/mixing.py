"""Mixing sources to target weights with hash-threshold histograms.

Each source gets a budget of words. Documents are ordered by a hash of their id and text; a source
takes the documents below a threshold of that hash. The threshold comes from sums of words by source and
hash bucket: the bucket in which the running sum passes the budget is refined with the next bits of the
hash, and so on, so no document is ever sorted. Larger budgets have larger thresholds, so their
selections contain those of smaller budgets.

Driver state is one row per source (totals and thresholds); sources are a label set, not a key of documents.

Cases: a null or empty text has size 0; a null source is a source of its own, the last; rows equal in id
and text share a hash and are taken together; an empty table gives no rows. Other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabload.llm.common import WORD, bounded, fresh
from tabload.session import stage

WEIGHTS = (1, 2, 3)  # dealt to the sources in code-point order, repeating
MOST_COPIES = 3  # a document is taken this often at most
BITS = 10  # hash bits per level of the histogram
LEVELS = 6  # 60 bits in all


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def position(doc_id: Column, text: Column) -> Column:
    """Where a document stands in the order of its source: 60 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, text), 64 - BITS * LEVELS)


def share_out(totals: dict[str | None, int], weights: tuple[float, ...], most: float) -> dict[str | None, float]:
    """Budgets by weight that add up to all words, none above ``most`` times its source's words.

    What a source cannot hold is shared among the others by weight until no budget is too large.
    """
    names = sorted(totals, key=lambda name: (name is None, name or ""))
    weight = {name: weights[at % len(weights)] for at, name in enumerate(names)}
    left, free, budget = float(sum(totals.values())), set(names), {}
    while free:
        unit = left / sum(weight[name] for name in free)
        full = {name for name in free if unit * weight[name] >= most * totals[name]}
        if not full:
            return budget | {name: unit * weight[name] for name in free}
        budget |= {name: float(most * totals[name]) for name in full}
        left = max(0.0, left - sum(budget[name] for name in full))
        free -= full
    return budget


def plan_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, most_copies: int = MOST_COPIES,
) -> DataFrame:
    """One row per source: ``mix_source, source_size, target, whole, threshold``.

    A document of the source is taken ``whole`` times, and once more if its position is below the
    threshold. Runs one job over the texts and a small one per level over their sizes.
    """
    spark = docs.sparkSession
    sized = stage(
        docs.select(
            F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
            position(F.col(id_col), F.col(text_col)).alias("at"),
        ),
        "sizes",
    )
    totals = {row["source"]: row["n"] for row in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    budget = share_out(totals, weights, most_copies)
    whole = {name: min(most_copies, int(budget[name] // totals[name])) if totals[name] else 0 for name in totals}
    rest = {name: budget[name] - whole[name] * totals[name] for name in totals}
    threshold = dict.fromkeys(totals, 0)
    open_sources = {name for name in totals if rest[name] > 0}
    for level in range(LEVELS):
        if not open_sources:
            break
        shift = BITS * (LEVELS - 1 - level)
        bounds = spark.createDataFrame(
            [(name, threshold[name] >> (shift + BITS), rest[name]) for name in open_sources],
            "of string, prefix bigint, rest double",
        )
        inside = sized.join(
            bounded(bounds, len(open_sources)), F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("at", shift + BITS) == F.col("prefix"))
        )
        sums = inside.groupBy("of", F.shiftright("at", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"), F.first("rest").alias("rest")
        )
        running = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        found = (
            sums.withColumn("upto", F.sum("words").over(running))
            .filter(F.col("upto") > F.col("rest"))
            .groupBy("of").agg(F.min(F.struct("bucket", "upto", "words", "docs")).alias("b"))
            .select("of", "b.*").collect()
        )
        hit = {row["of"]: row for row in found}
        for name in list(open_sources):
            row = hit.get(name)
            if row is None:  # what is left to take is all there is, but for rounding
                threshold[name] = ((threshold[name] >> (shift + BITS)) + 1) << (shift + BITS)
                open_sources.discard(name)
                continue
            threshold[name] = row["bucket"] << shift
            rest[name] -= row["upto"] - row["words"]
            if row["docs"] == 1 or level == LEVELS - 1:
                if 2 * rest[name] >= row["words"]:
                    threshold[name] += 1 << shift
                open_sources.discard(name)
    plan = spark.createDataFrame(
        [(name, int(totals[name]), float(budget[name]), whole[name], threshold[name]) for name in totals],
        "mix_source string, source_size bigint, target double, whole int, threshold bigint",
    )
    return bounded(plan, len(totals))


def apply_mix(
    docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    copies_col: str = "copies",
) -> DataFrame:
    """All documents with the number of times the mix takes them, and ``source_size`` and ``target`` of their source."""
    share = plan.select(
        F.col("mix_source").alias(fresh(docs, "mix_source")), F.struct("*").alias(fresh(docs, "mix"))
    )
    key, mix = share.columns
    more = F.when(position(F.col(id_col), F.col(text_col)) < F.col(f"{mix}.threshold"), 1).otherwise(0)
    return (
        docs.join(share, F.col(source_col).eqNullSafe(F.col(key)), "left")
        .withColumns({
            copies_col: F.coalesce(F.col(f"{mix}.whole") + more, F.lit(0)),
            fresh(docs, "source_size"): F.col(f"{mix}.source_size"), fresh(docs, "target"): F.col(f"{mix}.target"),
        })
        .drop(key, mix)
    )


def repeat_copies(docs: DataFrame, copies_col: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return docs.withColumn(
        copies_col, F.explode(F.when(F.col(copies_col) > 0, F.sequence(F.lit(1), F.col(copies_col))))
    ).drop(copies_col)

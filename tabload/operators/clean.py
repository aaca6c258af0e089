"""Cleaning steps over whole tables: rows dropped, cells normalised, columns renamed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from tabload.config import (
    EXCLUDED_COMMENTS, FILE_KIND_ALIASES, NULL_TOKENS, SECONDARY_CONFIRMATION, SECONDARY_CONFIRMATION_KIND,
)
from tabload.functions import nulls, text
from tabload.operators.joins import anti


def text_columns(df: DataFrame, but: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in but]


def map_text(df: DataFrame, change, but: tuple[str, ...] = ()) -> DataFrame:
    """Apply one expression to every text column, in a single projection."""
    names = set(text_columns(df, but))
    return df.select(*[change(F.col(f"`{c}`")).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


def normalise_nulls(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    return map_text(df, lambda cell: nulls.blank_tokens(cell, tokens))


def normalise_dashes(df: DataFrame) -> DataFrame:
    return map_text(df, text.dash)


def trim_all(df: DataFrame) -> DataFrame:
    return map_text(df, text.strip)


def canonical_text(df: DataFrame, but: tuple[str, ...] = ()) -> DataFrame:
    return map_text(df, text.canonical, but)


def strip_trailing_zeros(df: DataFrame, but: tuple[str, ...] = ()) -> DataFrame:
    return map_text(df, text.strip_trailing_zero, but)


def recode_all(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return map_text(df, lambda cell: text.recode(cell, mapping))


def recode_columns(df: DataFrame, recodes: dict[str, dict[str, str]]) -> DataFrame:
    present = {c: text.recode(F.col(c), mapping) for c, mapping in recodes.items() if c in df.columns}
    return df.withColumns(present) if present else df


def fill_labels(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    return df.na.fill({c: label for c, label in labels.items() if c in df.columns})


def drop_blank_rows(df: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Drop rows with no value in any column that counts; blank texts are no value."""
    kinds = dict(df.dtypes)
    counted = [c for c in df.columns if c not in ignore]
    cells = [F.nullif(F.col(f"`{c}`"), F.lit("")) if kinds[c] == "string" else F.col(f"`{c}`") for c in counted]
    return df.filter(reduce(lambda one, other: one | other, [cell.isNotNull() for cell in cells]))


def drop_constant_rows(df: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """Drop rows whose columns all hold the same value (template lines); a NULL keeps the row."""
    names = list(columns) or df.columns
    if len(names) < 2:
        return df
    first = F.col(f"`{names[0]}`").cast("string")
    same = reduce(lambda one, other: one & other, [F.col(f"`{c}`").cast("string") == first for c in names[1:]])
    return df.filter(~F.coalesce(same, F.lit(False)))


def drop_unnamed_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("Unnamed")])


def exclude_marked(df: DataFrame, column: str = "Comments", marks: tuple[str, ...] = EXCLUDED_COMMENTS) -> DataFrame:
    """Drop rows whose comment marks them as invalid; rows without a comment stay."""
    if column not in df.columns:
        return df
    return df.filter(~F.coalesce(F.col(column).isin(*marks), F.lit(False)))


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows with NULL or a blank text in a required column."""
    kinds = dict(df.dtypes)
    for c in columns:
        if c in kinds:
            df = df.filter(F.col(c).isNotNull() & (F.col(c) != "") if kinds[c] == "string" else F.col(c).isNotNull())
    return df


def exclude_keys(df: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows whose key (one or several columns) is listed."""
    return anti(df, listed, keys)


def exclude_pieces(df: DataFrame, columns: list[str], pieces: tuple[str, ...]) -> DataFrame:
    """Drop rows with an id that contains one of a few pieces; rows without an id drop too."""
    for c in columns:
        hit = reduce(lambda one, other: one | other, [F.col(c).contains(piece) for piece in pieces], F.lit(False))
        df = df.filter(F.col(c).isNotNull() & ~hit)
    return df


def exclude_containing(df: DataFrame, columns: list[str], listed: DataFrame, piece: str) -> DataFrame:
    """Drop rows with an id that contains any listed piece; rows without an id drop too.

    The list may be long: instead of testing every row against every entry, each distinct id (of
    all columns at once) is cut into all pieces as long as some listed one, and the pieces meet the
    list in an equi join.
    """
    entries = listed.select(F.col(piece).alias("_piece")).filter(F.length("_piece") > 0).distinct()
    lengths = entries.agg(F.collect_set(F.length("_piece")).alias("lengths")).scalar()
    starts = F.sequence(F.lit(1), F.length("_id") - F.col("_size") + 1)
    told = df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("_id"))
    ids = told.filter(F.col("_id").isNotNull()).distinct()
    sized = ids.select("_id", F.explode(lengths).alias("_size")).filter(F.length("_id") >= F.col("_size"))
    cut = sized.select("_id", "_size", F.explode(starts).alias("_at")).select(
        "_id", F.substring(F.col("_id"), F.col("_at"), F.col("_size")).alias("_piece")
    )
    hits = cut.join(entries, "_piece", "left_semi").select("_id").distinct()
    kept = df
    for c in columns:
        kept = kept.filter(F.col(c).isNotNull())
    return _without(kept, columns, hits)


def _without(df: DataFrame, columns: list[str], hits: DataFrame) -> DataFrame:
    """Rows none of whose ids is a hit.

    Spark takes what an explode puts out to be as large as what goes in, and would send millions of cut ids through the driver; so hits
    are merged, whatever size they are taken for.
    """
    for c in columns:
        df = anti(df, hits.withColumnRenamed("_id", c).hint("merge"), [c])
    return df


GRAM = 4
#: Runs are counted by a hash of so many values: the counts go through the driver.
RUN_COUNTS = 1 << 16


def exclude_by_grams(df: DataFrame, columns: list[str], listed: DataFrame, piece: str, gram: int = GRAM) -> DataFrame:
    """``exclude_containing`` for long lists of pieces of many lengths: an id is cut once, however many lengths there are.

    Pieces shorter than ``gram`` have few lengths and are cut for by length, first: what they exclude is not looked at again. Each
    longer piece is filed under its rarest run of ``gram`` characters among the distinct ids, one entry each. An id is cut into its
    distinct runs; those that are filed fetch their pieces, and the id is searched for them until one is found. How rare a run is
    decides where a piece is filed, not whether it is found, so runs may share a count.
    """
    entries = listed.select(F.col(piece).alias("_piece")).filter(F.length("_piece") > 0).distinct()
    runs_of = lambda c: F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(c) - gram + 1), lambda at: F.substring(c, at, F.lit(gram))
    ))
    place = lambda run: F.pmod(F.xxhash64(run), F.lit(RUN_COUNTS)).cast("int")
    kept = exclude_containing(df, columns, entries.filter(F.length("_piece") < gram), "_piece")
    told = kept.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("_id"))
    ids = told.filter(F.length("_id") >= gram).distinct()
    held = ids.select("_id", F.explode(runs_of(F.col("_id"))).alias("_gram"))
    places = df.sparkSession.range(RUN_COUNTS).select(F.col("id").cast("int").alias("_place"), F.lit(0).cast("bigint").alias("_n"))
    counted = held.select(place(F.col("_gram")).alias("_place"), F.lit(1).cast("bigint").alias("_n"))
    sums = counted.unionByName(places).groupBy("_place").agg(F.sum("_n").alias("_n"))
    counts = sums.agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "_n"))), lambda one: one["_n"])).scalar()
    rarest = F.array_min(F.transform(runs_of(F.col("_piece")), lambda run: F.struct(F.get("_counts", place(run)), run.alias("_gram"))))
    long = entries.filter(F.length("_piece") >= gram)
    filed = long.withColumn("_counts", counts).select("_piece", rarest["_gram"].alias("_key"))
    found = (F.col("_gram") == F.col("_key")) & F.col("_id").contains(F.col("_piece"))
    return _without(kept, columns, held.join(filed, found, "left_semi").select("_id").distinct())


def keep_matching_ids(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).rlike(pattern))


def require_label(df: DataFrame, column: str) -> DataFrame:
    """Keep rows with a label; ``0`` stands for none."""
    return df.filter(F.col(f"`{column}`").isNotNull() & (F.col(f"`{column}`") != "0"))


def blank_comment(df: DataFrame) -> DataFrame:
    """The first comments column holds NULL where it carries a missing-value label."""
    names = [c for c in df.columns if "Comments" in c]
    return df.withColumn(names[0], nulls.text_sentinel_to_null(F.col(names[0]))) if names else df


def kind_alias(name: Column) -> Column:
    """Canonical file kind of a file name."""
    return F.when(name.contains(SECONDARY_CONFIRMATION), SECONDARY_CONFIRMATION_KIND).otherwise(
        text.recode(name, FILE_KIND_ALIASES)
    )


def rename_by_part(df: DataFrame, parts: dict[str, str]) -> DataFrame:
    """Replace a part of the column names, in the order given."""
    renamed = df.columns
    for old, new in parts.items():
        renamed = [c.replace(old, new) for c in renamed]
    return df.toDF(*renamed)


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """Project to the target columns that exist, in target order."""
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])

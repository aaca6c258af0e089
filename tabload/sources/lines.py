"""Delimited files with varying headers, read as lines in one scan.

``delimited.read_kinds`` hands the paths of each header shape to a CSV read of its own. Here all files below a folder are
read as text at once; each line meets its file's header by the path Spark knows it from and is parsed by the shape of that header. Only
distinct header lines reach the driver, however many files there are. Cells cannot hold line ends, and files are UTF-8.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tabload.operators.joins import fits_broadcast
from tabload.operators.reshape import union_all
from tabload.session import stage
from tabload.sources.delimited import MALFORMED_COLUMN, PATH_COLUMN, column_names, mark_lines, open_file, rejected
from tabload.sources.listing import comparable_path, literal_path, metadata_path

NOT_BLANK = r"[^\x00-\x20]"


def _first_line(path: str) -> tuple[str | None, list[str] | None, str | None]:
    """First line of a file that is not blank, its cells, or what is wrong with it."""
    with open_file(path) as stream, io.TextIOWrapper(stream, encoding="utf-8-sig", newline="") as lines:
        try:
            for line in lines:
                if line.strip():
                    told = line.rstrip("\r\n")
                    return told, next(csv.reader([told])), None
        except (UnicodeDecodeError, csv.Error) as error:
            return None, None, f"header cannot be read as UTF-8: {type(error).__name__}"
    return None, None, None


def read_first_lines(files: DataFrame) -> DataFrame:
    """Add the header line (``line``) and its cells (``header``) to a listing; ``problem`` says why a file has none.

    A file without any line has neither.
    """
    schema = StructType([
        *files.schema.fields, StructField("line", StringType()), StructField("header", ArrayType(StringType())),
        StructField("problem", StringType()),
    ])

    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_first_line(path) for path in batch["path"]]
            yield batch.assign(**{name: [row[at] for row in found] for at, name in enumerate(("line", "header", "problem"))})

    return files.mapInPandas(first_lines, schema)


def place_lines(spark: SparkSession, root: str, heads: DataFrame, pattern: str) -> DataFrame:
    """All lines of the listed files with the shape of their file; staged by shape, so that each shape reads its own lines only.

    ``heads`` has a row per file; it is broadcast if it is measured to be small, else both sides meet by path.
    """
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(literal_path(root))
    lines = text.select("value", metadata_path().alias(PATH_COLUMN)).filter(F.col("value").rlike(NOT_BLANK))
    files = heads.select(comparable_path(F.col("path")).alias("_file"), "shape")
    files = F.broadcast(files) if fits_broadcast(files) else files
    placed = lines.join(files, comparable_path(F.col(PATH_COLUMN)) == F.col("_file")).drop("_file")
    return stage(placed, "lines", by="shape")


def below_header(lines: DataFrame, header: str) -> DataFrame:
    """The lines without one header line a file.

    A file may hold its header line again, as data. These lines are all alike, so it does not matter which of them stays away: they are
    counted by file, and all but one are given back.
    """
    is_header = F.col("value") == header
    repeats = lines.filter(is_header).groupBy("value", PATH_COLUMN).agg((F.count(F.lit(1)) - 1).alias("_n")).filter("_n > 0")
    again = repeats.select("value", PATH_COLUMN, F.explode(F.sequence(F.lit(1), "_n"))).drop("col")
    return lines.filter(~is_header).select("value", PATH_COLUMN).unionByName(again)


def parse_shape(lines: DataFrame, header: list[str]) -> DataFrame:
    """Lines of one header as columns of text, with path, malformed and short lines as ``delimited.read_shape`` gives them."""
    names = column_names(header)
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in [*names, MALFORMED_COLUMN])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED_COLUMN}
    cells = lines.select(F.from_csv("value", schema, options).alias("_cells"), F.col(PATH_COLUMN))
    return mark_lines(cells.select("_cells.*", PATH_COLUMN), names)


def read_lines(
    spark: SparkSession, root: str, files: DataFrame, pattern: str = "*.csv", rejects: list[DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """One all-text table per file kind from a listing (``path``, ``kind``) of files below ``root``.

    Files below ``root`` that are not listed are read but not kept; ``pattern`` keeps the scan from those that need not be. A
    file whose header cannot be read is left out and listed in ``rejects``. The result is that of ``delimited.read_kinds``.
    """
    headed = read_first_lines(files.select("path", "kind"))
    headed = stage(headed.withColumn("shape", F.md5(F.to_json(F.struct("kind", "line")))), "headers")
    if rejects is not None:
        bad = headed.filter(F.col("problem").isNotNull())
        rejects.append(rejected(bad.select("kind", "problem", "path"), F.col("kind"), F.col("problem")))
    heads = headed.filter(F.col("header").isNotNull())
    shapes = heads.select("kind", "shape", "line", "header").distinct().orderBy("kind", "shape").collect()
    if not shapes:
        return {}
    placed = place_lines(spark, root, heads, pattern)
    by_kind: dict[str, list[DataFrame]] = {}
    for shape in shapes:
        own = below_header(placed.filter(F.col("shape") == shape.shape), shape.line)
        by_kind.setdefault(shape.kind, []).append(parse_shape(own, shape.header))
    return {kind: union_all(frames) for kind, frames in by_kind.items()}

"""Delimited files with varying headers.

A CSV read applies one column order to all its files. Files are therefore grouped by their header
line first, read once per header shape, and united by column name.
"""

from __future__ import annotations

import codecs
import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tabload.operators.reshape import union_all
from tabload.session import stage
from tabload.sources.listing import literal_path, metadata_path

PATH_COLUMN = "_path"
MALFORMED_COLUMN = "_malformed"
SHORT_COLUMN = "_short"


def open_file(path: str):
    from pyarrow import fs

    if path.startswith("file:") or path.startswith("/"):
        return fs.LocalFileSystem().open_input_stream("/" + path.removeprefix("file:").lstrip("/"))
    scheme, _, rest = path.partition("://")
    system, key = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme) }://{rest.split('/')[0]}")
    return system.open_input_stream("/".join(part for part in (key, *rest.split("/")[1:]) if part))


def _first_record(path: str, encoding: str) -> tuple[list[str] | None, str | None]:
    """Header cells of a file, or what is wrong with it; reads no more of it than its first record."""
    with open_file(path) as stream:
        lines = codecs.getreader("utf-8-sig" if codecs.lookup(encoding).name == "utf-8" else encoding)(stream)
        try:
            # Blank lines above the header are none of Spark's lines either.
            return next((cells for cells in csv.reader(lines) if len(cells) > 1 or "".join(cells).strip()), []), None
        except (UnicodeDecodeError, csv.Error) as error:
            return None, f"header cannot be read as {encoding}: {type(error).__name__}"


def read_headers(files: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Add the header cells (``header``) to a listing with a ``path`` column; ``problem`` says why a file has none."""
    schema = StructType([
        *files.schema.fields, StructField("header", ArrayType(StringType())), StructField("problem", StringType()),
    ])

    def first_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_first_record(path, encoding) for path in batch["path"]]
            yield batch.assign(header=[header for header, _ in found], problem=[problem for _, problem in found])

    return files.mapInPandas(first_records, schema)


def column_names(header: list[str]) -> list[str]:
    """Names of the columns: blanks are ``Unnamed: n``, repeats get a running number."""
    names: list[str] = []
    seen: dict[str, int] = {}
    for at, cell in enumerate(header):
        name = cell.strip() or f"Unnamed: {at}"
        count = seen.get(name, 0)
        seen[name] = count + 1
        names.append(f"{name}.{count}" if count else name)
    return names


def read_shape(
    spark: SparkSession, header: list[str], paths: list[str], multi_line: bool = False, encoding: str = "UTF-8",
) -> DataFrame:
    """All files with one header: every column as text, plus path and malformed records.

    A line with too many cells is ``MALFORMED_COLUMN``: its cells may stand in the wrong columns. One with too
    few is ``SHORT_COLUMN``: the missing cells are NULL.
    """
    names = column_names(header)
    fields = [StructField(name, StringType()) for name in [*names, MALFORMED_COLUMN]]
    rows = (
        spark.read.schema(StructType(fields))
        .option("header", "true")
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED_COLUMN)
        .option("multiLine", str(multi_line).lower())
        .option("encoding", encoding)
        .csv([literal_path(path) for path in paths])
    )
    return mark_lines(rows.withColumn(PATH_COLUMN, metadata_path()), names)


def mark_lines(rows: DataFrame, names: list[str]) -> DataFrame:
    """Tell lines with too many cells from those with too few; ``rows`` holds either as ``MALFORMED_COLUMN``."""
    line = F.col(MALFORMED_COLUMN)
    unquoted = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    few = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1 < len(names)
    return rows.withColumns({MALFORMED_COLUMN: F.when(~few, line), SHORT_COLUMN: F.when(few, line)})


def rejected(rows: DataFrame, source: str | Column, reason: str | Column) -> DataFrame:
    """Rows that are turned away, in the form in which all rejects are listed: source, reason and the row as JSON."""
    told = [F.lit(x) if isinstance(x, str) else x for x in (source, reason)]
    return rows.select(told[0].alias("source"), told[1].alias("reason"), F.to_json(F.struct("*")).alias("record"))


def split_lines(rows: DataFrame, source: str, rejects: list[DataFrame] | None) -> DataFrame:
    """The lines that fit their header, without the columns about the line; the others are added to ``rejects``, with all they hold.

    The lines are parsed once, into a staged table.
    """
    rows, bad = stage(rows, "lines"), F.col(MALFORMED_COLUMN).isNotNull()
    if rejects is not None:
        rejects.append(rejected(rows.filter(bad), source, "line has too many cells"))
    return rows.filter(~bad).drop(MALFORMED_COLUMN, SHORT_COLUMN)


def read_kinds(
    files: DataFrame, multi_line: bool | tuple[str, ...] = False, encoding: str = "UTF-8", rejects: list[DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """One all-text table per file kind from a listing with ``path`` and ``kind``.

    A file whose header cannot be read is left out, and listed in ``rejects``; the others are read.

    Only paths and distinct header lines reach the driver; Spark's own file index holds the same
    paths.
    ``multi_line`` (for all kinds, or a list of them) is for kinds whose quoted cells hold line ends; such
    files cannot be split. The headers are read once: the listing with its headers is staged.
    """
    spark = files.sparkSession
    headed = read_headers(files.select("path", "kind"), encoding).withColumn("shape", F.md5(F.to_json("header")))
    headed = stage(headed, "headers")
    if rejects is not None:
        rejects.append(rejected(headed.filter(F.col("problem").isNotNull()).select("kind", "problem", "path"), F.col("kind"), F.col("problem")))
    headed = headed.filter(F.col("problem").isNull())
    headers = {row.shape: row.header for row in headed.select("shape", "header").distinct().collect()}
    groups: dict[tuple[str, str], list[str]] = {}
    for row in headed.select("kind", "shape", "path").collect():
        groups.setdefault((row.kind, row.shape), []).append(row.path)
    by_kind: dict[str, list[DataFrame]] = {}
    for (kind, shape), paths in sorted(groups.items()):
        if headers[shape]:
            whole = multi_line if isinstance(multi_line, bool) else kind in multi_line
            by_kind.setdefault(kind, []).append(read_shape(spark, headers[shape], sorted(paths), whole, encoding))
    return {kind: union_all(frames) for kind, frames in by_kind.items()}


def read_delimited(
    files: DataFrame, multi_line: bool = False, source: str = "all", rejects: list[DataFrame] | None = None,
) -> DataFrame | None:
    """One table from all listed files, whatever their headers; None if there are no files."""
    return read_kinds(files.withColumn("kind", F.lit(source)), multi_line, rejects=rejects).get(source)


def read_pairs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Two-column files as (key, value) rows, the header line included."""
    schema = StructType([StructField("key", StringType()), StructField("value", StringType())])
    rows = spark.read.schema(schema).option("header", "false").option("escape", '"').csv([literal_path(p) for p in paths])
    return rows.select("*", metadata_path().alias(PATH_COLUMN))

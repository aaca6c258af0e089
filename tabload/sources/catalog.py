"""The column catalog: declared type, key and reference of every target column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

from tabload.config import SERVER_COLUMNS
from tabload.operators.cast import INTEGERS, NUMBERS, base_type, decimal_type
from tabload.operators.joins import join_on

CATALOG_SCHEMA = StructType([
    StructField("Table_Name", StringType()),
    StructField("Column_Name", StringType()),
    StructField("Var_Type", StringType()),
    StructField("Primary_Key", BooleanType()),
    StructField("Autoincrement", BooleanType()),
    StructField("Foreign_Key_Count", LongType()),
    StructField("Foreign_Key_Table", StringType()),
    StructField("Foreign_Key_Column", StringType()),
])


KEY_SCHEMA = StructType([
    StructField("Key_Name", StringType()),
    StructField("Table_Name", StringType()),
    StructField("Column_Names", ArrayType(StringType())),
    StructField("Foreign_Key_Table", StringType()),
    StructField("Foreign_Key_Columns", ArrayType(StringType())),
])


def foreign_key_summary(columns: DataFrame, usage: DataFrame) -> DataFrame:
    """Reference count per column, and the reference where there is exactly one."""
    key = ["Table_Name", "Column_Name"]
    target = F.struct("Foreign_Key_Table", "Foreign_Key_Column")
    counted = usage.groupBy(*key).agg(F.count_distinct(target).alias("n"), F.max(target).alias("target"))
    joined = join_on(columns, counted, key, "left")
    single = F.col("n") == 1
    return joined.withColumns({
        "Foreign_Key_Count": F.coalesce(F.col("n"), F.lit(0)),
        "Foreign_Key_Table": F.when(single, F.col("target.Foreign_Key_Table")).otherwise("None"),
        "Foreign_Key_Column": F.when(single, F.col("target.Foreign_Key_Column")).otherwise("None"),
    }).drop("n", "target")


def from_information_schema(columns: DataFrame, usage: DataFrame) -> DataFrame:
    """Catalog rows from the ``COLUMNS`` and ``KEY_COLUMN_USAGE`` views of a database."""
    listed = columns.select(
        F.col("TABLE_NAME").alias("Table_Name"), F.col("COLUMN_NAME").alias("Column_Name"),
        F.upper("COLUMN_TYPE").alias("Var_Type"), (F.col("COLUMN_KEY") == "PRI").alias("Primary_Key"),
        F.lower("EXTRA").contains("auto_increment").alias("Autoincrement"),
    )
    references = usage.filter(F.col("REFERENCED_TABLE_NAME").isNotNull()).select(
        F.col("TABLE_NAME").alias("Table_Name"), F.col("COLUMN_NAME").alias("Column_Name"),
        F.col("REFERENCED_TABLE_NAME").alias("Foreign_Key_Table"),
        F.col("REFERENCED_COLUMN_NAME").alias("Foreign_Key_Column"),
    )
    return foreign_key_summary(listed, references)


def foreign_keys(usage: DataFrame) -> DataFrame:
    """Every reference of the ``KEY_COLUMN_USAGE`` view with its columns in their order: one row each, in ``KEY_SCHEMA``.

    A column may be in several references, and a reference may have several columns.
    """
    own = usage.filter(F.col("REFERENCED_TABLE_NAME").isNotNull())
    part = F.struct("ORDINAL_POSITION", "COLUMN_NAME", "REFERENCED_COLUMN_NAME")
    parts = own.groupBy("CONSTRAINT_NAME", "TABLE_NAME", "REFERENCED_TABLE_NAME").agg(F.sort_array(F.collect_set(part)).alias("parts"))
    return parts.select(
        F.col("CONSTRAINT_NAME").alias("Key_Name"), F.col("TABLE_NAME").alias("Table_Name"),
        F.col("parts.COLUMN_NAME").alias("Column_Names"), F.col("REFERENCED_TABLE_NAME").alias("Foreign_Key_Table"),
        F.col("parts.REFERENCED_COLUMN_NAME").alias("Foreign_Key_Columns"),
    )


def spark_type(declared: str) -> DataType:
    kind = base_type(declared)
    if kind in INTEGERS:
        return LongType()
    if exact := decimal_type(declared):
        return exact
    if kind in NUMBERS:
        return DoubleType()
    if kind == "DATE":
        return DateType()
    if kind in ("DATETIME", "TIMESTAMP"):
        return TimestampType()
    return StringType()


@dataclass(frozen=True)
class Entry:
    table: str
    column: str
    type: str
    primary: bool = False
    auto: bool = False
    parent: str | None = None
    parent_column: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    """A reference of one table to another by one or more columns."""

    name: str
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Catalog:
    """Catalog rows on the driver: one per target column and reference, so of schema size, not data size."""

    entries: tuple[Entry, ...]
    keys_to: tuple[ForeignKey, ...] = ()

    @staticmethod
    def load(rows: DataFrame, references: DataFrame | None = None) -> Catalog:
        """``references`` (see ``foreign_keys``) tells references of several columns and several references of a column."""
        listed = [] if references is None else references.select(*[f.name for f in KEY_SCHEMA.fields]).collect()
        found = rows.select(*[f.name for f in CATALOG_SCHEMA.fields]).collect()
        return Catalog(tuple(
            Entry(
                r.Table_Name, r.Column_Name, r.Var_Type, bool(r.Primary_Key), bool(r.Autoincrement),
                r.Foreign_Key_Table if r.Foreign_Key_Count == 1 else None,
                r.Foreign_Key_Column if r.Foreign_Key_Count == 1 else None,
            )
            for r in found
        ), tuple(
            ForeignKey(r.Key_Name, r.Table_Name, tuple(r.Column_Names), r.Foreign_Key_Table, tuple(r.Foreign_Key_Columns))
            for r in sorted(listed)
        ))

    @staticmethod
    def read(spark: SparkSession, path: str) -> Catalog:
        return Catalog.load(spark.read.schema(CATALOG_SCHEMA).json(path))

    def of(self, table: str) -> list[Entry]:
        return [e for e in self.entries if e.table == table]

    def tables(self) -> list[str]:
        return sorted({e.table for e in self.entries})

    def types(self, *tables: str) -> dict[str, str]:
        """Declared type per column; the first table that has the column decides."""
        found: dict[str, str] = {}
        for table in tables:
            for e in self.of(table):
                found.setdefault(e.column, e.type)
        return found

    def columns(self, table: str) -> list[str]:
        """Columns a load may fill: not numbered by the database and not kept by it."""
        return [e.column for e in self.of(table) if not e.auto and e.column not in SERVER_COLUMNS]

    def keys(self, table: str) -> list[str]:
        return [e.column for e in self.of(table) if e.primary and not e.auto]

    def auto_column(self, table: str) -> str | None:
        return next((e.column for e in self.of(table) if e.auto), None)

    def foreign_keys(self, table: str) -> list[ForeignKey]:
        """The references of a table: the listed ones, and one for each column whose entry names a parent that none of them covers."""
        listed = [key for key in self.keys_to if key.table == table]
        covered = {column for key in listed for column in key.columns}
        return listed + [
            ForeignKey(f"{table}.{e.column}", table, (e.column,), e.parent, (e.parent_column,))
            for e in self.of(table) if e.parent and e.column not in covered
        ]

    def parents(self, table: str) -> set[str]:
        return {key.parent for key in self.foreign_keys(table)}

    def schema(self, table: str) -> StructType:
        return StructType([StructField(e.column, spark_type(e.type)) for e in self.of(table)])

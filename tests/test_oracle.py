"""Every registered query against its SQL, run by DuckDB on the same files."""

import glob
import os
import sys

import duckdb
import pytest

import __spark_entry__ as driver
from tabload.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def cell(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return f"float {round(value, 9)!r}"
    return f"{type(value).__name__} {value}"


def canonical(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in found)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, duck, name):
    df = driver.queries()[name](spark, FOLDER)
    got = canonical(df.columns, df.collect())
    relation = duck.sql(SQL[name])
    assert got == canonical(relation.columns, relation.fetchall())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL) <= set(driver.queries())


def test_queries_without_the_training_data_operators(monkeypatch):
    """A missing subpackage and a missing library of its leave the other queries."""
    for name in ("sentencepiece", "tabload.llm"):
        with monkeypatch.context() as patch:
            for module in [m for m in sys.modules if m.startswith(("tabload.llm", "corpus_pipeline"))]:
                patch.delitem(sys.modules, module)
            patch.setitem(sys.modules, name, None)
            with pytest.warns(UserWarning, match="without the training-data operators"):
                assert set(driver.queries()) == set(QUERIES)
            with pytest.warns(UserWarning):
                assert set(driver.oracle_sql()) == set(QUERIES)

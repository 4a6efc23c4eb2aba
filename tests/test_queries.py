"""Every registered query against its SQL, over the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tallyloom.plans import gold
from tallyloom.standin import landing
from tallyloom.standin.oracles import GOLD_SQL, QUESTION_NAMES, all_oracles
from tallyloom.standin.queries import all_queries

QUERIES = all_queries()
SQL = all_oracles()


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    return (1, repr(round(value, 6)) if isinstance(value, float) else repr(value))


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL) and len(QUERIES) >= 47


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    cursor = tables.execute(SQL[name])
    named = [column[0] for column in cursor.description]
    assert sorted(named) == columns
    assert got == sorted(tuple(plain(row[named.index(c)]) for c in columns) for row in cursor.fetchall())
    assert got


@pytest.mark.parametrize("name", list(GOLD_SQL))
def test_questions_can_be_asked_in_sql(spark, sf_dir, name):
    """The unified table answers plain SQL the way the measures do."""
    silver = landing.silver(spark, sf_dir)
    silver.createOrReplaceTempView("silver")
    answered = gold.answer(QUESTION_NAMES[name], silver)
    asked = spark.sql(GOLD_SQL[name]).select(*answered.columns)
    assert sorted(map(str, answered.collect())) == sorted(map(str, asked.collect()))


def test_entry_points_hold_every_query():
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark, sf_dir):
    assert entry_points.entry(spark).count() == 15

"""Every corpus query runs over the given tables, and equals its SQL where it has one."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tallyloom.llm.queries import llm_oracles, llm_queries


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    return connection


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry_points.queries())
    assert set(llm_queries()) | {"pipeline"} <= names
    assert {name.split("_")[0] for name in llm_queries()} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", list(llm_oracles()))
def test_query_equals_sql(spark, tables, sf_dir, name):
    df = llm_queries()[name](spark, sf_dir)
    cursor = tables.execute(llm_oracles()[name])
    named = [column[0] for column in cursor.description]
    assert sorted(named) == sorted(df.columns)
    got = sorted(repr(tuple(row[c] for c in named)) for row in df.collect())
    assert got == sorted(map(repr, cursor.fetchall()))

"""Types found on reading back, positions without one task, matrices of unknown categories."""

from __future__ import annotations

from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators.measures import numbered
from tallyloom.operators.positions import positioned, running_total
from tallyloom.operators.reshape import matrix, pivot_sum, spread
from tallyloom.plans import gold
from tallyloom.sources.results import write_result
from tallyloom.sources.typed import found_types, read_typed, typed
from tallyloom.standin import landing

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
KINDS = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "str": "string"}


def as_pandas(folder):
    parts = [pd.read_csv(path) for path in sorted(folder.glob("part-*.csv"))]
    frame = pd.concat(parts, ignore_index=True)
    return frame, {column: KINDS[str(kind)] for column, kind in frame.dtypes.items()}


@pytest.mark.parametrize("name", list(gold.QUESTIONS))
def test_exported_results_get_the_types_pandas_gives(spark, sf_dir, tmp_path, name):
    folder = tmp_path / name
    write_result(gold.answer(name, landing.silver(spark, sf_dir)).coalesce(1), str(folder))
    back = read_typed(spark, str(folder))
    frame, kinds = as_pandas(folder)
    assert dict(back.dtypes) == kinds
    got = [tuple(None if v is None else v for v in row) for row in back.collect()]
    assert sorted(map(repr, got)) == sorted(repr(tuple(None if pd.isna(v) else v for v in row)) for row in frame.astype(object).to_numpy().tolist())


TEXTS = {
    "whole": (["1", "-2", "+3"], "bigint"),
    "some": (["1", None, "3"], "double"),
    "parts": (["1", "2.5", ".5"], "double"),
    "small": (["1e3", "2", None], "double"),
    "truth": (["True", "false", "TRUE"], "boolean"),
    "maybe": (["true", None, "false"], "boolean"),
    "yes": (["1", "true", "2"], "string"),
    "none": ([None, None, None], "double"),
    "long": (["1", "123456789012345678901", "3"], "string"),
    "edge": (["9223372036854775807", "-9223372036854775808", "0"], "bigint"),
    "spaced": ([" 1", "2 ", "3"], "bigint"),
    "odd": (["1d", "2", "3"], "string"),
    "not a.number`": (["NaN", "Infinity", "1"], "string"),
}


def test_lattice_of_types(spark):
    rows = list(zip(*(values for values, _ in TEXTS.values()), strict=True))
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in TEXTS)
    texts = spark.createDataFrame(rows, schema)
    assert found_types(texts) == {name: kind for name, (_, kind) in TEXTS.items()}
    back = typed(texts)
    assert dict(back.dtypes) == {name: kind for name, (_, kind) in TEXTS.items()}
    first = back.first()
    assert (first["whole"], first["small"], first["truth"], first["long"], first["spaced"]) == (1, 1000.0, True, "1", 1)
    assert found_types(texts.limit(0)) == dict.fromkeys(TEXTS, "string")


def test_types_take_one_look(spark):
    texts = spark.createDataFrame([("1", "a")], "a string, b string")
    assert found_types(texts, ["a"]) == {"a": "bigint"}
    assert typed(texts.withColumn("c", F.lit(2)), {"a": "bigint"}).dtypes == [("a", "bigint"), ("b", "string"), ("c", "int")]
    assert found_types(spark.range(3).toDF("n")) == {}


@FEW
@given(st.lists(st.tuples(st.sampled_from([5, 7, None]), st.sampled_from(["x", "y", None])), max_size=60))
def test_positions_equal_those_of_one_window(spark, rows):
    df = spark.createDataFrame([(a, b, n) for n, (a, b) in enumerate(rows)], "a int, b string, id int")
    order = ("-a", "b", "id")
    got = {r["id"]: r["posicao"] for r in positioned(df, *order, parts=5).collect()}
    assert got == {r["id"]: r["posicao"] for r in numbered(df, *order).collect()}


@FEW
@given(st.lists(st.sampled_from([0.1, 2.25, -1.5, None]), max_size=40))
def test_running_totals_equal_sums(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    got = running_total(positioned(df, "id", parts=3), "v", "up_to", stretch=7).collect()
    known = [Decimal(str(v or 0)) for v in values]
    assert {r["id"]: r["up_to"] for r in got} == {n: sum(known[: n + 1]) for n in range(len(values))}


def test_positions_need_no_window_over_all_rows(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7).withColumn("_part", F.lit("kept")).withColumn("_Row", F.lit(1))
    ranked = positioned(df, "-v", "id", parts=6)
    total = running_total(ranked, "v", "up_to", stretch=100)
    assert total.columns == ["id", "v", "_part", "_Row", "posicao", "up_to"]
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    last = total.orderBy(F.desc("posicao")).first()
    assert (last["posicao"], last["up_to"], last["_part"]) == (1000, sum(n % 7 for n in range(1000)), "kept")


@FEW
@given(st.lists(st.tuples(st.sampled_from(["e", "f", None]), st.sampled_from(["p", "q r", "s.t", None]), st.sampled_from([1.5, 2.0, None])), max_size=40))
def test_matrix_has_the_cells_of_a_pivot(spark, rows):
    df = spark.createDataFrame(rows, "i string, c string, v double")
    open_cells = matrix(df, "i", "c", "v")
    pivoted = pivot_sum(df, "i", "c", "v")
    got = {r["i"]: r["celulas"] for r in open_cells.collect()}
    names = sorted({name for cells in got.values() for name in cells})
    assert set(pivoted.columns) - {"i"} == set(names)
    expected = {r["i"]: {name: r[name] for name in names} for r in pivoted.collect()}
    assert {i: {name: cells.get(name, 0.0) for name in names} for i, cells in got.items()} == expected
    drawn = spread(open_cells, "i", "celulas", ["p", "q r", "s.t", "null"]).collect()
    assert {r["i"]: {name: r[name] for name in names} for r in drawn} == expected


def test_matrix_takes_more_categories_than_a_pivot(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("i"), F.col("id").cast("string").alias("c"), F.lit(1).alias("v"))
    limit = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "100")
    try:
        assert [len(r["celulas"]) for r in matrix(df, "i", "c", "v").collect()] == [1500, 1500]
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", limit)


def test_an_unlisted_category_is_an_error(spark):
    cells = matrix(spark.createDataFrame([("e", "p", 1)], "i string, c string, v int"), "i", "c", "v")
    with pytest.raises(Exception, match="not listed: p"):
        spread(cells, "i", "celulas", ["q"]).collect()

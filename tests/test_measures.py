"""Measures against brute force on small frames."""

from __future__ import annotations

from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyloom.operators.measures import flag_adoption, flag_profile, mean_by, ordered, share, share_and_mean
from tallyloom.operators.reshape import rank_in, stack_offsets, weighted_mean

ROWS = st.lists(
    st.tuples(
        st.sampled_from(["x", "y", None]),
        st.sampled_from(["a", "b", "c", None]),
        st.sampled_from([500.0, 1500.5, 2500.5, None]),
    ),
    max_size=60,
)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def half_up(value, digits):
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def frame(spark, rows):
    return spark.createDataFrame(rows, "edition string, answer string, pay double")


@FEW
@given(ROWS)
def test_share(spark, rows):
    counts = Counter(answer for _, answer, _ in rows if answer)
    whole = sum(counts.values())
    got = {r.answer: (r.total, r.percentual) for r in share(frame(spark, rows), "answer").collect()}
    assert got == {a: (n, half_up(100.0 * n / whole, 1)) for a, n in counts.items()}


@FEW
@given(ROWS)
def test_share_within(spark, rows):
    # A missing edition is a group like any other.
    counts = Counter((edition, answer) for edition, answer, _ in rows if answer)
    wholes = Counter(edition for edition, answer, _ in rows if answer)
    got = {(r.edition, r.answer): (r.total, r.percentual) for r in share(frame(spark, rows), "answer", "edition").collect()}
    assert got == {key: (n, half_up(100.0 * n / wholes[key[0]], 1)) for key, n in counts.items()}


@FEW
@given(ROWS, st.sampled_from([None, 2]))
def test_mean_by(spark, rows, least):
    groups = defaultdict(list)
    for edition, answer, pay in rows:
        if edition and answer in ("a", "b") and pay is not None:
            groups[edition, answer].append(pay)
    kept = {key: pays for key, pays in groups.items() if len(pays) >= (least or 1)}
    means = mean_by(frame(spark, rows), ["edition", "answer"], "pay", least, only={"answer": ("a", "b")})
    got = {(r.edition, r.answer): (r.salario_medio, r.total) for r in means.collect()}
    assert got == {key: (half_up(sum(p) / len(p), 2), len(p)) for key, p in kept.items()}


def test_share_and_mean_counts_those_without_a_value(spark):
    rows = [("x", "a", 10.0), ("x", "a", None), ("x", "b", None), ("x", None, 5.0)]
    got = ordered(share_and_mean(frame(spark, rows), "answer", "pay"), "-total", "answer").collect()
    assert [tuple(r) for r in got] == [("a", 2, 66.7, 10.0), ("b", 1, 33.3, None)]


def test_flag_profile_keeps_missing_flags_apart(spark):
    rows = [("1", "1", 10.0), ("1", "0", 5.0), ("0", "1", 6.0), ("1", None, 9.0), (None, None, 11.0), ("1", "1", None)]
    df = spark.createDataFrame(rows, "f string, g string, pay double")
    got = ordered(flag_profile(df, ["f", "g"], "pay", "n"), "n").collect()
    assert [tuple(r) for r in got] == [(1, 5.5, 2), (2, 10.0, 1), (None, 10.0, 2)]
    assert [r.n for r in ordered(flag_profile(df, ["f", "g"], "pay", "n", 2), "n").collect()] == [1, None]


def test_a_malformed_flag_is_an_error(spark):
    df = spark.createDataFrame([("1.0",)], "f string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        flag_adoption(df, {"F": "f"}, "flag", "n").collect()


def test_flag_adoption(spark):
    df = spark.createDataFrame([("1", "0"), ("1", None), ("0", "1")], "f string, g string")
    got = ordered(flag_adoption(df, {"F/f": "f", "G": "g"}, "flag", "n"), "-n").collect()
    assert [tuple(r) for r in got] == [("F/f", 2), ("G", 1)]


def test_order_puts_missing_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "n int")
    assert [r.n for r in ordered(df, "n").collect()] == [1, 2, None]
    assert [r.n for r in ordered(df, "-n").collect()] == [2, 1, None]
    assert [r.n for r in ordered(df, "-n", top=1).collect()] == [2]


def test_weighted_mean(spark):
    df = spark.createDataFrame([("a", 10.0, 1), ("a", 20.0, 3), ("b", 5.0, 2)], "k string, v double, w bigint")
    assert sorted(map(tuple, weighted_mean(df, ["k"], "v", "w").collect())) == [("a", 4, 17.5), ("b", 2, 5.0)]


def test_stack_and_rank_ignore_unlisted_categories(spark):
    df = spark.createDataFrame([("e", "q", 1.0), ("e", "p", 2.0), ("e", "z", 9.0), ("f", "q", 4.0)], "i string, c string, v double")
    assert [tuple(r) for r in stack_offsets(df, "i", "c", "v", ["p", "q"]).collect()] == [
        ("e", "p", 2.0, 0.0),
        ("e", "q", 1.0, 2.0),
        ("f", "q", 4.0, 0.0),
    ]
    assert [r[0] for r in df.select(rank_in("c", ["p", "q"])).collect()] == [2, 1, None, 2]


def test_rounding_is_half_up_at_ties(spark):
    # 1 of 8 is exactly 12.5 %, 1 of 16 exactly 6.25 %.
    sixteenth = [(None, "a", None)] + [(None, "b", None)] * 15
    got = {r.answer: r.percentual for r in share(frame(spark, sixteenth), "answer").collect()}
    assert got == {"a": 6.3, "b": 93.8}

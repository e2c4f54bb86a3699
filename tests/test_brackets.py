"""Percentiles by narrowing brackets against the built-in, with brackets forced to narrow many times."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from depotline.operators import brackets, cleaning as C

SHARES = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p999": 0.999, "p100": 1.0}


def both(df, **limits):
    expected = df.agg(*[F.percentile("u", share).alias(name) for name, share in SHARES.items()]).first()
    return brackets.exact_percentiles(df, "u", SHARES, **limits).first(), expected


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.sampled_from([-3.0, 0.0, 0.5, 7.25]) | st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_small_brackets_match_builtin(spark, values):
    got, expected = both(spark.createDataFrame([(v,) for v in values], "u double"), small=2, accuracy=5)
    assert list(got) == pytest.approx(list(expected), rel=1e-12, abs=1e-9)


def test_hot_values_on_either_side_of_a_rank(spark):
    """A third of all rows hold one value, the rest are spread; the rank beyond the hot value is found too."""
    random.seed(4)
    values = [5.0] * 4000 + [random.uniform(0, 10) for _ in range(8000)]
    df = spark.createDataFrame([(v,) for v in values], "u double").repartition(7)
    got, expected = both(df, small=50, accuracy=20)
    assert list(got) == pytest.approx(list(expected), rel=1e-12)
    ordered = sorted(values)
    last = max(i for i, v in enumerate(ordered) if v == 5.0)
    ranks = [ordered.index(5.0) - 1, ordered.index(5.0), last, last + 1]
    assert brackets.values_at_ranks(df, "u", ranks, len(values), small=3, accuracy=20) == [ordered[r] for r in ranks]


def test_one_value_only_and_none(spark):
    same = spark.createDataFrame([(2.0,)] * 500 + [(None,)], "u double")
    assert list(both(same, small=1, accuracy=10)[0]) == [2.0] * 5
    empty = spark.createDataFrame([(None,)], "u double")
    assert list(brackets.exact_percentiles(empty, "u", SHARES).first()) == [None] * 5
    assert C.cap_outliers(empty, "u").count() == 1


def test_infinite_values(spark):
    df = spark.createDataFrame([(v,) for v in [float("-inf")] * 30 + [float("inf")] * 31 + [1.0] * 40], "u double")
    assert brackets.values_at_ranks(df, "u", [0, 29, 30, 69, 70, 100], 101, small=1, accuracy=10) == [float("-inf")] * 2 + [1.0] * 2 + [float("inf")] * 2


def test_neighbouring_ranks_share_a_bracket(spark, monkeypatch):
    """A percentile between two rows asks for both; each took a sketch and counts of its own in every pass."""
    asked, ends = [], brackets._ends
    monkeypatch.setattr(brackets, "_ends", lambda value, bracket, accuracy: asked.append(bracket.rank) or ends(value, bracket, accuracy))
    values = [float((i * 7919) % 5003) for i in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert brackets.values_at_ranks(df, "v", [2999, 3000], 4000, small=500, accuracy=100) == sorted(values)[2999:3001]
    assert asked and set(asked) == {2999}

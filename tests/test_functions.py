"""Column builders on hand-made edge cases."""

from __future__ import annotations

import datetime as dt
import math
from statistics import NormalDist

import pytest
from helpers import rows
from pyspark.sql import functions as F

from depotline.functions import calendar as cal, numeric as num, text, vectors
from depotline.functions.normal import normal_quantile, normal_upper_tail


def column(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_iso_week_at_new_year(spark):
    dates = [dt.date(2023, 1, 1), dt.date(2024, 12, 30), dt.date(2020, 12, 31), dt.date(2024, 7, 1)]
    assert column(spark, dates, "date", cal.iso_year_week) == ["2022-W52", "2025-W01", "2020-W53", "2024-W27"]


def test_week_label_round_trip(spark):
    labels = ["2022-W52", "2025-W01", "2020-W53", "2024-W27"]
    mondays = column(spark, labels, "string", cal.week_label_to_monday)
    assert mondays == [dt.date.fromisocalendar(int(w[:4]), int(w[6:]), 1) for w in labels]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 30),)], "d date").select(
        *[c.alias(n) for n, c in cal.date_parts(F.col("d")).items()]
    )
    assert df.first().asDict() == {
        "year": 2024, "month": 3, "quarter": 1, "week_number": 13, "day_of_week": 5, "year_week": "2024-W13", "is_weekend": 1,
    }


def test_parse_date_is_tolerant(spark):
    values = ["2024-02-29", " 2024-01-01 ", "01/01/1970", "2023-02-30", "", None]
    assert column(spark, values, "string", cal.parse_date) == [dt.date(2024, 2, 29), dt.date(2024, 1, 1), None, None, None, None]


@pytest.mark.parametrize("raw", ["north", " North ", "wh-north", "O'NEIL", "middle EAST", "\tsouth\n", "3rd street", "", "éCOLE"])
def test_title_case_matches_python(spark, raw):
    assert column(spark, [raw], "string", lambda c: text.standard_text(c, "title")) == [raw.strip().title()]


def test_standard_text_keeps_null(spark):
    assert column(spark, [None], "string", lambda c: text.standard_text(c, "upper")) == [None]
    with pytest.raises(ValueError):
        text.standard_text(F.col("v"), "snake")


def test_to_number(spark):
    values = ["1", " 2.5 ", "-3e2", ".5", "1d", "n/a", "", "NaN", None]
    assert column(spark, values, "string", num.to_number) == [1.0, 2.5, -300.0, 0.5, None, None, None, None, None]


def test_clips_keep_null(spark):
    assert column(spark, [None, 1.0, 9.0], "double", lambda c: num.cap_above(c, F.lit(5.0))) == [None, 1.0, 5.0]
    assert column(spark, [None, 1.0, 9.0], "double", lambda c: num.floor_below(c, 5.0)) == [None, 5.0, 9.0]


def test_ratio_by_zero_is_null(spark):
    assert column(spark, [0.0, 2.0, None], "double", lambda c: num.ratio(F.lit(1.0), c)) == [None, 0.5, None]


def test_constant_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert df.agg(num.guarded_corr(F.col("x"), F.col("y"))).first()[0] is None


@pytest.mark.parametrize("p", [0.001, 0.02, 0.1, 0.5, 0.9, 0.92, 0.95, 0.98, 0.999])
def test_normal_quantile(spark, p):
    got = column(spark, [p], "double", normal_quantile)[0]
    assert got == pytest.approx(NormalDist().inv_cdf(p), abs=1e-7)


def test_normal_quantile_outside(spark):
    assert column(spark, [0.0, 1.0, None], "double", normal_quantile) == [None, None, None]


@pytest.mark.parametrize("z", [-4.0, -1.0, 0.0, 0.5, 1.96, 6.0])
def test_normal_upper_tail(spark, z):
    got = column(spark, [z], "double", normal_upper_tail)[0]
    assert got == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-6)


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = rows(df.select(vectors.l2_norm(F.col("v")), vectors.unit_vector(F.col("v"))))
    assert got == [(5.0, [0.6, 0.8]), (0.0, [0.0, 0.0])]


def test_remap(spark):
    assert column(spark, ["WH-N", "WH-X", None], "string", lambda c: text.remap(c, {"WH-N": "WH-NORTH"})) == ["WH-NORTH", "WH-X", None]


def test_trimming_is_that_of_the_pattern(spark):
    from depotline.functions.text import standard_text

    texts = ["", " ", "a", "  Middle East \t", "\r\na\x0b\x0c", " a  ", "a \u0085", "a ", "   a", "a \n", "\xa0a\xa0", "a b\x1c ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(standard_text(F.col("t"), "strip").alias("a"), F.regexp_replace("t", r"^\s+|\s+$", "").alias("b"))
    assert all(r.a == r.b for r in got.collect())
    # Texts without such ends meet no pattern.
    plan = df.where("t = 'a'").select(standard_text(F.col("t"), "strip").alias("a"))._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN" in plan and "trim" in plan

"""Weekly grain, features, splits, folds and forecasts on small frames."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from depotline.operators import enrich, evaluation as E, weekly as W

MONDAY = dt.date(2024, 1, 1)


def week(n: int) -> dt.date:
    return MONDAY + dt.timedelta(weeks=n)


def series(spark, values, region="North", category="Toys", start=0):
    data = [(week(start + i), region, category, float(v)) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(data, "week_start date, region string, category string, total_units double")


def daily(spark, data):
    return spark.createDataFrame(
        data,
        "date date, region string, category string, units_ordered double, price_usd double, holiday_peak_flag int, "
        "prime_event_flag int, marketing_push_flag int, weather_disruption_index double",
    )


def test_weekly_grain(spark):
    df = daily(spark, [
        (dt.date(2024, 12, 30), "North", "Toys", 2.0, 10.0, 0, 0, 1, 0.5),
        (dt.date(2025, 1, 1), "North", "Toys", 3.0, 20.0, 1, 0, 0, None),
        (dt.date(2025, 1, 6), "North", "Toys", None, 5.0, 0, 0, 0, 1.0),
        (dt.date(2025, 1, 6), None, "Toys", 9.0, 5.0, 0, 0, 0, 1.0),
    ])
    got = rows(W.weekly_grain(df).select(
        "year_week", "week_start", "total_units", "avg_price_usd", "holiday_peak_flag", "marketing_push_flag",
        "weather_disruption", "year", "month", "week_number"), "week_start")
    assert got == [
        ("2025-W01", dt.date(2024, 12, 30), 5.0, 15.0, 1, 1, 0.5, 2024, 12, 1),
        ("2025-W02", dt.date(2025, 1, 6), 0.0, 5.0, 0, 0, 1.0, 2025, 1, 2),
    ]


def test_weekly_grain_ignores_row_order(spark):
    data = [(dt.date(2024, 1, d), "North", "Toys", float(d), 1.0, d % 2, 0, 0, 0.1 * d) for d in range(1, 8)]
    one, other = W.weekly_grain(daily(spark, data)), W.weekly_grain(daily(spark, data[::-1]))
    assert rows(one.select("total_units", "holiday_peak_flag", F.round("weather_disruption", 9))) == rows(
        other.select("total_units", "holiday_peak_flag", F.round("weather_disruption", 9)))


def test_lags_count_rows_and_rolling_excludes_current(spark):
    df = series(spark, [1, 2, None, 4, 5, 6])
    lagged = rows(W.add_lags(df, lags=[1]).select("total_units", "total_units_lag_1"), "week_start")
    assert lagged == [(1.0, None), (2.0, 1.0), (4.0, 2.0), (5.0, 4.0), (6.0, 5.0)]
    rolled = rows(W.add_rolling(df, windows=[4]).select("total_units_roll_mean_4", "total_units_roll_std_4"), "week_start")
    assert rolled[:4] == [(None, None)] * 4
    assert rolled[4] == (pytest.approx(3.0), pytest.approx(1.8257418584))


def test_short_series_has_no_rolling(spark):
    assert rows(W.add_rolling(series(spark, [1, 2]), windows=[4]).select("total_units_roll_mean_4")) == [(None,), (None,)]


def test_dense_weeks_and_view(spark):
    both = series(spark, [1, None, 3]).unionByName(series(spark, [7], region="South", start=1))
    dense = W.dense_weeks(both)
    assert rows(dense.select("region", "total_units"), "region", "week_start") == [
        ("North", 1.0), ("North", 0.0), ("North", 3.0), ("South", 0.0), ("South", 7.0), ("South", 0.0)]
    view = W.week_view(both, start=1, size=2, region="North")
    assert rows(view.select("week_index", "total_units")) == [(2, 3.0)]


def test_event_lift_without_one_side(spark):
    df = series(spark, [10, 20]).withColumn("holiday_peak_flag", F.lit(1))
    assert W.event_lift(df, ["holiday_peak_flag"]).first()["lift_pct"] is None
    mixed = series(spark, [10, 20]).withColumn("f", (F.col("total_units") > 15).cast("int"))
    assert W.event_lift(mixed, ["f"]).first()["lift_pct"] == 100.0


def test_shares_sum_to_hundred(spark):
    df = series(spark, [1, 2]).unionByName(series(spark, [3], category="Pet"))
    assert sum(r["share_pct"] for r in W.category_share(df).collect()) == pytest.approx(100.0)


def test_unpivot_drops_empty_cells(spark):
    df = series(spark, [1, 2]).withColumn("week_number", F.weekofyear("week_start"))
    matrix = W.seasonality_matrix(df, ["North", "South"])
    assert W.unpivot_matrix(matrix, "week_number", ["North", "South"], "region", "u").count() == 2


def test_calendar_prefix_and_miss(spark):
    demand = spark.createDataFrame([(week(0), 1), (week(1), 2)], "date date, year int")
    calendar = spark.createDataFrame([(week(0), 2024)], "date date, year int")
    assert rows(enrich.join_calendar(demand, calendar), "date") == [(week(0), 1, 2024), (week(1), 2, None)]


def test_time_split_is_exact(spark):
    df = series(spark, range(10)).unionByName(series(spark, range(5), region="South"))
    marked = E.time_split(df, 0.8)
    assert marked.where("is_train").count() == 12
    latest_train = marked.where("is_train").agg(F.max("week_start")).first()[0]
    earliest_test = marked.where("NOT is_train").agg(F.min("week_start")).first()[0]
    assert latest_train <= earliest_test


def test_folds_expand(spark):
    folded = E.walk_forward_folds(series(spark, range(12)), folds=4)
    got = {r["fold"]: (r["t"], r["v"]) for r in folded.groupBy("fold").agg(
        F.count_if("is_train").alias("t"), F.count_if(~F.col("is_train")).alias("v")).collect()}
    assert got == {1: (4, 2), 2: (6, 2), 3: (8, 2), 4: (10, 2)}


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 1.0), (4.0, None)], "total_units double, predicted_units double")
    row = E.metrics(df).first()
    assert (row.n, row.mae, row.rmse, row.wape, row.r2) == (3, 1.67, 2.38, 55.6, -1.125)
    constant = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0)], "total_units double, predicted_units double")
    row = E.metrics(constant).first()
    assert (row.wape, row.r2) == (0.0, None)
    assert E.mape(constant).first().undefined_rows == 2


def test_naive_and_interval(spark):
    df = series(spark, [5, 6, 7, 8, 9, 10, 11, 12, 13, 1])
    naive = E.last_value_forecast(E.holdout_split(df, 1))
    assert rows(naive.select("total_units", "predicted_units")) == [(1.0, 13.0)]
    stats = E.residual_stats(E.persistence_residuals(df))
    forecast = E.add_interval(E.forward_persistence(df, 3), stats)
    got = rows(forecast.select("week_start", "predicted_units", "predicted_units_lower"), "week_start")
    assert [g[0] for g in got] == [week(10), week(11), week(12)]
    assert all(g[1] == 1.0 and g[2] == 0.0 for g in got)


def test_year_over_year_null_without_match(spark):
    df = series(spark, [10], start=0).unionByName(series(spark, [15], start=52)).withColumns(
        {"year_week": F.concat(F.extract(F.lit("YEAROFWEEK"), "week_start").cast("string"), F.lit("-W01")), "week_number": F.lit(1)})
    growth = rows(E.year_over_year(df).select("demand_yoy_growth_pct"), "week_start")
    assert growth == [(None,), (50.0,)]


def test_placeholder_bounds(spark):
    assert rows(E.placeholder_forecast(series(spark, [10])).select("forecast_units", "lower_bound", "upper_bound")) == [(10.0, 8.0, 12.0)]


def test_calendar_with_repeated_dates_is_refused(spark, monkeypatch):
    demand = spark.createDataFrame([(week(0), 1)], "date date, units int")
    twice = spark.createDataFrame([(week(0), 5), (week(0), 6)], "date date, year int")
    with pytest.raises(ValueError, match="2 rows for 1 dates"):
        enrich.join_calendar(demand, twice)
    monkeypatch.setattr(enrich, "CALENDAR_ROWS", 0)
    joined = enrich.join_calendar(demand, twice.limit(1))
    assert joined.count() == 1 and "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()

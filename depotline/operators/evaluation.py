"""Splits, error metrics, baselines and residual statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from depotline import settings as S
from depotline.functions.numeric import ratio
from depotline.operators.weekly import SEGMENT, segment_window, week_index

TARGET = "total_units"


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def training_frame(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, list[str]]:
    """Complete rows and the numeric feature list."""
    features = numeric_columns(df, (target,))
    if not features:
        raise ValueError("no numeric feature columns")
    return df.na.drop(subset=[*features, target]), features


def time_split(df: DataFrame, share: float = 0.8, order: str = "week_start", tie_break: list[str] | None = None) -> DataFrame:
    """Mark the first ``share`` of the rows in time order as training rows.

    Positions come from counts per date and, inside a date, per tie-break key;
    the ordered windows see one row per date and one row per key of a date.
    Rows that agree on date and tie-break key stay on the same side.
    """
    ties = tie_break or SEGMENT
    per_key = df.groupBy(order, *ties).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    per_date = per_key.groupBy(order).agg(F.sum("_n").alias("_d")).select(
        order, F.coalesce(F.sum("_d").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(order).orderBy(*ties).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_key.join(per_date, order).withColumn(
        "_start", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    )
    size = per_key.agg(F.floor(F.sum("_n") * F.lit(share))).scalar()
    marked = starts.select(order, *ties, (F.col("_start") < size).alias("is_train"))
    return df.join(marked, [order, *ties])


def holdout_split(weekly: DataFrame, weeks: int = 8) -> DataFrame:
    """The last ``weeks`` calendar weeks are the test rows."""
    last = weekly.agg(F.max("week_start")).scalar()
    return weekly.withColumn("is_train", F.col("week_start") <= F.date_sub(last, weeks * 7))


def walk_forward_folds(weekly: DataFrame, folds: int = 4) -> DataFrame:
    """Expanding-window folds over distinct weeks with equal validation blocks.

    Weeks are cut into ``folds + 1`` blocks (the first takes the remainder);
    fold k validates on block k and trains on every earlier week. A row appears
    once per fold it belongs to.
    """
    numbered = week_index(weekly)
    weeks = weekly.agg(F.count_distinct("week_start")).scalar()
    expanded = numbered.withColumn("_block", F.floor(weeks / (folds + 1))).withColumn(
        "fold", F.explode(F.sequence(F.lit(1), F.lit(folds)))
    )
    start = weeks - F.col("_block") * (folds + 1 - F.col("fold"))
    return (
        expanded.withColumn("_start", start)
        .where(F.col("week_index") < F.col("_start") + F.col("_block"))
        .withColumn("is_train", F.col("week_index") < F.col("_start"))
        .drop("_block", "_start")
    )


def metric_columns(actual: Column, predicted: Column) -> dict[str, Column]:
    """MAE, RMSE, WAPE (denominator at least 1) and R2 as aggregates."""
    error = actual - predicted
    squared = F.sum(error * error)
    total = F.var_pop(actual) * F.count(error)
    return {
        "mae": F.round(F.avg(F.abs(error)), 2),
        "rmse": F.round(F.sqrt(F.avg(error * error)), 2),
        "wape": F.round(F.sum(F.abs(error)) / F.greatest(F.sum(F.abs(actual)), F.lit(1.0)) * 100, 1),
        "r2": F.round(F.lit(1.0) - F.try_divide(squared, F.nullif(total, F.lit(0.0))), 4),
    }


def metrics(df: DataFrame, by: list[str] | None = None, actual: str = TARGET, predicted: str = "predicted_units") -> DataFrame:
    """All four metrics for every group in one pass; rows without a prediction are left out."""
    scored = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    columns = metric_columns(F.col(actual), F.col(predicted))
    return scored.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"), *[c.alias(name) for name, c in columns.items()]
    )


def mape(df: DataFrame, by: list[str] | None = None, actual: str = TARGET, predicted: str = "predicted_units") -> DataFrame:
    """Mean absolute percentage error; rows with zero actual have none and are counted."""
    share = F.try_divide(F.abs(F.col(actual) - F.col(predicted)), F.abs(F.col(actual)))
    return df.groupBy(*(by or [])).agg(
        F.round(F.avg(share) * 100, 4).alias("mape_pct"), F.count_if(F.col(actual) == 0).alias("undefined_rows")
    )


def last_value_forecast(marked: DataFrame, by: list[str] | None = None, target: str = TARGET) -> DataFrame:
    """Persistence baseline: each segment's last training value for all its test weeks."""
    keys = [*(by or []), *SEGMENT]
    last = marked.where("is_train").groupBy(*keys).agg(F.max_by(target, "week_start").alias("predicted_units"))
    return marked.where("NOT is_train").join(last, keys, "left")


def persistence_residuals(weekly: DataFrame, target: str = TARGET) -> DataFrame:
    """One-step persistence over history: actual, prediction (previous row) and residual."""
    previous = F.lag(target).over(segment_window())
    rows = weekly.select("week_start", *SEGMENT, F.col(target), previous.alias("predicted_units"))
    return rows.where(F.col("predicted_units").isNotNull()).withColumn(
        "residual", F.col(target) - F.col("predicted_units")
    )


def with_residual(df: DataFrame, actual: str = TARGET, predicted: str = "predicted_units") -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def residual_stats(residuals: DataFrame, actual: str = TARGET) -> DataFrame:
    """Spread, bias and size of the residuals per segment."""
    spread = F.stddev_samp("residual")
    return residuals.groupBy(*SEGMENT).agg(
        spread.alias("residual_std"),
        F.avg("residual").alias("residual_mean"),
        F.avg(F.abs("residual")).alias("residual_mae"),
        F.avg(actual).alias("mean_actual_demand"),
        F.count(F.lit(1)).alias("train_row_count"),
        (ratio(spread, F.avg(actual)) * 100).alias("cv_pct"),
    )


def future_weeks(weekly: DataFrame, horizon: int = S.FORECAST_WEEKS) -> DataFrame:
    """Segments by the ``horizon`` weeks after the last week of the data."""
    last = weekly.agg(F.max("week_start")).scalar()
    steps = F.sequence(F.lit(1), F.lit(horizon))
    return weekly.select(*SEGMENT).distinct().withColumn("step", F.explode(steps)).withColumn(
        "week_start", F.date_add(last, F.col("step") * 7)
    )


def forward_persistence(weekly: DataFrame, horizon: int = S.FORECAST_WEEKS, target: str = TARGET) -> DataFrame:
    """Flat forward forecast: the last value of each segment over the horizon."""
    last = weekly.groupBy(*SEGMENT).agg(F.max_by(target, "week_start").alias("predicted_units"))
    return future_weeks(weekly, horizon).join(last, SEGMENT, "left")


def add_interval(forecast: DataFrame, stats: DataFrame, z: float = S.INTERVAL_Z) -> DataFrame:
    """Point forecast minus and plus z residual deviations; the lower bound stays at or above 0."""
    joined = forecast.join(
        stats.select(*SEGMENT, "residual_std", "mean_actual_demand", "cv_pct"), SEGMENT, "left"
    )
    half = F.coalesce("residual_std", F.lit(0.0)) * z
    point = F.col("predicted_units")
    return joined.withColumns(
        {
            "predicted_units_lower": F.when(point.isNotNull(), F.greatest(point - half, F.lit(0.0))),
            "predicted_units_upper": point + half,
            "forecast_std": F.col("residual_std"),
        }
    )


def tag_interval(forecast: DataFrame, kind: str = "forward_12wk") -> DataFrame:
    return forecast.withColumns(
        {
            "ci_width": F.col("predicted_units_upper") - F.col("predicted_units_lower"),
            "forecast_type": F.lit(kind),
        }
    )


def placeholder_forecast(test: DataFrame, target: str = TARGET) -> DataFrame:
    """Export shape without a model: forecast equals actual, bounds at 80 and 120 percent."""
    actual = F.col(target)
    return test.select(
        "week_start",
        *SEGMENT,
        actual.alias("actual_units"),
        actual.alias("forecast_units"),
        F.when(actual.isNotNull(), F.greatest(actual * 0.8, F.lit(0.0))).alias("lower_bound"),
        (actual * 1.2).alias("upper_bound"),
    )


def compare_models(scored: dict[str, DataFrame], baseline: str, actual: str = TARGET) -> DataFrame:
    """Metrics per model and the percent improvement over the baseline, lowest MAE first."""
    rows = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("model"), actual, "predicted_units") for name, df in scored.items()],
    )
    table = metrics(rows, ["model"], actual)
    reference = table.where(F.col("model") == baseline).select(F.struct("mae", "wape")).scalar()
    return (
        table.withColumn("_b", reference)
        .withColumn("mae_improvement_pct", F.round(ratio(F.col("_b.mae") - F.col("mae"), F.col("_b.mae")) * 100, 1))
        .withColumn("wape_improvement_pct", F.round(ratio(F.col("_b.wape") - F.col("wape"), F.col("_b.wape")) * 100, 1))
        .drop("_b")
        .orderBy(F.col("mae").asc_nulls_last(), "model")
    )


def distribution_shift(marked: DataFrame, target: str = TARGET) -> DataFrame:
    """Mean of the target in training and test rows, and the change in percent."""
    train = F.avg(F.when(F.col("is_train"), F.col(target)))
    test = F.avg(F.when(~F.col("is_train"), F.col(target)))
    return marked.agg(
        F.round(train, 4).alias("train_mean"),
        F.round(test, 4).alias("test_mean"),
        F.round((ratio(test, train) - 1) * 100, 4).alias("shift_pct"),
    )


def year_over_year(weekly: DataFrame, target: str = TARGET) -> DataFrame:
    """Growth against the same ISO week one ISO year earlier; null without a match."""
    dated = weekly.withColumn("iso_year", F.substring("year_week", 1, 4).cast("int"))
    keys = ["iso_year", "week_number", *SEGMENT]
    before = dated.select(
        (F.col("iso_year") + 1).alias("iso_year"), "week_number", *SEGMENT, F.col(target).alias("units_year_before")
    )
    return dated.join(before, keys, "left").withColumn(
        "demand_yoy_growth_pct", ratio((F.col(target) - F.col("units_year_before")) * 100, F.col("units_year_before"))
    )

"""Weekly region-by-category grain and the summaries read off it.

Once demand is on the weekly grain, a (region, category) series holds at most
one row per calendar week, whatever the number of demand lines behind it. The
ordered windows below rely on that bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from depotline import settings as S
from depotline.functions.calendar import date_parts, iso_week_start
from depotline.functions.numeric import guarded_corr, intercept, ratio, slope

SEGMENT = ["region", "category"]


def with_category(demand: DataFrame, skus: DataFrame) -> DataFrame:
    """Look the category up in the SKU master, keeping every demand row."""
    return demand.join(skus.select("sku_id", "category"), "sku_id", "left")


def weekly_grain(demand: DataFrame) -> DataFrame:
    """Sum units, average price and weather, any-flag, per week, region and category.

    Grouping on the week's Monday (an integer underneath) keeps label formatting
    out of the row loop; labels and calendar parts are added to the aggregated
    rows. Parts are those of the earliest date the week has. Partial sums are
    formed before the shuffle, so the shuffled volume depends on weeks x
    segments per task and a dominant segment costs nothing extra.
    """
    keyed = demand.where(F.col("region").isNotNull() & F.col("category").isNotNull() & F.col("date").isNotNull())
    grouped = keyed.groupBy(iso_week_start(F.col("date")).alias("week_start"), *SEGMENT).agg(
        F.coalesce(F.sum("units_ordered"), F.lit(0.0)).alias("total_units"),
        F.avg("price_usd").alias("avg_price_usd"),
        *[F.max(flag).alias(flag) for flag in S.EVENT_FLAGS],
        F.avg("weather_disruption_index").alias("weather_disruption"),
        F.min("date").alias("_first"),
    )
    parts = date_parts(F.col("_first"))
    return grouped.withColumns(
        {name: parts[name] for name in ("year_week", "year", "month", "quarter", "week_number")}
    ).drop("_first")


def region_weekly_stats(weekly: DataFrame) -> DataFrame:
    """Total, mean and standard deviation of each region's weekly volume."""
    per_week = weekly.groupBy("week_start", "region").agg(F.sum("total_units").alias("units"))
    return per_week.groupBy("region").agg(
        F.round(F.sum("units"), 1).alias("total_units"),
        F.round(F.avg("units"), 1).alias("avg_weekly"),
        F.round(F.stddev_samp("units"), 1).alias("std_weekly"),
    )


def category_share(weekly: DataFrame) -> DataFrame:
    """Units per category and their share; the total is taken over the category rows."""
    totals = weekly.groupBy("category").agg(F.sum("total_units").alias("total_units"))
    everything = F.sum("total_units").over(Window.partitionBy())
    return totals.withColumn("share_pct", F.round(ratio(F.col("total_units") * 100, everything), 1))


def seasonality(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("week_number", "region").agg(F.avg("total_units").alias("avg_units"))


def seasonality_matrix(weekly: DataFrame, regions: list[str]) -> DataFrame:
    return weekly.groupBy("week_number").pivot("region", regions).agg(F.avg("total_units"))


def unpivot_matrix(matrix: DataFrame, key: str, columns: list[str], name: str, value: str) -> DataFrame:
    """Wide to long, without the empty cells."""
    return matrix.unpivot([key], columns, name, value).where(F.col(value).isNotNull())


def hottest_cells(weekly: DataFrame, top: int = 5) -> DataFrame:
    return (
        seasonality(weekly)
        .orderBy(F.col("avg_units").desc(), F.col("week_number"), F.col("region"))
        .limit(top)
    )


def event_lift(weekly: DataFrame, flags: list[str] | None = None, target: str = "total_units") -> DataFrame:
    """Percent lift of flagged over unflagged weeks, all flags in one pass."""
    entries = []
    for flag in flags or S.EVENT_FLAGS:
        on = F.avg(F.when(F.col(flag) == 1, F.col(target)))
        off = F.avg(F.when(F.col(flag) == 0, F.col(target)))
        entries.append(
            F.struct(
                F.lit(flag).alias("flag"),
                on.alias("mean_on"),
                off.alias("mean_off"),
                F.round((ratio(on, off) - 1) * 100, 1).alias("lift_pct"),
            )
        )
    return weekly.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def weather_response(weekly: DataFrame) -> DataFrame:
    """Correlation and linear trend of weekly units on weather, per region."""
    x, y = F.col("weather_disruption"), F.col("total_units")
    return weekly.groupBy("region").agg(
        F.round(guarded_corr(x, y), 3).alias("pearson_r"),
        F.round(slope(x, y), 4).alias("trend_slope"),
        F.round(intercept(x, y), 4).alias("trend_intercept"),
    )


def overview(weekly: DataFrame) -> DataFrame:
    return weekly.agg(
        F.count(F.lit(1)).alias("weekly_rows"),
        F.count_distinct("year_week").alias("weeks"),
        F.count_distinct("region").alias("regions"),
        F.count_distinct("category").alias("categories"),
        F.min("week_start").alias("first_week"),
        F.max("week_start").alias("last_week"),
        F.sum("total_units").alias("total_units"),
    )


def segment_window(order: str = "week_start"):
    return Window.partitionBy(*SEGMENT).orderBy(order)


def add_lags(
    weekly: DataFrame, target: str = "total_units", lags: list[int] | None = None, order: str = "week_start"
) -> DataFrame:
    """Earlier rows of the same segment. Lags count rows, so a silent week is skipped."""
    window = segment_window(order)
    return weekly.withColumns({f"{target}_lag_{n}": F.lag(target, n).over(window) for n in lags or S.LAG_WEEKS})


def trailing(function, target: str, size: int, order: str = "week_start") -> Column:
    """Aggregate over the ``size`` rows before the current one; null until they exist."""
    frame = segment_window(order).rowsBetween(-size, -1)
    return F.when(F.count(target).over(frame) == size, function(target).over(frame))


def add_rolling(
    weekly: DataFrame, target: str = "total_units", windows: list[int] | None = None, order: str = "week_start"
) -> DataFrame:
    """Trailing mean and sample deviation that leave the current row out."""
    columns = {}
    for size in windows or S.ROLLING_WEEKS:
        columns[f"{target}_roll_mean_{size}"] = trailing(F.avg, target, size, order)
        columns[f"{target}_roll_std_{size}"] = trailing(F.stddev_samp, target, size, order)
    return weekly.withColumns(columns)


def dense_weeks(weekly: DataFrame) -> DataFrame:
    """Add a spine: every segment gets a row for every week between first and last."""
    span = weekly.agg(F.struct(F.min("week_start").alias("a"), F.max("week_start").alias("b"))).scalar()
    spine = weekly.select(*SEGMENT).distinct().withColumn("s", span).select(
        *SEGMENT, F.explode(F.sequence("s.a", "s.b", F.expr("interval 7 days"))).alias("week_start")
    )
    return spine.join(weekly, [*SEGMENT, "week_start"], "left").withColumn(
        "total_units", F.coalesce("total_units", F.lit(0.0))
    )


def week_index(weekly: DataFrame) -> DataFrame:
    """Dense 0-based number of each distinct week, joined back on.

    The ordered window runs over distinct weeks only (one row per week).
    """
    weeks = weekly.select("week_start").distinct()
    numbered = weeks.withColumn("week_index", F.row_number().over(Window.orderBy("week_start")) - 1)
    return weekly.join(numbered, "week_start")


def week_view(
    weekly: DataFrame,
    start: int = 0,
    size: int = S.FORECAST_WEEKS,
    region: str = "All",
    category: str = "All",
) -> DataFrame:
    """Dashboard slice: ``size`` consecutive distinct weeks, optionally one region or category."""
    picked = week_index(weekly).where((F.col("week_index") >= start) & (F.col("week_index") < start + size))
    return equal_or_all(picked, region=region, category=category)


def equal_or_all(df: DataFrame, **choices: str) -> DataFrame:
    """Equality filters; the choice ``All`` (or an absent column) filters nothing."""
    for column, choice in choices.items():
        if choice != "All" and column in df.columns:
            df = df.where(F.col(column) == choice)
    return df

"""Join chains: the enriched demand fact and the modelling table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from depotline import settings as S
from depotline.functions.calendar import date_parts
from depotline.operators.valuation import add_carbon_features
from depotline.operators.weekly import SEGMENT, add_lags, add_rolling, segment_window, trailing


def prefixed(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    """Rename all columns but ``keep`` so that a join cannot produce twin names."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


#: Calendar rows up to which the calendar is sent to the demand rows (some hundred years of dates).
CALENDAR_ROWS = 50_000


def join_calendar(demand: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on date. A calendar that repeats a date is refused, as it would multiply demand; one with few rows is sent to
    the demand rows, any other is joined by date."""
    size = calendar.where(F.col("date").isNotNull()).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("date").alias("dates")).first()
    if size.rows != size.dates:
        raise ValueError(f"calendar: {size.rows} rows for {size.dates} dates")
    days = prefixed(calendar, "cal_", ["date"])
    return demand.join(F.broadcast(days) if size.rows <= CALENDAR_ROWS else days, "date", "left")


def home_sites(warehouses: DataFrame, lanes: DataFrame) -> DataFrame:
    """Per region: its own warehouse and the lane from that warehouse to the region."""
    home_lane = lanes.select(
        "warehouse_id",
        F.col("demand_region").alias("region"),
        F.col("ship_cost_per_unit").alias("home_ship_cost"),
        F.col("lead_time_days").alias("home_lead_time"),
        F.col("distance_km_proxy").alias("home_distance_km"),
        F.col("lane_efficiency_score").alias("home_lane_efficiency"),
    )
    site = warehouses.select(
        "warehouse_id",
        "region",
        F.col("capacity_units").alias("home_wh_capacity"),
        F.col("fixed_daily_cost_usd").alias("home_wh_fixed_cost"),
    )
    return site.join(home_lane, ["warehouse_id", "region"], "left").withColumnRenamed("warehouse_id", "home_warehouse")


def enriched_demand(demand: DataFrame, skus: DataFrame, warehouses: DataFrame, lanes: DataFrame) -> DataFrame:
    """Demand rows with SKU economics, home warehouse, home lane, revenue and carbon."""
    rows = demand.join(skus, "sku_id", "left").join(home_sites(warehouses, lanes), "region", "left")
    carbon = add_carbon_features(
        rows.withColumnRenamed("home_lead_time", "lead_time_days").drop("volume_m3")
    ).withColumnRenamed("lead_time_days", "home_lead_time")
    return carbon.withColumns(
        {
            "revenue_usd": F.col("units_ordered") * F.col("price_usd"),
            "carbon_kg": F.col("units_ordered") * F.col("carbon_kg_per_unit"),
        }
    )


def category_averages(skus: DataFrame) -> DataFrame:
    """Mean SKU economics per category."""
    names = {
        "unit_cost_usd": "avg_unit_cost_usd",
        "selling_price_usd": "avg_selling_price_usd",
        "gross_margin_usd": "avg_gross_margin_usd",
        "margin_pct": "avg_margin_pct",
        "cube_ft": "avg_cube_ft",
        "volume_m3": "avg_volume_m3",
        "holding_cost_daily_usd": "avg_holding_cost_daily",
        "stockout_penalty_usd": "avg_stockout_penalty",
    }
    return skus.groupBy("category").agg(*[F.avg(c).alias(name) for c, name in names.items()])


def event_weeks(calendar: DataFrame) -> DataFrame:
    """Calendar collapsed to ISO weeks: any-flag and mean weather."""
    return calendar.groupBy("year_week").agg(
        *[F.max(flag).alias(f"week_{flag}") for flag in S.EVENT_FLAGS],
        F.avg("weather_disruption_index").alias("week_weather"),
    )


def weekly_chain(
    weekly: DataFrame, calendar: DataFrame, skus: DataFrame, warehouses: DataFrame, lanes: DataFrame
) -> DataFrame:
    """Weekly rows with event weeks, category economics, home site and carbon; no row is lost."""
    joined = (
        weekly.join(event_weeks(calendar), "year_week", "left")
        .join(category_averages(skus), "category", "left")
        .join(home_sites(warehouses, lanes), "region", "left")
    )
    distance = F.col("home_lead_time") * S.KM_PER_LEAD_DAY
    weight = F.col("avg_volume_m3") * S.FREIGHT_KG_PER_M3 / 1000
    return joined.withColumns(
        {
            "carbon_distance_km": distance,
            "carbon_weight_tonnes": weight,
            "carbon_kg_per_unit": distance * weight * S.KG_CO2_PER_TONNE_KM,
        }
    )


def add_epoch_features(weekly: DataFrame) -> DataFrame:
    """Weeks since the first week of the data and a fourth-quarter marker."""
    first = weekly.agg(F.min("week_start")).scalar()
    return weekly.withColumns(
        {
            "weeks_since_epoch": F.floor(F.datediff(F.col("week_start"), first) / 7).cast("int"),
            "is_q4": (F.col("quarter") == 4).cast("int"),
        }
    )


def add_short_features(weekly: DataFrame, target: str = "total_units") -> DataFrame:
    """Lags 1, 2 and 4, trailing four-week mean and spread, and lag 1 minus lag 4."""
    window = segment_window()
    lag1, lag2, lag4 = (F.lag(target, n).over(window) for n in (1, 2, 4))
    return weekly.withColumns(
        {
            "lag_1_week_demand": lag1,
            "lag_2_week_demand": lag2,
            "lag_4_week_demand": lag4,
            "rolling_4wk_mean": trailing(F.avg, target, 4),
            "rolling_4wk_std": trailing(F.stddev_samp, target, 4),
            "demand_trend": lag1 - lag4,
        }
    )


def add_velocity(weekly: DataFrame, train_until=None, target: str = "total_units") -> DataFrame:
    """Mean weekly units per segment in the training weeks, and its rank in the region.

    ``train_until`` (a date column expression) bounds the training weeks; none
    means all rows. The rank window runs over segments, not over weekly rows.
    """
    trained = weekly if train_until is None else weekly.where(F.col("week_start") <= train_until)
    means = trained.groupBy(*SEGMENT).agg(F.avg(target).alias("category_velocity"))
    by_region = Window.partitionBy("region").orderBy(F.col("category_velocity").desc())
    ranked = means.withColumn("region_demand_rank", F.rank().over(by_region))
    return weekly.join(ranked, SEGMENT, "left")


def modelling_table(
    weekly: DataFrame, calendar: DataFrame, skus: DataFrame, warehouses: DataFrame, lanes: DataFrame, train_until=None
) -> DataFrame:
    """Everything the forecast models see, one row per week and segment."""
    chained = weekly_chain(weekly, calendar, skus, warehouses, lanes)
    table = add_velocity(add_short_features(add_epoch_features(chained)), train_until)
    # A week without a calendar entry has no disruption.
    return table.withColumn("weather_disruption", F.coalesce("weather_disruption", F.lit(0.0)))


def daily_modelling_table(demand: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar-joined demand aggregated per day and segment, with lags and trailing stats.

    Lags need an order that is unique inside a segment, so demand lines are
    first summed per date; a segment then holds one row per calendar day.
    """
    days = demand.where(F.col("region").isNotNull() & F.col("category").isNotNull()).groupBy("date", *SEGMENT).agg(
        F.sum("units_ordered").alias("units_sold")
    )
    joined = join_calendar(days, calendar.select("date", *S.EVENT_FLAGS, "weather_disruption_index"))
    dated = joined.withColumns(date_parts(F.col("date")))
    return add_rolling(add_lags(dated, "units_sold", order="date"), "units_sold", order="date")

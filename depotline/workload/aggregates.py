"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.operators import enrich, inventory as I, lanes as L, marts, planning as P, reports, segments as G, weekly as W
from depotline.operators.cleaning import collapse_dates
from depotline.plans.network import Network
from depotline.sources import bridge
from depotline.workload.registry import query


def network(spark: SparkSession, sf_dir: str) -> Network:
    return Network.from_benchmark(spark, sf_dir)


@query(
    "a01_collapse_dates",
    "date:d holiday_peak_flag:i prime_event_flag:i marketing_push_flag:i weather_disruption_index:6",
    "SELECT * FROM events_by_date",
)
def collapsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_dates(bridge.raw_event_calendar(spark, sf_dir))


@query(
    "a01_collapse_event_stream",
    "date:d purchase:i value:6",
    """SELECT CAST(ts AS DATE) AS date, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchase, avg(value) AS value
       FROM events GROUP BY 1""",
)
def collapsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bridge.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), (F.col("event_type") == "purchase").cast("int").alias("purchase"), "value"
    )
    return collapse_dates(rows, rules={"purchase": F.max, "value": F.avg})


@query(
    "a02_weekly_grain",
    "year_week region category total_units:2 avg_price_usd:4t holiday_peak_flag:i prime_event_flag:i marketing_push_flag:i "
    "weather_disruption:6 year:i month:i quarter:i week_number:i week_start:d",
    "SELECT * FROM weekly",
)
def weekly_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).weekly()


@query(
    "a03_region_weekly_stats",
    "region total_units:1 avg_weekly:1 std_weekly:1",
    """SELECT region, sum(u) AS total_units, avg(u) AS avg_weekly, stddev_samp(u) AS std_weekly
       FROM (SELECT week_start, region, sum(total_units) AS u FROM weekly GROUP BY 1, 2) GROUP BY region""",
)
def region_weekly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.region_weekly_stats(network(spark, sf_dir).weekly())


@query(
    "a04_category_share",
    "category total_units:2 share_pct:1",
    "SELECT category, sum(total_units) AS total_units, sum(total_units) * 100 / sum(sum(total_units)) OVER () AS share_pct FROM weekly GROUP BY 1",
)
def category_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.category_share(network(spark, sf_dir).weekly())


@query(
    "a05_seasonality",
    "week_number:i region avg_units:4",
    "SELECT week_number, region, avg(total_units) AS avg_units FROM weekly GROUP BY 1, 2",
)
def seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.seasonality(network(spark, sf_dir).weekly())


@query(
    "a06_event_lift",
    "flag mean_on:4 mean_off:4 lift_pct:1",
    " UNION ALL ".join(
        f"""SELECT '{f}' AS flag, avg(total_units) FILTER (WHERE {f} = 1) AS mean_on, avg(total_units) FILTER (WHERE {f} = 0) AS mean_off,
            (avg(total_units) FILTER (WHERE {f} = 1) / nullif(avg(total_units) FILTER (WHERE {f} = 0), 0) - 1) * 100 AS lift_pct FROM weekly"""
        for f in ("holiday_peak_flag", "prime_event_flag", "marketing_push_flag")
    ),
)
def event_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.event_lift(network(spark, sf_dir).weekly())


@query(
    "a07_event_type_summary",
    "event_type avg_units:2 total_units:2 record_count:l",
    """SELECT CASE WHEN holiday_peak_flag = 1 THEN 'Holiday' WHEN marketing_push_flag = 1 THEN 'Marketing' ELSE 'Non-event' END AS event_type,
              avg(units_ordered) AS avg_units, sum(units_ordered) AS total_units, count(*) AS record_count
       FROM demand GROUP BY 1""",
)
def event_type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    demand = bridge.demand_lines(spark, sf_dir).withColumnRenamed("units_ordered", "units_sold")
    return reports.event_type_summary(spark, demand, reports.calendar_view(bridge.event_calendar(spark, sf_dir)))


@query(
    "a08_category_revenue",
    "category revenue:2",
    "SELECT category, sum(units_ordered * price_usd) AS revenue FROM demand_cat GROUP BY category",
)
def category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).demand_with_category().groupBy("category").agg(
        F.sum(F.col("units_ordered") * F.col("price_usd")).alias("revenue")
    )


@query(
    "a09_abc_base",
    "category revenue:2 demand_mean:6 demand_std:4",
    """SELECT category, sum(units_ordered) AS revenue, avg(units_ordered) AS demand_mean,
              coalesce(stddev_samp(units_ordered), 0) AS demand_std FROM demand_cat GROUP BY category""",
)
def abc_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.category_base(network(spark, sf_dir).demand_with_category(), "units_ordered")


@query("a10_average_daily_demand", "region avg_daily_demand:6", "SELECT region, avg_daily_demand FROM daily_rate")
def average_daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.average_daily_demand(bridge.daily_demand(spark, sf_dir))


@query(
    "a11_units_by_site",
    "canonical_warehouse_id region inv_units:2",
    "SELECT canonical_warehouse_id, region, sum(starting_inventory_units) AS inv_units FROM master GROUP BY 1, 2",
)
def units_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).units_by_site()


_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "a12_units_matrix",
    "canonical_warehouse_id " + " ".join(f"{c}:2" for c in _CATEGORIES),
    "SELECT canonical_warehouse_id, " + ", ".join(
        f"coalesce(sum(starting_inventory_units) FILTER (WHERE category = '{c}'), 0) AS {c}" for c in _CATEGORIES
    ) + " FROM master GROUP BY 1",
)
def units_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.units_matrix(network(spark, sf_dir).inventory_master(), bridge.CATEGORIES)


@query(
    "a13_warehouse_totals",
    "canonical_warehouse_id total_units:2 total_value:0 capacity:l utilisation_pct:1",
    """SELECT canonical_warehouse_id, sum(starting_inventory_units) AS total_units, sum(inventory_value_usd) AS total_value,
              max(capacity_units) AS capacity, sum(starting_inventory_units) * 100 / max(capacity_units) AS utilisation_pct
       FROM master GROUP BY 1""",
)
def warehouse_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.warehouse_totals(network(spark, sf_dir).inventory_master())


@query(
    "a14_category_value",
    "category total_value:2 total_holding_cost:2 total_units:2",
    """SELECT category, sum(inventory_value_usd) AS total_value, sum(daily_holding_cost_usd) AS total_holding_cost,
              sum(starting_inventory_units) AS total_units FROM master GROUP BY 1""",
)
def category_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.category_value(network(spark, sf_dir).inventory_master())


@query(
    "a15_cover_summary",
    "min_cover:1 max_cover:1 mean_cover:4 at_risk:l watch:l healthy:l",
    """SELECT min(days_of_cover) AS min_cover, max(days_of_cover) AS max_cover, avg(days_of_cover) AS mean_cover,
              count(*) FILTER (WHERE days_of_cover < 14) AS at_risk,
              count(*) FILTER (WHERE days_of_cover >= 14 AND days_of_cover < 30) AS watch,
              count(*) FILTER (WHERE days_of_cover >= 30) AS healthy FROM cover""",
)
def cover_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return I.cover_summary(I.days_of_cover(n.units_by_site(), n.demand))


@query(
    "a16_efficiency_summary",
    "best_warehouse best_score:4 worst_warehouse worst_score:4",
    """WITH m AS (SELECT warehouse_id, avg(lane_efficiency_score) AS s FROM lanes GROUP BY 1)
       SELECT (SELECT warehouse_id FROM m ORDER BY round(s, 9) DESC, warehouse_id LIMIT 1) AS best_warehouse,
              (SELECT max(s) FROM m) AS best_score,
              (SELECT warehouse_id FROM m ORDER BY round(s, 9), warehouse_id LIMIT 1) AS worst_warehouse,
              (SELECT min(s) FROM m) AS worst_score""",
)
def efficiency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.efficiency_summary(bridge.lanes(spark, sf_dir))


@query(
    "a17_lane_extremes",
    "lane warehouse_id demand_region value:6",
    " UNION ALL ".join(
        f"(SELECT '{lane}' AS lane, warehouse_id, demand_region, {m} AS value FROM costed_lanes "
        f"ORDER BY {m} {d}, warehouse_id, demand_region LIMIT 1)"
        for lane, m, d in (
            ("cheapest", "ship_cost_per_unit", "ASC"), ("costliest", "ship_cost_per_unit", "DESC"),
            ("fastest", "lead_time_days", "ASC"), ("slowest", "lead_time_days", "DESC"),
            ("greenest", "carbon_kg_per_unit", "ASC"), ("dirtiest", "carbon_kg_per_unit", "DESC"),
        )
    ),
)
def lane_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.lane_extremes(network(spark, sf_dir).costed_lanes())


@query(
    "a18_portfolio",
    "stock_rows:l skus:l total_units:2 total_value:2 total_holding_cost:2 mean_row_value:4",
    """SELECT count(*) AS stock_rows, count(DISTINCT sku_id) AS skus, sum(starting_inventory_units) AS total_units,
              sum(inventory_value_usd) AS total_value, sum(daily_holding_cost_usd) AS total_holding_cost,
              avg(inventory_value_usd) AS mean_row_value FROM master""",
)
def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.portfolio(network(spark, sf_dir).inventory_master())


@query(
    "a18_demand_overview",
    "weekly_rows:l weeks:l regions:l categories:l first_week:d last_week:d total_units:2",
    """SELECT count(*) AS weekly_rows, count(DISTINCT year_week) AS weeks, count(DISTINCT region) AS regions,
              count(DISTINCT category) AS categories, min(week_start) AS first_week, max(week_start) AS last_week,
              sum(total_units) AS total_units FROM weekly""",
)
def demand_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.overview(network(spark, sf_dir).weekly())


@query(
    "a18_forecast_overview",
    "rows:l total_units:2 mean_units:4 min_units:4 max_units:4 units_per_week:4",
    """SELECT count(*) AS rows, sum(predicted_units) AS total_units, avg(predicted_units) AS mean_units,
              min(predicted_units) AS min_units, max(predicted_units) AS max_units,
              sum(predicted_units) / count(DISTINCT week_start) AS units_per_week FROM forecast""",
)
def forecast_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.forecast_overview(network(spark, sf_dir).forecast())


@query(
    "a19_forecast_rollup",
    "region category total_forecast_units:2 avg_lower_pi:2 avg_upper_pi:2",
    """SELECT region, category, sum(predicted_units) AS total_forecast_units, avg(predicted_units_lower) AS avg_lower_pi,
              avg(predicted_units_upper) AS avg_upper_pi FROM forecast GROUP BY 1, 2""",
)
def forecast_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.forecast_rollup(spark, reports.forecast_view(network(spark, sf_dir).forecast()))


@query(
    "a20_weekly_units_sql",
    "region category year_week weekly_units:2",
    "SELECT region, category, year_week, sum(units_ordered) AS weekly_units FROM demand_cat GROUP BY 1, 2, 3",
)
def weekly_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return reports.weekly_units(spark, reports.demand_view(n.demand, n.skus))


@query(
    "a21_residual_stats",
    "region category residual_std:4 residual_mean:4 residual_mae:4 mean_actual_demand:4 train_row_count:l cv_pct:4",
    "SELECT * FROM residual_stats",
)
def residual_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).residual_stats()


@query(
    "a22_category_averages",
    "category avg_unit_cost_usd:6 avg_selling_price_usd:6 avg_gross_margin_usd:6 avg_margin_pct:6 avg_cube_ft:6 avg_volume_m3:6 "
    "avg_holding_cost_daily:6 avg_stockout_penalty:6",
    """SELECT category, avg(unit_cost_usd) AS avg_unit_cost_usd, avg(selling_price_usd) AS avg_selling_price_usd,
              avg(gross_margin_usd) AS avg_gross_margin_usd, avg(margin_pct) AS avg_margin_pct, avg(cube_ft) AS avg_cube_ft,
              avg(volume_m3) AS avg_volume_m3, avg(holding_cost_daily_usd) AS avg_holding_cost_daily,
              avg(stockout_penalty_usd) AS avg_stockout_penalty FROM skus GROUP BY 1""",
)
def category_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.category_averages(bridge.sku_master(spark, sf_dir))


@query(
    "a23_warehouse_utilisation",
    "warehouse_id region capacity_units:l inventory_units:2 utilization_pct:2 available_units:2 status inventory_value_usd:2 "
    "daily_holding_cost_usd:4 fixed_daily_cost_usd:2 sku_count:l",
    """SELECT *, pct AS utilization_pct, CASE WHEN pct >= 100 THEN 'CRITICAL' WHEN pct >= 85 THEN 'HIGH' ELSE 'NORMAL' END AS status
       FROM util""",
)
def warehouse_utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).utilisation()


@query(
    "a24_placement_rollup",
    "scenario warehouse_id region category units_allocated:2 total_cost_usd:2 carbon_kg:4",
    """SELECT scenario, warehouse_id, region, category, units_allocated, total_cost_usd, carbon_kg FROM plan
       UNION ALL SELECT scenario, 'ALL', 'ALL', 'ALL', sum(units_allocated), sum(total_cost_usd), sum(carbon_kg) FROM plan GROUP BY 1""",
)
def placement_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.placement_rollup(network(spark, sf_dir).plan())


@query(
    "a25_safety_matrix",
    "region " + " ".join(f"{c}:l" for c in _CATEGORIES),
    "SELECT region, " + ", ".join(
        f"coalesce(sum(safety_stock_int) FILTER (WHERE category = '{c}'), 0) AS {c}" for c in _CATEGORIES
    ) + " FROM safety GROUP BY 1",
)
def safety_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.safety_matrix(network(spark, sf_dir).safety_stock(), bridge.CATEGORIES)


@query(
    "a26_distinct_pairs",
    "warehouse_id sku_id",
    "SELECT DISTINCT canonical_warehouse_id AS warehouse_id, sku_id FROM stock",
)
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = bridge.starting_inventory(spark, sf_dir)
    return stock.select(F.col("canonical_warehouse_id").alias("warehouse_id"), "sku_id").distinct()

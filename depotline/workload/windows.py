"""Window functions, ordering and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from depotline.operators import enrich, evaluation as E, inventory as I, planning as P, reports, segments as G, statistics as T, weekly as W
from depotline.plans.network import Network
from depotline.session import store
from depotline.sources import bridge
from depotline.workload.registry import query


def network(spark: SparkSession, sf_dir: str) -> Network:
    return Network.from_benchmark(spark, sf_dir)


_LAGS = [1, 2, 3, 4, 8, 12, 27]
_ROLLS = [4, 8, 12]


@query(
    "w01_group_lags",
    "year_week region category " + " ".join(f"total_units_lag_{n}:2" for n in _LAGS),
    "SELECT year_week, region, category, " + ", ".join(
        f"lag(total_units, {n}) OVER (PARTITION BY region, category ORDER BY week_start) AS total_units_lag_{n}" for n in _LAGS
    ) + " FROM weekly",
)
def group_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.add_lags(network(spark, sf_dir).weekly())


def _roll(n: int) -> str:
    frame = f"OVER (PARTITION BY region, category ORDER BY week_start ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return (
        f"CASE WHEN count(*) {frame} = {n} THEN avg(total_units) {frame} END AS total_units_roll_mean_{n}, "
        f"CASE WHEN count(*) {frame} = {n} THEN stddev_samp(total_units) {frame} END AS total_units_roll_std_{n}"
    )


@query(
    "w02_group_rolling",
    "year_week region category " + " ".join(f"total_units_roll_mean_{n}:5 total_units_roll_std_{n}:4" for n in _ROLLS),
    "SELECT year_week, region, category, " + ", ".join(_roll(n) for n in _ROLLS) + " FROM weekly",
)
def group_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing windows without the current row (G1: no user function needed)."""
    return W.add_rolling(network(spark, sf_dir).weekly())


@query(
    "w02_daily_features",
    "date:d region category units_sold:2 units_sold_lag_1:2 units_sold_lag_27:2 units_sold_roll_mean_4:4 units_sold_roll_std_4:4 cal_holiday_peak_flag:i",
    """WITH d AS (SELECT date, region, category, sum(units_ordered) AS units_sold FROM demand_cat GROUP BY 1, 2, 3)
       SELECT d.*, lag(units_sold, 1) OVER w AS units_sold_lag_1, lag(units_sold, 27) OVER w AS units_sold_lag_27,
              CASE WHEN count(*) OVER f = 4 THEN avg(units_sold) OVER f END AS units_sold_roll_mean_4,
              CASE WHEN count(*) OVER f = 4 THEN stddev_samp(units_sold) OVER f END AS units_sold_roll_std_4,
              c.holiday_peak_flag AS cal_holiday_peak_flag
       FROM d LEFT JOIN calendar c ON d.date = c.date
       WINDOW w AS (PARTITION BY region, category ORDER BY d.date),
              f AS (PARTITION BY region, category ORDER BY d.date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)""",
)
def daily_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily modelling table: calendar join, date parts, lags and trailing statistics per day."""
    n = network(spark, sf_dir)
    return enrich.daily_modelling_table(n.demand_with_category(), n.calendar)


_RANKED = """SELECT region, category, year_week, sum(units_ordered) AS weekly_units,
       rank() OVER (PARTITION BY region ORDER BY sum(units_ordered) DESC) AS region_rank FROM demand_cat GROUP BY 1, 2, 3"""


@query("d26_weekly_demand_ranking", "region category year_week weekly_units:2 region_rank:l", _RANKED)
def weekly_demand_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First reporting statement: rank of each week within its region."""
    n = network(spark, sf_dir)
    return reports.weekly_demand_ranking(spark, reports.demand_view(n.demand, n.skus))


@query(
    "d25_lane_ranking",
    "demand_region warehouse shipping_cost_per_unit:4 co2_kg_per_unit:4 lane_rank:l",
    """SELECT demand_region, warehouse_id AS warehouse, ship_cost_per_unit AS shipping_cost_per_unit, carbon_kg_per_unit AS co2_kg_per_unit,
              rank() OVER (PARTITION BY demand_region ORDER BY ship_cost_per_unit, carbon_kg_per_unit) AS lane_rank FROM costed_lanes""",
)
def lane_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lane ranking statement."""
    return reports.lane_ranking(spark, reports.lane_view(network(spark, sf_dir).costed_lanes()))


_SHARES = """SELECT category, revenue, revenue * 100 / sum(revenue) OVER () AS revenue_share_pct,
       sum(revenue) OVER (ORDER BY revenue DESC, category ROWS UNBOUNDED PRECEDING) * 100 / sum(revenue) OVER () AS cumulative_share_pct
       FROM (SELECT k.category, sum(d.units_ordered * k.selling_price_usd) AS revenue FROM demand d JOIN skus k ON d.sku_id = k.sku_id GROUP BY 1)"""


@query("w06_running_share", "category revenue:2 revenue_share_pct:4 cumulative_share_pct:4", _SHARES)
def running_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the grand total (W5) and running share."""
    n = network(spark, sf_dir)
    sold = n.demand.withColumnRenamed("units_ordered", "units_sold")
    return G.add_revenue_shares(reports.category_revenue(spark, sold, reports.sku_view(n.skus)))


@query(
    "w06_running_share_many_keys",
    "sku_id revenue:2 cumulative_share_pct:6",
    """SELECT sku_id, revenue, sum(revenue) OVER (ORDER BY revenue DESC, sku_id ROWS UNBOUNDED PRECEDING) * 100
              / sum(revenue) OVER () AS cumulative_share_pct
       FROM (SELECT sku_id, sum(units_ordered) AS revenue FROM demand GROUP BY 1)""",
)
def running_share_many_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU-level running share without a single-task window."""
    return G.add_revenue_shares(G.category_base(bridge.daily_demand(spark, sf_dir), "units_ordered", key="sku_id"), key="sku_id")


@query(
    "w07_group_z_scores",
    "week_start:d region category group_mean:4 group_std:4 z_score:4",
    """SELECT week_start, region, category, avg(total_units) OVER w AS group_mean, stddev_samp(total_units) OVER w AS group_std,
              (total_units - avg(total_units) OVER w) / nullif(stddev_samp(total_units) OVER w, 0) AS z_score
       FROM weekly WINDOW w AS (PARTITION BY region, category)""",
)
def group_z_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.segment_z_scores(network(spark, sf_dir).stored_weekly)


@query(
    "w10_short_features",
    "year_week region category lag_1_week_demand:2 lag_2_week_demand:2 lag_4_week_demand:2 rolling_4wk_mean:4 rolling_4wk_std:4 demand_trend:2",
    "SELECT * FROM short_features",
)
def short_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published short lags and trailing statistics (W10) with the trend lag 1 - lag 4."""
    return enrich.add_short_features(network(spark, sf_dir).weekly())


@query(
    "w11_velocity_rank",
    "region category category_velocity:4 region_demand_rank:l",
    """SELECT region, category, category_velocity, rank() OVER (PARTITION BY region ORDER BY category_velocity DESC) AS region_demand_rank
       FROM (SELECT region, category, avg(total_units) AS category_velocity FROM holdout WHERE is_train GROUP BY 1, 2)""",
)
def velocity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean weekly units in the training weeks and its rank in the region."""
    weekly = network(spark, sf_dir).stored_weekly
    last_training_week = F.date_sub(weekly.agg(F.max("week_start")).scalar(), 56)
    scored = enrich.add_velocity(weekly, last_training_week)
    return scored.groupBy("region", "category").agg(
        F.max("category_velocity").alias("category_velocity"), F.max("region_demand_rank").alias("region_demand_rank")
    )


@query(
    "w12_top_names",
    "scenario warehouse_id top_category",
    """SELECT scenario, warehouse_id, string_agg(category, '|' ORDER BY r) AS top_category FROM (
         SELECT scenario, warehouse_id, category, row_number() OVER (PARTITION BY scenario, warehouse_id
                ORDER BY round(sum(units_allocated), 6) DESC, category) AS r FROM plan GROUP BY 1, 2, 3) WHERE r <= 2 GROUP BY 1, 2""",
)
def top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.top_names(network(spark, sf_dir).plan(), "category")


@query(
    "w13_week_index",
    "week_start:d week_index:l rows:l",
    """SELECT week_start, dense_rank() OVER (ORDER BY week_start) - 1 AS week_index, count(*) AS rows FROM weekly GROUP BY week_start""",
)
def week_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = W.week_index(network(spark, sf_dir).stored_weekly)
    return indexed.groupBy("week_start", "week_index").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "w13_dense_weeks",
    "region category week_start:d total_units:2",
    """SELECT s.region, s.category, d.week_start, coalesce(w.total_units, 0) AS total_units
       FROM (SELECT DISTINCT region, category FROM weekly) s
       CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT min(week_start) FROM weekly), (SELECT max(week_start) FROM weekly), INTERVAL 7 DAY)) AS DATE) AS week_start) d
       LEFT JOIN weekly w ON w.region = s.region AND w.category = s.category AND w.week_start = d.week_start""",
)
def dense_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series with a row for every calendar week, silent weeks at 0."""
    return W.dense_weeks(network(spark, sf_dir).stored_weekly)


# --- ordering and limits -------------------------------------------------------------


@query(
    "o01_multi_key_sort",
    "position:l region category year_week",
    "SELECT row_number() OVER (ORDER BY region, sum(units_ordered) DESC, year_week, category) AS position, region, category, year_week FROM demand_cat GROUP BY 2, 3, 4",
)
def multi_key_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranked report in its output order, every row with its position.

    Positions count within the leading key; its few values give the offsets.
    """
    n = network(spark, sf_dir)
    weekly = store(reports.weekly_units(spark, reports.demand_view(n.demand, n.skus)), "ranked")
    before = Window.orderBy("of_region").rowsBetween(Window.unboundedPreceding, -1)
    sizes = weekly.groupBy(F.col("region").alias("of_region")).count()
    starts = sizes.select("of_region", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("region").orderBy(F.col("weekly_units").desc(), "year_week", "category")
    numbered = weekly.withColumn("place", F.row_number().over(within))
    placed = numbered.join(starts, F.col("region").eqNullSafe(F.col("of_region"))).withColumn("position", F.col("start") + F.col("place"))
    return placed.orderBy("region", F.col("weekly_units").desc(), "year_week", "category")


@query(
    "o03_top_anomalies",
    "region category week_start:d z_score:4",
    """SELECT region, category, week_start, z_score FROM (
         SELECT region, category, week_start, (total_units - avg(total_units) OVER (PARTITION BY region, category))
                / nullif(stddev_samp(total_units) OVER (PARTITION BY region, category), 0) AS z_score FROM weekly)
       WHERE abs(z_score) > 2 ORDER BY abs(z_score) DESC, region, category, week_start LIMIT 20""",
)
def top_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted by absolute z-score (O2, G3), first twenty (O3)."""
    return T.top_anomalies(T.anomalies(network(spark, sf_dir).stored_weekly), ["region", "category", "week_start"])


@query(
    "o04_hottest_cells",
    "week_number:i region avg_units:4",
    """SELECT week_number, region, avg(total_units) AS avg_units FROM weekly GROUP BY 1, 2
       ORDER BY avg_units DESC, week_number, region LIMIT 5""",
)
def hottest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.hottest_cells(network(spark, sf_dir).weekly())


@query(
    "o06_sorted_cover",
    "label days_of_cover:1 zone",
    """SELECT warehouse_id || ' -> ' || region AS label, days_of_cover,
              CASE WHEN days_of_cover < 14 THEN 'at_risk' WHEN days_of_cover < 30 THEN 'watch' ELSE 'healthy' END AS zone FROM cover""",
)
def sorted_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return I.cover_report(I.days_of_cover(n.units_by_site(), n.demand))


@query(
    "o08_time_split",
    "week_start:d region category is_train:b",
    """SELECT week_start, region, category, row_number() OVER (ORDER BY week_start, region, category) <= floor(count(*) OVER () * 0.8::DOUBLE) AS is_train
       FROM weekly""",
)
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.time_split(network(spark, sf_dir).stored_weekly)

"""Projections, column rules and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline import settings as S
from depotline.functions import calendar as cal, numeric as num, text
from depotline.functions.normal import normal_quantile, normal_upper_tail
from depotline.functions.vectors import dot, l2_norm, unit_vector
from depotline.operators import cleaning as C, enrich, evaluation as E, inventory as I, lanes as L
from depotline.plans.network import Network
from depotline.sources import bridge, readers
from depotline.workload.fragments import normal_cdf_sql
from depotline.workload.registry import query


@query("p01_column_pruning", "category rows:l", "SELECT category, count(*) AS rows FROM demand_cat GROUP BY category")
def column_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Network.from_benchmark(spark, sf_dir).demand_with_category().select("category").groupBy("category").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query("p02_alias_resolution", "region units_sold:2", "SELECT region, sum(units_ordered) AS units_sold FROM demand GROUP BY region")
def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target column arrives under one of several names."""
    demand = bridge.daily_demand(spark, sf_dir).withColumnRenamed("units_ordered", "demand_units")
    named = readers.resolve_alias(demand, "units_sold", ["demand_units", "units", "sales_units"])
    return named.groupBy("region").agg(F.sum("units_sold").alias("units_sold"))


@query(
    "p03_drop_column_sample",
    "value remaining:l",
    """SELECT value, (SELECT count(*) - 1 FROM (DESCRIBE SELECT * FROM raw_demand)) AS remaining
       FROM (SELECT DISTINCT weekend_flag AS value FROM raw_demand WHERE weekend_flag IS NOT NULL ORDER BY value LIMIT 5)""",
)
def drop_column_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence sample of a corrupted column, and the column count after dropping it."""
    raw = bridge.raw_daily_demand(spark, sf_dir)
    left = len(C.drop_if_present(raw, "weekend_flag").columns)
    return C.distinct_sample(raw, "weekend_flag").withColumn("remaining", F.lit(left))


@query(
    "p04_numeric_coercion",
    "rows:l units_null:l units_sum:2 price_sum:2 flag_sum:l",
    """SELECT count(*) AS rows, count(*) - count(u) AS units_null, sum(u) AS units_sum, sum(p) AS price_sum, sum(f) AS flag_sum
       FROM (SELECT TRY_CAST(units_ordered AS DOUBLE) AS u, TRY_CAST(price_usd AS DOUBLE) AS p,
                    coalesce(TRY_CAST(holiday_peak_flag AS DOUBLE), 0) AS f FROM raw_demand)""",
)
def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = C.coerce_numeric(bridge.raw_daily_demand(spark, sf_dir), ["units_ordered", "price_usd"], S.EVENT_FLAGS)
    return typed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("units_ordered").isNull()).alias("units_null"),
        F.sum("units_ordered").alias("units_sum"),
        F.sum("price_usd").alias("price_sum"),
        F.sum("holiday_peak_flag").alias("flag_sum"),
    )


@query(
    "p05_null_fill",
    "region holiday_rows:l weather_zero:l",
    """SELECT region, count(*) FILTER (WHERE coalesce(e.holiday_peak_flag, 0) = 1) AS holiday_rows,
              count(*) FILTER (WHERE coalesce(e.weather_disruption_index, 0.0) = 0.0) AS weather_zero
       FROM lines l LEFT JOIN events_by_date e ON l.date = e.date GROUP BY region""",
)
def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = C.collapse_dates(bridge.raw_event_calendar(spark, sf_dir))
    joined = bridge.demand_lines(spark, sf_dir).join(events, "date", "left")
    filled = C.fill_nulls(joined, {"holiday_peak_flag": 0, "weather_disruption_index": 0.0})
    return filled.groupBy("region").agg(
        F.count_if(F.col("holiday_peak_flag") == 1).alias("holiday_rows"),
        F.count_if(F.col("weather_disruption_index") == 0.0).alias("weather_zero"),
    )


@query(
    "p06_date_parse",
    "rows_before:l bad_dates:l rows_after:l bad_pct:4 status",
    """SELECT count(*) AS rows_before, count(*) - count(d) AS bad_dates, count(d) AS rows_after,
              (count(*) - count(d)) * 100.0 / count(*) AS bad_pct,
              CASE WHEN (count(*) - count(d)) * 1.0 / count(*) > 0.01 THEN 'WARN' ELSE 'PASS' END AS status
       FROM (SELECT TRY_CAST(date AS DATE) AS d FROM raw_demand)""",
)
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.date_parse_report(bridge.raw_daily_demand(spark, sf_dir))


@query(
    "p07_calendar_features",
    "date:d year:i month:i quarter:i week_number:i day_of_week:i year_week is_weekend:i",
    "SELECT * FROM calendar",
)
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.add_date_parts(C.collapse_dates(bridge.raw_event_calendar(spark, sf_dir)))


@query(
    "p08_week_label_to_monday",
    "year_week monday:d",
    "SELECT DISTINCT year_week, CAST(date_trunc('week', date) AS DATE) AS monday FROM demand",
)
def week_label_to_monday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels parsed back to their Monday, checked against the week of the date itself."""
    labels = bridge.daily_demand(spark, sf_dir).select("year_week").distinct()
    return labels.withColumn("monday", cal.week_label_to_monday(F.col("year_week")))


@query(
    "p09_epoch_features",
    "year_week region category weeks_since_epoch:i is_q4:i",
    """SELECT year_week, region, category, CASE WHEN quarter = 4 THEN 1 ELSE 0 END AS is_q4,
              date_diff('day', (SELECT min(week_start) FROM weekly), week_start) // 7 AS weeks_since_epoch FROM weekly""",
)
def epoch_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.add_epoch_features(Network.from_benchmark(spark, sf_dir).stored_weekly)


@query(
    "p10_conditional_column",
    "size_band rows:l units:2",
    """SELECT CASE WHEN units_ordered < 10 THEN 'small' WHEN units_ordered < 30 THEN 'medium' ELSE 'large' END AS size_band,
              count(*) AS rows, sum(units_ordered) AS units FROM demand GROUP BY 1""",
)
def conditional_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = F.col("units_ordered")
    band = F.when(units < 10, "small").when(units < 30, "medium").otherwise("large")
    return bridge.daily_demand(spark, sf_dir).groupBy(band.alias("size_band")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("units_ordered").alias("units")
    )


@query(
    "p11_label_concat",
    "label rows:l",
    "SELECT region || '|' || category AS label, count(*) AS rows FROM demand_cat GROUP BY 1",
)
def label_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Network.from_benchmark(spark, sf_dir).demand_with_category()
    return rows.groupBy(F.concat_ws("|", "region", "category").alias("label")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "p12_constant_tag",
    "forecast_type rows:l width:4",
    """SELECT 'forward_12wk' AS forecast_type, count(*) AS rows,
              avg(predicted_units_upper - predicted_units_lower) AS width FROM forecast""",
)
def constant_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = E.tag_interval(Network.from_benchmark(spark, sf_dir).forecast())
    return tagged.groupBy("forecast_type").agg(F.count(F.lit(1)).alias("rows"), F.avg("ci_width").alias("width"))


@query(
    "p13_value_remap",
    "warehouse_id canonical_warehouse_id rows:l",
    "SELECT warehouse_id, canonical_warehouse_id, count(*) AS rows FROM stock GROUP BY 1, 2",
)
def value_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = C.map_values(
        bridge.raw_starting_inventory(spark, sf_dir), "warehouse_id", bridge.SHORT_IDS, "canonical_warehouse_id"
    )
    return mapped.groupBy("warehouse_id", "canonical_warehouse_id").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "p14_numeric_discovery",
    "feature present:l mean:6",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS present, avg({c}) AS mean FROM weekly"
        for c in ("total_units", "avg_price_usd", "holiday_peak_flag", "prime_event_flag", "marketing_push_flag",
                  "weather_disruption", "year", "month", "quarter", "week_number")
    ) + ")",
)
def numeric_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric columns found from the schema, each summarised, in one pass."""
    weekly = Network.from_benchmark(spark, sf_dir).weekly()
    entries = [
        F.struct(F.lit(c).alias("feature"), F.count(c).alias("present"), F.avg(F.col(c).cast("double")).alias("mean"))
        for c in E.numeric_columns(weekly)
    ]
    return weekly.agg(F.array(*entries).alias("e")).select(F.inline("e"))


@query(
    "p15_placeholder_forecast",
    "week_start:d region category actual_units:4 forecast_units:4 lower_bound:4 upper_bound:4",
    """SELECT week_start, region, category, total_units AS actual_units, total_units AS forecast_units,
              greatest(total_units * 0.8, 0) AS lower_bound, total_units * 1.2 AS upper_bound
       FROM holdout WHERE NOT is_train""",
)
def placeholder_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = E.holdout_split(Network.from_benchmark(spark, sf_dir).stored_weekly)
    return E.placeholder_forecast(marked.where("NOT is_train"))


# --- scalar functions ---------------------------------------------------------


@query(
    "x01_strip_case",
    "raw stripped upper_text lower_text rows:l",
    """SELECT region AS raw, trim(region) AS stripped, upper(trim(region)) AS upper_text, lower(trim(region)) AS lower_text,
              count(*) AS rows FROM raw_demand GROUP BY region""",
)
def strip_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw")
    counts = bridge.raw_daily_demand(spark, sf_dir).groupBy(F.col("region").alias("raw")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumns(
        {
            "stripped": text.standard_text(raw, "strip"),
            "upper_text": text.standard_text(raw, "upper"),
            "lower_text": text.standard_text(raw, "lower"),
        }
    )


@query(
    "x02_title_case",
    "warehouse_id title",
    """SELECT warehouse_id, CASE warehouse_id WHEN 'WH-MIDDLE-EAST' THEN 'Wh-Middle-East'
              ELSE 'Wh-' || warehouse_id[4] || lower(warehouse_id[5:]) END AS title FROM sites""",
)
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters after a hyphen start a new word."""
    return bridge.warehouses(spark, sf_dir).withColumn("title", text.title_case(F.col("warehouse_id")))


@query(
    "x06_calendar_functions",
    "date:d inclusive_span:l iso_label monday:d",
    """SELECT date, date_diff('day', (SELECT min(date) FROM calendar), date) + 1 AS inclusive_span,
              strftime(date, '%G-W%V') AS iso_label, CAST(date_trunc('week', date) AS DATE) AS monday FROM calendar""",
)
def calendar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = C.collapse_dates(bridge.raw_event_calendar(spark, sf_dir)).select("date")
    first = days.agg(F.min("date")).scalar()
    return days.withColumns(
        {
            "inclusive_span": cal.inclusive_days(first, F.col("date")),
            "iso_label": cal.iso_year_week(F.col("date")),
            "monday": cal.iso_week_start(F.col("date")),
        }
    )


@query(
    "x10_numeric_functions",
    "sku_id magnitude:6 root:6 rounded:6 floored:6 capped:6 whole:l per_cube:6 share_pct:6",
    """SELECT sku_id, abs(unit_cost_usd - 900) AS magnitude, sqrt(selling_price_usd) AS root,
              round(selling_price_usd / 7, 2) AS rounded, greatest(unit_cost_usd - 900, 0) AS floored,
              least(selling_price_usd, 1000) AS capped, ceil(cube_ft) AS whole,
              selling_price_usd / nullif(cube_ft - 1, 0) AS per_cube,
              selling_price_usd * 100 / sum(selling_price_usd) OVER () AS share_pct
       FROM skus""",
)
def numeric_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """abs, sqrt, round, lower and upper clip, ceil, guarded division, share."""
    skus = bridge.sku_master(spark, sf_dir)
    cost, price = F.col("unit_cost_usd"), F.col("selling_price_usd")
    total = skus.agg(F.sum("selling_price_usd")).scalar()
    return skus.withColumns(
        {
            "magnitude": F.abs(cost - 900),
            "root": F.sqrt(price),
            "rounded": F.round(price / 7, 2),
            "floored": num.floor_below(cost - 900, 0.0),
            "capped": num.cap_above(price, F.lit(1000.0)),
            "whole": F.ceil("cube_ft"),
            "per_cube": num.ratio(price, F.col("cube_ft") - 1),
            "share_pct": num.ratio(price * 100, total),
        }
    )


@query(
    "x15_normal_quantile",
    "category target_service_level:2 z_score:6",
    "SELECT DISTINCT category, target_service_level, z_score FROM safety",
)
def service_level_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = bridge.sku_master(spark, sf_dir).select("category", "target_service_level").distinct()
    return levels.withColumn("z_score", normal_quantile(F.col("target_service_level")))


@query(
    "x16_normal_tail",
    "region category week_start:d p_value:6",
    f"""SELECT region, category, week_start, 1 - ({normal_cdf_sql('z')}) AS p_value FROM (
         SELECT region, category, week_start, (total_units - avg(total_units) OVER (PARTITION BY region, category))
                / stddev_samp(total_units) OVER (PARTITION BY region, category) AS z FROM weekly)""",
)
def normal_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-tail probability of each weekly z-score."""
    from depotline.operators.statistics import segment_z_scores

    scored = segment_z_scores(Network.from_benchmark(spark, sf_dir).stored_weekly)
    return scored.withColumn("p_value", normal_upper_tail(F.col("z_score")))


@query(
    "x17_vector_functions",
    "vec_id norm:5 unit_norm:6 self_dot:5",
    """SELECT vec_id, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm,
              (SELECT sqrt(list_dot_product(v, v)) FROM unit_index u WHERE u.vec_id = e.vec_id) AS unit_norm,
              list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) AS self_dot FROM embeddings e""",
)
def vector_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.col("embedding")
    return bridge.table(spark, sf_dir, "embeddings").select(
        "vec_id",
        l2_norm(vector).alias("norm"),
        l2_norm(unit_vector(vector)).alias("unit_norm"),
        dot(vector.cast("array<double>"), vector.cast("array<double>")).alias("self_dot"),
    )


# --- callables handed to operators --------------------------------------------


@query(
    "g02_normaliser_per_column",
    "warehouse_id demand_region cost_scaled:6 lead_scaled:6",
    """SELECT warehouse_id, demand_region,
              (ship_cost_per_unit - min(ship_cost_per_unit) OVER ()) / (max(ship_cost_per_unit) OVER () - min(ship_cost_per_unit) OVER ()) AS cost_scaled,
              CAST(lead_time_days - min(lead_time_days) OVER () AS DOUBLE) / (max(lead_time_days) OVER () - min(lead_time_days) OVER ()) AS lead_scaled
       FROM lanes""",
)
def normaliser_per_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column-building function applied to several columns (also the min-max window W8)."""
    lanes = bridge.lanes(spark, sf_dir)
    scaled = L.min_max_scaled(lanes, ["ship_cost_per_unit", "lead_time_days"])
    return lanes.withColumns({"cost_scaled": scaled["ship_cost_per_unit"], "lead_scaled": scaled["lead_time_days"]})


@query(
    "g05_rule_dictionary",
    "date:d prime_event_flag:i weather_disruption_index:6",
    """SELECT date, min(prime_event_flag) AS prime_event_flag, max(weather_disruption_index) AS weather_disruption_index
       FROM raw_events GROUP BY date""",
)
def rule_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collapse with caller-supplied aggregation rules."""
    rules = {"prime_event_flag": F.min, "weather_disruption_index": F.max}
    return C.collapse_dates(bridge.raw_event_calendar(spark, sf_dir), rules=rules)


@query(
    "g06_risk_zone",
    "warehouse_id region zone",
    """SELECT warehouse_id, region, CASE WHEN days_of_cover < 14 THEN 'at_risk' WHEN days_of_cover < 30 THEN 'watch'
              ELSE 'healthy' END AS zone FROM cover""",
)
def risk_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = Network.from_benchmark(spark, sf_dir)
    return I.cover_report(I.days_of_cover(n.units_by_site(), n.demand))

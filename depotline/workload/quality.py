"""Filters and data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline import settings as S
from depotline.functions.text import standard_text
from depotline.operators import cleaning as C, evaluation as E, lanes as L, quality as Q, sketches as K, statistics as T, weekly as W
from depotline.operators.cleaning import outside_range
from depotline.plans.cleaning import clean_daily_demand, clean_event_calendar
from depotline.plans.network import Network
from depotline.session import store
from depotline.sources import bridge, catalog
from depotline.workload.registry import query

_MEASURES = ["units_ordered", "price_usd", "weather_disruption_index"]


def typed_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged demand with dates and numbers parsed."""
    raw = C.parse_date_column(bridge.raw_daily_demand(spark, sf_dir))
    return C.coerce_numeric(raw, _MEASURES, S.EVENT_FLAGS)


def damaged_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU master that lacks some SKUs with demand and lists some without any."""
    skus = bridge.sku_master(spark, sf_dir).select("sku_id", F.substring("sku_id", 5, 20).cast("bigint").alias("k"))
    kept = skus.where(F.col("k") % 97 != 0)
    unused = skus.where(F.col("k") % 89 == 0).select(F.concat(F.col("sku_id"), F.lit("-X")).alias("sku_id"))
    return kept.select("sku_id").unionByName(unused)


_DAMAGED = """(SELECT sku_id FROM skus WHERE CAST(sku_id[5:] AS BIGINT) % 97 <> 0
               UNION ALL SELECT sku_id || '-X' FROM skus WHERE CAST(sku_id[5:] AS BIGINT) % 89 = 0)"""


@query(
    "f01_remove_non_positive",
    "allow_zero:b rows:l null_rows:l units:2",
    """SELECT false AS allow_zero, count(*) AS rows, count(*) - count(units_ordered) AS null_rows, sum(units_ordered) AS units
       FROM typed_demand WHERE units_ordered IS NULL OR units_ordered > 0
       UNION ALL SELECT true, count(*), count(*) - count(units_ordered), sum(units_ordered)
       FROM typed_demand WHERE units_ordered IS NULL OR units_ordered >= 0""",
)
def remove_non_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed_demand(spark, sf_dir)

    def summary(allow_zero: bool) -> DataFrame:
        return C.remove_negative(rows, "units_ordered", allow_zero).agg(
            F.lit(allow_zero).alias("allow_zero"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("units_ordered").isNull()).alias("null_rows"),
            F.sum("units_ordered").alias("units"),
        )

    return summary(False).unionByName(summary(True))


@query(
    "f02_cap_outliers",
    "rows:l top:6 price_sum:2 capped:l",
    """SELECT count(*) AS rows, max(least(price_usd, cap)) AS top, sum(least(price_usd, cap)) AS price_sum,
              count(*) FILTER (WHERE price_usd >= cap) AS capped
       FROM typed_demand CROSS JOIN (SELECT quantile_cont(price_usd, 0.999) AS cap FROM typed_demand)""",
)
def cap_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit prices capped at their exact 99.9th percentile."""
    rows = typed_demand(spark, sf_dir)
    capped = C.cap_outliers(rows, "price_usd")
    top = F.max("price_usd")
    return capped.groupBy("price_usd").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("rows"),
        top.alias("top"),
        F.sum(F.col("price_usd") * F.col("n")).alias("price_sum"),
        F.max_by("n", "price_usd").alias("capped"),
    )


@query(
    "f03_drop_incomplete",
    "region rows:l",
    """SELECT region, count(*) AS rows FROM (
         SELECT region, lag(total_units, 4) OVER (PARTITION BY region, category ORDER BY week_start) AS l4, weather_disruption
         FROM weekly) WHERE l4 IS NOT NULL AND weather_disruption IS NOT NULL GROUP BY region""",
)
def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    lagged = W.add_lags(Network.from_benchmark(spark, sf_dir).weekly(), lags=[4])
    complete = C.drop_incomplete(lagged, ["total_units_lag_4", "weather_disruption"])
    return complete.groupBy("region").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "f04_membership",
    "side rows:l",
    """SELECT 'in' AS side, count(*) AS rows FROM raw_demand WHERE holiday_peak_flag IN ('0', '1')
       UNION ALL SELECT 'not in', count(*) FROM raw_demand WHERE holiday_peak_flag IS NULL OR holiday_peak_flag NOT IN ('0', '1')""",
)
def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null counts as not a member."""
    raw = bridge.raw_daily_demand(spark, sf_dir)
    sides = [
        C.members_only(raw, "holiday_peak_flag", ["0", "1"], negate).agg(
            F.lit(label).alias("side"), F.count(F.lit(1)).alias("rows")
        )
        for label, negate in (("in", False), ("not in", True))
    ]
    return sides[0].unionByName(sides[1])


@query(
    "f05_regex_match",
    "well_formed:b rows:l",
    "SELECT regexp_full_match(sku_id, 'SKU-[0-9]{6}') AS well_formed, count(*) AS rows FROM raw_demand GROUP BY 1",
)
def regex_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bridge.raw_daily_demand(spark, sf_dir)
    formed = standard_text(F.col("sku_id"), "strip").rlike(S.SKU_ID_PATTERN)
    return raw.groupBy(F.coalesce(formed, F.lit(False)).alias("well_formed")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "f06_range_predicate",
    "date:d weather_disruption_index:6",
    "SELECT date, weather_disruption_index FROM events_by_date WHERE weather_disruption_index < 0 OR weather_disruption_index > 1",
)
def range_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = C.collapse_dates(bridge.raw_event_calendar(spark, sf_dir))
    return days.where(outside_range("weather_disruption_index", 0.0, 1.0))


@query(
    "f07_choice_filter",
    "choice rows:l units:2",
    """SELECT 'Europe/All' AS choice, count(*) AS rows, sum(predicted_units) AS units FROM forecast WHERE region = 'Europe'
       UNION ALL SELECT 'All/PROMO', count(*), sum(predicted_units) FROM forecast WHERE category = 'PROMO'
       UNION ALL SELECT 'All/All', count(*), sum(predicted_units) FROM forecast""",
)
def choice_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard filters: a chosen region or category, or everything."""
    forecast = Network.from_benchmark(spark, sf_dir).forecast()
    parts = [
        W.equal_or_all(forecast, region=r, category=c).agg(
            F.lit(f"{r}/{c}").alias("choice"), F.count(F.lit(1)).alias("rows"), F.sum("predicted_units").alias("units")
        )
        for r, c in (("Europe", "All"), ("All", "PROMO"), ("All", "All"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "f08_week_view",
    "year_week region category total_units:2 week_index:l",
    """SELECT year_week, region, category, total_units, i AS week_index
       FROM weekly w JOIN (SELECT week_start, row_number() OVER (ORDER BY week_start) - 1 AS i
                           FROM (SELECT DISTINCT week_start FROM weekly)) d ON w.week_start = d.week_start
       WHERE i >= 100 AND i < 112""",
)
def week_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve consecutive weeks from the hundredth on (the dashboard's window, also O7)."""
    return W.week_view(Network.from_benchmark(spark, sf_dir).stored_weekly, start=100)


@query(
    "f09_absolute_threshold",
    "region category week_start:d z_score:4",
    """SELECT * FROM (SELECT region, category, week_start,
              (total_units - avg(total_units) OVER (PARTITION BY region, category))
                / nullif(stddev_samp(total_units) OVER (PARTITION BY region, category), 0) AS z_score FROM weekly)
       WHERE abs(z_score) > 2""",
)
def absolute_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.anomalies(Network.from_benchmark(spark, sf_dir).stored_weekly)


@query(
    "f10_score_counts",
    "perfect_lanes:l zero_lanes:l",
    """SELECT count(*) FILTER (WHERE lane_efficiency_score = 1.0) AS perfect_lanes,
              count(*) FILTER (WHERE lane_efficiency_score = 0.0) AS zero_lanes FROM lanes""",
)
def score_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.efficiency_summary(bridge.lanes(spark, sf_dir))


# --- validators -----------------------------------------------------------------


def _rule_check(name: str, source: str, bad: str, shown: str, status: str) -> str:
    return f"""SELECT '{name}' AS rule, count(*) AS rows_checked, count(*) FILTER (WHERE {bad}) AS bad_rows,
        count(*) FILTER (WHERE {bad}) * 100.0 / count(*) AS bad_pct,
        CASE WHEN {status} THEN 'WARN' ELSE 'PASS' END AS status,
        min(CASE WHEN {bad} THEN {shown} END) AS low_sample, max(CASE WHEN {bad} THEN {shown} END) AS high_sample
        FROM {source}"""


_RULE_SPEC = "rule rows_checked:l bad_rows:l bad_pct:4 status low_sample high_sample"
_FLAG_BAD = "holiday_peak_flag NOT IN (0, 1)"


@query(
    "v01_binary_flags",
    "holiday_peak_flag:i prime_event_flag:i marketing_push_flag:i rows:l",
    f"""SELECT CASE WHEN {_FLAG_BAD} THEN 0 ELSE holiday_peak_flag END AS holiday_peak_flag, prime_event_flag,
               marketing_push_flag, count(*) AS rows FROM typed_demand GROUP BY 1, 2, 3""",
)
def binary_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.coerce_flags(typed_demand(spark, sf_dir), S.EVENT_FLAGS).groupBy(*S.EVENT_FLAGS).agg(
        F.count(F.lit(1)).alias("rows")
    )


_TITLED = "CASE lower(trim(region)) WHEN 'middle east' THEN 'Middle East' ELSE upper(trim(region)[1]) || lower(trim(region)[2:]) END"


@query(
    "v02_rule_report",
    _RULE_SPEC,
    " UNION ALL ".join(
        [
            _rule_check("binary:holiday_peak_flag", "typed_demand", _FLAG_BAD,
                        "CAST(holiday_peak_flag AS VARCHAR)", f"count(*) FILTER (WHERE {_FLAG_BAD}) > count(*) * 0.05"),
            _rule_check("region:region", "raw_demand WHERE TRY_CAST(date AS DATE) IS NOT NULL", f"{_TITLED} = 'Atlantis'",
                        _TITLED, f"count(*) FILTER (WHERE {_TITLED} = 'Atlantis') > 0"),
            _rule_check("sku_format:sku_id", "typed_demand", "NOT regexp_full_match(sku_id, 'SKU-[0-9]{6}')", "sku_id",
                        "count(*) FILTER (WHERE NOT regexp_full_match(sku_id, 'SKU-[0-9]{6}')) > 0"),
        ]
    ),
)
def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag, region and SKU-format rules of one table in a single pass (V1, V3, V4)."""
    rules = [Q.flag_rule("holiday_peak_flag"), Q.region_rule("region", bridge.REGIONS), Q.sku_rule()]
    return Q.check(typed_demand(spark, sf_dir), rules)


@query(
    "v02_standard_text",
    "region rows:l",
    f"SELECT {_TITLED} AS region, count(*) AS rows FROM raw_demand GROUP BY 1",
)
def standard_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.standardise_text(bridge.raw_daily_demand(spark, sf_dir), "region").groupBy("region").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "v03_unknown_regions",
    "region rows:l",
    f"SELECT {_TITLED} AS region, count(*) AS rows FROM raw_demand WHERE {_TITLED} = 'Atlantis' GROUP BY 1",
)
def unknown_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = C.standardise_text(bridge.raw_daily_demand(spark, sf_dir), "region")
    return C.members_only(clean, "region", bridge.REGIONS, negate=True).groupBy("region").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "v04_sku_format",
    "sku_id rows:l",
    "SELECT trim(sku_id) AS sku_id, count(*) AS rows FROM raw_demand WHERE NOT regexp_full_match(trim(sku_id), 'SKU-[0-9]{6}') GROUP BY 1",
)
def malformed_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Q.sku_rule()
    raw = bridge.raw_daily_demand(spark, sf_dir)
    return raw.where(rule.bad).groupBy(rule.shown.alias("sku_id")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "v05_positive_columns",
    "rule rows_checked:l bad_rows:l status",
    """SELECT rule, rows_checked, bad_rows, CASE WHEN bad_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (
         SELECT 'positive:units_ordered' AS rule, count(*) AS rows_checked, count(*) FILTER (WHERE units_ordered < 0.01) AS bad_rows FROM typed_demand
         UNION ALL SELECT 'positive:price_usd', count(*), count(*) FILTER (WHERE price_usd < 0.01) FROM typed_demand)""",
)
def positive_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard rules reported as FAIL; ``enforce`` would raise on this report."""
    return Q.check(typed_demand(spark, sf_dir), [Q.positive_rule("units_ordered"), Q.positive_rule("price_usd")])


@query(
    "v05_in_plan_assert",
    "rows:l price_sum:2",
    "SELECT count(*) AS rows, sum(price_usd) AS price_sum FROM typed_demand",
)
def in_plan_assert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hard rule inside the plan, without a job of its own."""
    return Q.assert_positive(typed_demand(spark, sf_dir), "price_usd").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("price_usd").alias("price_sum")
    )


@query(
    "v06_service_level",
    "rule rows_checked:l bad_rows:l status",
    """SELECT *, CASE WHEN bad_rows > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM (
         SELECT 'range:target_service_level' AS rule, count(*) AS rows_checked,
                count(*) FILTER (WHERE target_service_level < 0.8 OR target_service_level > 1) AS bad_rows FROM skus)""",
)
def service_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.check(bridge.sku_master(spark, sf_dir), [Q.service_level_rule()])


@query(
    "v07_warehouse_ids",
    "stage unknown:l",
    """SELECT 'before mapping' AS stage, count(DISTINCT warehouse_id) FILTER (WHERE warehouse_id NOT IN (SELECT warehouse_id FROM sites)) AS unknown FROM stock
       UNION ALL SELECT 'after mapping', count(DISTINCT canonical_warehouse_id) FILTER (WHERE canonical_warehouse_id NOT IN (SELECT warehouse_id FROM sites)) FROM stock""",
)
def warehouse_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, sites = bridge.raw_starting_inventory(spark, sf_dir), bridge.warehouses(spark, sf_dir)
    mapped = C.map_values(raw, "warehouse_id", bridge.SHORT_IDS)
    found = [
        Q.unknown_ids(df, "warehouse_id", sites).agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("unknown"))
        for stage, df in (("before mapping", raw), ("after mapping", mapped))
    ]
    return found[0].unionByName(found[1])


@query(
    "v08_schema_audit",
    "column_name status present:l",
    """SELECT w.column_name, CASE WHEN h.kind IS NULL THEN 'MISSING' WHEN h.kind <> w.kind THEN 'TYPE' ELSE 'OK' END AS status,
              (SELECT count(*) FROM positive_demand) AS present
       FROM (VALUES ('date', 'DATE'), ('sku_id', 'VARCHAR'), ('region', 'VARCHAR'), ('units_ordered', 'DOUBLE'), ('price_usd', 'DOUBLE'), ('holiday_peak_flag', 'INTEGER'),
                    ('prime_event_flag', 'INTEGER'), ('is_weekend', 'INTEGER'), ('marketing_push_flag', 'INTEGER'), ('weather_disruption_index', 'DOUBLE'), ('year', 'INTEGER'),
                    ('month', 'INTEGER'), ('quarter', 'INTEGER'), ('week_number', 'INTEGER'), ('day_of_week', 'INTEGER'), ('year_week', 'VARCHAR')) w(column_name, kind)
       LEFT JOIN (SELECT column_name, replace(column_type, 'BIGINT', 'INTEGER') AS kind FROM (DESCRIBE SELECT * FROM demand)) h ON w.column_name = h.column_name""",
)
def schema_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract check of the cleaned table next to its row count."""
    clean = clean_daily_demand(bridge.raw_daily_demand(spark, sf_dir))
    rows = clean.agg(F.count(F.lit(1))).scalar()
    return Q.schema_report(clean, catalog.dataset("daily_demand").contract).withColumn("present", rows)


@query(
    "v09_referential_integrity",
    "demand_keys:l master_keys:l orphaned:l dead_stock:l first_orphan first_dead_stock",
    f"""WITH d AS (SELECT DISTINCT sku_id FROM demand), m AS (SELECT DISTINCT sku_id FROM {_DAMAGED}),
             o AS (SELECT sku_id FROM d WHERE sku_id NOT IN (SELECT sku_id FROM m)),
             x AS (SELECT sku_id FROM m WHERE sku_id NOT IN (SELECT sku_id FROM d))
        SELECT (SELECT count(*) FROM d) AS demand_keys, (SELECT count(*) FROM m) AS master_keys,
               (SELECT count(*) FROM o) AS orphaned, (SELECT count(*) FROM x) AS dead_stock,
               (SELECT min(sku_id) FROM o) AS first_orphan, (SELECT min(sku_id) FROM x) AS first_dead_stock""",
)
def referential_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.referential_integrity(bridge.daily_demand(spark, sf_dir), damaged_skus(spark, sf_dir))


@query(
    "v10_lane_coverage",
    "lane_count:l expected_lanes:l missing_pairs:l extra_pairs:l all_lanes_ok:b",
    """WITH wanted AS (SELECT s.warehouse_id, r.region FROM sites s CROSS JOIN region_dim r)
       SELECT *, lane_count = expected_lanes AND missing_pairs = 0 AS all_lanes_ok FROM (
         SELECT (SELECT count(*) FROM lanes) AS lane_count, (SELECT count(*) FROM wanted) AS expected_lanes,
                (SELECT count(*) FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM lanes l WHERE l.warehouse_id = w.warehouse_id AND l.demand_region = w.region)) AS missing_pairs,
                (SELECT count(*) FROM lanes l WHERE NOT EXISTS (SELECT 1 FROM wanted w WHERE l.warehouse_id = w.warehouse_id AND l.demand_region = w.region)) AS extra_pairs)""",
)
def lane_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hub has no lanes here, so its five pairs are missing."""
    expected = L.expected_lanes(bridge.warehouses(spark, sf_dir), bridge.REGIONS)
    return Q.lane_coverage(bridge.lanes(spark, sf_dir), expected, expected_count=30)


@query(
    "v11_region_consistency",
    "table_name column_name value canonical:b",
    f"""SELECT 'raw_demand' AS table_name, 'region' AS column_name, value, value IN (SELECT region FROM region_dim) AS canonical
        FROM (SELECT DISTINCT region AS value FROM raw_demand)
        UNION ALL SELECT 'warehouses', 'region', region, region <> 'Central' FROM sites
        UNION ALL SELECT 'lanes', 'demand_region', d, true FROM (SELECT DISTINCT demand_region AS d FROM lanes)""",
)
def region_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "raw_demand": bridge.raw_daily_demand(spark, sf_dir),
        "warehouses": bridge.warehouses(spark, sf_dir),
        "lanes": bridge.lanes(spark, sf_dir),
    }
    return Q.region_consistency(tables, bridge.REGIONS)


@query(
    "v12_duplicate_audit",
    "rows:l distinct_keys:l duplicate_rows:l first_duplicated:d max_rows_per_key:l",
    """SELECT sum(n) AS rows, count(*) AS distinct_keys, sum(n) - count(*) AS duplicate_rows,
              min(date) FILTER (WHERE n > 1) AS first_duplicated, max(n) AS max_rows_per_key
       FROM (SELECT date, count(*) AS n FROM raw_events GROUP BY date)""",
)
def duplicate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_summary(bridge.raw_event_calendar(spark, sf_dir), "date")


@query(
    "v12_duplicated_dates",
    "date:d rows:l",
    "SELECT date, count(*) AS rows FROM raw_events GROUP BY date HAVING count(*) > 1",
)
def duplicated_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_keys(bridge.raw_event_calendar(spark, sf_dir), ["date"])


@query(
    "v13_sku_occurrence",
    "distinct_keys:l seen_once:l max_occurrences:l rows:l",
    """SELECT count(*) AS distinct_keys, count(*) FILTER (WHERE n = 1) AS seen_once, max(n) AS max_occurrences, sum(n) AS rows
       FROM (SELECT sku_id, count(*) AS n FROM demand GROUP BY sku_id)""",
)
def sku_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.occurrence_summary(bridge.daily_demand(spark, sf_dir))


@query(
    "v14_weather_range",
    "min_value:6 max_value:6 mean_value:6 out_of_range:l rows:l",
    """SELECT min(w) AS min_value, max(w) AS max_value, avg(w) AS mean_value, count(*) FILTER (WHERE w < 0 OR w > 1) AS out_of_range,
              count(*) AS rows FROM (SELECT weather_disruption_index AS w FROM events_by_date)""",
)
def weather_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = C.collapse_dates(bridge.raw_event_calendar(spark, sf_dir))
    return Q.range_summary(days, "weather_disruption_index", 0.0, 1.0)


@query(
    "v15_unmatched_rows",
    "rule rows_checked:l bad_rows:l status",
    """SELECT *, CASE WHEN bad_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (
         SELECT 'null:category' AS rule, count(*) AS rows_checked, count(*) - count(category) AS bad_rows FROM demand_cat
         UNION ALL SELECT 'null:weather_disruption_index', count(*), count(*) - count(weather_disruption_index) FROM demand_cat)""",
)
def unmatched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every demand row has a category; some dates have no calendar row."""
    joined = Network.from_benchmark(spark, sf_dir).demand_with_category()
    return Q.check(joined, [Q.unmatched_rule("category"), Q.unmatched_rule("weather_disruption_index")])


@query(
    "v16_row_count",
    "rows:l expected_rows:l status",
    """SELECT *, CASE WHEN rows = expected_rows THEN 'PASS' ELSE 'FAIL' END AS status
       FROM (SELECT (SELECT count(*) FROM lanes) AS rows, (SELECT count(*) * count(*) FROM region_dim) AS expected_rows)""",
)
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.row_count_report(bridge.lanes(spark, sf_dir), len(bridge.REGIONS) ** 2)


@query(
    "v17_value_checks",
    "rule rows_checked:l bad_rows:l status",
    """SELECT *, CASE WHEN bad_rows > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM (
         SELECT unnest(['negative_margin:gross_margin_usd', 'zero_volume:volume_m3', 'null:unit_cost_usd']) AS rule,
              n AS rows_checked, unnest([a, b, c]) AS bad_rows
       FROM (SELECT count(*) AS n, count(*) FILTER (WHERE gross_margin_usd < 0) AS a, count(*) FILTER (WHERE volume_m3 = 0) AS b,
                    count(*) - count(unit_cost_usd) AS c FROM skus))""",
)
def value_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.check(
        bridge.sku_master(spark, sf_dir), [Q.negative_margin_rule(), Q.zero_volume_rule(), Q.null_rule("unit_cost_usd")]
    )


@query(
    "v18_split_check",
    "train_rows:l test_rows:l status",
    """SELECT *, CASE WHEN train_rows > 0 AND test_rows > 0 THEN 'PASS' ELSE 'FAIL' END AS status
       FROM (SELECT count(*) FILTER (WHERE is_train) AS train_rows, count(*) FILTER (WHERE NOT is_train) AS test_rows FROM holdout)""",
)
def split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.split_counts(E.holdout_split(Network.from_benchmark(spark, sf_dir).stored_weekly))


@query(
    "v19_table_profile",
    "column_name rows:l nulls:l null_pct:1 distinct_values:l",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls,
            round((count(*) - count({c})) * 100.0 / count(*), 1) AS null_pct,
            count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END AS distinct_values FROM raw_demand"""
        for c in ("date", "day", "weekend_flag", "sku_id", "region", "units_ordered", "price_usd", "holiday_peak_flag",
                  "prime_event_flag", "marketing_push_flag", "weather_disruption_index")
    ),
)
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.profile(bridge.raw_daily_demand(spark, sf_dir))


@query(
    "v19_approximate_profile",
    "column_name type rows:l nulls:l",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, 'string' AS type, count(*) AS rows, count(*) - count({c}) AS nulls FROM raw_demand"
        for c in ("date", "day", "weekend_flag", "sku_id", "region", "units_ordered", "price_usd", "holiday_peak_flag",
                  "prime_event_flag", "marketing_push_flag", "weather_disruption_index")
    ),
)
def approximate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch-based profile: no shuffle of values. The exact parts are compared."""
    return Q.profile(bridge.raw_daily_demand(spark, sf_dir), approximate=True)


_COLUMNS = (
    "date", "day", "weekend_flag", "sku_id", "region", "units_ordered", "price_usd", "holiday_peak_flag", "prime_event_flag", "marketing_push_flag",
    "weather_disruption_index",
)


def yearly_sketches(raw: DataFrame) -> DataFrame:
    """Sketches of the raw demand, every year a load, as kept on disk."""
    return store(K.load_sketches(raw.withColumn("load", F.substring("date", 1, 4)), "load"), "profile-sketches")


@query("v19_sketch_profile", "column_name type loads:l rows:l nulls:l null_pct:1 distinct_values:l p50")
def sketch_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of all years from their stored sketches; the estimates themselves have no SQL."""
    return K.sketched_profile(yearly_sketches(bridge.raw_daily_demand(spark, sf_dir)), {"p50": 0.5})


@query(
    "v19_sketch_error",
    "column_name loads:l rows:l nulls:l distinct_values:l median_rows:l distinct_close:b median_close:b",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(DISTINCT substr(date, 1, 4)) AS loads, count(*) AS rows, count(*) - count({c}) AS nulls,
            count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END AS distinct_values,
            count(try_cast({c} AS DOUBLE)) AS median_rows, TRUE AS distinct_close, TRUE AS median_close FROM raw_demand"""
        for c in _COLUMNS
    ),
)
def sketch_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether estimates from sketches lie within the stated errors of the exact profile.

    Sketches, exact profile and ranks are a pass each over the raw rows, which are stored so that the joins behind them run once.
    """
    raw = store(bridge.raw_daily_demand(spark, sf_dir), "profile-rows")
    estimates = K.sketched_profile(yearly_sketches(raw), {"p50": 0.5}).withColumnRenamed("distinct_values", "_estimate")
    exact = Q.profile(raw).select("column_name", "distinct_values")
    # A row per column of the table.
    medians = {r.column_name: r.p50 for r in estimates.select("column_name", "p50").collect()}
    ranks = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c) < F.lit(medians[c]).cast("double")).alias("_below"),
            F.count_if(F.col(c) <= F.lit(medians[c]).cast("double")).alias("_upto"),
            F.count(c).alias("median_rows"),
        )
        for c in raw.columns
    ]
    numbers = raw.select(*[K.number(F.col(c)).alias(c) for c in raw.columns])
    ranked = numbers.agg(F.array(*ranks).alias("_r")).select(F.inline("_r"))
    slack = F.col("median_rows") * K.RANK_ERROR
    half = F.col("median_rows") / 2
    return estimates.join(exact, "column_name").join(ranked, "column_name").withColumns(
        {
            "distinct_close": F.abs(F.col("_estimate") - F.col("distinct_values")) <= F.col("distinct_values") * K.DISTINCT_ERROR,
            "median_close": (F.col("_below") - slack <= half) & (half <= F.col("_upto") + slack),
        }
    )


@query(
    "v20_value_counts",
    "value n:l share_pct:1",
    """SELECT region AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM raw_demand), 1) AS share_pct
       FROM raw_demand GROUP BY region ORDER BY n DESC, region LIMIT 10""",
)
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten most frequent raw region spellings."""
    return Q.value_counts(bridge.raw_daily_demand(spark, sf_dir), "region")


@query(
    "v22_required_values",
    "region rows:l",
    "SELECT region, count(*) AS rows FROM demand GROUP BY region",
)
def required_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demand regions must not be empty; the list then drives a filter."""
    names = Q.required_values(bridge.lanes(spark, sf_dir), "demand_region")
    return C.members_only(bridge.daily_demand(spark, sf_dir), "region", names).groupBy("region").agg(F.count(F.lit(1)).alias("rows"))


# --- whole cleaning pipelines ------------------------------------------------------


@query(
    "v00_clean_demand",
    "year_week region rows:l units:4 holiday:l weekend:l price:2",
    """SELECT strftime(date, '%G-W%V') AS year_week, region, count(*) AS rows, sum(CASE WHEN units_ordered > cap THEN cap ELSE units_ordered END) AS units,
              count(*) FILTER (WHERE holiday_peak_flag = 1) AS holiday, count(*) FILTER (WHERE isodow(date) >= 6) AS weekend,
              sum(price_usd) AS price
       FROM positive_demand CROSS JOIN unit_cap GROUP BY 1, 2""",
)
def clean_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full demand cleaning chain, summarised by week and region."""
    clean = clean_daily_demand(bridge.raw_daily_demand(spark, sf_dir))
    return clean.groupBy("year_week", "region").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("units_ordered").alias("units"),
        F.sum("holiday_peak_flag").alias("holiday"),
        F.sum("is_weekend").alias("weekend"),
        F.sum("price_usd").alias("price"),
    )


@query(
    "v00_clean_calendar",
    "date:d holiday_peak_flag:i prime_event_flag:i marketing_push_flag:i weather_disruption_index:6 year_week is_weekend:i",
    "SELECT * FROM calendar",
)
def clean_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar cleaning chain from text rows."""
    raw = bridge.raw_event_calendar(spark, sf_dir)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return clean_event_calendar(text.withColumn("weekend_flag", F.lit("01/01/1970")))

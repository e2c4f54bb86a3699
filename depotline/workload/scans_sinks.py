"""Scans, sources and sinks."""

from __future__ import annotations

from functools import reduce
from posixpath import join
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.operators import cleaning as C, reports

from depotline.plans.cleaning import audit_occurrence, clean_daily_demand, clean_event_calendar
from depotline.plans.network import Network
from depotline.session import checkpoint_dir, store
from depotline.sources import bridge, catalog, readers, sinks
from depotline.sources.audit import StepAudit, run_summary, summarise_log
from depotline.stages import Job
from depotline.workload.registry import query


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return join(checkpoint_dir(spark), "workload", f"{name}-{uuid4().hex}")


def counts_by_name(tables: dict[str, DataFrame], label: str) -> DataFrame:
    """One row per table with its row count."""
    counted = [df.agg(F.lit(name).alias(label), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


@query(
    "s01_raw_text_scan",
    "region rows:l text_units:s blank_flags:l",
    "SELECT region, count(*) AS rows, max(units_ordered) AS text_units, "
    "count(*) - count(holiday_peak_flag) AS blank_flags FROM raw_demand GROUP BY region",
)
def raw_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged demand written as CSV and read back with every column as text."""
    root = scratch(spark, "s01")
    raw = bridge.raw_daily_demand(spark, sf_dir).select(*catalog.dataset("daily_demand").raw_columns)
    # Blanks around a region are part of the damage and have to survive the file.
    raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(catalog.path_of(root, "daily_demand", "raw"))
    return readers.read_raw(spark, "daily_demand", root).groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("units_ordered").alias("text_units"),
        F.count_if(F.col("holiday_peak_flag").isNull()).alias("blank_flags"),
    )


@query(
    "s02_typed_scan",
    "category skus:l mean_price:4 mean_cube:4",
    "SELECT category, count(*) AS skus, avg(selling_price_usd) AS mean_price, avg(cube_ft) AS mean_cube "
    "FROM skus GROUP BY category",
)
def typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "s02")
    sinks.write_processed(bridge.sku_master(spark, sf_dir), "sku_master", root, fmt="csv")
    return readers.read_processed(spark, "sku_master", root, fmt="csv").groupBy("category").agg(
        F.count(F.lit(1)).alias("skus"), F.avg("selling_price_usd").alias("mean_price"), F.avg("cube_ft").alias("mean_cube")
    )


@query(
    "s03_date_scan",
    "first_date:d last_date:d dates:l",
    "SELECT min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS dates FROM calendar",
)
def date_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "s03")
    contract = catalog.dataset("event_calendar").contract.fieldNames()
    sinks.write_processed(bridge.event_calendar(spark, sf_dir).select(*contract), "event_calendar", root, fmt="csv")
    return readers.read_processed(spark, "event_calendar", root, fmt="csv").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count_distinct("date").alias("dates")
    )


@query(
    "s04_checked_load",
    "name rows:l",
    """SELECT 'daily_demand' AS name, count(*) AS rows FROM demand UNION ALL SELECT 'event_calendar', count(*) FROM calendar
       UNION ALL SELECT 'sku_master', count(*) FROM skus UNION ALL SELECT 'warehouses', count(*) FROM sites""",
)
def checked_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables, each refused unless it has the columns its users need."""
    tables = {
        "daily_demand": bridge.daily_demand(spark, sf_dir),
        "event_calendar": bridge.event_calendar(spark, sf_dir),
        "sku_master": bridge.sku_master(spark, sf_dir),
        "warehouses": bridge.warehouses(spark, sf_dir),
    }
    return counts_by_name(
        {n: readers.require_columns(df, catalog.dataset(n).contract.names, n) for n, df in tables.items()}, "name"
    )


@query(
    "s05_optional_scan",
    "source rows:l",
    "SELECT 'present' AS source, count(*) AS rows FROM sites UNION ALL SELECT 'absent', 0",
)
def optional_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "s05")
    schema = catalog.dataset("warehouses").contract
    sinks.write_processed(bridge.warehouses(spark, sf_dir), "warehouses", root)
    present = readers.read_optional(spark, catalog.path_of(root, "warehouses", "processed"), schema)
    absent = readers.read_optional(spark, catalog.path_of(root, "sku_master", "processed"), schema)
    return counts_by_name({"present": present, "absent": absent}, "source")


@query(
    "s06_literal_dimension",
    "region category mean_units:4 target:2",
    """SELECT region, w.category, avg(total_units) AS mean_units, max(target) AS target
       FROM weekly w JOIN (VALUES ('PROMO', 0.98), ('ECONOMY', 0.95), ('MEDIUM', 0.95), ('LARGE', 0.92),
                                  ('SMALL', 0.92), ('STANDARD', 0.90)) t(category, target) ON w.category = t.category
       GROUP BY region, w.category""",
)
def literal_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension written in code, joined to the weekly grain."""
    targets = catalog.from_rows(spark, list(bridge.SERVICE_LEVELS.items()), "category:string target:double")
    weekly = Network.from_benchmark(spark, sf_dir).weekly()
    return weekly.join(F.broadcast(targets), "category").groupBy("region", "category").agg(
        F.avg("total_units").alias("mean_units"), F.max("target").alias("target")
    )


@query(
    "s07_catalog_views",
    "region rows:l units:2",
    "SELECT region, count(*) AS rows, sum(units_ordered) AS units FROM demand GROUP BY region",
)
def catalog_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog tables registered by name and read through SQL."""
    catalog.register_views({"daily_demand": bridge.daily_demand(spark, sf_dir)}, prefix="depot_")
    return spark.sql("SELECT region, count(*) AS rows, sum(units_ordered) AS units FROM depot_daily_demand GROUP BY region")


@query(
    "s08_processed_sink",
    "year:i rows:l units:2",
    "SELECT year, count(*) AS rows, sum(total_units) AS units FROM weekly GROUP BY year",
)
def processed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly demand written by year and read back; a year filter prunes folders."""
    path = join(scratch(spark, "s08"), "weekly")
    sinks.write_table(Network.from_benchmark(spark, sf_dir).weekly(), path, partition_by=["year"])
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.sum("total_units").alias("units"))


@query(
    "s09_interim_stage",
    "region rows:l missing_units:l",
    """SELECT region, count(*) AS rows, count(*) - count(units_ordered) AS missing_units
       FROM typed_demand GROUP BY region""",
)
def interim_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning interrupted by a stage on disk, later steps read the stage."""
    typed = C.coerce_numeric(C.parse_date_column(bridge.raw_daily_demand(spark, sf_dir)), ["units_ordered"])
    stage = sinks.write_interim(C.standardise_text(typed, "region"), "daily_demand", scratch(spark, "s09"))
    return stage.groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("units_ordered").isNull()).alias("missing_units")
    )


@query(
    "s09_resumed_stage",
    "region rows:l missing_units:l builds:i",
    """SELECT region, count(*) AS rows, count(*) - count(units_ordered) AS missing_units, 1 AS builds
       FROM typed_demand GROUP BY region""",
)
def resumed_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job asks for its stage twice, as before and after a lost driver: built once, read the second time."""
    builds = []

    def build() -> DataFrame:
        builds.append("typed")
        typed = C.coerce_numeric(C.parse_date_column(bridge.raw_daily_demand(spark, sf_dir)), ["units_ordered"])
        return C.standardise_text(typed, "region")

    tables = [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders", "customer", "nation", "region")]
    name = f"s09-{uuid4().hex}"
    Job(spark, name, tables).stage("typed", build)
    again = Job(spark, name, tables)
    stage = again.stage("typed", build)
    counted = store(
        stage.groupBy("region").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("units_ordered").isNull()).alias("missing_units")), "resumed"
    )
    again.close()
    return counted.withColumn("builds", F.lit(len(builds)))


def audited_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean the damaged demand, store it, and return the step log of that one pass."""
    audit = StepAudit("daily_demand")
    root = scratch(spark, "audit")
    clean = clean_daily_demand(bridge.raw_daily_demand(spark, sf_dir), audit, regions=bridge.REGIONS)
    sinks.write_processed(clean, "daily_demand", root)
    audit_occurrence(audit, readers.read_processed(spark, "daily_demand", root))
    log = audit.log(spark)
    sinks.append_log(log, "daily_demand", root)
    return log


_AUDIT = """(
       WITH n AS (SELECT (SELECT count(*) FROM raw_demand) AS raw, (SELECT count(*) FROM typed_demand) AS dated,
                         (SELECT count(*) FROM positive_demand) AS kept,
                         (SELECT count(*) FROM typed_demand WHERE NOT regexp_full_match(sku_id, 'SKU-[0-9]{6}')) AS bad_skus,
                         (SELECT count(*) FROM positive_demand WHERE price_usd < 0.01) AS bad_prices,
                         (SELECT count(*) FROM typed_demand WHERE region NOT IN ('Africa', 'America', 'Asia', 'Europe', 'Middle East')) AS bad_regions,
                         (SELECT greatest(count(*) FILTER (WHERE holiday_peak_flag NOT IN (0, 1)), count(*) FILTER (WHERE prime_event_flag NOT IN (0, 1)),
                                          count(*) FILTER (WHERE marketing_push_flag NOT IN (0, 1))) > 0.05 * count(*) FROM positive_demand) AS bad_flags,
                         (SELECT max(n) FROM (SELECT count(*) AS n FROM positive_demand GROUP BY sku_id)) AS most)
       SELECT step, b AS rows_before, a AS rows_after, b - a AS rows_affected,
              CASE WHEN step = 'assert_price' AND bad_prices > 0 THEN 'FAIL'
                   WHEN (step = 'standardise_sku' AND bad_skus > 0) OR (step = 'standardise_region' AND bad_regions > 0) OR (step = 'coerce_flags' AND bad_flags)
                        OR (step = 'audit_sku_occurrence' AND most = 1) THEN 'WARN'
                   WHEN step IN ('parse_date', 'remove_non_positive_units') AND b <> 0 AND a <> b THEN 'WARN' ELSE 'PASS' END AS status FROM (
         SELECT unnest(['load_raw', 'parse_date', 'drop_weekend_flag', 'drop_day', 'coerce_numeric',
                        'standardise_region', 'standardise_sku', 'remove_non_positive_units', 'cap_units',
                        'assert_price', 'coerce_flags', 'add_date_parts', 'audit_schema', 'audit_sku_occurrence']) AS step,
                unnest([0, raw, dated, dated, dated, dated, dated, dated, kept, kept, kept, kept, kept, kept]) AS b,
                unnest([raw, dated, dated, dated, dated, dated, dated, kept, kept, kept, kept, kept, kept, kept]) AS a,
                bad_skus, bad_prices, bad_regions, bad_flags, most FROM n))"""
_VERDICT = """count(*) AS steps_run, count(*) FILTER (WHERE status = 'PASS') AS pass_count, count(*) FILTER (WHERE status = 'WARN') AS warn_count,
              count(*) FILTER (WHERE status = 'FAIL') AS fail_count, sum(abs(rows_affected)) AS rows_affected,
              CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END AS overall_status"""


@query(
    "s10_step_audit",
    "step rows_before:l rows_after:l rows_affected:l status",
    f"SELECT step, rows_before, rows_after, rows_affected, status FROM {_AUDIT}",
)
def step_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited_log(spark, sf_dir)


@query(
    "s10_calendar_audit",
    "step rows_before:l rows_after:l status",
    """SELECT step, b AS rows_before, a AS rows_after, CASE WHEN step = 'collapse_dates' AND a <> b THEN 'WARN' WHEN step = 'validate_weather' AND beyond > 0 THEN 'WARN' ELSE 'PASS' END AS status
       FROM (SELECT unnest(['load_raw', 'parse_date', 'drop_weekend_flag', 'coerce_numeric', 'collapse_dates', 'coerce_flags', 'validate_weather', 'add_date_parts', 'audit_schema']) AS step,
                    unnest([0, raw, raw, raw, raw, days, days, days, days]) AS b, unnest([raw, raw, raw, raw, days, days, days, days, days]) AS a, beyond
             FROM (SELECT (SELECT count(*) FROM raw_events) AS raw, count(*) AS days,
                          count(*) FILTER (WHERE weather_disruption_index < 0 OR weather_disruption_index > 1) AS beyond FROM events_by_date))""",
)
def calendar_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar as delivered text through its whole chain: repeated dates and weather beyond its range are findings."""
    raw = bridge.raw_event_calendar(spark, sf_dir)
    text = raw.select(F.date_format("date", "yyyy-MM-dd").alias("date"), F.lit("01/01/1970").alias("weekend_flag"), *[F.col(c).cast("string") for c in raw.columns if c != "date"])
    audit, root = StepAudit("event_calendar"), scratch(spark, "calendar-audit")
    sinks.write_processed(clean_event_calendar(text, audit), "event_calendar", root)
    return audit.log(spark)


@query(
    "v21_run_summary",
    "dataset rows_raw:l rows_clean:l row_delta:l columns_raw:l columns_clean:l steps_run:l pass_count:l warn_count:l fail_count:l overall_status",
    f"""SELECT 'daily_demand' AS dataset, max(rows_after) AS rows_raw, min(rows_after) AS rows_clean, min(rows_after) - max(rows_after) AS row_delta,
              (SELECT count(*) FROM (DESCRIBE SELECT * FROM raw_demand)) AS columns_raw,
              (SELECT count(*) FROM (DESCRIBE SELECT * FROM demand)) AS columns_clean, {_VERDICT} FROM {_AUDIT}""",
)
def cleaning_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = catalog.dataset("daily_demand")
    return run_summary(audited_log(spark, sf_dir), len(entry.raw_columns), len(entry.contract))


@query("s10_log_totals", "dataset steps_run:l rows_affected:l overall_status",
       f"SELECT 'daily_demand' AS dataset, {_VERDICT} FROM {_AUDIT}")
def log_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise_log(audited_log(spark, sf_dir))


@query(
    "s11_report_views",
    "view rows:l",
    """SELECT 'daily_demand' AS view, count(*) AS rows FROM demand UNION ALL SELECT 'event_calendar', count(*) FROM calendar
       UNION ALL SELECT 'sku_master', count(*) FROM skus UNION ALL SELECT 'starting_inventory_snapshot', count(*) FROM stock
       UNION ALL SELECT 'warehouses', count(*) FROM sites UNION ALL SELECT 'warehouse_region_costs', count(*) FROM lanes
       UNION ALL SELECT 'forecast_12wk_forward', count(*) FROM forecast""",
)
def seven_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven business views; the counted column is one the statements rely on."""
    n = Network.from_benchmark(spark, sf_dir)
    views = reports.report_views(n.demand, n.calendar, n.skus, n.stock, n.warehouses, n.costed_lanes(), n.forecast())
    catalog.register_views(views, prefix="depot_")
    needed = {
        "daily_demand": "units_sold",
        "event_calendar": "is_holiday",
        "sku_master": "unit_price",
        "starting_inventory_snapshot": "inventory_units",
        "warehouses": "daily_storage_cost",
        "warehouse_region_costs": "co2_kg_per_unit",
        "forecast_12wk_forward": "forecast_units",
    }
    return spark.sql(
        " UNION ALL ".join(f"SELECT '{v}' AS view, count({c}) AS rows FROM depot_{v}" for v, c in needed.items())
    )


@query(
    "s12_mart_sinks",
    "mart rows:l",
    """SELECT 'demand_summary' AS mart, count(*) AS rows FROM weekly UNION ALL SELECT 'forecast_summary', count(*) FROM forecast
       UNION ALL SELECT 'inventory_summary', count(*) FROM util UNION ALL SELECT 'cost_summary', count(DISTINCT scenario) + 1 FROM plan
       UNION ALL SELECT 'carbon_summary', count(*) + count(DISTINCT scenario) FROM plan""",
)
def mart_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five marts from one stored weekly table, written and counted from the files."""
    root = scratch(spark, "s12")
    paths = sinks.write_marts(Network.from_benchmark(spark, sf_dir).marts(), root)
    return counts_by_name({name: spark.read.parquet(path) for name, path in paths.items()}, "mart")


@query(
    "s12_demand_mart",
    "year_week region category total_units:2 holiday_peak_flag:i prime_event_flag:i marketing_push_flag:i demand_yoy_growth_pct:4",
    """SELECT w.*, (w.total_units - p.total_units) * 100 / nullif(p.total_units, 0) AS demand_yoy_growth_pct
       FROM weekly w LEFT JOIN weekly p ON w.region = p.region AND w.category = p.category
         AND w.week_number = p.week_number
         AND CAST(w.year_week[1:4] AS INTEGER) = CAST(p.year_week[1:4] AS INTEGER) + 1""",
)
def demand_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotline.operators.marts import demand_summary

    return demand_summary(Network.from_benchmark(spark, sf_dir).stored_weekly)



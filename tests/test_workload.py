"""Workload queries against their SQL checks, the entry point, marts and the stream.

By default a cross-section runs; ``DEPOTLINE_ALL=1`` runs every query.
"""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from depotline.plans.network import Network
from depotline.plans.run import export_marts
from depotline.sources import sinks
from depotline.streaming.weekly import write_weekly

QUERIES, CHECKS = entry_module.queries(), entry_module.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SAMPLE = [
    "s01_raw_text_scan", "s10_step_audit", "p13_value_remap", "x16_normal_tail", "f02_cap_outliers", "v00_clean_demand", "v09_referential_integrity",
    "v19_table_profile", "a02_weekly_grain", "a24_placement_rollup", "j12_enriched_demand", "w02_group_rolling",
    "w06_running_share_many_keys", "d09_lane_allocation", "d16_safety_stock", "d24_abc_revenue", "d26_weekly_demand_ranking", "m06_fold_baseline",
    "m12_mann_whitney", "r03_top_k",
]
KEYS = sorted(QUERIES) if os.environ.get("DEPOTLINE_ALL") else SAMPLE


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """None for missing, dates without a time part."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value.date() if isinstance(value, dt.datetime) else value


def normalised(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cleaned = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cleaned, key=repr)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_check(spark, sf_dir, duck, key):
    df = QUERIES[key](spark, sf_dir)
    got = normalised([tuple(r) for r in df.collect()], df.columns)
    if key not in CHECKS:
        assert df.columns
        return
    result = duck.sql(CHECKS[key])
    assert got == normalised(result.fetchall(), result.columns)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).limit(5).count() == 5


def test_marts_from_catalog(spark, sf_dir, tmp_path):
    """Cleaned tables on disk in, five exports out."""
    source, root = Network.from_benchmark(spark, sf_dir), str(tmp_path)
    tables = {
        "daily_demand": source.demand, "event_calendar": source.calendar, "sku_master": source.skus, "warehouses": source.warehouses,
        "warehouse_region_costs": source.lanes.withColumn("carbon_kg_per_unit", F.lit(0.0)), "starting_inventory": source.stock,
    }
    for name, df in tables.items():
        sinks.write_processed(df, name, root)
    paths = export_marts(spark, root)
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    assert counts["cost_summary"] == 4 and counts["carbon_summary"] == 453 and counts["forecast_summary"] == 360
    assert counts["inventory_summary"] == 6


def test_stream_agrees_with_batch(spark, tmp_path):
    flags = "holiday_peak_flag int, prime_event_flag int, marketing_push_flag int"
    start = dt.date(2024, 1, 1)
    data = [(start + dt.timedelta(days=d), "North", "Toys", float(d), d % 2, 0, 0) for d in range(60)]
    demand = spark.createDataFrame(data, f"date date, region string, category string, units_ordered double, {flags}")
    demand.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(demand.schema).parquet(str(tmp_path / "in"))
    write_weekly(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    got = {r.week_start: r.total_units for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    expected = {r.w: r.u for r in demand.groupBy(F.date_sub("date", F.weekday("date")).alias("w")).agg(F.sum("units_ordered").alias("u")).collect()}
    assert len(got) >= 5 and all(expected[w] == u for w, u in got.items())

"""Cleaning steps, validators, audit and the cleaning pipelines on small frames."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from depotline import settings as S
from depotline.operators import cleaning as C, prefix, quality as Q
from depotline.plans import cleaning as P
from depotline.sources import catalog, readers, sinks
from depotline.sources.audit import StepAudit, run_summary, summarise_log


def test_remove_negative_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (2.0,), (None,)], "u double")
    assert rows(C.remove_negative(df, "u")) == [(2.0,), (None,)]
    assert rows(C.remove_negative(df, "u", allow_zero=True)) == [(0.0,), (2.0,), (None,)]


def test_percentile_is_linear_and_cap_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "u double")
    assert prefix.exact_percentiles(df, "u", {"p": 0.999}).first()[0] == pytest.approx(9.984)
    assert sorted(r[0] for r in C.cap_outliers(df, "u").collect() if r[0] is not None) == pytest.approx([1.0, 2.0, 9.984])
    assert C.cap_outliers(df, "u").where("u is null").count() == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e6, 1e6).map(lambda x: round(x, 3)), min_size=1, max_size=40), share=st.sampled_from([0.1, 0.5, 0.999]))
def test_percentile_matches_builtin(spark, values, share):
    df = spark.createDataFrame([(v,) for v in values], "u double")
    expected = df.agg(F.percentile("u", share)).first()[0]
    assert prefix.exact_percentiles(df, "u", {"p": share}).first()[0] == pytest.approx(expected, abs=1e-6)


def test_running_totals_against_brute_force(spark):
    values = [(float(v), n) for v, n in [(-5, 1), (-0.25, 2), (0, 3), (0.125, 4), (1, 5), (1.0001, 6), (700, 7), (1e9, 8)]]
    df = spark.createDataFrame(values, "v double, n int")
    up = rows(prefix.running_totals(df, "v", {"t": "n"}).select("v", "t"), "v")
    down = rows(prefix.running_totals(df, "v", {"t": "n"}, descending=True).select("v", "t"), "v")
    total = 0
    for (value, n), (got, running) in zip(values, up):
        total += n
        assert (got, running) == (value, total)
    assert [t for _, t in down] == [36, 35, 33, 30, 26, 21, 15, 8]


def test_flags(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (-1,), (None,)], "f int")
    assert [r[0] for r in rows(C.coerce_flags(df, ["f", "absent"]))] == [0, 1, 0, 0, 0]


def test_collapse_dates_is_idempotent(spark):
    day = dt.date(2024, 7, 1)
    df = spark.createDataFrame(
        [(day, 0, 1, 0, 1.0), (day, 1, 0, 0, 2.0), (None, 1, 1, 1, 9.0)],
        "date date, holiday_peak_flag int, prime_event_flag int, marketing_push_flag int, weather_disruption_index double",
    )
    once = C.collapse_dates(df)
    assert rows(once) == [(day, 1, 1, 0, 1.5)]
    assert rows(C.collapse_dates(once)) == rows(once)


def test_membership_of_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows(C.members_only(df, "v", ["a"])) == [("a",)]
    assert rows(C.members_only(df, "v", ["a"], negate=True)) == [("b",), (None,)]


def test_rules_in_one_pass(spark):
    df = spark.createDataFrame(
        [("north", "SKU-000001", 1, 5.0), ("Atlantis", "SKU-1", 3, -1.0), (None, None, None, None)],
        "region string, sku_id string, flag int, price double",
    )
    report = Q.check(df, [Q.flag_rule("flag"), Q.region_rule("region", S.DEMAND_REGIONS), Q.sku_rule(), Q.positive_rule("price")])
    got = {r["rule"]: (r["bad_rows"], r["status"], r["high_sample"]) for r in report.collect()}
    assert got == {
        "binary:flag": (2, "WARN", "null"),
        "region:region": (2, "WARN", "Atlantis"),
        "sku_format:sku_id": (2, "WARN", "SKU-1"),
        "positive:price": (1, "FAIL", "-1.0"),
    }
    with pytest.raises(Q.QualityError):
        Q.enforce(report)


def test_in_plan_assert(spark):
    good = spark.createDataFrame([(1.0,), (None,)], "p double")
    assert Q.assert_positive(good, "p").count() == 2
    bad = spark.createDataFrame([(0.0,)], "p double")
    with pytest.raises(PySparkException, match="below"):
        Q.assert_positive(bad, "p").collect()


def test_known_ids(spark):
    sites = C.canonical_warehouses(spark)
    stock = spark.createDataFrame([("WH-N",), (" WH-SOUTH ",)], "warehouse_id string")
    with pytest.raises(Q.QualityError):
        Q.assert_known_ids(stock, "warehouse_id", sites)
    mapped = C.map_values(stock, "warehouse_id", S.SHORT_WAREHOUSE_IDS)
    assert Q.assert_known_ids(mapped, "warehouse_id", sites).count() == 2


def test_non_canonical_rows(spark):
    raw = spark.createDataFrame(
        [("WH-NORTH", "North", 120000, 1800.0), ("WH-NORTH", "North", 1, 1800.0)] * 3,
        "warehouse_id string, region string, capacity_units int, fixed_daily_cost_usd double",
    )
    assert rows(C.non_canonical_rows(raw, C.canonical_warehouses(spark))) == [("WH-NORTH", "North", 1, 1800.0)]


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "x")], "warehouse_id int, extra string")
    status = {r["column_name"]: r["status"] for r in Q.schema_report(df, catalog.dataset("warehouses").contract).collect()}
    assert status == {
        "warehouse_id": "TYPE", "extra": "EXTRA", "region": "MISSING", "capacity_units": "MISSING", "fixed_daily_cost_usd": "MISSING",
    }
    assert not Q.schema_matches(df, catalog.dataset("warehouses").contract)


def test_referential_integrity(spark):
    demand = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "sku_id string")
    master = spark.createDataFrame([("a",), ("c",)], "sku_id string")
    assert rows(Q.referential_integrity(demand, master)) == [(2, 2, 1, 1, "b", "c")]


def test_lane_coverage(spark):
    lanes = spark.createDataFrame([("W1", "North"), ("W1", "North"), ("W9", "North")], "warehouse_id string, demand_region string")
    expected = spark.createDataFrame([("W1", "North"), ("W1", "South")], "warehouse_id string, demand_region string")
    assert rows(Q.lane_coverage(lanes, expected, 2)) == [(2, 2, 1, 1, False)]
    assert rows(Q.missing_lanes(lanes, expected)) == [("W1", "South")]


def test_profile_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "n int, s string")
    got = {r["column_name"]: (r["nulls"], r["distinct_values"]) for r in Q.profile(df).collect()}
    assert got == {"n": (0, 2), "s": (2, 2)}
    assert {r["column_name"]: r["nulls"] for r in Q.profile(df, approximate=True).collect()} == {"n": 0, "s": 2}


def test_value_counts_shows_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    assert [tuple(r) for r in Q.value_counts(df, "v").collect()] == [("a", 2, 66.7), (None, 1, 33.3)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(Q.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert sorted(rows(Q.count_over_key(df, ["k"]))) == [(1, 2), (1, 2), (2, 1)]
    with pytest.raises(Q.QualityError):
        Q.required_values(df.where("k > 5"), "k")


def test_alias_resolution(spark):
    df = spark.createDataFrame([(1,)], "demand_units int")
    assert readers.resolve_alias(df, "units_sold", ["units", "demand_units"]).columns == ["units_sold"]
    with pytest.raises(ValueError):
        readers.resolve_alias(df, "units_sold", ["units"])


def test_optional_scan(spark, tmp_path):
    schema = catalog.dataset("warehouses").contract
    assert readers.read_optional(spark, str(tmp_path / "none"), schema).count() == 0
    assert readers.read_optional(spark, str(tmp_path / "none.csv"), schema, fmt="csv").count() == 0


_RAW_DEMAND = [
    ("2024-07-01", "Monday", "01/01/1970", " SKU-000001", " north ", "5", "10.0", "1", "0", "2", "0.5"),
    ("2024-07-02", "Tuesday", "01/01/1970", "SKU-000002", "SOUTH", "0", "10.0", "0", "0", "0", "0.5"),
    ("2024-07-06", "Saturday", "01/01/1970", "SKU-000003", "east", "n/a", "10.0", None, "1", "0", ""),
    ("bad", "Friday", "01/01/1970", "SKU-000004", "West", "7", "10.0", "0", "0", "0", "0.1"),
]


def raw_demand(spark):
    entry = catalog.dataset("daily_demand")
    order = ["date", "day", "weekend_flag", "sku_id", "region", "units_ordered", "price_usd", *S.EVENT_FLAGS, "weather_disruption_index"]
    return spark.createDataFrame(_RAW_DEMAND, ", ".join(f"{c} string" for c in order)).select(*entry.raw_columns)


def test_clean_demand_and_audit(spark, tmp_path):
    audit = StepAudit("daily_demand")
    clean = P.clean_daily_demand(raw_demand(spark), audit)
    assert Q.schema_matches(clean, catalog.dataset("daily_demand").contract)
    sinks.write_processed(clean, "daily_demand", str(tmp_path))
    got = rows(readers.read_processed(spark, "daily_demand", str(tmp_path)).select(
        "sku_id", "region", "units_ordered", "holiday_peak_flag", "marketing_push_flag", "is_weekend", "year_week"), "sku_id")
    assert got == [("SKU-000001", "North", 5.0, 1, 0, 0, "2024-W27"), ("SKU-000003", "East", None, 0, 0, 1, "2024-W27")]
    log = audit.log(spark)
    steps = {r["step"]: (r["rows_before"], r["rows_after"]) for r in log.collect()}
    assert steps["load_raw"] == (0, 4) and steps["parse_date"] == (4, 3) and steps["remove_non_positive_units"] == (3, 2)
    summary = run_summary(log, 11, 16).first()
    assert (summary.rows_raw, summary.rows_clean, summary.overall_status) == (4, 2, "WARN")
    statuses = {r["step"]: r["status"] for r in log.collect()}
    # One flag of two rows is a 2, more than the share tolerated.
    assert {k for k, v in statuses.items() if v == "WARN"} == {"parse_date", "remove_non_positive_units", "coerce_flags"}
    assert summarise_log(log).first().rows_affected == 6


def test_clean_calendar_warns_about_repeats(spark, tmp_path):
    raw = spark.createDataFrame(
        [("2024-07-01", "x", "1", "0", "0", "1.0"), ("2024-07-01", "x", None, "1", "0", "0.0")],
        "date string, weekend_flag string, holiday_peak_flag string, prime_event_flag string, marketing_push_flag string, weather_disruption_index string",
    )
    audit = StepAudit("event_calendar")
    clean = P.clean_event_calendar(raw, audit)
    assert clean.count() == 1
    assert clean.select("holiday_peak_flag", "prime_event_flag", "weather_disruption_index").first() == (1, 1, 0.5)


def test_all_datasets_from_files(spark, tmp_path):
    """Raw CSV files in, cleaned tables and logs out, for every dataset."""
    root = str(tmp_path)

    def raw(name, values):
        entry = catalog.dataset(name)
        df = spark.createDataFrame(values, entry.raw_schema)
        df.write.option("header", True).csv(catalog.path_of(root, name, "raw"))

    raw_demand(spark).write.option("header", True).csv(catalog.path_of(root, "daily_demand", "raw"))
    raw("event_calendar", [("2024-07-01", "x", "1", "0", "0", "1.0")])
    raw("sku_master", [(" SKU-000001", "toys", "6.0", "10.0", "0.5", "0.95"), ("SKU-000003", "Pet", "3.0", "4.0", "1", "0.9")])
    raw("warehouses", [("WH-NORTH", "North", "1", "1")] * 3)
    raw("warehouse_region_costs", [("wh-north", "north", "1.5", "1"), ("WH-NORTH", "South", "7.0", "5")])
    raw("starting_inventory", [("WH-N", "SKU-000001", "100"), ("WH-S", "SKU-000003", "10")])
    from depotline.plans.run import CLEANING_ORDER

    for name in CLEANING_ORDER:
        log = P.clean_dataset(spark, root, name)
        assert log.where("status = 'FAIL'").count() == 0
        assert Q.schema_matches(readers.read_processed(spark, name, root), catalog.dataset(name).contract)
    skus = readers.read_processed(spark, "sku_master", root)
    assert rows(skus.select("sku_id", "category", "margin_pct"), "sku_id") == [("SKU-000001", "TOYS", 0.4), ("SKU-000003", "PET", 0.25)]
    stock = readers.read_processed(spark, "starting_inventory", root)
    assert rows(stock.select("canonical_warehouse_id", "inventory_value_usd"), "sku_id") == [("WH-NORTH", 600.0), ("WH-SOUTH", 30.0)]
    assert readers.read_processed(spark, "warehouses", root).count() == 5
    lanes = readers.read_processed(spark, "warehouse_region_costs", root)
    assert rows(lanes.select("demand_region", "lane_efficiency_score"), "demand_region") == [("North", 1.0), ("South", 0.0)]


def test_audit_judges_regions_flags_weather_sites_and_schema(spark, tmp_path):
    """Each rule shows in the log of its chain, with the rows that break it."""
    raw = raw_demand(spark).withColumn("region", F.when(F.col("sku_id") == "SKU-000003", "Atlantis").otherwise(F.col("region")))
    audit = StepAudit("daily_demand")
    sinks.write_processed(P.clean_daily_demand(raw, audit), "daily_demand", str(tmp_path))
    P.audit_occurrence(audit, readers.read_processed(spark, "daily_demand", str(tmp_path)))
    log = {r.step: r for r in audit.log(spark).collect()}
    assert log["standardise_region"].status == "WARN" and "region:region: 1 of 3 rows" in log["standardise_region"].issue_found
    assert log["coerce_flags"].status == "WARN" and "binary:marketing_push_flag: 1 of 2 rows" in log["coerce_flags"].issue_found
    assert log["audit_sku_occurrence"].status == "WARN" and log["audit_sku_occurrence"].rows_after == 2
    assert log["audit_schema"].status == "PASS"

    days = spark.createDataFrame([("2024-07-01", "x", "1", "0", "0", "1.5"), ("2024-07-02", "x", "0", "0", "0", "0.5")],
                                 "date string, weekend_flag string, holiday_peak_flag string, prime_event_flag string, marketing_push_flag string, weather_disruption_index string")
    audit = StepAudit("event_calendar")
    P.clean_event_calendar(days, audit).collect()
    log = {r.step: r for r in audit.log(spark).collect()}
    assert log["validate_weather"].status == "WARN" and log["coerce_flags"].status == "PASS"

    skus = spark.createDataFrame([("SKU-000001", 2.0)], "sku_id string, unit_cost_usd double")
    stock = spark.createDataFrame([("WH-N", "SKU-000001", "100"), ("WH-X", "SKU-000001", "10")], "warehouse_id string, sku_id string, starting_inventory_units string")
    audit = StepAudit("starting_inventory")
    P.clean_inventory(stock, skus, audit).collect()
    log = {r.step: r for r in audit.log(spark).collect()}
    assert log["map_warehouse"].status == "FAIL" and log["audit_schema"].status == "PASS"


def test_schema_audit_names_what_is_missing(spark):
    audit = StepAudit("warehouses")
    df = audit.step(spark.createDataFrame([("WH", "North", "5")], "warehouse_id string, region string, capacity_units string"), "load_raw")
    kept = P._finish(df, audit, "warehouses")
    kept.collect()
    entry = audit.log(spark).where("step = 'audit_schema'").first()
    assert entry.status == "FAIL" and "MISSING: fixed_daily_cost_usd" in entry.issue_found and "TYPE: capacity_units" in entry.issue_found

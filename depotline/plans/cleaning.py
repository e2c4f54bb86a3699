"""Raw table to clean table, per dataset, with an optional step audit.

Each pipeline is one lazy chain. Given a ``StepAudit`` it counts rows at every
step inside the same job; without one it is just the transformations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline import settings as S
from depotline.operators import cleaning as C, quality as Q
from depotline.operators.lanes import add_lane_efficiency
from depotline.operators.valuation import add_financials, add_inventory_value
from depotline.sources import catalog, readers, sinks
from depotline.sources.audit import StepAudit


def _run(df: DataFrame, audit: StepAudit | None, steps: list[tuple]) -> DataFrame:
    """Apply ``(name, change, notes)`` steps in order."""
    for name, change, notes in steps:
        if audit is None:
            df = change(df) if change else df
        else:
            df = audit.step(df, name, change, **notes)
    return df


def _note(
    issue: str = "", action: str = "", assumption: str = "", on_loss: str = "PASS", rules: list[Q.Rule] | None = None, before: bool = False
) -> dict:
    return {"issue": issue, "action": action, "assumption": assumption, "on_loss": on_loss, "rules": rules, "before": before}


def _finish(df: DataFrame, audit: StepAudit | None, name: str) -> DataFrame:
    """The columns of the contract; what is missing or of another type is a finding of the audit."""
    contract = catalog.dataset(name).contract
    if audit is not None:
        report = {r.column_name: r.status for r in Q.schema_report(df, contract).collect()}  # a row per column
        found = {status: sorted(c for c, s in report.items() if s == status) for status in ("MISSING", "TYPE")}
        status = "FAIL" if found["MISSING"] else "WARN" if found["TYPE"] else "PASS"
        text = "; ".join(f"{kind}: {', '.join(columns)}" for kind, columns in found.items() if columns)
        audit.judge("audit_schema", None, status, text or "none", "columns checked against the contract", "extra columns are dropped")
    return df.select(*[c for c in contract.fieldNames() if audit is None or c in df.columns])


def audit_occurrence(audit: StepAudit, clean: DataFrame, key: str = "sku_id") -> None:
    """Whether keys repeat in the stored clean table. If none does, a key has no history of its own.

    Keys are counted per task before they are dealt out, and only this column is read.
    """
    seen = Q.occurrence_summary(clean, key).first()
    once = seen.max_occurrences == 1
    issue = f"all {seen.distinct_keys} keys appear once" if once else f"keys appear up to {seen.max_occurrences or 0} times, {seen.seen_once} of {seen.distinct_keys} once"
    audit.judge(f"audit_{key.removesuffix('_id')}_occurrence", int(seen.rows or 0), "WARN" if once else "PASS", issue, "documented", "the forecast grain is week, region and category")


def clean_daily_demand(
    raw: DataFrame, audit: StepAudit | None = None, percentile: float = S.OUTLIER_PERCENTILE, regions: list[str] | None = None
) -> DataFrame:
    """Typed, standardised demand with calendar columns; bad dates and non-positive units go.

    The cap needs all units before it can be applied, so ``cap_outliers`` stores what the steps before it leave; the raw
    feed and the joins behind it are read in that pass alone.
    """
    measures = ["units_ordered", "price_usd", "weather_disruption_index"]
    steps = [
        ("load_raw", None, _note("raw text load")),
        ("parse_date", C.parse_date_column, _note("dates are text", "parsed; unreadable rows dropped", "ISO dates", on_loss="WARN")),
        ("drop_weekend_flag", lambda d: C.drop_if_present(d, "weekend_flag"),
         _note("weekend_flag holds epoch dates", "dropped", "is_weekend is derived from the date")),
        ("drop_day", lambda d: C.drop_if_present(d, "day"), _note("day repeats the date", "dropped")),
        ("coerce_numeric", lambda d: C.coerce_numeric(d, measures, S.EVENT_FLAGS),
         _note("numbers are text", "parsed; unreadable becomes null, missing flags 0")),
        ("standardise_region", lambda d: C.standardise_text(d, "region", "title"),
         _note("region case and blanks differ", "trimmed, title case; unknown regions stay", rules=[Q.region_rule("region", regions or S.DEMAND_REGIONS)])),
        ("standardise_sku", lambda d: C.standardise_text(d, "sku_id", "strip"),
         _note("blanks around ids", "trimmed", rules=[Q.sku_rule()])),
        ("remove_non_positive_units", lambda d: C.remove_negative(d, "units_ordered"),
         _note("units at or below zero", "rows dropped", "entry errors, not returns", on_loss="WARN")),
        ("cap_units", lambda d: C.cap_outliers(d, "units_ordered", percentile),
         _note("extreme orders inflate buffers", f"capped at the {percentile}th percentile")),
        ("assert_price", None, _note("price must be positive", "bad rows counted, the run goes on", rules=[Q.positive_rule("price_usd")])),
        ("coerce_flags", lambda d: C.coerce_flags(d, S.EVENT_FLAGS), _note("flags outside 0/1", "set to 0", rules=[Q.flag_rule(f) for f in S.EVENT_FLAGS], before=True)),
        ("add_date_parts", C.add_date_parts, _note("no calendar columns", "derived, ISO weeks")),
    ]
    return _finish(_run(raw, audit, steps), audit, "daily_demand")


def clean_event_calendar(raw: DataFrame, audit: StepAudit | None = None) -> DataFrame:
    """One row per date. Numbers are parsed before dates collapse, calendar parts added after."""
    weather = ["weather_disruption_index"]
    steps = [
        ("load_raw", None, _note("raw text load")),
        ("parse_date", C.parse_date_column, _note("dates are text", "parsed; unreadable rows dropped", "ISO dates", on_loss="WARN")),
        ("drop_weekend_flag", lambda d: C.drop_if_present(d, "weekend_flag"),
         _note("weekend_flag holds epoch dates", "dropped", "is_weekend is derived from the date")),
        ("coerce_numeric", lambda d: C.coerce_numeric(d, weather, S.EVENT_FLAGS),
         _note("numbers are text", "parsed; unreadable becomes null, missing flags 0")),
        ("collapse_dates", C.collapse_dates,
         _note("dates repeat", "one row per date: any flag, mean weather", "a date is an event if any row says so", on_loss="WARN")),
        ("coerce_flags", lambda d: C.coerce_flags(d, S.EVENT_FLAGS), _note("flags outside 0/1", "set to 0", rules=[Q.flag_rule(f) for f in S.EVENT_FLAGS], before=True)),
        ("validate_weather", None, _note("weather index beyond 0 to 1", "counted, values stay", "normalised at the source", rules=[Q.range_rule("weather_disruption_index", 0.0, 1.0)])),
        ("add_date_parts", C.add_date_parts, _note("no calendar columns", "derived, ISO weeks")),
    ]
    return _finish(_run(raw, audit, steps), audit, "event_calendar")


def clean_sku_master(raw: DataFrame, audit: StepAudit | None = None) -> DataFrame:
    numbers = ["unit_cost_usd", "selling_price_usd", "cube_ft", "target_service_level"]
    steps = [
        ("load_raw", None, _note("raw text load")),
        ("standardise_sku", lambda d: C.standardise_text(d, "sku_id", "strip"), _note("blanks around ids", "trimmed")),
        ("standardise_category", lambda d: C.standardise_text(d, "category", "upper"), _note("case differs", "upper case")),
        ("coerce_numeric", lambda d: C.coerce_numeric(d, numbers), _note("numbers are text", "parsed")),
        ("assert_positive", _assert_all(numbers[:3]), _note("cost, price and volume must be positive", "checked in the plan")),
        ("add_financials", add_financials, _note("no cost columns", "margin, penalty, holding cost derived")),
        ("add_volume", lambda d: d.withColumn("volume_m3", F.col("cube_ft") * S.M3_PER_CUBIC_FOOT),
         _note("no metric volume", "derived from cubic feet")),
    ]
    return _finish(_run(raw, audit, steps), audit, "sku_master")


def _assert_all(columns: list[str]) -> Callable[[DataFrame], DataFrame]:
    def change(df: DataFrame) -> DataFrame:
        for column in columns:
            df = Q.assert_positive(df, column)
        return df

    return change


def clean_warehouses(raw: DataFrame, audit: StepAudit | None = None, network: list[tuple] | None = None) -> DataFrame:
    """The raw feed repeats the same sites many times; the network definition replaces it.

    The result does not read the feed, so its rows are counted separately.
    """
    if audit is not None:
        audit.record("load_raw", raw.count(), "raw text load")
    steps = [
        ("canonical_network", lambda d: C.canonical_warehouses(d.sparkSession, network),
         _note("sites repeat", "replaced by the network definition", "the definition is the truth")),
    ]
    return _run(raw, audit, steps)


def clean_lanes(raw: DataFrame, audit: StepAudit | None = None) -> DataFrame:
    """Typed lanes with distance and efficiency (1 = best); carbon is filled once SKU volumes are known."""
    steps = [
        ("load_raw", None, _note("raw text load")),
        ("standardise_region", lambda d: C.standardise_text(d, "demand_region", "title"), _note("case differs", "title case")),
        ("standardise_warehouse", lambda d: C.standardise_text(d, "warehouse_id", "upper"), _note("case differs", "upper case")),
        ("coerce_numeric", lambda d: C.coerce_numeric(d, ["ship_cost_per_unit", "lead_time_days"]), _note("numbers are text", "parsed")),
        ("one_row_per_lane", lambda d: d.groupBy("warehouse_id", "demand_region").agg(
            F.min(F.struct("ship_cost_per_unit", "lead_time_days")).alias("lane"),
        ).select(
            "warehouse_id", "demand_region", "lane.ship_cost_per_unit", F.col("lane.lead_time_days").cast("int").alias("lead_time_days"),
        ), _note("lanes repeat", "the cheapest row of each lane, as delivered", on_loss="WARN")),
        ("add_distance", lambda d: d.withColumns({
            "distance_km_proxy": F.col("lead_time_days") * S.KM_PER_LEAD_DAY, "carbon_kg_per_unit": F.lit(0.0),
        }), _note("no distance", "500 km per lead day")),
        ("add_efficiency", lambda d: add_lane_efficiency(d, ["ship_cost_per_unit", "lead_time_days"], invert=True),
         _note("no lane score", "mean of scaled cost and lead time, 1 = best")),
    ]
    return _finish(_run(raw, audit, steps), audit, "warehouse_region_costs")


def clean_inventory(
    raw: DataFrame, skus: DataFrame, audit: StepAudit | None = None, short_ids: dict[str, str] | None = None, sites: list[str] | None = None
) -> DataFrame:
    """Typed stock with canonical warehouse ids, value and daily holding cost; ``sites`` are the ids of the network."""
    known = sites or [row[0] for row in S.NETWORK]
    unknown = Q.Rule("canonical:warehouse_id", ~F.coalesce(F.col("canonical_warehouse_id").isin(known), F.lit(False)), F.col("canonical_warehouse_id"), severity="FAIL")
    steps = [
        ("load_raw", None, _note("raw text load")),
        ("coerce_numeric", lambda d: C.coerce_numeric(d, ["starting_inventory_units"]), _note("numbers are text", "parsed")),
        ("map_warehouse", lambda d: C.map_values(d, "warehouse_id", short_ids or S.SHORT_WAREHOUSE_IDS, "canonical_warehouse_id"),
         _note("short warehouse ids", "mapped to network ids", rules=[unknown])),
        ("add_value", lambda d: add_inventory_value(d.join(skus.select("sku_id", "unit_cost_usd"), "sku_id", "left")),
         _note("no values", "units x unit cost, daily holding cost")),
    ]
    return _finish(_run(raw, audit, steps), audit, "starting_inventory")


def clean_dataset(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Read raw, clean, write processed, append the step log; returns the log."""
    raw = readers.read_raw(spark, name, root)
    audit = StepAudit(name)
    if name == "starting_inventory":
        clean = clean_inventory(raw, readers.read_processed(spark, "sku_master", root, fmt), audit)
    else:
        cleaners = {
            "daily_demand": clean_daily_demand,
            "event_calendar": clean_event_calendar,
            "sku_master": clean_sku_master,
            "warehouses": clean_warehouses,
            "warehouse_region_costs": clean_lanes,
        }
        clean = cleaners[name](raw, audit)
    sinks.write_processed(clean, name, root, fmt)
    if name == "daily_demand":
        audit_occurrence(audit, readers.read_processed(spark, name, root, fmt))
    log = audit.log(spark)
    sinks.append_log(log, name, root)
    return log

"""Stock, lanes, segmentation and planning: formulas against hand-computed numbers."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from depotline.operators import inventory as I, lanes as L, planning as P, segments as G, valuation as V

# Published lane costs and lead times of the five-site network.
_LANES = [
    ("WH-CENTRAL", "East", 3.5, 2), ("WH-CENTRAL", "North", 3.0, 2), ("WH-CENTRAL", "South", 3.0, 2), ("WH-CENTRAL", "West", 3.5, 2),
    ("WH-EAST", "East", 1.5, 1), ("WH-EAST", "North", 4.0, 3), ("WH-EAST", "South", 4.5, 3), ("WH-EAST", "West", 8.0, 6),
    ("WH-NORTH", "East", 4.0, 3), ("WH-NORTH", "North", 1.5, 1), ("WH-NORTH", "South", 7.0, 5), ("WH-NORTH", "West", 5.0, 4),
    ("WH-SOUTH", "East", 4.5, 3), ("WH-SOUTH", "North", 7.0, 5), ("WH-SOUTH", "South", 1.5, 1), ("WH-SOUTH", "West", 4.0, 3),
    ("WH-WEST", "East", 8.0, 6), ("WH-WEST", "North", 5.0, 4), ("WH-WEST", "South", 4.0, 3), ("WH-WEST", "West", 1.5, 1),
]


@pytest.fixture(scope="module")
def lanes(spark):
    return spark.createDataFrame(_LANES, "warehouse_id string, demand_region string, ship_cost_per_unit double, lead_time_days int")


def test_financials_floor_margin(spark):
    df = spark.createDataFrame([(6.0, 10.0), (50.0, 10.0), (1.0, 0.0)], "unit_cost_usd double, selling_price_usd double")
    got = rows(V.add_financials(df).select("gross_margin_usd", "margin_pct", "stockout_penalty_usd", "holding_cost_daily_usd"))
    assert got[0] == (4.0, 0.4, 20.0, pytest.approx(6 * 0.25 / 365))
    assert got[1][1] == -1.0 and got[2][1] is None


def test_carbon_formula_and_missing_input(spark):
    df = spark.createDataFrame([(2, 1.5)], "lead_time_days int, cube_ft double")
    volume = 1.5 * 0.028317
    assert V.add_carbon_features(df).first()["carbon_kg_per_unit"] == pytest.approx(1000 * volume * 0.2 * 0.062)
    assert V.add_carbon_features(df.drop("cube_ft")).first()["carbon_kg_per_unit"] is None


def test_published_lane_efficiency(lanes):
    scored = L.add_lane_efficiency(lanes, ["ship_cost_per_unit", "lead_time_days"], invert=True)
    got = {(r.warehouse_id, r.demand_region): r.lane_efficiency_score for r in scored.collect()}
    for lane, score in {("WH-CENTRAL", "East"): 0.7462, ("WH-EAST", "East"): 1.0, ("WH-EAST", "West"): 0.0,
                        ("WH-NORTH", "South"): 0.1769, ("WH-NORTH", "West"): 0.4308, ("WH-EAST", "South"): 0.5692}.items():
        assert got[lane] == pytest.approx(score, abs=5e-5)
    summary = L.efficiency_summary(scored).first()
    assert (summary.best_warehouse, summary.best_score) == ("WH-CENTRAL", 0.7654)
    assert (summary.worst_warehouse, summary.worst_score) == ("WH-WEST", 0.5096)
    assert (summary.perfect_lanes, summary.zero_lanes) == (4, 2)


def test_efficiency_of_constant_and_absent_metrics(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "ship_cost_per_unit double")
    assert [r.lane_efficiency_score for r in L.add_lane_efficiency(df).collect()] == [0.0, 0.0]
    assert L.add_lane_efficiency(df.select(F.lit(1).alias("x"))).first().lane_efficiency_score is None


def test_lane_extremes_break_ties_by_key(lanes):
    found = {r.lane: (r.warehouse_id, r.demand_region, r.value)
             for r in L.lane_extremes(lanes.withColumn("carbon_kg_per_unit", F.col("lead_time_days") * 0.1)).collect()}
    assert found["cheapest"] == ("WH-EAST", "East", 1.5)
    assert found["costliest"] == ("WH-EAST", "West", 8.0)
    assert found["slowest"] == ("WH-EAST", "West", 6.0)


def test_days_of_cover_splits_hub(spark):
    master = spark.createDataFrame(
        [("WH-N", "North", 100.0), ("WH-C", "Central", 80.0)], "canonical_warehouse_id string, region string, inv_units double")
    demand = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "North", 10.0), (dt.date(2024, 1, 10), "South", 0.0)], "date date, region string, units_ordered double")
    got = rows(I.days_of_cover(master, demand), "warehouse_id", "region")
    assert got == [("WH-C", "North", 40.0, 1.0, 40.0), ("WH-C", "South", 40.0, 0.0, None), ("WH-N", "North", 100.0, 1.0, 100.0)]
    zones = rows(I.cover_report(I.days_of_cover(master, demand)).select("zone"))
    assert zones == [("healthy",), ("healthy",), (None,)]


def test_published_network_cover(spark):
    util = spark.createDataFrame(
        [("WH-CENTRAL", 1797061), ("WH-EAST", 1818359), ("WH-NORTH", 1821735), ("W4", 1), ("W5", 1)], "warehouse_id string, inventory_units int")
    got = {r.warehouse_id: r.days_of_cover for r in I.network_days_of_cover(util, F.lit(5451.88)).collect()}
    assert (got["WH-CENTRAL"], got["WH-EAST"], got["WH-NORTH"]) == (11536.8, 11673.5, 11695.2)


def test_utilisation_with_zero_capacity(spark):
    stock = spark.createDataFrame([("A", "s", 10.0, 1.0, 0.1)],
                                  "canonical_warehouse_id string, sku_id string, starting_inventory_units double, inventory_value_usd double, daily_holding_cost_usd double")
    sites = spark.createDataFrame([("A", "North", 0, 1.0)], "warehouse_id string, region string, capacity_units int, fixed_daily_cost_usd double")
    row = I.warehouse_utilisation(stock, sites).first()
    assert (row.utilization_pct, row.status, row.available_units) == (None, "NORMAL", -10.0)


def test_published_safety_stock(spark, lanes):
    residuals = spark.createDataFrame([("East", "BEAUTY", 1.3389), ("East", "ELECTRONICS", 4.0502), ("East", "HOME", 1.0003)],
                                      "region string, category string, residual_std double")
    terms = spark.createDataFrame([("BEAUTY", 0.95, 0.0424, 1.0), ("ELECTRONICS", 0.98, 0.0507, 1.0), ("HOME", 0.92, 0.0701, 1.0)],
                                  "category string, target_service_level double, avg_holding_cost_daily double, avg_volume_m3 double")
    got = {r.category: r for r in P.safety_stock(residuals, lanes, terms).collect()}
    for category, units, whole, cost in [("BEAUTY", 4.5775, 5, 0.636), ("ELECTRONICS", 17.2884, 18, 2.7378), ("HOME", 2.9213, 3, 0.6309)]:
        assert got[category].safety_stock_units == pytest.approx(units, abs=2e-3)
        assert got[category].safety_stock_int == whole
        assert got[category].ss_holding_cost_usd == pytest.approx(cost, abs=5e-4)


@pytest.fixture(scope="module")
def plan(spark, lanes):
    requirements = spark.createDataFrame(
        [(r, c, 100.0 + i, 5, 105.0 + i) for i, (r, c) in enumerate((r, c) for r in ("North", "South", "East", "West") for c in ("TOYS", "PET"))],
        "region string, category string, mean_demand_units double, safety_stock_units int, required_units double")
    terms = spark.createDataFrame([("TOYS", 0.95, 0.05, 0.02), ("PET", 0.9, 0.07, 0.01)],
                                  "category string, target_service_level double, avg_holding_cost_daily double, avg_volume_m3 double")
    return P.allocate_lanes(P.lane_options(requirements, lanes, terms)), requirements, terms


def test_plan_sends_everything_home(plan):
    allocated, requirements, _ = plan
    used = allocated.where("units_allocated > 0")
    assert used.where(F.upper(F.concat(F.lit("WH-"), F.col("region"))) != F.col("warehouse_id")).count() == 0
    per_scenario = {r.scenario: r.u for r in allocated.groupBy("scenario").agg(F.sum("units_allocated").alias("u")).collect()}
    required = requirements.agg(F.sum("required_units")).first()[0]
    assert per_scenario == {"A": required, "B": required, "C": required}


def test_plan_is_the_minimum_over_lanes(plan):
    allocated, _, _ = plan
    chosen = allocated.where("units_allocated > 0").select("scenario", "region", "category", F.col("score").alias("best"))
    beaten = allocated.join(chosen, ["scenario", "region", "category"]).where(F.col("score") < F.col("best") - 1e-12)
    assert beaten.count() == 0


def test_capacity_overflow_is_flagged(spark, plan):
    allocated, _, _ = plan
    sites = spark.createDataFrame([("WH-NORTH", "North", 10), ("WH-SOUTH", "South", 10_000)], "warehouse_id string, region string, capacity_units int")
    checked = {r.warehouse_id: r.overflows for r in P.capacity_check(allocated, sites).where("scenario = 'A'").collect()}
    assert checked["WH-NORTH"] is True and checked["WH-SOUTH"] is False


def test_rollup_detail_equals_total(plan):
    allocated, _, _ = plan
    rolled = P.placement_rollup(allocated)
    detail = {r.scenario: r.u for r in rolled.where("warehouse_id <> 'ALL'").groupBy("scenario").agg(F.sum("carbon_kg").alias("u")).collect()}
    total = {r.scenario: r.carbon_kg for r in rolled.where("warehouse_id = 'ALL'").collect()}
    assert detail == pytest.approx(total)


def test_sweep_and_summary(spark, lanes, plan):
    _, requirements, terms = plan
    swept = P.allocate_lanes(P.lane_options(requirements, lanes, terms), P.sweep_scenarios())
    summary = P.scenario_summary(swept, terms)
    assert summary.count() == 11
    assert {r.segments_meeting_sl for r in summary.collect()} == {8}


def test_service_levels_and_saving(spark, lanes, plan):
    allocated, _, terms = plan
    sites = spark.createDataFrame([(f"WH-{r.upper()}", r, 1000) for r in ("North", "South", "East", "West")] + [("WH-CENTRAL", "Central", 5)],
                                  "warehouse_id string, region string, capacity_units int")
    levels = P.service_levels(allocated, sites, terms)
    assert levels.where("breach_flag").count() == 0
    assert {r.home_wh_pct for r in levels.collect()} == {100.0}
    advice = {r.warehouse_id: r.recommendation for r in P.warehouse_recommendations(allocated, sites).collect()}
    assert advice["WH-CENTRAL"].startswith("Zero allocation") and advice["WH-NORTH"].startswith("Under-utilised")
    saving = P.routing_saving(allocated, lanes).first()
    assert saving.mean_lane_cost_usd == pytest.approx(saving.units * 4.2)
    assert saving.annual_saving_usd == pytest.approx(52 * saving.weekly_saving_usd)


def test_published_baseline(spark, lanes):
    forecast = spark.createDataFrame([("TOYS", 65422.55)], "category string, predicted_units double")
    stock = spark.createDataFrame([(406381.70,)], "daily_holding_cost_usd double")
    terms = spark.createDataFrame([("TOYS", 0.9, 0.1, 0.02)], "category string, target_service_level double, avg_holding_cost_daily double, avg_volume_m3 double")
    base = P.baseline(forecast, lanes, stock, terms).first()
    assert base.ship_cost_usd == pytest.approx(274774.71, abs=0.01)
    assert base.holding_cost_usd == pytest.approx(34136062.8, abs=0.01)


def test_abc_xyz_cuts_and_ties(spark):
    data = [("A1", 70.0), ("B1", 15.0), ("B2", 15.0)]
    df = spark.createDataFrame(data + data, "category string, u double")
    got = {r.category: (r.abc_class, r.xyz_class, round(r.cumulative_share_pct, 6)) for r in G.classify_abc_xyz(df, "u").collect()}
    assert got == {"A1": ("A", "X", 70.0), "B1": ("B", "X", 85.0), "B2": ("C", "X", 100.0)}


def test_single_row_category_has_no_spread(spark):
    df = spark.createDataFrame([("A", 5.0)], "category string, u double")
    row = G.classify_abc_xyz(df, "u").first()
    assert (row.demand_std, row.cv, row.abc_xyz_class) == (0.0, 0.0, "C|X")


def test_strategy_only_for_published_pairs(spark):
    df = spark.createDataFrame([("AX",), ("AZ",)], "c string")
    assert rows(df.select(G.strategy(F.col("c")))) == [("Lean replenishment - high value, predictable",), (None,)]


def _priced_plan(spark, segments, lanes):
    """A plan of one scenario from (region, units) and (region, warehouse, score)."""
    needed = dict(segments)
    rows_ = [("A", "x", 1.0, 0.0, r, "c", w, float(needed[r]), float(s), 1.0, 0.0, 0.0, 0.0) for r, w, s in lanes]
    columns = "scenario string, scenario_label string, w_cost double, w_carbon double, region string, category string, warehouse_id string, required_units double, score double, ship_cost_per_unit double, unit_holding double, unit_carbon double, units_allocated double"
    return spark.createDataFrame(rows_, columns)


def test_capacity_prices_prove_the_best_plan(spark):
    """One tight warehouse: who loses least by leaving leaves; the plan that does so meets the bound."""
    segments = [("r1", 10), ("r2", 10), ("r3", 10)]
    lanes = [("r1", "N", 1), ("r1", "S", 9), ("r2", "N", 1), ("r2", "S", 2), ("r3", "N", 1), ("r3", "S", 5)]
    sites = spark.createDataFrame([("N", 15.0), ("S", 100.0)], "warehouse_id string, capacity_units double")
    chosen, report = P.plan_within_capacity(_priced_plan(spark, segments, lanes), sites)
    row = report.first()
    # r1 stays, half of r3 stays, r2 goes.
    best = 10 * 1 + 5 * 1 + 5 * 5 + 10 * 2
    assert (row.lower_bound, row.weighted_score, row.unserved_units) == (pytest.approx(best), pytest.approx(best), 0.0)
    assert row.gap_pct == pytest.approx(0.0) and {r.optimal for r in chosen.collect()} == {True}
    served = {(r.region, r.warehouse_id): r.units_allocated for r in chosen.collect() if r.units_allocated}
    assert served == {("r1", "N"): 10.0, ("r3", "N"): 5.0, ("r3", "S"): 5.0, ("r2", "S"): 10.0}


def test_bound_holds_below_every_plan(spark):
    """Against all whole assignments of small instances, shortage included."""
    import itertools
    import random

    rnd = random.Random(3)
    for _ in range(3):
        segments = [(f"r{i}", rnd.randint(3, 9)) for i in range(4)]
        lanes = [(r, w, rnd.randint(1, 9)) for r, _ in segments for w in "NSE"]
        room = {w: float(rnd.randint(6, 12)) for w in "NSE"}
        sites = spark.createDataFrame(list(room.items()), "warehouse_id string, capacity_units double")
        _, report = P.plan_within_capacity(_priced_plan(spark, segments, lanes), sites)
        row = report.first()
        score = {(r, w): s for r, w, s in lanes}
        shortage = P.SHORTAGE * max(score.values())
        best = min(
            sum(u * (score[r, w] if w else shortage) for (r, u), w in zip(segments, chosen))
            for chosen in itertools.product(["N", "S", "E", None], repeat=4)
            if all(sum(u for (_, u), w in zip(segments, chosen) if w == site) <= room[site] for site in room)
        )
        assert row.lower_bound <= best + 1e-9 and row.lower_bound <= row.weighted_score + 1e-9
        assert row.weighted_score <= row.regret_score + 1e-9
        assert row.gap_pct == pytest.approx(max(0.0, (row.weighted_score - row.lower_bound) / row.weighted_score * 100))


def test_prices_where_all_fits(spark):
    plan = _priced_plan(spark, [("r1", 10)], [("r1", "N", 1), ("r1", "S", 9)])
    sites = spark.createDataFrame([("N", 15.0), ("S", 100.0)], "warehouse_id string, capacity_units double")
    assert P.capacity_prices(plan, sites).collect() == []
    assert P.plan_within_capacity(plan, sites)[1].first().gap_pct == 0.0

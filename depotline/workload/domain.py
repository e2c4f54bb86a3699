"""Domain operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.operators import evaluation as E, inventory as I, lanes as L, planning as P, reports, segments as G, valuation as V
from depotline.plans.network import ModelNetwork, Network
from depotline.session import store
from depotline.sources import bridge
from depotline.workload.registry import query


def network(spark: SparkSession, sf_dir: str) -> Network:
    return Network.from_benchmark(spark, sf_dir)


@query(
    "d01_financials",
    "sku_id gross_margin_usd:6 margin_pct:6 stockout_penalty_usd:4 holding_cost_daily_usd:6",
    "SELECT * FROM skus",
)
def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.add_financials(bridge.raw_sku_master(spark, sf_dir))


@query(
    "d02_inventory_value",
    "canonical_warehouse_id sku_id inventory_value_usd:3 daily_holding_cost_usd:5",
    "SELECT * FROM stock",
)
def inventory_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.starting_inventory(spark, sf_dir)


@query(
    "d03_carbon_features",
    "warehouse_id demand_region category volume_m3:6 distance_km_proxy:2 carbon_kg_per_unit:6",
    """SELECT warehouse_id, demand_region, category, cube_ft * 0.028317 AS volume_m3, lead_time_days * 500.0 AS distance_km_proxy,
              lead_time_days * 500.0 * (cube_ft * 0.028317 * 200 / 1000) * 0.062 AS carbon_kg_per_unit
       FROM lanes CROSS JOIN (SELECT category, avg(cube_ft) AS cube_ft FROM skus GROUP BY category)""",
)
def carbon_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carbon per unit on every lane for each category's mean volume."""
    cubes = bridge.sku_master(spark, sf_dir).groupBy("category").agg(F.avg("cube_ft").alias("cube_ft"))
    # Six category rows as one array: an expansion of the lane table.
    listed = cubes.agg(F.collect_list(F.struct("category", "cube_ft"))).scalar()
    rows = bridge.lanes(spark, sf_dir).withColumn("c", F.explode(listed)).select("*", "c.*").drop("c")
    return V.add_carbon_features(rows)


@query(
    "d04_lane_carbon",
    "warehouse_id demand_region distance_km:2 weight_tonnes:8 carbon_kg_per_unit:6",
    "SELECT * FROM costed_lanes",
)
def lane_carbon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).costed_lanes()


_UNIT = """(ship_cost_per_unit - min(ship_cost_per_unit) OVER ()) / (max(ship_cost_per_unit) OVER () - min(ship_cost_per_unit) OVER ())"""


@query(
    "d05_lane_efficiency",
    "warehouse_id demand_region lane_efficiency_score:6 lane_badness:6",
    f"""SELECT warehouse_id, demand_region, lane_efficiency_score, ({_UNIT}
               + (carbon_kg_per_unit - min(carbon_kg_per_unit) OVER ()) / (max(carbon_kg_per_unit) OVER () - min(carbon_kg_per_unit) OVER ())
               + CAST(lead_time_days - min(lead_time_days) OVER () AS DOUBLE) / (max(lead_time_days) OVER () - min(lead_time_days) OVER ())) / 3
               AS lane_badness FROM costed_lanes""",
)
def lane_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both conventions: 1 = best over cost and lead time, and lower = better over all three."""
    return L.add_lane_efficiency(network(spark, sf_dir).costed_lanes(), output="lane_badness")


@query(
    "d06_days_of_cover",
    "warehouse_id region inv_units:4 avg_daily_demand:6 days_of_cover:1",
    "SELECT * FROM cover",
)
def days_of_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cover per site and region with the hub split evenly (zones: D7)."""
    n = network(spark, sf_dir)
    return I.days_of_cover(n.units_by_site(), n.demand)


@query(
    "d06b_network_cover",
    "warehouse_id days_of_cover:1",
    """SELECT warehouse_id, inventory_units / ((SELECT avg(u) FROM (SELECT sum(predicted_units) AS u FROM forecast GROUP BY week_start))
              / (SELECT count(*) FROM util)) * 7 AS days_of_cover FROM util""",
)
def network_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    per_week = n.forecast().groupBy("week_start").agg(F.sum("predicted_units").alias("u"))
    return I.network_days_of_cover(n.utilisation(), per_week.agg(F.avg("u")).scalar())


@query(
    "d08_capacity_pressure",
    "warehouse inventory_units:2 capacity_units:l utilisation_pct:2 daily_storage_cost:2 utilisation_status",
    """SELECT warehouse_id AS warehouse, inventory_units, capacity_units, pct AS utilisation_pct, fixed_daily_cost_usd AS daily_storage_cost,
              CASE WHEN pct >= 100 THEN 'CRITICAL' WHEN pct >= 85 THEN 'HIGH' ELSE 'NORMAL' END AS utilisation_status FROM util""",
)
def capacity_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return reports.capacity_pressure(spark, reports.stock_view(n.stock), reports.warehouse_view(n.warehouses))


@query(
    "d09_lane_allocation",
    "scenario warehouse_id region category score:6 units_allocated:4",
    "SELECT scenario, warehouse_id, region, category, score, units_allocated FROM plan",
)
def lane_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).plan()


@query(
    "d09_capacity_check",
    "scenario warehouse_id allocated_units:4 utilisation_pct:4 overflow_units:4 overflows:b",
    """SELECT scenario, p.warehouse_id, sum(units_allocated) AS allocated_units, sum(units_allocated) * 100 / capacity_units AS utilisation_pct,
              greatest(sum(units_allocated) - capacity_units, 0) AS overflow_units, sum(units_allocated) > capacity_units AS overflows
       FROM plan p JOIN sites s ON p.warehouse_id = s.warehouse_id GROUP BY scenario, p.warehouse_id, capacity_units""",
)
def capacity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return P.capacity_check(n.plan(), n.warehouses)


# Capacities that a plan does not fit into: each warehouse holds a sixth of what a scenario needs.
#: Passes that the statements below spell out; the benchmark has as many lanes a region.
_PASSES = 5
_KEYS = "scenario, region, category"
_TIGHT = f"""tight AS (SELECT scenario, sum(lack) / 6 AS room FROM (SELECT {_KEYS}, max(required_units) AS lack FROM plan GROUP BY ALL) GROUP BY 1)"""


def _passes(source: str, score: str, name: str) -> list[str]:
    """The passes of the allocation within tight capacities, one statement per pass; lanes ranked by ``score``."""
    order = f"PARTITION BY {_KEYS} ORDER BY round({score}, 12), warehouse_id"
    steps = [
        f"ranked{name} AS (SELECT *, row_number() OVER ({order}) AS place, round(lead({score}) OVER ({order}) - {score}, 12) AS regret FROM {source})",
        f"lack{name}1 AS (SELECT {_KEYS}, required_units AS lack FROM ranked{name} WHERE place = 1)",
        f"room{name}1 AS (SELECT DISTINCT r.scenario, r.warehouse_id, t.room FROM ranked{name} r JOIN tight t ON r.scenario = t.scenario)",
    ]
    for k in range(1, _PASSES + 1):
        steps += [
            f"""taken{name}{k} AS (SELECT scenario, region, category, warehouse_id, {k} > 1 AS late, greatest(0, least(lack, room - coalesce(
                  sum(lack) OVER (PARTITION BY scenario, warehouse_id ORDER BY regret DESC NULLS FIRST, region, category ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS taken
                FROM ranked{name} JOIN lack{name}{k} USING ({_KEYS}) JOIN room{name}{k} USING (scenario, warehouse_id) WHERE place = {k})""",
            f"lack{name}{k + 1} AS (SELECT {_KEYS}, lack - coalesce(taken, 0) AS lack FROM lack{name}{k} LEFT JOIN taken{name}{k} USING ({_KEYS}))",
            f"""room{name}{k + 1} AS (SELECT scenario, warehouse_id, room - coalesce(used, 0) AS room FROM room{name}{k}
                LEFT JOIN (SELECT scenario, warehouse_id, sum(taken) AS used FROM taken{name}{k} GROUP BY 1, 2) USING (scenario, warehouse_id))""",
        ]
    served = " UNION ALL ".join(f"SELECT * FROM taken{name}{k}" for k in range(1, _PASSES + 1))
    steps.append(f"""tight_plan{name} AS (SELECT r.* EXCLUDE (units_allocated), coalesce(taken, 0) AS units_allocated, coalesce(late AND taken > 0, false) AS spilled
        FROM ranked{name} r LEFT JOIN ({served}) USING ({_KEYS}, warehouse_id))""")
    return steps


def _capacity_sql(select: str) -> str:
    return f"WITH {_TIGHT}, {', '.join(_passes('plan', 'score', ''))} {select}"


def _bound_sql(sites: list[str], rounds: int = 2) -> str:
    """Prices of one warehouse after the other, the bound they give, and both plans' scores."""
    steps = [
        _TIGHT,
        "short AS (SELECT scenario, 2.0 * max(score) AS shortage FROM plan GROUP BY 1)",
        "lanes0 AS MATERIALIZED (SELECT scenario, region, category, warehouse_id, score, required_units, shortage FROM plan JOIN short USING (scenario))",
        "p0 AS MATERIALIZED (SELECT DISTINCT scenario, warehouse_id, shortage AS price FROM lanes0)",
    ]
    for n, site in enumerate(sites * rounds):
        steps.append(
            f"""p{n + 1} AS MATERIALIZED (SELECT p.scenario, p.warehouse_id, CASE WHEN p.warehouse_id = '{site}' THEN coalesce(f.price, 0.0) ELSE p.price END AS price
              FROM p{n} p LEFT JOIN (
                SELECT scenario, max(loss) AS price FROM (
                  SELECT scenario, loss, sum(units) OVER (PARTITION BY scenario ORDER BY loss DESC, region, category ROWS UNBOUNDED PRECEDING) AS load
                  FROM (SELECT l.scenario, region, category, max(required_units) AS units,
                               round(least(min(CASE WHEN l.warehouse_id <> '{site}' THEN score + price END), max(shortage)) - min(CASE WHEN l.warehouse_id = '{site}' THEN score END), 12) AS loss
                        FROM lanes0 l JOIN p{n} q ON l.scenario = q.scenario AND l.warehouse_id = q.warehouse_id GROUP BY 1, 2, 3) WHERE loss > 0)
                JOIN tight USING (scenario) WHERE load > room GROUP BY scenario) f ON p.scenario = f.scenario)"""
        )
    last = f"p{len(sites) * rounds}"
    steps.append(f"priced AS MATERIALIZED (SELECT p.*, q.price FROM plan p JOIN {last} q USING (scenario, warehouse_id))")
    steps += _passes("plan", "score", "_r") + _passes("priced", "(score + price)", "_p")
    steps.append(
        f"""bound AS (SELECT scenario, least_score - rent AS lower_bound FROM (
              SELECT scenario, sum(u * least(m, shortage)) AS least_score FROM (
                SELECT {_KEYS}, max(required_units) AS u, min(score + price) AS m FROM priced GROUP BY ALL) JOIN short USING (scenario) GROUP BY 1)
            JOIN (SELECT scenario, sum(price * room) AS rent FROM {last} JOIN tight USING (scenario) GROUP BY 1) USING (scenario))"""
    )
    for name in ("_r", "_p"):
        steps.append(
            f"""score{name} AS (SELECT scenario, sum(units) AS served, sum(need - units) AS unserved, sum(s + (need - units) * shortage) AS total FROM (
                  SELECT {_KEYS}, sum(units_allocated) AS units, max(required_units) AS need, sum(units_allocated * score) AS s FROM tight_plan{name} GROUP BY ALL)
                JOIN short USING (scenario) GROUP BY 1)"""
        )
    return f"""WITH {', '.join(steps)}
        SELECT scenario, CASE WHEN better THEN p.served ELSE r.served END AS served_units, CASE WHEN better THEN p.unserved ELSE r.unserved END AS unserved_units,
               CASE WHEN better THEN 'priced' ELSE 'regret' END AS method, lower_bound, w AS weighted_score, r.total AS regret_score, greatest(0.0, (w - lower_bound) * 100 / w) AS gap_pct
        FROM (SELECT scenario, round(p.total, 9) < round(r.total, 9) AS better, least(p.total, r.total) AS w FROM score_p p JOIN score_r r USING (scenario))
        JOIN score_p p USING (scenario) JOIN score_r r USING (scenario) JOIN bound USING (scenario)"""


def _tight_inputs(spark: SparkSession, sf_dir: str) -> tuple[Network, DataFrame, DataFrame]:
    n = network(spark, sf_dir)
    plan = store(n.plan(), "plan")
    needed = plan.groupBy("scenario").agg((F.sum("units_allocated") / 6).alias("room")).agg(F.max("room")).scalar()
    return n, plan, n.warehouses.withColumn("capacity_units", needed)


def _tight_plan(spark: SparkSession, sf_dir: str) -> tuple[Network, DataFrame]:
    n, plan, sites = _tight_inputs(spark, sf_dir)
    return n, P.allocate_within_capacity(plan, sites)


@query(
    "d09_capacity_allocation",
    "scenario warehouse_id region category units_allocated:4 spilled:b optimal:b",
    _capacity_sql("""SELECT t.scenario, warehouse_id, region, category, units_allocated, spilled,
        sum(CASE WHEN NOT spilled THEN units_allocated ELSE 0 END) OVER (PARTITION BY t.scenario) >= 6 * room - 0.000001 AS optimal
        FROM tight_plan t JOIN tight USING (scenario)"""),
)
def capacity_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spill to the next best lanes where each warehouse can hold a sixth of all units."""
    return _tight_plan(spark, sf_dir)[1]


_LANE_SITES = ["WH-AFRICA", "WH-AMERICA", "WH-ASIA", "WH-EUROPE", "WH-MIDDLE-EAST"]


@query(
    "d09_capacity_bound",
    "scenario method served_units:4 unserved_units:4 lower_bound:6 weighted_score:6 regret_score:6 gap_pct:4",
    _bound_sql(_LANE_SITES),
)
def capacity_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the plan within tight capacities can be from the best one, by prices on capacity."""
    _, plan, sites = _tight_inputs(spark, sf_dir)
    return P.plan_within_capacity(plan, sites)[1]


@query(
    "d09_capacity_proof",
    "scenario lower_bound:6 weighted_score:6 gap_pct:4",
    """SELECT scenario, sum(units_allocated * score) AS lower_bound, sum(units_allocated * score) AS weighted_score, 0.0 AS gap_pct FROM plan GROUP BY scenario""",
)
def capacity_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where all fits, the bound meets the plan of best lanes: it is proven optimal."""
    n = network(spark, sf_dir)
    return P.plan_within_capacity(store(n.plan(), "plan"), n.warehouses)[1]


@query(
    "d17_tight_service_levels",
    "region category total_required_units:4 units_allocated:4 fill_rate:4 target_sl_pct:2 breach_flag:b gap_units:4 gap_pct:4 home_wh_units:4 status",
    _capacity_sql("""SELECT region, category, need AS total_required_units, units AS units_allocated, least(1, units / need) AS fill_rate,
        target * 100 AS target_sl_pct, least(1, units / need) < target AS breach_flag, greatest(0, need - units) AS gap_units,
        greatest(0, need - units) * 100 / need AS gap_pct, home_wh_units, CASE WHEN least(1, units / need) < target THEN 'BREACH' ELSE 'OK' END AS status
        FROM (SELECT p.region, p.category, max(required_units) AS need, sum(units_allocated) AS units, max(target_service_level) AS target,
                     sum(CASE WHEN warehouse_id = home_warehouse THEN units_allocated ELSE 0 END) AS home_wh_units
              FROM tight_plan p JOIN home h ON p.region = h.region JOIN terms t ON p.category = t.category
              WHERE scenario = 'B' GROUP BY p.region, p.category)"""),
)
def tight_service_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill rates, gaps and breaches of a plan that capacity cuts short."""
    n, plan = _tight_plan(spark, sf_dir)
    return P.service_levels(plan, n.warehouses, n.terms())


def _model_network(spark: SparkSession, sf_dir: str) -> ModelNetwork:
    return ModelNetwork.from_benchmark(spark, sf_dir)


@query("d21_model_interval", "week_start:d region category predicted_units:2 predicted_units_lower:2 predicted_units_upper:2")
def model_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward forecast of a fitted model with the interval of its own residuals; the persistence variant is checked."""
    return _model_network(spark, sf_dir).forecast()


@query("d11_model_scenarios", "scenario total_units:2 total_cost_usd:2 total_carbon_kg:2 segments_meeting_sl:l service_level_pct:2")
def model_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenarios of a plan whose requirements come from a fitted model."""
    n = _model_network(spark, sf_dir)
    return P.scenario_summary(n.plan(), n.terms())


@query(
    "d10_lane_costs",
    "scenario warehouse_id region category ship_cost_usd:4 holding_cost_usd:4 total_cost_usd:4 carbon_kg:4",
    "SELECT * FROM plan",
)
def lane_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).plan()


def _summary(source: str) -> str:
    return f"""SELECT scenario, w_cost, w_carbon, sum(u) AS total_units, sum(c) AS total_cost_usd, sum(k) AS total_carbon_kg,
        count(*) FILTER (WHERE least(1, u / r) >= t.target_service_level) AS segments_meeting_sl,
        count(*) FILTER (WHERE least(1, u / r) >= t.target_service_level) * 100.0 / count(*) AS service_level_pct,
        sum(c) / sum(u) AS cost_per_unit, sum(k) / sum(u) AS carbon_per_unit
        FROM (SELECT scenario, w_cost, w_carbon, region, category, sum(units_allocated) AS u, max(required_units) AS r,
                     sum(total_cost_usd) AS c, sum(carbon_kg) AS k FROM {source} GROUP BY 1, 2, 3, 4, 5) x
        JOIN terms t ON x.category = t.category GROUP BY 1, 2, 3"""


_SUMMARY_SPEC = ("scenario w_cost:1 w_carbon:1 total_units:3 total_cost_usd:3 total_carbon_kg:3 segments_meeting_sl:l "
                 "service_level_pct:2 cost_per_unit:5 carbon_per_unit:5")


@query("d11_scenarios", _SUMMARY_SPEC, _summary("plan"))
def scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return P.scenario_summary(n.plan(), n.terms())


@query(
    "d12_sensitivity_sweep",
    _SUMMARY_SPEC,
    """WITH sweep AS (
         SELECT *, units_allocated * (ship_cost_per_unit + unit_holding) AS total_cost_usd, units_allocated * unit_carbon AS carbon_kg FROM (
           SELECT *, CASE WHEN row_number() OVER (PARTITION BY scenario, region, category ORDER BY round(s, 12), warehouse_id) = 1
                          THEN required_units ELSE 0 END AS units_allocated FROM (
             SELECT o.*, printf('S%02d', i) AS scenario, 1 - i / 10.0::DOUBLE AS w_cost, i / 10.0::DOUBLE AS w_carbon,
                    (1 - i / 10.0::DOUBLE) * unit_cost / max(unit_cost) OVER () + i / 10.0::DOUBLE * unit_carbon / max(unit_carbon) OVER () AS s
             FROM options o CROSS JOIN (SELECT unnest(range(0, 11)) AS i))))
       """ + _summary("sweep"),
)
def sensitivity_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven weightings in one job."""
    n = network(spark, sf_dir)
    return P.scenario_summary(n.plan(P.sweep_scenarios()), n.terms())


@query(
    "d13_baseline",
    "units:3 ship_cost_usd:2 holding_cost_usd:0 total_cost_usd:0 carbon_kg:3 mean_lane_cost:6 mean_lead_time_days:6",
    "SELECT * FROM base",
)
def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).baseline()


@query(
    "d14_cost_to_serve",
    "scenario units:3 ship_cost_usd:2 holding_cost_usd:0 total_cost_usd:0 vs_baseline_usd:0 vs_baseline_pct:4 cost_per_unit_served:4 recommended:b",
    """SELECT *, total_cost_usd - (SELECT total_cost_usd FROM base) AS vs_baseline_usd,
              (total_cost_usd / (SELECT total_cost_usd FROM base) - 1) * 100 AS vs_baseline_pct,
              total_cost_usd / units AS cost_per_unit_served, scenario = 'B' AS recommended FROM with_base""",
)
def cost_to_serve(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return P.cost_to_serve(n.stored_plan, n.baseline())


@query(
    "d14b_routing_saving",
    "units:3 mean_lane_cost_usd:2 optimised_cost_usd:2 weekly_saving_usd:2 weekly_saving_pct:4 annual_saving_usd:1",
    """SELECT units, units * m AS mean_lane_cost_usd, c AS optimised_cost_usd, units * m - c AS weekly_saving_usd,
              (1 - c / (units * m)) * 100 AS weekly_saving_pct, (units * m - c) * 52 AS annual_saving_usd
       FROM (SELECT sum(units_allocated) AS units, sum(total_cost_usd) AS c FROM plan WHERE scenario = 'B')
       CROSS JOIN (SELECT avg(ship_cost_per_unit) AS m FROM lanes)""",
)
def routing_saving(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return P.routing_saving(n.plan(), n.lanes)


@query(
    "d15_carbon_comparison",
    "scenario scope warehouse_id region units:3 carbon_kg:3 carbon_per_unit:6 vs_baseline_kg:3 vs_baseline_pct:4",
    """SELECT scenario, 'total' AS scope, 'ALL' AS warehouse_id, 'ALL' AS region, units, carbon_kg, carbon_kg / nullif(units, 0) AS carbon_per_unit,
              carbon_kg - (SELECT carbon_kg FROM base) AS vs_baseline_kg,
              (carbon_kg / (SELECT carbon_kg FROM base) - 1) * 100 AS vs_baseline_pct FROM with_base""",
)
def carbon_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return P.carbon_comparison(n.stored_plan, n.baseline())


@query(
    "d16_safety_stock",
    "region category residual_std:4 avg_lead_time_days:4 target_service_level:2 z_score:4 safety_stock_units:4 safety_stock_int:i ss_holding_cost_usd:4",
    "SELECT * FROM safety",
)
def safety_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).safety_stock()


@query(
    "d17_service_levels",
    "region category mean_demand_units:4 safety_stock_units:l total_required_units:4 units_allocated:4 fill_rate:4 target_sl_pct:2 breach_flag:b "
    "gap_units:4 gap_pct:4 home_warehouse home_wh_units:4 home_wh_pct:4 status",
    """SELECT p.region, p.category, max(mean_demand_units) AS mean_demand_units, max(safety_stock_units) AS safety_stock_units,
              max(required_units) AS total_required_units, sum(units_allocated) AS units_allocated,
              least(1, sum(units_allocated) / max(required_units)) AS fill_rate, max(target_service_level) * 100 AS target_sl_pct,
              least(1, sum(units_allocated) / max(required_units)) < max(target_service_level) AS breach_flag,
              greatest(0, max(required_units) - sum(units_allocated)) AS gap_units,
              greatest(0, max(required_units) - sum(units_allocated)) * 100 / max(required_units) AS gap_pct, home_warehouse,
              sum(CASE WHEN warehouse_id = home_warehouse THEN units_allocated ELSE 0 END) AS home_wh_units,
              sum(CASE WHEN warehouse_id = home_warehouse THEN units_allocated ELSE 0 END) * 100 / sum(units_allocated) AS home_wh_pct,
              CASE WHEN least(1, sum(units_allocated) / max(required_units)) < max(target_service_level) THEN 'BREACH' ELSE 'OK' END AS status
       FROM plan p JOIN home h ON p.region = h.region JOIN terms t ON p.category = t.category
       WHERE scenario = 'B' GROUP BY p.region, p.category, home_warehouse""",
)
def service_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return P.service_levels(n.plan(), n.warehouses, n.terms())


_CLASSES = """SELECT *, CASE WHEN cumulative_share_pct <= 80 THEN 'A' WHEN cumulative_share_pct <= 95 THEN 'B' ELSE 'C' END AS abc_class"""


@query(
    "d18_abc_xyz",
    "category revenue:2 revenue_share_pct:4 cumulative_share_pct:4 cv:4 abc_class xyz_class abc_xyz_class",
    f"""SELECT *, abc_class || '|' || xyz_class AS abc_xyz_class FROM ({_CLASSES},
               CASE WHEN cv <= 10 THEN 'X' WHEN cv <= 25 THEN 'Y' ELSE 'Z' END AS xyz_class FROM (
          SELECT category, revenue, revenue * 100 / sum(revenue) OVER () AS revenue_share_pct,
                 sum(revenue) OVER (ORDER BY revenue DESC, category ROWS UNBOUNDED PRECEDING) * 100 / sum(revenue) OVER () AS cumulative_share_pct, cv
          FROM (SELECT category, sum(units_ordered * price_usd) AS revenue,
                       stddev_samp(units_ordered) / avg(units_ordered) * 100 AS cv FROM demand_cat GROUP BY category)))""",
)
def abc_xyz(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = network(spark, sf_dir).demand_with_category()
    return G.classify_abc_xyz(
        rows.withColumn("revenue", F.col("units_ordered") * F.col("price_usd")), "units_ordered", revenue="revenue"
    )


@query(
    "d19_strategies",
    "category revenue:2 residual_std_mean:4 mean_demand:4 cv_pct:4 abc_xyz strategy",
    f"""SELECT *, CASE abc_xyz WHEN 'AX' THEN 'Lean replenishment - high value, predictable' WHEN 'BX' THEN 'Standard replenishment'
               WHEN 'CX' THEN 'Consolidate SKUs' END AS strategy FROM (
          SELECT *, abc_class || CASE WHEN cv_pct <= 30 THEN 'X' WHEN cv_pct <= 60 THEN 'Y' ELSE 'Z' END AS abc_xyz FROM ({_CLASSES} FROM (
            SELECT b.category, revenue, sum(revenue) OVER (ORDER BY revenue DESC, b.category ROWS UNBOUNDED PRECEDING) * 100 / sum(revenue) OVER () AS cumulative_share_pct,
                   residual_std_mean, mean_demand, residual_std_mean * 100 / mean_demand AS cv_pct
            FROM (SELECT category, sum(total_units * avg_price_usd) AS revenue FROM weekly GROUP BY 1) b
            JOIN (SELECT category, avg(residual_std) AS residual_std_mean FROM residual_stats GROUP BY 1) r ON b.category = r.category
            JOIN (SELECT category, avg(predicted_units) AS mean_demand FROM forecast GROUP BY 1) f ON b.category = f.category)))""",
)
def strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published variant: stability from forecast residuals, strategy text per class pair."""
    n = network(spark, sf_dir)
    base = n.stored_weekly.groupBy("category").agg(F.sum(F.col("total_units") * F.col("avg_price_usd")).alias("revenue"))
    return G.classify_by_forecast(base, n.residual_stats(), n.forecast())


_TOP = """(SELECT warehouse_id, string_agg({c}, '|' ORDER BY r) AS names FROM (
            SELECT warehouse_id, {c}, row_number() OVER (PARTITION BY warehouse_id ORDER BY round(sum(units_allocated), 6) DESC, {c}) AS r
            FROM plan WHERE scenario = 'B' GROUP BY 1, 2) WHERE r <= 2 GROUP BY 1)"""


@query(
    "d20_recommendations",
    "warehouse_id home_region capacity_units:l allocated_units:4 utilisation_pct:4 top_categories top_regions total_cost_usd:3 total_carbon_kg:3 recommendation",
    f"""SELECT *, CASE WHEN utilisation_pct = 0 THEN 'Zero allocation — consolidate demand to active warehouses'
                       WHEN utilisation_pct < 50 THEN 'Under-utilised — candidate for safety stock buffer storage' ELSE 'On plan' END AS recommendation
        FROM (SELECT s.warehouse_id, s.region AS home_region, capacity_units, coalesce(u, 0) AS allocated_units,
                     coalesce(u * 100 / capacity_units, 0) AS utilisation_pct, coalesce(c.names, '') AS top_categories,
                     coalesce(r.names, '') AS top_regions, coalesce(cost, 0) AS total_cost_usd, coalesce(kg, 0) AS total_carbon_kg
              FROM sites s
              LEFT JOIN (SELECT warehouse_id, sum(units_allocated) AS u, sum(total_cost_usd) AS cost, sum(carbon_kg) AS kg
                         FROM plan WHERE scenario = 'B' GROUP BY 1) p ON s.warehouse_id = p.warehouse_id
              LEFT JOIN {_TOP.format(c="category")} c ON s.warehouse_id = c.warehouse_id
              LEFT JOIN {_TOP.format(c="region")} r ON s.warehouse_id = r.warehouse_id)""",
)
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).recommendations()


@query(
    "d21_forecast_interval",
    "year_week week_start:d region category predicted_units:4 predicted_units_lower:4 predicted_units_upper:4 cv_pct:4",
    "SELECT * FROM forecast",
)
def forecast_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).forecast()


@query(
    "d22_interval_width",
    "week_label region category ci_width:2 forecast_type",
    "SELECT year_week AS week_label, region, category, predicted_units_upper - predicted_units_lower AS ci_width, 'forward_12wk' AS forecast_type FROM forecast",
)
def interval_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotline.operators.marts import forecast_summary

    return forecast_summary(network(spark, sf_dir).forecast())


@query(
    "d23_yoy_growth",
    "year_week region category demand_yoy_growth_pct:4",
    """SELECT w.year_week, w.region, w.category, (w.total_units - p.total_units) * 100 / nullif(p.total_units, 0) AS demand_yoy_growth_pct
       FROM weekly w LEFT JOIN weekly p ON w.region = p.region AND w.category = p.category AND w.week_number = p.week_number
         AND CAST(w.year_week[1:4] AS INTEGER) = CAST(p.year_week[1:4] AS INTEGER) + 1""",
)
def yoy_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.year_over_year(network(spark, sf_dir).stored_weekly)


@query(
    "d24_abc_revenue",
    "category revenue:2 revenue_share_pct:2 cumulative_share_pct:2 abc_class",
    f"""{_CLASSES} FROM (SELECT category, revenue, revenue * 100 / sum(revenue) OVER () AS revenue_share_pct,
               sum(revenue) OVER (ORDER BY revenue DESC, category ROWS UNBOUNDED PRECEDING) * 100 / sum(revenue) OVER () AS cumulative_share_pct
        FROM (SELECT k.category, sum(d.units_ordered * k.selling_price_usd) AS revenue FROM demand d JOIN skus k ON d.sku_id = k.sku_id GROUP BY 1))""",
)
def abc_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    demand = n.demand.withColumnRenamed("units_ordered", "units_sold")
    return reports.abc_revenue(spark, demand, reports.sku_view(n.skus))

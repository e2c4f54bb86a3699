"""Joins, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.operators import enrich, evaluation as E, inventory as I, lanes as L, marts, planning as P, quality as Q, weekly as W
from depotline.operators.cleaning import non_canonical_rows
from depotline.operators.reports import category_revenue, sku_view
from depotline.plans.network import Network
from depotline.sources import bridge
from depotline.workload.quality import _DAMAGED, damaged_skus
from depotline.workload.registry import query


def network(spark: SparkSession, sf_dir: str) -> Network:
    return Network.from_benchmark(spark, sf_dir)


@query(
    "j01_demand_calendar",
    "region rows:l matched:l holiday_rows:l",
    """SELECT region, count(*) AS rows, count(c.date) AS matched, count(*) FILTER (WHERE c.holiday_peak_flag = 1) AS holiday_rows
       FROM lines l LEFT JOIN calendar c ON l.date = c.date GROUP BY region""",
)
def demand_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.join_calendar(bridge.demand_lines(spark, sf_dir), bridge.event_calendar(spark, sf_dir))
    return joined.groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("cal_year").alias("matched"),
        F.count_if(F.col("cal_holiday_peak_flag") == 1).alias("holiday_rows"),
    )


@query(
    "j02_demand_category",
    "region category rows:l units:2",
    "SELECT region, category, count(*) AS rows, sum(units_ordered) AS units FROM demand_cat GROUP BY 1, 2",
)
def demand_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).demand_with_category().groupBy("region", "category").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("units_ordered").alias("units")
    )


@query(
    "j03_demand_revenue",
    "category revenue:2",
    """SELECT k.category, sum(d.units_ordered * k.selling_price_usd) AS revenue
       FROM demand d JOIN skus k ON d.sku_id = k.sku_id GROUP BY 1""",
)
def demand_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    demand = bridge.daily_demand(spark, sf_dir).withColumnRenamed("units_ordered", "units_sold")
    return category_revenue(spark, demand, sku_view(bridge.sku_master(spark, sf_dir)))


@query(
    "j04_inventory_master",
    "canonical_warehouse_id region category rows:l units:2",
    """SELECT canonical_warehouse_id, region, category, count(*) AS rows, sum(starting_inventory_units) AS units
       FROM master GROUP BY 1, 2, 3""",
)
def inventory_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category join (J4) and warehouse join on differently named keys."""
    return network(spark, sf_dir).inventory_master().groupBy("canonical_warehouse_id", "region", "category").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("starting_inventory_units").alias("units")
    )


@query(
    "j06_lanes_warehouses",
    "warehouse_id demand_region region fixed_daily_cost_usd:2 capacity_units:l carbon_kg_per_unit:6",
    """SELECT l.warehouse_id, demand_region, s.region, fixed_daily_cost_usd, capacity_units, carbon_kg_per_unit
       FROM costed_lanes l LEFT JOIN sites s ON l.warehouse_id = s.warehouse_id""",
)
def lanes_warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return L.join_warehouse_columns(n.costed_lanes(), n.warehouses)


@query(
    "j07_capacity_inventory",
    "warehouse_id capacity_units:l inventory_units:2 available_units:2",
    "SELECT warehouse_id, capacity_units, inventory_units, available_units FROM util",
)
def capacity_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).utilisation()


@query(
    "j08_demand_lookup",
    "warehouse_id region avg_daily_demand:6",
    "SELECT warehouse_id, region, avg_daily_demand FROM cover",
)
def demand_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return I.days_of_cover(n.units_by_site(), n.demand)


@query(
    "j09_hub_fan_out",
    "warehouse_id region inv_units:4",
    "SELECT warehouse_id, region, inv_units FROM cover",
)
def hub_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hub stock spread over the demand regions."""
    n = network(spark, sf_dir)
    return I.spread_hub(n.units_by_site(), bridge.regions(spark, sf_dir))


@query(
    "j10_expected_lanes",
    "warehouse_id demand_region",
    "SELECT s.warehouse_id, r.region AS demand_region FROM sites s CROSS JOIN region_dim r",
)
def expected_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.expected_lanes(bridge.warehouses(spark, sf_dir), bridge.REGIONS)


@query(
    "j11_orphan_skus",
    "sku_id",
    f"SELECT DISTINCT sku_id FROM demand WHERE sku_id NOT IN (SELECT sku_id FROM {_DAMAGED})",
)
def orphan_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.keys_only_in(bridge.daily_demand(spark, sf_dir), damaged_skus(spark, sf_dir), ["sku_id"])


@query(
    "j12_enriched_demand",
    "home_warehouse category rows:l revenue_usd:2 carbon_kg:4 ship:2 missing:l",
    """SELECT home_warehouse, k.category, count(*) AS rows, sum(units_ordered * price_usd) AS revenue_usd,
              sum(units_ordered * (home_lead_time * 500.0 * (cube_ft * 0.028317 * 200 / 1000) * 0.062)) AS carbon_kg,
              sum(units_ordered * home_ship_cost) AS ship, count(*) FILTER (WHERE unit_cost_usd IS NULL OR home_ship_cost IS NULL) AS missing
       FROM demand d LEFT JOIN skus k ON d.sku_id = k.sku_id LEFT JOIN home h ON d.region = h.region GROUP BY 1, 2""",
)
def enriched_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    fact = enrich.enriched_demand(n.demand, n.skus, n.warehouses, n.lanes)
    return fact.groupBy("home_warehouse", "category").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("revenue_usd").alias("revenue_usd"),
        F.sum("carbon_kg").alias("carbon_kg"),
        F.sum(F.col("units_ordered") * F.col("home_ship_cost")).alias("ship"),
        F.count_if(F.col("unit_cost_usd").isNull() | F.col("home_ship_cost").isNull()).alias("missing"),
    )


@query(
    "j13_weekly_chain",
    "year_week region category total_units:2 week_holiday_peak_flag:i avg_unit_cost_usd:6 home_warehouse home_ship_cost:4 carbon_kg_per_unit:6",
    """SELECT w.year_week, w.region, w.category, total_units, week_holiday_peak_flag, avg_unit_cost_usd, home_warehouse,
              home_ship_cost, home_lead_time * 500.0 * (avg_volume_m3 * 200 / 1000) * 0.062 AS carbon_kg_per_unit
       FROM weekly w
       LEFT JOIN (SELECT year_week, max(holiday_peak_flag) AS week_holiday_peak_flag FROM calendar GROUP BY year_week) e
         ON w.year_week = e.year_week
       LEFT JOIN (SELECT category, avg(unit_cost_usd) AS avg_unit_cost_usd, avg(volume_m3) AS avg_volume_m3
                  FROM skus GROUP BY category) c ON w.category = c.category
       LEFT JOIN home h ON w.region = h.region""",
)
def weekly_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return enrich.weekly_chain(n.weekly(), n.calendar, n.skus, n.warehouses, n.lanes)


@query(
    "j14_forecast_residuals",
    "week_start:d region category predicted_units:4 residual_std:4",
    "SELECT week_start, region, category, predicted_units, residual_std FROM forecast",
)
def forecast_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).forecast()


@query(
    "j15_year_over_year",
    "year_week region category total_units:2 units_year_before:2",
    """SELECT w.year_week, w.region, w.category, w.total_units, p.total_units AS units_year_before
       FROM weekly w LEFT JOIN weekly p ON w.region = p.region AND w.category = p.category
         AND w.week_number = p.week_number
         AND CAST(w.year_week[1:4] AS INTEGER) = CAST(p.year_week[1:4] AS INTEGER) + 1""",
)
def year_over_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.year_over_year(network(spark, sf_dir).stored_weekly)


_WEEKLY_DEMAND = "(SELECT avg(u) FROM (SELECT sum(predicted_units) AS u FROM forecast GROUP BY week_start))"
_ALLOCATED = """(SELECT s.warehouse_id, coalesce(p.u, 0) AS u, coalesce(p.u * 100 / s.capacity_units, 0) AS pct
                 FROM sites s LEFT JOIN (SELECT warehouse_id, sum(units_allocated) AS u FROM plan
                                         WHERE scenario = 'B' GROUP BY warehouse_id) p ON s.warehouse_id = p.warehouse_id)"""
_ADVICE = """CASE WHEN {pct} = 0 THEN 'Zero allocation — consolidate demand to active warehouses'
                  WHEN {pct} < 50 THEN 'Under-utilised — candidate for safety stock buffer storage' ELSE 'On plan' END"""


@query(
    "j16_inventory_mart",
    "warehouse_id home_region starting_inventory_units:2 starting_utilisation_pct:2 optimised_allocation_units:2 days_of_cover:1 recommendation",
    f"""SELECT u.warehouse_id, region AS home_region, inventory_units AS starting_inventory_units, u.pct AS starting_utilisation_pct,
               a.u AS optimised_allocation_units,
               inventory_units / ({_WEEKLY_DEMAND} / (SELECT count(*) FROM util)) * 7 AS days_of_cover,
               {_ADVICE.format(pct="a.pct")} AS recommendation
        FROM util u JOIN {_ALLOCATED} a ON u.warehouse_id = a.warehouse_id""",
)
def inventory_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return marts.inventory_summary(n.utilisation(), n.recommendations(), n.forecast())


_CHANGE = """CASE WHEN scenario = 'Baseline' THEN 0.0
             ELSE ({c} - (SELECT {c} FROM base)) / (SELECT {c} FROM base) * 100 END"""


@query(
    "j16_cost_mart",
    "scenario scenario_label w_cost:1 w_carbon:1 ship_cost_usd:2 holding_cost_usd:2 total_cost_usd:2 vs_baseline_pct:2 cost_per_unit_served:4",
    f"""SELECT b.scenario, scenario_label, w_cost, w_carbon, ship_cost_usd, holding_cost_usd, total_cost_usd,
               {_CHANGE.format(c="total_cost_usd").replace("scenario =", "b.scenario =")} AS vs_baseline_pct,
               total_cost_usd / units AS cost_per_unit_served
        FROM with_base b LEFT JOIN (VALUES ('A', 1.0, 0.0), ('B', 0.6, 0.4), ('C', 0.2, 0.8)) s(scenario, w_cost, w_carbon)
          ON b.scenario = s.scenario""",
)
def cost_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return marts.cost_summary(n.stored_plan, n.baseline())


@query(
    "j16_carbon_mart",
    "scenario warehouse_id region category carbon_kg:6 units_allocated:2 carbon_per_unit_served:6 vs_baseline_pct:2 lead_time_days:i",
    f"""SELECT p.scenario, warehouse_id, region, category, p.carbon_kg, units_allocated,
               p.carbon_kg / nullif(units_allocated, 0) AS carbon_per_unit_served, vs_baseline_pct, lead_time_days
        FROM (SELECT scenario, warehouse_id, region, category, lead_time_days, carbon_kg, units_allocated FROM plan
              UNION ALL SELECT scenario, 'ALL', 'ALL', 'ALL', NULL, sum(carbon_kg), sum(units_allocated)
              FROM plan GROUP BY scenario) p
        JOIN (SELECT scenario, {_CHANGE.format(c="carbon_kg")} AS vs_baseline_pct FROM with_base) b ON p.scenario = b.scenario""",
)
def carbon_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail and ``ALL`` rows together."""
    n = network(spark, sf_dir)
    return marts.carbon_summary(n.stored_plan, n.baseline())


@query(
    "j17_best_lane",
    "warehouse_id region category score:4",
    """SELECT warehouse_id, region, category, score FROM chosen WHERE scenario = 'B' AND units_allocated > 0""",
)
def best_lane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse-to-region assignment by least cost (in place of positional pairing)."""
    plan = network(spark, sf_dir).plan()
    return plan.where((F.col("scenario") == "B") & (F.col("units_allocated") > 0))


# --- set operations and reshaping --------------------------------------------------


@query(
    "u01_key_differences",
    "side keys:l",
    f"""WITH d AS (SELECT DISTINCT sku_id FROM demand), m AS (SELECT DISTINCT sku_id FROM {_DAMAGED})
        SELECT 'demand only' AS side, count(*) AS keys FROM (SELECT * FROM d EXCEPT SELECT * FROM m)
        UNION ALL SELECT 'master only', count(*) FROM (SELECT * FROM m EXCEPT SELECT * FROM d)""",
)
def key_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    demand, master = bridge.daily_demand(spark, sf_dir), damaged_skus(spark, sf_dir)
    sides = [
        Q.keys_only_in(a, b, ["sku_id"]).agg(F.lit(name).alias("side"), F.count(F.lit(1)).alias("keys"))
        for name, a, b in (("demand only", demand, master), ("master only", master, demand))
    ]
    return sides[0].unionByName(sides[1])


@query(
    "u03_baseline_and_scenarios",
    "scenario scenario_label units:2 total_cost_usd:1 carbon_kg:3",
    "SELECT scenario, scenario_label, units, total_cost_usd, carbon_kg FROM with_base",
)
def baseline_and_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return P.with_baseline(n.stored_plan, n.baseline())


_REGION_COLUMNS = ["Africa", "America", "Asia", "Europe", "Middle East"]


def _renamed(df: DataFrame) -> DataFrame:
    """Column names without blanks."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


@query(
    "u04_lane_matrix",
    "warehouse_id africa:4 america:4 asia:4 europe:4 middle_east:4",
    "SELECT warehouse_id, " + ", ".join(
        f"max(ship_cost_per_unit) FILTER (WHERE demand_region = '{r}') AS {r.lower().replace(' ', '_')}" for r in _REGION_COLUMNS
    ) + " FROM lanes GROUP BY warehouse_id",
)
def lane_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(L.lane_matrix(bridge.lanes(spark, sf_dir), "ship_cost_per_unit", bridge.REGIONS))


@query(
    "u04_seasonality_matrix",
    "week_number:i africa:4 america:4 asia:4 europe:4 middle_east:4",
    "SELECT week_number, " + ", ".join(
        f"avg(total_units) FILTER (WHERE region = '{r}') AS {r.lower().replace(' ', '_')}" for r in _REGION_COLUMNS
    ) + " FROM weekly GROUP BY week_number",
)
def seasonality_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(W.seasonality_matrix(network(spark, sf_dir).weekly(), bridge.REGIONS))


@query(
    "u05_unpivot",
    "week_number:i region avg_units:4",
    "SELECT week_number, region, avg(total_units) AS avg_units FROM weekly GROUP BY 1, 2",
)
def unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = W.seasonality_matrix(network(spark, sf_dir).weekly(), bridge.REGIONS)
    return W.unpivot_matrix(matrix, "week_number", bridge.REGIONS, "region", "avg_units")


@query(
    "u07_text_chunks",
    "source key text",
    """SELECT 'warehouse_utilization' AS source, warehouse_id AS key,
              printf('Warehouse %s in %s holds %.0f units of capacity %d, utilisation %.2f percent, status %s.', warehouse_id, region,
                     inventory_units, capacity_units, round(round(pct, 2), 2),
                     CASE WHEN pct >= 100 THEN 'CRITICAL' WHEN pct >= 85 THEN 'HIGH' ELSE 'NORMAL' END) AS text FROM util
       UNION ALL SELECT 'warehouses', warehouse_id, printf('Warehouse %s serves %s with capacity %d units at a fixed cost of %.2f USD per day.',
                     warehouse_id, region, capacity_units, CAST(fixed_daily_cost_usd AS DOUBLE)) FROM sites
       UNION ALL SELECT 'warehouse_region_costs', warehouse_id || '->' || demand_region,
                     printf('Lane %s to %s costs %.2f USD per unit, takes %d days and scores %.4f.', warehouse_id, demand_region,
                     CAST(ship_cost_per_unit AS DOUBLE), lead_time_days, round(lane_efficiency_score, 4)) FROM lanes
       UNION ALL SELECT 'forecast_12wk_forward', region || '|' || category,
                     printf('Forecast for %s in %s: mean %.1f, lowest %.1f, highest %.1f units per week.', category, region,
                     avg(predicted_units), min(predicted_units), max(predicted_units)) FROM forecast GROUP BY region, category
       UNION ALL SELECT 'sku_master', category, printf('Category %s has %d SKUs, mean price %.2f USD, mean unit cost %.2f USD.',
                     category, count(*), round(avg(selling_price_usd), 2), round(avg(unit_cost_usd), 2)) FROM skus GROUP BY category""",
)
def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text line per entity of five tables."""
    from depotline.operators.retrieval import table_chunks

    n = network(spark, sf_dir)
    return table_chunks(n.utilisation(), n.warehouses, n.lanes, n.forecast(), n.skus)


@query(
    "a27_non_canonical_rows",
    "warehouse_id region capacity_units:l",
    "SELECT warehouse_id, region, capacity_units FROM sites",
)
def non_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered warehouse rows, repeated per supplier, that contradict the four-region network."""
    from depotline.operators.cleaning import canonical_warehouses

    delivered = bridge.raw_starting_inventory(spark, sf_dir).select(
        F.col("warehouse_id").alias("short_id")
    ).join(
        spark.createDataFrame(list(bridge.SHORT_IDS.items()), "short_id string, warehouse_id string"), "short_id"
    ).join(bridge.warehouses(spark, sf_dir), "warehouse_id")
    network_table = canonical_warehouses(spark).where(F.col("warehouse_id") != bridge.HUB)
    return non_canonical_rows(delivered, network_table)

"""Shared SQL fragments for the checks: the benchmark tables seen as supply-chain tables.

Written independently of the Spark code, in plain SQL over the parquet tables.
``with_fragments`` prepends the fragments a statement mentions, in order.
"""

from __future__ import annotations

import re
from statistics import NormalDist

_Z = "CASE {level} " + " ".join(
    f"WHEN {p} THEN {NormalDist().inv_cdf(p)!r}" for p in (0.90, 0.92, 0.95, 0.98)
) + " END"



def normal_cdf_sql(z: str, terms: int = 200) -> str:
    """Phi(z) by its power series (sum of z^(2k+1) / (2k+1)!! times the density), |z| cut at 9."""
    size = f"least(greatest(abs({z}), 1e-300), 9.0)"
    term = f"exp((2 * k + 1) * ln({size}) + k * ln(2.0) + lgamma(k + 1) - lgamma(2 * k + 2))"
    series = f"list_sum(list_transform(range(0, {terms}), lambda k: {term}))"
    return f"0.5 + sign({z}) * exp(-{size} * {size} / 2) / sqrt(2 * pi()) * {series}"


FRAGMENTS: dict[str, str] = {
    "region_dim": """
        SELECT r_regionkey, CASE r_name WHEN 'MIDDLE EAST' THEN 'Middle East'
               ELSE upper(r_name[1]) || lower(r_name[2:]) END AS region
        FROM region""",
    "lines": """
        SELECT l_orderkey, CAST(l_shipdate AS DATE) AS date, printf('SKU-%06d', l_partkey) AS sku_id, region,
               l_quantity AS units_ordered, l_extendedprice / l_quantity AS price_usd
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region_dim ON n_regionkey = r_regionkey""",
    "raw_events": """
        SELECT CAST(o_orderdate AS DATE) AS date,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 1 ELSE 0 END AS holiday_peak_flag,
               CASE WHEN o_totalprice > 490000 THEN 1 ELSE 0 END AS prime_event_flag,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS marketing_push_flag,
               o_totalprice / 250000 - 1 AS weather_disruption_index
        FROM orders""",
    "events_by_date": """
        SELECT date, max(holiday_peak_flag) AS holiday_peak_flag, max(prime_event_flag) AS prime_event_flag,
               max(marketing_push_flag) AS marketing_push_flag,
               avg(weather_disruption_index) AS weather_disruption_index
        FROM raw_events GROUP BY date""",
    "calendar": """
        SELECT *, year(date) AS year, month(date) AS month, quarter(date) AS quarter,
               weekofyear(date) AS week_number, isodow(date) - 1 AS day_of_week,
               strftime(date, '%G-W%V') AS year_week,
               CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend
        FROM events_by_date""",
    "demand": """
        SELECT l.date, sku_id, region, units_ordered, price_usd,
               coalesce(holiday_peak_flag, 0) AS holiday_peak_flag,
               coalesce(prime_event_flag, 0) AS prime_event_flag,
               coalesce(marketing_push_flag, 0) AS marketing_push_flag,
               weather_disruption_index,
               year(l.date) AS year, month(l.date) AS month, quarter(l.date) AS quarter,
               weekofyear(l.date) AS week_number, isodow(l.date) - 1 AS day_of_week,
               strftime(l.date, '%G-W%V') AS year_week,
               CASE WHEN isodow(l.date) >= 6 THEN 1 ELSE 0 END AS is_weekend
        FROM lines l LEFT JOIN events_by_date e ON l.date = e.date""",
    "raw_demand": """
        SELECT CASE WHEN l_orderkey % 101 = 7 THEN 'not-a-date' ELSE strftime(l.date, '%Y-%m-%d') END AS date,
               dayname(l.date) AS day, '01/01/1970' AS weekend_flag,
               CASE WHEN l_orderkey % 103 = 9 THEN replace(sku_id, 'SKU-', 'sku') ELSE sku_id END AS sku_id,
               CASE WHEN l_orderkey % 7 = 1 THEN lower(region)
                    WHEN l_orderkey % 7 = 2 THEN '  ' || region || ' '
                    WHEN l_orderkey % 7 = 3 THEN upper(region)
                    WHEN l_orderkey % 107 = 11 THEN 'Atlantis' ELSE region END AS region,
               CASE WHEN l_orderkey % 97 = 5 THEN 'n/a' WHEN l_orderkey % 89 = 3 THEN '0'
                    WHEN l_orderkey % 83 = 4 THEN CAST(-units_ordered AS VARCHAR)
                    ELSE CAST(units_ordered AS VARCHAR) END AS units_ordered,
               CAST(price_usd AS VARCHAR) AS price_usd,
               CASE WHEN l_orderkey % 61 = 2 THEN '2' WHEN l_orderkey % 67 = 2 THEN NULL
                    ELSE CAST(coalesce(holiday_peak_flag, 0) AS VARCHAR) END AS holiday_peak_flag,
               CAST(coalesce(prime_event_flag, 0) AS VARCHAR) AS prime_event_flag,
               CAST(coalesce(marketing_push_flag, 0) AS VARCHAR) AS marketing_push_flag,
               CAST(weather_disruption_index AS VARCHAR) AS weather_disruption_index
        FROM lines l LEFT JOIN events_by_date e ON l.date = e.date""",
    "typed_demand": """
        SELECT TRY_CAST(date AS DATE) AS date, trim(sku_id) AS sku_id,
               CASE lower(trim(region)) WHEN 'middle east' THEN 'Middle East'
                    ELSE upper(trim(region)[1]) || lower(trim(region)[2:]) END AS region,
               TRY_CAST(units_ordered AS DOUBLE) AS units_ordered, TRY_CAST(price_usd AS DOUBLE) AS price_usd,
               coalesce(TRY_CAST(holiday_peak_flag AS DOUBLE), 0) AS holiday_peak_flag,
               coalesce(TRY_CAST(prime_event_flag AS DOUBLE), 0) AS prime_event_flag,
               coalesce(TRY_CAST(marketing_push_flag AS DOUBLE), 0) AS marketing_push_flag,
               TRY_CAST(weather_disruption_index AS DOUBLE) AS weather_disruption_index
        FROM raw_demand WHERE TRY_CAST(date AS DATE) IS NOT NULL""",
    "positive_demand": """
        SELECT * FROM typed_demand WHERE units_ordered IS NULL OR units_ordered > 0""",
    "unit_cap": """
        SELECT quantile_cont(units_ordered, 0.999) AS cap FROM positive_demand""",
    "skus": """
        SELECT printf('SKU-%06d', p_partkey) AS sku_id, p_type AS category, p_retailprice * 0.6 AS unit_cost_usd,
               p_retailprice AS selling_price_usd, p_size / 10.0 AS cube_ft,
               CASE p_type WHEN 'PROMO' THEN 0.98 WHEN 'ECONOMY' THEN 0.95 WHEN 'MEDIUM' THEN 0.95
                           WHEN 'LARGE' THEN 0.92 WHEN 'SMALL' THEN 0.92 WHEN 'STANDARD' THEN 0.90 END
                 AS target_service_level,
               p_retailprice - p_retailprice * 0.6 AS gross_margin_usd,
               greatest((p_retailprice - p_retailprice * 0.6) / nullif(p_retailprice, 0), -1.0) AS margin_pct,
               p_retailprice * 2 AS stockout_penalty_usd,
               p_retailprice * 0.6 * 0.25 / 365 AS holding_cost_daily_usd,
               p_size / 10.0 * 0.028317 AS volume_m3
        FROM part""",
    "sites": """
        SELECT 'WH-' || replace(upper(region), ' ', '-') AS warehouse_id, region,
               110000 + 10000 * r_regionkey AS capacity_units, 1700.0 + 100 * r_regionkey AS fixed_daily_cost_usd
        FROM region_dim
        UNION ALL SELECT 'WH-CENTRAL', 'Central', 180000, 2600.0""",
    "lane_base": """
        SELECT 'WH-' || replace(upper(a.region), ' ', '-') AS warehouse_id, b.region AS demand_region,
               1.5 + 1.25 * abs(a.r_regionkey - b.r_regionkey) AS ship_cost_per_unit,
               1 + abs(a.r_regionkey - b.r_regionkey) AS lead_time_days,
               500.0 * (1 + abs(a.r_regionkey - b.r_regionkey)) AS distance_km_proxy
        FROM region_dim a CROSS JOIN region_dim b""",
    "lanes": """
        SELECT *, 1 - ((ship_cost_per_unit - min(ship_cost_per_unit) OVER ())
                       / (max(ship_cost_per_unit) OVER () - min(ship_cost_per_unit) OVER ())
                     + CAST(lead_time_days - min(lead_time_days) OVER () AS DOUBLE)
                       / (max(lead_time_days) OVER () - min(lead_time_days) OVER ())) / 2 AS lane_efficiency_score
        FROM lane_base""",
    "costed_lanes": """
        SELECT l.*, lead_time_days * 500.0 AS distance_km, v.vol * 200 / 1000 AS weight_tonnes,
               round_even(lead_time_days * 500.0 * (v.vol * 200 / 1000) * 0.062, 6) AS carbon_kg_per_unit
        FROM lanes l CROSS JOIN (SELECT avg(volume_m3) AS vol FROM skus) v""",
    "stock": """
        SELECT CASE WHEN s_suppkey % 10 = 0 THEN 'WH-CE' ELSE 'WH-' || upper(region[1:2]) END AS warehouse_id,
               CASE WHEN s_suppkey % 10 = 0 THEN 'WH-CENTRAL'
                    ELSE 'WH-' || replace(upper(region), ' ', '-') END AS canonical_warehouse_id,
               k.sku_id, sum(l_quantity) * 10 AS starting_inventory_units,
               sum(l_quantity) * 10 * any_value(unit_cost_usd) AS inventory_value_usd,
               sum(l_quantity) * 10 * any_value(unit_cost_usd) * (0.25 / 365) AS daily_holding_cost_usd
        FROM lineitem
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region_dim ON n_regionkey = r_regionkey
        JOIN skus k ON k.sku_id = printf('SKU-%06d', l_partkey)
        GROUP BY 1, 2, 3""",
    "master": """
        SELECT t.*, k.category, s.region, s.capacity_units
        FROM stock t LEFT JOIN skus k ON t.sku_id = k.sku_id
        LEFT JOIN sites s ON t.canonical_warehouse_id = s.warehouse_id""",
    "demand_cat": """
        SELECT d.*, k.category FROM demand d LEFT JOIN skus k ON d.sku_id = k.sku_id""",
    "weekly": """
        SELECT year_week, region, category, sum(units_ordered) AS total_units, avg(price_usd) AS avg_price_usd,
               max(holiday_peak_flag) AS holiday_peak_flag, max(prime_event_flag) AS prime_event_flag,
               max(marketing_push_flag) AS marketing_push_flag,
               avg(weather_disruption_index) AS weather_disruption,
               year(min(date)) AS year, month(min(date)) AS month, quarter(min(date)) AS quarter,
               min(week_number) AS week_number,
               CAST(date_trunc('week', min(date)) AS DATE) AS week_start
        FROM demand_cat GROUP BY year_week, region, category""",
    "residuals": """
        SELECT * FROM (
          SELECT week_start, year_week, region, category, total_units,
                 lag(total_units) OVER (PARTITION BY region, category ORDER BY week_start) AS predicted_units,
                 total_units - lag(total_units) OVER (PARTITION BY region, category ORDER BY week_start) AS residual
          FROM weekly) WHERE predicted_units IS NOT NULL""",
    "residual_stats": """
        SELECT region, category, stddev_samp(residual) AS residual_std, avg(residual) AS residual_mean,
               avg(abs(residual)) AS residual_mae, avg(total_units) AS mean_actual_demand,
               count(*) AS train_row_count, stddev_samp(residual) / avg(total_units) * 100 AS cv_pct
        FROM residuals GROUP BY region, category""",
    "forecast": """
        SELECT CAST(last_week + 7 * step AS DATE) AS week_start,
               strftime(CAST(last_week + 7 * step AS DATE), '%G-W%V') AS year_week, w.region, w.category,
               predicted_units, greatest(predicted_units - residual_std * 1.282, 0) AS predicted_units_lower,
               predicted_units + residual_std * 1.282 AS predicted_units_upper, residual_std, mean_actual_demand, cv_pct
        FROM (SELECT region, category, arg_max(total_units, week_start) AS predicted_units
              FROM weekly GROUP BY region, category) w
        CROSS JOIN (SELECT max(week_start) AS last_week FROM weekly) m
        CROSS JOIN (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS step) h
        JOIN residual_stats r ON w.region = r.region AND w.category = r.category""",
    "terms": """
        SELECT category, max(target_service_level) AS target_service_level,
               avg(holding_cost_daily_usd) AS avg_holding_cost_daily, avg(volume_m3) AS avg_volume_m3
        FROM skus GROUP BY category""",
    "safety": f"""
        SELECT *, ceil(safety_stock_units) AS safety_stock_int,
               ceil(safety_stock_units) * avg_holding_cost_daily * avg_lead_time_days AS ss_holding_cost_usd
        FROM (SELECT r.region, r.category, residual_std, avg_lead_time_days, target_service_level,
                     avg_holding_cost_daily, {_Z.format(level="target_service_level")} AS z_score,
                     {_Z.format(level="target_service_level")} * residual_std * sqrt(avg_lead_time_days) * 1.20
                       AS safety_stock_units
              FROM residual_stats r
              JOIN (SELECT demand_region AS region, avg(lead_time_days) AS avg_lead_time_days
                    FROM lanes GROUP BY demand_region) l ON r.region = l.region
              JOIN terms t ON r.category = t.category)""",
    "requirements": """
        SELECT f.region, f.category, f.mean_demand_units, s.safety_stock_int AS safety_stock_units,
               f.mean_demand_units + s.safety_stock_int AS required_units
        FROM (SELECT region, category, avg(predicted_units) AS mean_demand_units
              FROM forecast GROUP BY region, category) f
        JOIN safety s ON f.region = s.region AND f.category = s.category""",
    "options": """
        SELECT r.*, l.warehouse_id, l.ship_cost_per_unit, l.lead_time_days,
               t.avg_holding_cost_daily * l.lead_time_days AS unit_holding,
               l.ship_cost_per_unit + t.avg_holding_cost_daily * l.lead_time_days AS unit_cost,
               l.lead_time_days * 500.0 * (t.avg_volume_m3 * 200 / 1000) * 0.062 AS unit_carbon
        FROM requirements r JOIN lanes l ON r.region = l.demand_region JOIN terms t ON r.category = t.category""",
    "scored": """
        SELECT o.*, s.scenario, s.scenario_label, s.w_cost, s.w_carbon,
               s.w_cost * unit_cost / max(unit_cost) OVER () + s.w_carbon * unit_carbon / max(unit_carbon) OVER () AS score
        FROM options o CROSS JOIN (VALUES ('A', 'Cost Minimiser', 1.0::DOUBLE, 0.0::DOUBLE), ('B', 'Balanced', 0.6, 0.4),
                                          ('C', 'Carbon Champion', 0.2, 0.8)) s(scenario, scenario_label, w_cost, w_carbon)""",
    "chosen": """
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY scenario, region, category
                                               ORDER BY round(score, 12), warehouse_id) = 1
                       THEN required_units ELSE 0.0 END AS units_allocated
        FROM scored""",
    "plan": """
        SELECT *, units_allocated * ship_cost_per_unit AS ship_cost_usd,
               units_allocated * unit_holding AS holding_cost_usd,
               units_allocated * ship_cost_per_unit + units_allocated * unit_holding AS total_cost_usd,
               units_allocated * unit_carbon AS carbon_kg
        FROM chosen""",
    "base": """
        SELECT u.units, u.units * l.ship AS ship_cost_usd, h.daily * 84 AS holding_cost_usd,
               u.units * l.ship + h.daily * 84 AS total_cost_usd,
               u.tonnes * l.lead * 500.0 * 0.062 AS carbon_kg, l.ship AS mean_lane_cost, l.lead AS mean_lead_time_days
        FROM (SELECT sum(predicted_units) AS units, sum(predicted_units * avg_volume_m3 * 200 / 1000) AS tonnes
              FROM forecast f JOIN terms t ON f.category = t.category) u
        CROSS JOIN (SELECT avg(ship_cost_per_unit) AS ship, avg(lead_time_days) AS lead FROM lanes) l
        CROSS JOIN (SELECT sum(daily_holding_cost_usd) AS daily FROM stock) h""",
    "with_base": """
        SELECT 'Baseline' AS scenario, 'Current State (No Optimisation)' AS scenario_label, units, ship_cost_usd,
               holding_cost_usd, total_cost_usd, carbon_kg FROM base
        UNION ALL
        SELECT scenario, scenario_label, sum(units_allocated) * 12, sum(ship_cost_usd) * 12,
               sum(holding_cost_usd) * 12, sum(total_cost_usd) * 12, sum(carbon_kg) * 12
        FROM plan GROUP BY scenario, scenario_label""",
    "util": """
        SELECT s.warehouse_id, s.region, s.capacity_units, h.inventory_units,
               h.inventory_units * 100 / s.capacity_units AS pct,
               s.capacity_units - h.inventory_units AS available_units, h.inventory_value_usd,
               h.daily_holding_cost_usd, s.fixed_daily_cost_usd, h.sku_count
        FROM sites s JOIN (SELECT canonical_warehouse_id, sum(starting_inventory_units) AS inventory_units,
                                  sum(inventory_value_usd) AS inventory_value_usd,
                                  sum(daily_holding_cost_usd) AS daily_holding_cost_usd,
                                  count(DISTINCT sku_id) AS sku_count
                           FROM stock GROUP BY canonical_warehouse_id) h
          ON s.warehouse_id = h.canonical_warehouse_id""",
    "daily_rate": """
        SELECT region, sum(units_ordered) / (SELECT date_diff('day', min(date), max(date)) + 1 FROM demand)
                 AS avg_daily_demand
        FROM demand GROUP BY region""",
    "cover": """
        SELECT warehouse_id, s.region, inv_units, avg_daily_demand,
               round_even(inv_units / avg_daily_demand, 1) AS days_of_cover
        FROM (SELECT canonical_warehouse_id AS warehouse_id, region, sum(starting_inventory_units) AS inv_units
              FROM master WHERE region <> 'Central' GROUP BY 1, 2
              UNION ALL
              SELECT m.canonical_warehouse_id, d.region, m.units / (SELECT count(*) FROM daily_rate)
              FROM (SELECT canonical_warehouse_id, sum(starting_inventory_units) AS units
                    FROM master WHERE region = 'Central' GROUP BY 1) m CROSS JOIN daily_rate d) s
        LEFT JOIN daily_rate r ON s.region = r.region""",
    "home": """
        SELECT s.region, s.warehouse_id AS home_warehouse, s.capacity_units AS home_wh_capacity,
               s.fixed_daily_cost_usd AS home_wh_fixed_cost, l.ship_cost_per_unit AS home_ship_cost,
               l.lead_time_days AS home_lead_time, l.distance_km_proxy AS home_distance_km,
               l.lane_efficiency_score AS home_lane_efficiency
        FROM sites s LEFT JOIN lanes l ON s.warehouse_id = l.warehouse_id AND s.region = l.demand_region""",
    "short_features": """
        SELECT *, lag(total_units, 1) OVER w AS lag_1_week_demand, lag(total_units, 2) OVER w AS lag_2_week_demand,
               lag(total_units, 4) OVER w AS lag_4_week_demand,
               CASE WHEN count(*) OVER f = 4 THEN avg(total_units) OVER f END AS rolling_4wk_mean,
               CASE WHEN count(*) OVER f = 4 THEN stddev_samp(total_units) OVER f END AS rolling_4wk_std,
               lag(total_units, 1) OVER w - lag(total_units, 4) OVER w AS demand_trend
        FROM weekly
        WINDOW w AS (PARTITION BY region, category ORDER BY week_start),
               f AS (PARTITION BY region, category ORDER BY week_start ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)""",
    "modelling": """
        SELECT s.*, floor((s.week_start - (SELECT min(week_start) FROM weekly)) / 7) AS weeks_since_epoch, CAST(s.quarter = 4 AS INTEGER) AS is_q4,
               v.category_velocity, v.region_demand_rank, c.*, home_wh_capacity, home_wh_fixed_cost, home_ship_cost, home_lead_time,
               home_distance_km, home_lane_efficiency, home_lead_time * 500.0 AS carbon_distance_km, c.avg_volume_m3 * 200 / 1000 AS carbon_weight_tonnes,
               home_lead_time * 500.0 * (c.avg_volume_m3 * 200 / 1000) * 0.062 AS carbon_kg_per_unit
        FROM (SELECT * REPLACE (coalesce(weather_disruption, 0.0) AS weather_disruption) FROM short_features) s
        JOIN (SELECT region, category, u AS category_velocity, rank() OVER (PARTITION BY region ORDER BY u DESC) AS region_demand_rank
              FROM (SELECT region, category, avg(total_units) AS u FROM weekly GROUP BY 1, 2)) v
          ON s.region = v.region AND s.category = v.category
        LEFT JOIN (SELECT category AS of_category, avg(unit_cost_usd) AS avg_unit_cost_usd, avg(selling_price_usd) AS avg_selling_price_usd,
                          avg(gross_margin_usd) AS avg_gross_margin_usd, avg(margin_pct) AS avg_margin_pct, avg(cube_ft) AS avg_cube_ft,
                          avg(volume_m3) AS avg_volume_m3, avg(holding_cost_daily_usd) AS avg_holding_cost_daily, avg(stockout_penalty_usd) AS avg_stockout_penalty
                   FROM skus GROUP BY category) c ON s.category = c.of_category
        LEFT JOIN home h ON s.region = h.region""",
    "holdout": """
        SELECT *, week_start <= (SELECT max(week_start) FROM weekly) - 56 AS is_train FROM weekly""",
    "naive": """
        SELECT t.*, l.predicted_units
        FROM holdout t LEFT JOIN (SELECT region, category, arg_max(total_units, week_start) AS predicted_units
                                  FROM holdout WHERE is_train GROUP BY region, category) l
          ON t.region = l.region AND t.category = l.category
        WHERE NOT is_train""",
    "network_weeks": """
        SELECT week_start, sum(total_units) AS units, row_number() OVER (ORDER BY week_start) - 1 AS t
        FROM weekly GROUP BY week_start""",
    "unit_index": """
        SELECT vec_id, label, list_transform(embedding::DOUBLE[],
                 lambda x: x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS v
        FROM embeddings""",
    "label_queries": """
        SELECT label, list(x ORDER BY pos) AS q
        FROM (SELECT label, pos, avg(x) AS x
              FROM (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS pos
                    FROM embeddings) GROUP BY label, pos) GROUP BY label""",
    "hits": """
        SELECT * FROM (
          SELECT q.label AS query_id, i.vec_id, list_cosine_similarity(i.v, q.q) AS score,
                 row_number() OVER (PARTITION BY q.label
                                    ORDER BY round(list_cosine_similarity(i.v, q.q), 12) DESC, i.vec_id) AS rank
          FROM unit_index i CROSS JOIN label_queries q) WHERE rank <= 5""",
}


def with_fragments(statement: str) -> str:
    """Prepend the fragments used by ``statement``, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(re.findall(r"[a-z_]+", text))
        for name in FRAGMENTS:
            if name in words and name not in needed:
                needed.add(name)
                visit(FRAGMENTS[name])

    visit(statement)
    ordered = [name for name in FRAGMENTS if name in needed]
    if not ordered:
        return statement
    return "WITH " + ",\n".join(f"{name} AS ({FRAGMENTS[name]})" for name in ordered) + "\n" + statement

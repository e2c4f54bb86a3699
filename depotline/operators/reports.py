"""The reporting statements, as SQL over the business views.

``daily_demand`` needs ``date, region, category, year_week, sku_id, units_sold``;
``report_views`` produces that and the other aliased views from catalog tables,
so existing statements written against those names run unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline import settings as S
from depotline.operators.weekly import with_category


def report_views(
    demand: DataFrame,
    calendar: DataFrame,
    skus: DataFrame,
    stock: DataFrame,
    warehouses: DataFrame,
    lanes: DataFrame,
    forecast: DataFrame,
) -> dict[str, DataFrame]:
    """Catalog tables under the column names the reporting statements use."""
    return {
        "daily_demand": demand_view(demand, skus),
        "event_calendar": calendar_view(calendar),
        "sku_master": sku_view(skus),
        "starting_inventory_snapshot": stock_view(stock),
        "warehouses": warehouse_view(warehouses),
        "warehouse_region_costs": lane_view(lanes),
        "forecast_12wk_forward": forecast_view(forecast),
    }


def demand_view(demand: DataFrame, skus: DataFrame) -> DataFrame:
    return with_category(demand, skus).withColumn("units_sold", F.col("units_ordered"))


def calendar_view(calendar: DataFrame) -> DataFrame:
    return calendar.withColumns(
        {"is_holiday": F.col("holiday_peak_flag"), "is_marketing_campaign": F.col("marketing_push_flag")}
    )


def sku_view(skus: DataFrame) -> DataFrame:
    return skus.withColumn("unit_price", F.col("selling_price_usd"))


def stock_view(stock: DataFrame) -> DataFrame:
    return stock.withColumns(
        {"warehouse": F.col("canonical_warehouse_id"), "inventory_units": F.col("starting_inventory_units")}
    )


def warehouse_view(warehouses: DataFrame) -> DataFrame:
    return warehouses.withColumns(
        {"warehouse": F.col("warehouse_id"), "daily_storage_cost": F.col("fixed_daily_cost_usd")}
    )


def lane_view(lanes: DataFrame) -> DataFrame:
    return lanes.withColumns(
        {
            "warehouse": F.col("warehouse_id"),
            "shipping_cost_per_unit": F.col("ship_cost_per_unit"),
            "co2_kg_per_unit": F.col("carbon_kg_per_unit"),
        }
    )


def forecast_view(forecast: DataFrame) -> DataFrame:
    return forecast.withColumns(
        {
            "forecast_units": F.col("predicted_units"),
            "lower_pi": F.col("predicted_units_lower"),
            "upper_pi": F.col("predicted_units_upper"),
        }
    )


def weekly_units(spark: SparkSession, daily_demand: DataFrame) -> DataFrame:
    return spark.sql(
        """
        SELECT region, category, year_week, SUM(units_sold) AS weekly_units
        FROM {daily_demand}
        GROUP BY region, category, year_week
        """,
        daily_demand=daily_demand,
    )


def weekly_demand_ranking(spark: SparkSession, daily_demand: DataFrame) -> DataFrame:
    """Region-category weeks by volume within each region."""
    return spark.sql(
        """
        SELECT region, category, year_week, weekly_units,
               RANK() OVER (PARTITION BY region ORDER BY weekly_units DESC) AS region_rank
        FROM {weekly}
        ORDER BY region, region_rank, year_week, category
        """,
        weekly=weekly_units(spark, daily_demand),
    )


def event_type_summary(spark: SparkSession, daily_demand: DataFrame, event_calendar: DataFrame) -> DataFrame:
    """Average and total units on holiday, marketing and ordinary days.

    The calendar has one row per date and is sent to the demand rows.
    """
    return spark.sql(
        """
        SELECT /*+ BROADCAST(c) */
               CASE WHEN COALESCE(c.is_holiday, 0) = 1 THEN 'Holiday'
                    WHEN COALESCE(c.is_marketing_campaign, 0) = 1 THEN 'Marketing'
                    ELSE 'Non-event' END AS event_type,
               ROUND(AVG(d.units_sold), 2) AS avg_units,
               SUM(d.units_sold) AS total_units,
               COUNT(*) AS record_count
        FROM (SELECT date, units_sold FROM {daily_demand}) d
        LEFT JOIN (SELECT date, is_holiday, is_marketing_campaign FROM {event_calendar}) c ON d.date = c.date
        GROUP BY 1
        ORDER BY AVG(d.units_sold) DESC, event_type
        """,
        daily_demand=daily_demand,
        event_calendar=event_calendar,
    )


def category_revenue(spark: SparkSession, daily_demand: DataFrame, sku_master: DataFrame) -> DataFrame:
    return spark.sql(
        """
        SELECT s.category, SUM(d.units_sold * s.unit_price) AS revenue
        FROM (SELECT sku_id, units_sold FROM {daily_demand}) d
        JOIN (SELECT sku_id, category, unit_price FROM {sku_master}) s ON d.sku_id = s.sku_id
        GROUP BY s.category
        """,
        daily_demand=daily_demand,
        sku_master=sku_master,
    )


def abc_revenue(spark: SparkSession, daily_demand: DataFrame, sku_master: DataFrame) -> DataFrame:
    """Revenue, share, running share and ABC class per category.

    The ordered window sees one row per category.
    """
    return spark.sql(
        """
        WITH shares AS (
          SELECT category, revenue,
                 100.0 * revenue / SUM(revenue) OVER () AS share,
                 100.0 * SUM(revenue) OVER (ORDER BY revenue DESC, category ROWS UNBOUNDED PRECEDING)
                   / SUM(revenue) OVER () AS running
          FROM {revenue})
        SELECT category,
               ROUND(revenue, 2) AS revenue,
               ROUND(share, 2) AS revenue_share_pct,
               ROUND(running, 2) AS cumulative_share_pct,
               CASE WHEN running <= :cut_a THEN 'A' WHEN running <= :cut_b THEN 'B' ELSE 'C' END AS abc_class
        FROM shares
        ORDER BY revenue DESC, category
        """,
        args={"cut_a": S.ABC_CUTS[0], "cut_b": S.ABC_CUTS[1]},
        revenue=category_revenue(spark, daily_demand, sku_master),
    )


def capacity_pressure(spark: SparkSession, starting_inventory_snapshot: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Stock against capacity per warehouse, most loaded first."""
    return spark.sql(
        """
        WITH held AS (
          SELECT warehouse, SUM(inventory_units) AS inventory_units
          FROM {stock} GROUP BY warehouse),
        loaded AS (
          SELECT w.warehouse, h.inventory_units, w.capacity_units, w.daily_storage_cost,
                 100.0 * h.inventory_units / NULLIF(w.capacity_units, 0) AS pct
          FROM (SELECT warehouse, capacity_units, daily_storage_cost FROM {warehouses}) w
          JOIN held h ON w.warehouse = h.warehouse)
        SELECT warehouse, inventory_units, capacity_units,
               ROUND(pct, 2) AS utilisation_pct,
               ROUND(daily_storage_cost, 2) AS daily_storage_cost,
               CASE WHEN pct >= 100 THEN 'CRITICAL' WHEN pct >= 85 THEN 'HIGH' ELSE 'NORMAL' END AS utilisation_status
        FROM loaded
        ORDER BY pct DESC, warehouse
        """,
        stock=starting_inventory_snapshot,
        warehouses=warehouses,
    )


def lane_ranking(spark: SparkSession, warehouse_region_costs: DataFrame) -> DataFrame:
    """Lanes into each region, cheapest first, greener lane first among equals."""
    return spark.sql(
        """
        SELECT demand_region, warehouse,
               ROUND(shipping_cost_per_unit, 4) AS shipping_cost_per_unit,
               ROUND(co2_kg_per_unit, 4) AS co2_kg_per_unit,
               RANK() OVER (PARTITION BY demand_region
                            ORDER BY shipping_cost_per_unit, co2_kg_per_unit) AS lane_rank
        FROM {lanes}
        ORDER BY demand_region, lane_rank, warehouse
        """,
        lanes=warehouse_region_costs,
    )


def forecast_rollup(spark: SparkSession, forecast_12wk_forward: DataFrame) -> DataFrame:
    """Forward demand and mean interval bounds per region and category."""
    return spark.sql(
        """
        SELECT region, category,
               ROUND(SUM(forecast_units), 2) AS total_forecast_units,
               ROUND(AVG(lower_pi), 2) AS avg_lower_pi,
               ROUND(AVG(upper_pi), 2) AS avg_upper_pi
        FROM {forecast}
        GROUP BY region, category
        ORDER BY SUM(forecast_units) DESC, region, category
        """,
        forecast=forecast_12wk_forward,
    )

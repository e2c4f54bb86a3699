"""Stock on hand: master table, cover, utilisation, value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from depotline import settings as S
from depotline.functions.calendar import inclusive_days
from depotline.functions.numeric import ratio


def inventory_master(stock: DataFrame, skus: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Stock rows with category, warehouse region and capacity; no stock row is lost."""
    sites = warehouses.select(
        F.col("warehouse_id").alias("canonical_warehouse_id"), "region", "capacity_units"
    )
    return stock.join(skus.select("sku_id", "category"), "sku_id", "left").join(
        sites, "canonical_warehouse_id", "left"
    )


def average_daily_demand(demand: DataFrame) -> DataFrame:
    """Units per calendar day and region over the whole span of the data.

    One pass over demand: the span is read off the per-region rows.
    """
    totals = demand.where(F.col("region").isNotNull()).groupBy("region").agg(
        F.sum("units_ordered").alias("units"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    regions = Window.partitionBy()
    days = inclusive_days(F.min("first").over(regions), F.max("last").over(regions))
    return totals.select("region", ratio(F.col("units"), days).alias("avg_daily_demand"))


def units_by_site(stock: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Units held at each site, with its region; stock is summed before the sites are joined."""
    held = stock.groupBy("canonical_warehouse_id").agg(F.sum("starting_inventory_units").alias("inv_units"))
    sites = warehouses.select(F.col("warehouse_id").alias("canonical_warehouse_id"), "region")
    return held.join(sites, "canonical_warehouse_id", "left").select("canonical_warehouse_id", "region", "inv_units")


def spread_hub(sites: DataFrame, regions: DataFrame, hub_region: str = S.HUB_REGION) -> DataFrame:
    """Fan hub stock out evenly over the demand regions; other sites keep their own.

    The region list is a dimension with a handful of entries, carried as one
    array, so the fan-out is a plain row expansion.
    """
    served = regions.where(F.col("region") != hub_region).agg(F.array_sort(F.collect_set("region"))).scalar()
    is_hub = F.col("region") == hub_region
    spread = sites.withColumn("_served", served).withColumn(
        "_targets", F.when(is_hub, F.col("_served")).otherwise(F.array("region"))
    )
    return spread.select(
        F.col("canonical_warehouse_id").alias("warehouse_id"),
        F.explode("_targets").alias("region"),
        (F.col("inv_units") / F.size("_targets")).alias("inv_units"),
    )


def days_of_cover(by_site: DataFrame, demand: DataFrame, hub_region: str = S.HUB_REGION) -> DataFrame:
    """Units by site (``units_by_site``) divided by average daily demand, per warehouse and region served."""
    daily = average_daily_demand(demand)
    sites = spread_hub(by_site, daily, hub_region)
    cover = F.when(F.col("avg_daily_demand") > 0, ratio(F.col("inv_units"), F.col("avg_daily_demand")))
    return sites.join(daily, "region", "left").select(
        "warehouse_id", "region", "inv_units", "avg_daily_demand", F.bround(cover, 1).alias("days_of_cover")
    )


def cover_zone(days: Column) -> Column:
    return (
        F.when(days < S.COVER_RISK_DAYS, "at_risk")
        .when(days < S.COVER_HEALTHY_DAYS, "watch")
        .when(days.isNotNull(), "healthy")
    )


def cover_report(cover: DataFrame) -> DataFrame:
    """Cover per site with its label and zone, lowest first."""
    return cover.select(
        F.concat_ws(" -> ", "warehouse_id", "region").alias("label"),
        "warehouse_id",
        "region",
        "days_of_cover",
        cover_zone(F.col("days_of_cover")).alias("zone"),
    ).orderBy(F.col("days_of_cover").asc_nulls_last(), "label")


def cover_summary(cover: DataFrame) -> DataFrame:
    zone = cover_zone(F.col("days_of_cover"))
    return cover.agg(
        F.min("days_of_cover").alias("min_cover"),
        F.max("days_of_cover").alias("max_cover"),
        F.avg("days_of_cover").alias("mean_cover"),
        F.count_if(zone == "at_risk").alias("at_risk"),
        F.count_if(zone == "watch").alias("watch"),
        F.count_if(zone == "healthy").alias("healthy"),
    )


def network_days_of_cover(utilisation: DataFrame, weekly_demand: Column) -> DataFrame:
    """Cover of each site against an equal share of the network's weekly demand."""
    sites = utilisation.agg(F.count(F.lit(1))).scalar()
    return utilisation.withColumn(
        "days_of_cover", F.round(ratio(F.col("inventory_units"), weekly_demand / sites) * 7, 1)
    )


def units_matrix(master: DataFrame, categories: list[str]) -> DataFrame:
    """Warehouses by categories, empty cells 0; the category list is given, not scanned."""
    return (
        master.groupBy("canonical_warehouse_id").pivot("category", categories)
        .agg(F.sum("starting_inventory_units")).na.fill(0.0)
    )


def warehouse_totals(master: DataFrame) -> DataFrame:
    totals = master.groupBy("canonical_warehouse_id").agg(
        F.sum("starting_inventory_units").alias("total_units"),
        F.round(F.sum("inventory_value_usd"), 0).alias("total_value"),
        F.max("capacity_units").alias("capacity"),
    )
    return totals.withColumn("utilisation_pct", F.round(ratio(F.col("total_units") * 100, F.col("capacity")), 1))


def category_value(master: DataFrame) -> DataFrame:
    return master.groupBy("category").agg(
        F.round(F.sum("inventory_value_usd"), 2).alias("total_value"),
        F.round(F.sum("daily_holding_cost_usd"), 2).alias("total_holding_cost"),
        F.sum("starting_inventory_units").alias("total_units"),
    ).orderBy(F.col("total_value").desc(), "category")


def portfolio(master: DataFrame) -> DataFrame:
    return master.agg(
        F.count(F.lit(1)).alias("stock_rows"),
        F.count_distinct("sku_id").alias("skus"),
        F.sum("starting_inventory_units").alias("total_units"),
        F.round(F.sum("inventory_value_usd"), 2).alias("total_value"),
        F.round(F.sum("daily_holding_cost_usd"), 2).alias("total_holding_cost"),
        F.round(F.avg("inventory_value_usd"), 4).alias("mean_row_value"),
    )


def utilisation_status(percent: Column) -> Column:
    return (
        F.when(percent >= S.UTILISATION_CRITICAL, "CRITICAL")
        .when(percent >= S.UTILISATION_HIGH, "HIGH")
        .otherwise("NORMAL")
    )


def warehouse_utilisation(stock: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Per warehouse: stock, value, holding cost, SKUs, free units and load status."""
    held = stock.groupBy(F.col("canonical_warehouse_id").alias("warehouse_id")).agg(
        F.sum("starting_inventory_units").alias("inventory_units"),
        F.sum("inventory_value_usd").alias("inventory_value_usd"),
        F.sum("daily_holding_cost_usd").alias("daily_holding_cost_usd"),
        F.count_distinct("sku_id").alias("sku_count"),
    )
    load = ratio(F.col("inventory_units") * 100, F.col("capacity_units"))
    return warehouses.join(held, "warehouse_id").select(
        "warehouse_id",
        "region",
        "capacity_units",
        "inventory_units",
        F.round(load, 2).alias("utilization_pct"),
        (F.col("capacity_units") - F.col("inventory_units")).alias("available_units"),
        utilisation_status(load).alias("status"),
        F.round("inventory_value_usd", 2).alias("inventory_value_usd"),
        F.round("daily_holding_cost_usd", 4).alias("daily_holding_cost_usd"),
        "fixed_daily_cost_usd",
        "sku_count",
    )

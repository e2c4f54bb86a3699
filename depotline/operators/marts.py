"""Reporting marts: demand, forecast, inventory, cost and carbon summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from depotline import settings as S
from depotline.functions.numeric import ratio
from depotline.operators.evaluation import tag_interval, year_over_year
from depotline.operators.inventory import network_days_of_cover
from depotline.operators.planning import carbon_comparison, cost_to_serve, placement_rollup, scenario_dimension
from depotline.operators.weekly import SEGMENT


def demand_summary(weekly: DataFrame) -> DataFrame:
    """Weekly demand with flags and growth over the same week of the year before."""
    return year_over_year(weekly).select(
        "year_week", *SEGMENT, "total_units", *S.EVENT_FLAGS, F.round("demand_yoy_growth_pct", 4).alias("demand_yoy_growth_pct")
    )


def forecast_summary(forecast: DataFrame) -> DataFrame:
    tagged = tag_interval(forecast)
    bounds = ["predicted_units", "predicted_units_lower", "predicted_units_upper", "ci_width"]
    return tagged.select(
        F.col("year_week").alias("week_label"), *SEGMENT, *[F.round(c, 2).alias(c) for c in bounds], "forecast_type"
    )


def inventory_summary(utilisation: DataFrame, recommendations: DataFrame, forecast: DataFrame) -> DataFrame:
    """Stock position against the optimised plan, with network cover and the advice text."""
    per_week = forecast.groupBy("week_start").agg(F.sum("predicted_units").alias("u"))
    demand = per_week.agg(F.avg("u")).scalar()
    plan = recommendations.select(
        "warehouse_id",
        F.col("allocated_units").alias("optimised_allocation_units"),
        F.round("utilisation_pct", 4).alias("optimised_utilisation_pct"),
        "recommendation",
    )
    return network_days_of_cover(utilisation, demand).join(plan, "warehouse_id", "left").select(
        "warehouse_id",
        F.col("region").alias("home_region"),
        "capacity_units",
        F.col("inventory_units").alias("starting_inventory_units"),
        F.col("utilization_pct").alias("starting_utilisation_pct"),
        F.round("optimised_allocation_units", 2).alias("optimised_allocation_units"),
        "optimised_utilisation_pct",
        "recommendation",
        "days_of_cover",
        "daily_holding_cost_usd",
    )


def cost_summary(plan: DataFrame, base: DataFrame) -> DataFrame:
    """Baseline and scenarios with their weights (none for the baseline)."""
    weights = scenario_dimension(plan.sparkSession).select("scenario", "w_cost", "w_carbon")
    return cost_to_serve(plan, base).join(weights, "scenario", "left").select(
        "scenario",
        "scenario_label",
        "w_cost",
        "w_carbon",
        *[
            F.round(c, 2).alias(c)
            for c in ("ship_cost_usd", "holding_cost_usd", "total_cost_usd", "vs_baseline_usd", "vs_baseline_pct")
        ],
        F.round("cost_per_unit_served", 4).alias("cost_per_unit_served"),
        "recommended",
    )


def carbon_summary(plan: DataFrame, base: DataFrame) -> DataFrame:
    """Carbon per lane and category plus the ``ALL`` rows, with the scenario's change on baseline."""
    change = carbon_comparison(plan, base).select("scenario", "vs_baseline_pct")
    return placement_rollup(plan).join(change, "scenario", "left").select(
        "scenario",
        "warehouse_id",
        "region",
        "category",
        F.round("carbon_kg", 6).alias("carbon_kg"),
        F.round("units_allocated", 2).alias("units_allocated"),
        F.round("carbon_per_unit_served", 6).alias("carbon_per_unit_served"),
        F.round("vs_baseline_pct", 2).alias("vs_baseline_pct"),
        "lead_time_days",
    )


def safety_matrix(stock: DataFrame, categories: list[str]) -> DataFrame:
    """Regions by categories, summed safety stock, empty cells 0."""
    return stock.groupBy("region").pivot("category", categories).agg(F.sum("safety_stock_int")).na.fill(0)


def forecast_overview(forecast: DataFrame) -> DataFrame:
    """Headline numbers of the forward forecast."""
    return forecast.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum("predicted_units"), 2).alias("total_units"),
        F.round(F.avg("predicted_units"), 4).alias("mean_units"),
        F.round(F.min("predicted_units"), 4).alias("min_units"),
        F.round(F.max("predicted_units"), 4).alias("max_units"),
        F.round(ratio(F.sum("predicted_units"), F.count_distinct("week_start")), 4).alias("units_per_week"),
    )

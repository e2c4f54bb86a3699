"""Warehouse-to-region lanes: efficiency, carbon, extremes, matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from depotline import settings as S
from depotline.functions.numeric import mean_of, ratio

_FLAT = 1e-9


def min_max_scaled(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    """Column expressions scaled to [0, 1]; a constant column scales to 0.

    The limits come from one scalar subquery over all columns, not from a window
    over the whole table.
    """
    limits = df.agg(
        F.struct(
            *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
            *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
        )
    ).scalar()
    scaled = {}
    for c in columns:
        low, spread = limits[f"lo_{c}"], limits[f"hi_{c}"] - limits[f"lo_{c}"]
        scaled[c] = F.when(spread < _FLAT, 0.0).otherwise(ratio(F.col(c) - low, spread))
    return scaled


def add_lane_efficiency(
    df: DataFrame,
    metrics: list[str] | None = None,
    invert: bool = False,
    output: str = "lane_efficiency_score",
) -> DataFrame:
    """Mean of the min-max scaled metrics that are present.

    Lower is better by default; ``invert`` publishes 1 as the best lane.
    """
    wanted = metrics or ["ship_cost_per_unit", "carbon_kg_per_unit", "lead_time_days"]
    present = [m for m in wanted if m in df.columns]
    if not present:
        return df.withColumn(output, F.lit(None).cast("double"))
    score = mean_of(list(min_max_scaled(df, present).values()))
    return df.withColumn(output, F.lit(1.0) - score if invert else score)


def add_carbon(
    lanes: DataFrame,
    skus: DataFrame,
    km_per_day: float = S.KM_PER_LEAD_DAY,
    density: float = S.FREIGHT_KG_PER_M3,
    factor: float = S.KG_CO2_PER_TONNE_KM,
) -> DataFrame:
    """Carbon per unit on each lane for the average SKU volume, six decimals."""
    volume = skus.agg(F.avg("volume_m3")).scalar()
    return lanes.withColumns(
        {"distance_km": F.col("lead_time_days") * km_per_day, "weight_tonnes": volume * density / 1000}
    ).withColumn("carbon_kg_per_unit", F.bround(F.col("distance_km") * F.col("weight_tonnes") * factor, 6))


def join_warehouse_columns(lanes: DataFrame, warehouses: DataFrame) -> DataFrame:
    site = warehouses.select("warehouse_id", "region", "fixed_daily_cost_usd", "capacity_units")
    return lanes.join(site, "warehouse_id", "left")


def lane_extremes(lanes: DataFrame) -> DataFrame:
    """Cheapest, costliest, fastest, slowest, greenest and dirtiest lane, ties by key."""
    cases = [
        ("cheapest", "ship_cost_per_unit", F.min),
        ("costliest", "ship_cost_per_unit", F.max),
        ("fastest", "lead_time_days", F.min),
        ("slowest", "lead_time_days", F.max),
        ("greenest", "carbon_kg_per_unit", F.min),
        ("dirtiest", "carbon_kg_per_unit", F.max),
    ]
    keys = [F.col("warehouse_id"), F.col("demand_region")]
    found = []
    for label, metric, pick in cases:
        value = F.col(metric).cast("double").alias("value")
        # The smallest key must win ties in both directions, so a maximum is
        # taken as the minimum of the negated metric.
        signed = value if pick is F.min else -value
        best = F.min(F.struct(signed.alias("signed"), *keys, value))
        found.append(F.struct(F.lit(label).alias("lane"), F.lit(metric).alias("metric"), best.alias("best")))
    return lanes.agg(F.explode(F.array(*found)).alias("x")).select(
        "x.lane", "x.metric", "x.best.warehouse_id", "x.best.demand_region", "x.best.value"
    )


def efficiency_by_warehouse(lanes: DataFrame) -> DataFrame:
    return lanes.groupBy("warehouse_id").agg(F.avg("lane_efficiency_score").alias("mean_efficiency"))


def efficiency_summary(lanes: DataFrame) -> DataFrame:
    """Best and worst warehouse by mean efficiency, perfect and zero lane counts."""
    means = efficiency_by_warehouse(lanes)
    best = F.min(F.struct(-F.col("mean_efficiency"), F.col("warehouse_id")))
    worst = F.min(F.struct(F.col("mean_efficiency"), F.col("warehouse_id")))
    counts = lanes.agg(
        F.struct(
            F.count_if(F.col("lane_efficiency_score") == 1.0).alias("perfect"),
            F.count_if(F.col("lane_efficiency_score") == 0.0).alias("zero"),
        )
    ).scalar()
    return means.agg(
        best["warehouse_id"].alias("best_warehouse"),
        F.round(F.max("mean_efficiency"), 4).alias("best_score"),
        worst["warehouse_id"].alias("worst_warehouse"),
        F.round(F.min("mean_efficiency"), 4).alias("worst_score"),
    ).withColumn("c", counts).select(
        "best_warehouse", "best_score", "worst_warehouse", "worst_score",
        F.col("c.perfect").alias("perfect_lanes"), F.col("c.zero").alias("zero_lanes"),
    )


def lane_matrix(lanes: DataFrame, value: str, regions: list[str]) -> DataFrame:
    """Warehouses by demand regions; the column list is fixed, so no extra scan."""
    return lanes.groupBy("warehouse_id").pivot("demand_region", regions).agg(F.first(value))


def expected_lanes(warehouses: DataFrame, regions: list[str]) -> DataFrame:
    """Every warehouse with every demand region, by expanding the region list."""
    names = F.array(*[F.lit(r) for r in regions])
    return warehouses.select("warehouse_id", F.explode(names).alias("demand_region"))

"""ABC-XYZ segmentation by value share and demand variability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from depotline import settings as S
from depotline.functions.numeric import ratio
from depotline.functions.text import remap
from depotline.operators.prefix import running_totals
from depotline.session import store


def category_base(demand: DataFrame, units: str, revenue: str | None = None, key: str = "category") -> DataFrame:
    """Revenue, mean and sample deviation of units per category; one row has deviation 0.

    Without a revenue column, units stand in for it.
    """
    return demand.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(revenue or units).alias("revenue"),
        F.avg(units).alias("demand_mean"),
        F.coalesce(F.stddev_samp(units), F.lit(0.0)).alias("demand_std"),
    )


def banded(value: Column, cuts: tuple[float, float], labels: str) -> Column:
    low, high = cuts
    return F.when(value <= low, labels[0]).when(value <= high, labels[1]).otherwise(labels[2])


def add_revenue_shares(base: DataFrame, key: str = "category") -> DataFrame:
    """Share and running share of revenue, largest first, ties by key.

    ``base`` has one row per key, a handful of categories or all SKUs; it is stored,
    since total and running total both read it.
    """
    base = store(base, "shares")
    total = base.agg(F.sum("revenue")).scalar()
    shared = running_totals(base, "revenue", {"_running": "revenue"}, descending=True, tie_break=[key])
    return shared.withColumns(
        {
            "revenue_share_pct": ratio(F.col("revenue") * 100, total),
            "cumulative_share_pct": ratio(F.col("_running") * 100, total),
        }
    ).drop("_running")


def classify_abc_xyz(
    demand: DataFrame,
    units: str,
    revenue: str | None = None,
    key: str = "category",
    abc_cuts: tuple[float, float] = S.ABC_CUTS,
    xyz_cuts: tuple[float, float] = S.XYZ_CUTS,
    separator: str = "|",
) -> DataFrame:
    """Value class from the running revenue share, stability class from the raw CV."""
    base = add_revenue_shares(category_base(demand, units, revenue, key), key)
    cv = F.when(F.col("demand_mean") > 0, ratio(F.col("demand_std") * 100, F.col("demand_mean"))).otherwise(0.0)
    return (
        base.withColumn("cv", cv)
        .withColumn("abc_class", banded(F.col("cumulative_share_pct"), abc_cuts, "ABC"))
        .withColumn("xyz_class", banded(F.col("cv"), xyz_cuts, "XYZ"))
        .withColumn("abc_xyz_class", F.concat_ws(separator, "abc_class", "xyz_class"))
    )


def classify_by_forecast(
    base: DataFrame,
    residuals: DataFrame,
    forecast: DataFrame,
    abc_cuts: tuple[float, float] = S.ABC_CUTS,
    xyz_cut: float = S.XYZ_RESIDUAL_CUT,
) -> DataFrame:
    """Published variant: CV is mean residual deviation over mean forecast, X below the cut.

    ``base`` holds revenue per category, ``residuals`` a residual deviation per
    segment and ``forecast`` the forward forecast rows.
    """
    spread = residuals.groupBy("category").agg(F.avg("residual_std").alias("residual_std_mean"))
    level = forecast.groupBy("category").agg(F.avg("predicted_units").alias("mean_demand"))
    joined = add_revenue_shares(base.select("category", "revenue")).join(spread, "category", "left").join(
        level, "category", "left"
    )
    cv_pct = ratio(F.col("residual_std_mean") * 100, F.col("mean_demand"))
    return (
        joined.withColumn("cv_pct", cv_pct)
        .withColumn("abc_class", banded(F.col("cumulative_share_pct"), abc_cuts, "ABC"))
        .withColumn("xyz_class", banded(F.col("cv_pct"), (xyz_cut, 2 * xyz_cut), "XYZ"))
        .withColumn("abc_xyz", F.concat("abc_class", "xyz_class"))
        .withColumn("strategy", strategy(F.col("abc_xyz")))
    )


def strategy(label: Column, texts: dict[str, str] | None = None) -> Column:
    """Replenishment strategy for a class pair; pairs without a published text stay null."""
    found = remap(label, texts or S.STRATEGIES)
    return F.when(found != label, found)

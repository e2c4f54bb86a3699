"""Running totals and value counts without a global sort task.

An ``over (order by ...)`` window without a partition key pulls its whole input
into one task. Here the rows are dealt into ranges of the order, ties included,
whose bounds Spark draws by sampling, so ranges hold about as many rows each for
any distribution. The dealt rows are stored, since another draw would give other
bounds. Totals per range (one row each) give every range its offset; the exact
running total is then computed inside the ranges, in parallel.

Callers aggregate to one row per value first, or give a ``tie_break``, so that
ties can be dealt out too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from depotline.operators.brackets import exact_percentiles  # noqa: F401 - also known by this module's name
from depotline.session import store


def running_totals(
    df: DataFrame,
    order_by: str,
    totals: dict[str, str],
    descending: bool = False,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Add inclusive running sums of ``totals`` (output name -> input column).

    ``order_by`` is a non-null numeric column; rows that share a value
    are ordered by ``tie_break``.
    """
    key = -F.col(order_by).cast("double") if descending else F.col(order_by).cast("double")
    order = ["_key", *(tie_break or [])]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_key", key).repartitionByRange(ranges, *order)
    ranged = store(dealt.withColumn("_range", F.spark_partition_id()), "ranges")

    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{out}") for out, c in totals.items()])
    offsets = offsets.select(
        F.col("_range"), *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_o_{out}") for out in totals]
    )
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = {out: F.sum(c).over(within) + F.col(f"_o_{out}") for out, c in totals.items()}
    helpers = ["_key", "_range", *[f"_o_{out}" for out in totals]]
    return ranged.join(offsets, "_range").withColumns(running).drop(*helpers)


def value_counts_running(df: DataFrame, column: str) -> DataFrame:
    """One row per distinct non-null value: ``value, n, upto`` (rows at or below it).

    Running counts are stored: the input is read twice at most (once for the bounds
    of the ranges), and callers may use the result several times.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return store(running_totals(counts, "value", {"upto": "n"}), "running_counts")


def pick_percentiles(shares: list[float], rows: Column, upto: str = "upto") -> list[Column]:
    """Aggregates giving linearly interpolated percentiles from a running count table.

    The value at zero-based position k is the smallest one with more than k rows
    at or below it. ``rows`` is the total row count.
    """
    picks = []
    for share in shares:
        position = (rows - 1) * F.lit(share)
        low = F.min(F.when(F.col(upto) > F.floor(position), F.col("value")))
        high = F.min(F.when(F.col(upto) > F.ceil(position), F.col("value")))
        picks.append(low + (high - low) * (F.max(position) - F.floor(F.max(position))))
    return picks

"""Weekly grain kept up to date from arriving demand files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from depotline import settings as S
from depotline.operators.cleaning import coerce_flags
from depotline.operators.weekly import SEGMENT

# Windows align to the epoch, a Thursday; four days later is a Monday.
_MONDAY = "4 days"


def weekly_units(demand: DataFrame, lateness: str = "14 days") -> DataFrame:
    """Units and flags per Monday week, region and category of a demand stream.

    ``demand`` carries ``date, region, category, units_ordered`` and the event
    flags. A week is final once the watermark passes its end; the state held is
    one row per open week and segment.
    """
    stamped = coerce_flags(demand, S.EVENT_FLAGS).withColumn("_at", F.col("date").cast("timestamp"))
    grouped = stamped.withWatermark("_at", lateness).groupBy(
        F.window("_at", "7 days", startTime=_MONDAY).alias("w"), *SEGMENT
    )
    return grouped.agg(
        F.sum("units_ordered").alias("total_units"), *[F.max(flag).alias(flag) for flag in S.EVENT_FLAGS]
    ).select(F.to_date("w.start").alias("week_start"), *SEGMENT, "total_units", *S.EVENT_FLAGS)


def write_weekly(demand: DataFrame, path: str, checkpoint: str, lateness: str = "14 days") -> StreamingQuery:
    """Append finished weeks to a parquet table; restarts resume from the checkpoint."""
    return (
        weekly_units(demand, lateness).writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )

"""Command line: ``python -m depotline.plans.run clean|marts <root>``.

``marts --job NAME`` resumes: after a lost driver the same command reads the stages that were complete.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from depotline.plans.cleaning import clean_dataset
from depotline.plans.network import Network
from depotline.session import build_session, drop_stages
from depotline.sources import catalog, sinks
from depotline.sources.audit import summarise_log
from depotline.stages import Job

# SKU master first: stock values need its unit costs.
CLEANING_ORDER = [
    "sku_master",
    "warehouses",
    "warehouse_region_costs",
    "event_calendar",
    "daily_demand",
    "starting_inventory",
]


def clean_all(spark: SparkSession, root: str, fmt: str = "parquet") -> None:
    for name in CLEANING_ORDER:
        summarise_log(clean_dataset(spark, root, name, fmt)).show(truncate=False)


def export_marts(spark: SparkSession, root: str, fmt: str = "parquet", job: str | None = None) -> dict[str, str]:
    """Cleaned tables to the five exports; with a ``job`` name, resumable until all five are written."""
    stages = Job(spark, job, [catalog.path_of(root, name, "processed") for name in CLEANING_ORDER], fmt) if job else None
    paths = sinks.write_marts(Network.from_catalog(spark, root, fmt, stages).marts(), f"{root}/marts", fmt)
    if stages:
        stages.close()
    return paths


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stage", choices=["clean", "marts"])
    parser.add_argument("root")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--job", help="name under which stages of marts are kept until it succeeds")
    args = parser.parse_args()
    spark = build_session("depotline-" + args.stage)
    try:
        if args.stage == "clean":
            clean_all(spark, args.root, args.format)
        else:
            export_marts(spark, args.root, args.format, args.job)
    finally:
        drop_stages(spark)


if __name__ == "__main__":
    main()

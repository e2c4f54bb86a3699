"""Writers for processed tables, interim stages, logs and BI exports."""

from __future__ import annotations

from posixpath import join

from pyspark.sql import DataFrame

from depotline.sources.catalog import path_of


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, mode: str = "overwrite"
) -> str:
    """Distributed write: one file set per task, never gathered on one node."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_processed(
    df: DataFrame, name: str, root: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> str:
    return write_table(df, path_of(root, name, "processed"), fmt, partition_by)


def write_interim(df: DataFrame, name: str, root: str) -> DataFrame:
    """Write a stage and carry on from the files, so later steps do not recompute it."""
    path = write_table(df, path_of(root, name, "interim"))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_log(log: DataFrame, name: str, root: str) -> str:
    return write_table(log, path_of(root, name, "logs"), mode="append")


def write_marts(marts: dict[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """One export per mart, ``pbi_<name>`` below ``root``."""
    return {name: write_table(df, join(root, f"pbi_{name}"), fmt) for name, df in marts.items()}


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Bucketed table: later joins and groupings on ``keys`` need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)

"""Scans: raw text, typed files, required-column loads, optional inputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from depotline.sources.catalog import dataset, path_of


def read_raw(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Raw CSV with every column as text, so that no value is lost on read."""
    return read_raw_file(spark, path_of(root, name, "raw"), dataset(name).raw_schema)


def read_raw_file(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_typed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Typed scan; the schema is given, never inferred."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return reader.format(fmt).load(path)


def read_processed(spark: SparkSession, name: str, root: str, fmt: str = "parquet") -> DataFrame:
    return read_typed(spark, path_of(root, name, "processed"), dataset(name).contract, fmt)


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """An absent input reads as an empty table of the same shape."""
    try:
        return read_typed(spark, path, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def require_columns(df: DataFrame, columns: Iterable[str], label: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{label} lacks columns {missing}; it has {df.columns}")
    return df


def load_tables(
    spark: SparkSession, root: str, required: dict[str, Iterable[str]], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Several processed tables at once, each checked for the columns its user needs."""
    return {
        name: require_columns(read_processed(spark, name, root, fmt), columns, name)
        for name, columns in required.items()
    }


def resolve_alias(df: DataFrame, target: str, candidates: Iterable[str]) -> DataFrame:
    """Give the first present candidate the canonical name; error if none is there."""
    names = [target, *candidates]
    found = next((c for c in names if c in df.columns), None)
    if found is None:
        raise ValueError(f"none of {names} found in {df.columns}")
    return df if found == target else df.withColumnRenamed(found, target)

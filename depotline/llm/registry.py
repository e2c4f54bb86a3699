"""Queries of this subpackage and, where SQL can express them, their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
CHECKS: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = build
        if sql:
            CHECKS[key] = sql
        return build

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

"""Registration of workload queries and their checks.

A query names its output columns once, in a small spec that both sides share:
``name`` as is, ``name:4`` rounded to four digits, ``name:4t`` the same after a
shift by a fifth of the last digit, ``name:i`` int, ``name:l`` bigint, ``name:d``
date, ``name:s`` string, ``name:b`` boolean.

The shifted form is for averages of few prices: their exact value often lies on
a rounding boundary, where the order of summation would decide.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from depotline.workload.fragments import with_fragments

Build = Callable[[SparkSession, str], DataFrame]

_SPARK_TYPES = {"i": "int", "l": "bigint", "d": "date", "s": "string", "b": "boolean"}
_SQL_TYPES = {"i": "INTEGER", "l": "BIGINT", "d": "DATE", "s": "VARCHAR", "b": "BOOLEAN"}


@dataclass(frozen=True)
class Query:
    key: str
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def _fields(spec: str) -> list[tuple[str, str]]:
    return [tuple((item + ":").split(":")[:2]) for item in spec.split()]


def _digits(kind: str) -> tuple[int, float] | None:
    """Digits to round to and the shift to add first, if ``kind`` asks for rounding."""
    if not kind[:1].isdigit():
        return None
    digits = int(kind.rstrip("t"))
    return digits, 2.0 * 10.0 ** -(digits + 1) if kind.endswith("t") else 0.0


def spark_columns(spec: str) -> list[Column]:
    columns = []
    for name, kind in _fields(spec):
        column = F.col(name)
        if rounding := _digits(kind):
            digits, shift = rounding
            column = F.round(column.cast("double") + shift if shift else column.cast("double"), digits)
        elif kind:
            column = column.cast(_SPARK_TYPES[kind])
        columns.append(column.alias(name))
    return columns


def sql_columns(spec: str) -> str:
    parts = []
    for name, kind in _fields(spec):
        text = name
        if rounding := _digits(kind):
            digits, shift = rounding
            # Adding zero turns a rounded -0.0 into 0.0.
            text = f"ROUND(CAST({name} AS DOUBLE) + {shift:.{digits + 1}f}, {digits}) + 0.0"
        elif kind:
            text = f"CAST({name} AS {_SQL_TYPES[kind]})"
        parts.append(f"{text} AS {name}")
    return ", ".join(parts)


def query(key: str, spec: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register the decorated builder. ``sql`` may use the shared fragments by name."""

    def register(build: Build) -> Build:
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(spark, sf_dir).select(*spark_columns(spec))

        check = with_fragments(f"SELECT {sql_columns(spec)} FROM ({sql}) AS result") if sql else None
        QUERIES[key] = Query(key, run, check)
        return build

    return register

"""Data-quality checks.

Rules on one table are evaluated together in a single aggregation pass. Reports
are small DataFrames (one row per rule or finding); ``enforce`` is the only
place that runs a job and raises.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from depotline import settings as S
from depotline.functions.numeric import is_true
from depotline.functions.text import standard_text
from depotline.operators.cleaning import outside_range


class QualityError(ValueError):
    """A hard rule failed."""


@dataclass(frozen=True)
class Rule:
    """Rows for which ``bad`` holds break the rule.

    ``tolerate`` is the bad share up to which the rule still passes;
    ``severity`` is the status reported beyond it. ``shown`` is the value quoted
    as evidence (smallest and largest offender, so the sample stays bounded).
    """

    name: str
    bad: Column
    shown: Column
    severity: str = "WARN"
    tolerate: float = 0.0


def check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule from one pass over ``df``."""
    rows = F.count(F.lit(1))
    found = []
    for rule in rules:
        bad = is_true(rule.bad)
        hits = F.count_if(bad)
        evidence = F.when(bad, rule.shown.cast("string"))
        found.append(
            F.struct(
                F.lit(rule.name).alias("rule"),
                rows.alias("rows_checked"),
                hits.alias("bad_rows"),
                F.round(F.coalesce(F.try_divide(hits * 100.0, rows), F.lit(0.0)), 4).alias("bad_pct"),
                F.when(hits > rows * F.lit(rule.tolerate), F.lit(rule.severity)).otherwise("PASS").alias("status"),
                F.min(evidence).alias("low_sample"),
                F.max(evidence).alias("high_sample"),
            )
        )
    return df.agg(F.array(*found).alias("found")).select(F.inline("found"))


def enforce(report: DataFrame) -> DataFrame:
    """Raise if any rule of the report failed; the report has one row per rule."""
    failed = report.where(F.col("status") == "FAIL").collect()
    if failed:
        raise QualityError("; ".join(str(row.asDict()) for row in failed))
    return report


# --- rules ------------------------------------------------------------------


def flag_rule(column: str, valid: tuple[int, ...] = (0, 1)) -> Rule:
    bad = ~is_true(F.col(column).isin(*valid))
    return Rule(f"binary:{column}", bad, F.coalesce(F.col(column).cast("string"), F.lit("null")), tolerate=S.FLAG_WARN_SHARE)


def region_rule(column: str, canonical: list[str]) -> Rule:
    clean = standard_text(F.col(column), "title")
    return Rule(f"region:{column}", ~is_true(clean.isin(canonical)), clean)


def sku_rule(column: str = "sku_id", pattern: str = S.SKU_ID_PATTERN) -> Rule:
    clean = standard_text(F.col(column), "strip")
    return Rule(f"sku_format:{column}", ~is_true(clean.rlike(pattern)), clean)


def positive_rule(column: str, minimum: float = S.MIN_POSITIVE) -> Rule:
    return Rule(f"positive:{column}", F.col(column) < minimum, F.col(column), severity="FAIL")


def range_rule(column: str, low: float, high: float) -> Rule:
    return Rule(f"range:{column}", outside_range(column, low, high), F.col(column))


def service_level_rule(column: str = "target_service_level") -> Rule:
    return range_rule(column, *S.SERVICE_LEVEL_RANGE)


def negative_margin_rule(column: str = "gross_margin_usd") -> Rule:
    return Rule(f"negative_margin:{column}", F.col(column) < 0, F.col(column))


def zero_volume_rule(column: str = "volume_m3") -> Rule:
    return Rule(f"zero_volume:{column}", F.col(column) == 0, F.col(column))


def null_rule(column: str, severity: str = "WARN") -> Rule:
    return Rule(f"null:{column}", F.col(column).isNull(), F.lit("null"), severity=severity)


def unmatched_rule(column: str) -> Rule:
    """After a left join the looked-up column must not be null."""
    return null_rule(column, "FAIL")


# --- whole-table checks -----------------------------------------------------


def assert_positive(df: DataFrame, column: str, minimum: float = S.MIN_POSITIVE) -> DataFrame:
    """Hard check inside the plan: the job that reads a bad row fails.

    Needs no job of its own; null passes.
    """
    message = F.concat(F.lit(f"{column} below {minimum}: "), F.col(column).cast("string"))
    checked = F.when(F.col(column) < minimum, F.raise_error(message).cast("double")).otherwise(F.col(column))
    return df.withColumn(column, checked)


def unknown_ids(df: DataFrame, column: str, canonical: DataFrame, canonical_column: str | None = None) -> DataFrame:
    """Distinct ids absent from the canonical table."""
    known = canonical.select(F.col(canonical_column or column).alias(column)).distinct()
    return df.select(column).distinct().join(known, column, "left_anti")


def assert_known_ids(df: DataFrame, column: str, canonical: DataFrame) -> DataFrame:
    found = unknown_ids(df, column, canonical).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).first()
    if found.n:
        raise QualityError(f"{found.n} unknown {column}: {found.low} to {found.high}")
    return df


def schema_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Column contract check on names and types, one row per column; extras are allowed."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in contract}
    rows = []
    for name in sorted({*actual, *wanted}):
        have, need = actual.get(name), wanted.get(name)
        if need is None:
            status = "EXTRA"
        elif have is None:
            status = "MISSING"
        else:
            status = "OK" if have == need else "TYPE"
        rows.append((name, need, have, status))
    return df.sparkSession.createDataFrame(rows, "column_name string, expected string, actual string, status string")


def schema_matches(df: DataFrame, contract: T.StructType) -> bool:
    return set(contract.fieldNames()) <= set(df.columns)


def referential_integrity(demand: DataFrame, master: DataFrame, key: str = "sku_id") -> DataFrame:
    """Keys only in demand (orphans) and only in the master (dead stock).

    Both sides are tagged and grouped once; equal keys meet in one shuffle and
    are pre-aggregated before it.
    """
    tagged = demand.select(F.col(key), F.lit(1).alias("d"), F.lit(0).alias("m")).unionByName(
        master.select(F.col(key), F.lit(0).alias("d"), F.lit(1).alias("m"))
    )
    seen = tagged.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("d").alias("d"), F.max("m").alias("m"))
    orphan, dead = (F.col("m") == 0), (F.col("d") == 0)
    return seen.agg(
        F.count_if(F.col("d") == 1).alias("demand_keys"),
        F.count_if(F.col("m") == 1).alias("master_keys"),
        F.count_if(orphan).alias("orphaned"),
        F.count_if(dead).alias("dead_stock"),
        F.min(F.when(orphan, F.col(key))).alias("first_orphan"),
        F.min(F.when(dead, F.col(key))).alias("first_dead_stock"),
    )


def keys_only_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Set difference on keys."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def lane_coverage(lanes: DataFrame, expected: DataFrame, expected_count: int = S.EXPECTED_LANES) -> DataFrame:
    """Actual against expected warehouse-region pairs."""
    keys = ["warehouse_id", "demand_region"]
    tagged = lanes.select(*keys, F.lit(1).alias("a"), F.lit(0).alias("e")).unionByName(
        expected.select(*keys, F.lit(0).alias("a"), F.lit(1).alias("e"))
    )
    pairs = tagged.groupBy(*keys).agg(F.max("a").alias("a"), F.max("e").alias("e"))
    actual = F.count_if(F.col("a") == 1)
    missing = F.count_if(F.col("a") == 0)
    return pairs.agg(
        actual.alias("lane_count"),
        F.lit(expected_count).cast("bigint").alias("expected_lanes"),
        missing.alias("missing_pairs"),
        F.count_if(F.col("e") == 0).alias("extra_pairs"),
        ((actual == expected_count) & (missing == 0)).alias("all_lanes_ok"),
    )


def missing_lanes(lanes: DataFrame, expected: DataFrame) -> DataFrame:
    return keys_only_in(expected, lanes, ["warehouse_id", "demand_region"])


def region_consistency(tables: dict[str, DataFrame], canonical: list[str]) -> DataFrame:
    """Every value of every column whose name mentions "region", with its verdict."""
    found = []
    for name, df in tables.items():
        for column in (c for c in df.columns if "region" in c.lower()):
            found.append(
                df.where(F.col(column).isNotNull())
                .select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), F.col(column).alias("value"))
                .distinct()
            )
    return reduce(DataFrame.unionByName, found).withColumn("canonical", F.col("value").isin(canonical))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def duplicate_summary(df: DataFrame, key: str) -> DataFrame:
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicate_rows"),
        F.min(F.when(F.col("n") > 1, F.col(key))).alias("first_duplicated"),
        F.max("n").alias("max_rows_per_key"),
    )


def occurrence_summary(df: DataFrame, key: str = "sku_id") -> DataFrame:
    """How often keys repeat: distinct keys, keys seen once, the highest count."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") == 1).alias("seen_once"),
        F.max("n").alias("max_occurrences"),
        F.sum("n").alias("rows"),
    )


def range_summary(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.agg(
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
        F.avg(column).alias("mean_value"),
        F.count_if(outside_range(column, low, high)).alias("out_of_range"),
        F.count(F.lit(1)).alias("rows"),
    )


def row_count_report(df: DataFrame, expected: int) -> DataFrame:
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("rows"),
        F.lit(expected).cast("bigint").alias("expected_rows"),
        F.when(rows == expected, "PASS").otherwise("FAIL").alias("status"),
    )


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: type, nulls, null share, distinct values counting null as one.

    Exact distinct counts go through a (column, value) grouping, which combines
    before its shuffle and spreads every column over the whole cluster.
    ``approximate`` uses one sketch per column instead and shuffles nothing.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    if approximate:
        packed = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(kind).alias("type"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                (F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias("distinct_values"),
            )
            for c, kind in types.items()
        ]
        counted = df.agg(F.array(*packed).alias("p")).select(F.inline("p"))
    else:
        entries = [
            F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("type"), F.col(c).cast("string").alias("value"))
            for c, kind in types.items()
        ]
        values = (
            df.select(F.inline(F.array(*entries)))
            .groupBy("column_name", "type", "value").agg(F.count(F.lit(1)).alias("n"))
        )
        counted = values.groupBy("column_name", "type").agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count(F.lit(1)).alias("distinct_values"),
        )
    return counted.withColumn("null_pct", F.round(F.try_divide(F.col("nulls") * 100.0, F.col("rows")), 1))


def value_counts(df: DataFrame, column: str, top: int = 10) -> DataFrame:
    """Most frequent values with their share of all rows; null is a value too."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (
        counts.withColumn("share_pct", F.round(F.col("n") * 100.0 / total, 1))
        .orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
        .limit(top)
    )


def required_values(df: DataFrame, column: str) -> list:
    """Distinct values of a dimension column; an empty list is an error.

    Collects a dimension (regions), never a fact column.
    """
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).collect()
    if not rows:
        raise QualityError(f"no values in {column}")
    return [row[0] for row in rows]


def split_counts(df: DataFrame, marker: str = "is_train") -> DataFrame:
    """Sizes of both sides of a split; an empty side fails."""
    train, test = F.count_if(F.col(marker)), F.count_if(~F.col(marker))
    return df.agg(
        train.alias("train_rows"),
        test.alias("test_rows"),
        F.when((train == 0) | (test == 0), "FAIL").otherwise("PASS").alias("status"),
    )


def count_over_key(df: DataFrame, keys: list[str], output: str = "rows_per_key") -> DataFrame:
    """Attach each row's key count by joining a grouped side back on."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(output))
    return df.join(counts, keys, "left")

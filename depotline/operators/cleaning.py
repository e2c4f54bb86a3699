"""Cleaning steps for raw tables. Every step is lazy and row-local unless noted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from depotline import settings as S
from depotline.functions.calendar import date_parts, parse_date
from depotline.functions.numeric import cap_above, is_true, to_number
from depotline.functions.text import remap, standard_text
from depotline.operators.brackets import exact_percentiles
from depotline.session import store
from depotline.sources.catalog import network_dimension


def parse_date_column(df: DataFrame, column: str = "date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Text to date; rows without a readable date cannot be placed in time and go."""
    return df.withColumn(column, parse_date(F.col(column), fmt)).where(F.col(column).isNotNull())


def date_parse_report(df: DataFrame, column: str = "date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Share of unreadable dates; above one percent the feed itself is suspect."""
    bad = F.count_if(parse_date(F.col(column), fmt).isNull())
    rows = F.count(F.lit(1))
    share = F.try_divide(bad, rows)
    return df.agg(
        rows.alias("rows_before"),
        bad.alias("bad_dates"),
        (rows - bad).alias("rows_after"),
        F.round(share * 100, 4).alias("bad_pct"),
        F.when(share > S.DATE_NULL_WARN_SHARE, "WARN").otherwise("PASS").alias("status"),
    )


def add_date_parts(df: DataFrame, column: str = "date") -> DataFrame:
    return df.withColumns(date_parts(F.col(column)))


def drop_if_present(df: DataFrame, column: str) -> DataFrame:
    """Remove a column that carries no usable information."""
    return df.drop(column)


def distinct_sample(df: DataFrame, column: str, size: int = 5) -> DataFrame:
    """A few distinct values as evidence before a column is dropped (smallest first)."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], "value string")
    return (
        df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("value"))
        .distinct().orderBy("value").limit(size)
    )


def coerce_numeric(df: DataFrame, measures: list[str], flags: list[str] | None = None) -> DataFrame:
    """Text to double, unreadable text to null; missing flags become 0."""
    typed = {c: to_number(F.col(c)) for c in measures if c in df.columns}
    filled = {c: F.coalesce(to_number(F.col(c)), F.lit(0.0)) for c in flags or [] if c in df.columns}
    return df.withColumns({**typed, **filled})


def fill_nulls(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.na.fill(defaults)


def map_values(df: DataFrame, column: str, mapping: dict[str, str], output: str | None = None) -> DataFrame:
    """Dictionary lookup on the trimmed value; unknown values stay unchanged."""
    return df.withColumn(output or column, remap(standard_text(F.col(column), "strip"), mapping))


def standardise_text(df: DataFrame, column: str, case: str = "title") -> DataFrame:
    return df.withColumn(column, standard_text(F.col(column), case))


def remove_negative(df: DataFrame, column: str, allow_zero: bool = False) -> DataFrame:
    """Drop rows below zero (and zero itself unless allowed); null rows stay."""
    bad = F.col(column) < 0 if allow_zero else F.col(column) <= 0
    return df.where(~is_true(bad))


def cap_outliers(
    df: DataFrame, column: str, percentile: float = S.OUTLIER_PERCENTILE, approximate: bool = False
) -> DataFrame:
    """Clip the upper tail at a percentile of the column.

    The table is stored before its cap is sought, so whatever lies behind it is read
    once; it is not shuffled. ``approximate`` takes one sketch in place of the exact search.
    """
    kept = store(df, "cap-interim")
    if approximate:
        cap = kept.agg(F.percentile_approx(F.col(column).cast("double"), percentile / 100, 100000)).first()[0]
    else:
        cap = exact_percentiles(kept, column, {"cap": percentile / 100}).first()[0]
    return kept if cap is None else kept.withColumn(column, cap_above(F.col(column), F.lit(cap)))


def coerce_flags(df: DataFrame, flags: list[str], valid: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Anything outside the valid set, null included, counts as "event not active"."""
    fixed = {
        flag: F.when(is_true(F.col(flag).isin(*valid)), F.col(flag)).otherwise(F.lit(0)).cast("int")
        for flag in flags
        if flag in df.columns
    }
    return df.withColumns(fixed)


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def members_only(df: DataFrame, column: str, allowed: list, negate: bool = False) -> DataFrame:
    """Membership filter; null is never a member, so it passes the negated form."""
    inside = is_true(F.col(column).isin(allowed))
    return df.where(~inside if negate else inside)


def outside_range(column: str, low: float, high: float) -> Column:
    """True only for present values beyond the limits."""
    return is_true((F.col(column) < low) | (F.col(column) > high))


# Aggregation rule per column when several source rows describe one date.
DATE_RULES = {flag: F.max for flag in S.EVENT_FLAGS} | {"weather_disruption_index": F.avg}


def collapse_dates(df: DataFrame, key: str = "date", rules: dict | None = None) -> DataFrame:
    """One row per date: a flag holds if any row has it, weather is averaged.

    Partial aggregation runs before the shuffle, so a date that owns a large
    share of all rows reaches its reducer as one row per task.
    """
    chosen = rules or DATE_RULES
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[rule(column).alias(column) for column, rule in chosen.items() if column in df.columns]
    )


def canonical_warehouses(spark: SparkSession, network: list[tuple] | None = None) -> DataFrame:
    """The network definition replaces a warehouse feed full of repeated rows."""
    return network_dimension(spark, network or S.NETWORK)


def non_canonical_rows(raw: DataFrame, canonical: DataFrame, key: str = "warehouse_id") -> DataFrame:
    """Distinct delivered rows that contradict the canonical definition."""
    columns = canonical.columns
    return raw.select(*columns).distinct().join(canonical, on=columns, how="left_anti").orderBy(key)

"""Table profiles from sketches that are kept per load and united later without reading the loads again.

A load leaves one row per column: exact counts of rows and nulls, a sketch of its distinct
values and one of its quantiles. Sketches are a few kilobytes whatever the load holds, so a
table of them grows with loads and columns only, and any set of loads can be profiled from it.

Stated errors: distinct counts are off by ``DISTINCT_ERROR`` (three standard errors), ranks of
quantiles by ``RANK_ERROR``. A united profile keeps both, however many loads go into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Distinct sketches hold 2^14 registers: a standard error of 1.04 / 2^7.
LOG_REGISTERS = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_REGISTERS / 2)
#: Size of quantile sketches; ranks are within 0.33 % at 99 % confidence, stated with some room.
QUANTILE_SIZE = 1000
RANK_ERROR = 0.005

_KEPT = ["column_name", "type", "rows", "nulls", "distinct_sketch", "quantile_sketch"]


#: Every text that a cast to double accepts, but not-a-number; of texts in hexadecimal only the beginning is tested.
_NUMBER = r"^[\x00-\x20]*+[+-]?+(?:(?:[0-9]++\.?+[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+[fFdD]?+[\x00-\x20]*+$|0[xX]|(?i:inf(?:inity)?)[\x00-\x20]*+$)"


def number(column: Column) -> Column:
    """Numbers, also those kept as text; anything else, and not-a-number, is null.

    The shape is tested first because a cast of text that is no number raises and catches an error for every row.
    """
    text = column.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def load_sketches(df: DataFrame, load: str) -> DataFrame:
    """One row per load and column; ``load`` is the column that names the load.

    One pass over ``df`` for all columns. A load without rows leaves none.
    """
    packed = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(f"`{field.name}`").isNull()).alias("nulls"),
            F.hll_sketch_agg(F.col(f"`{field.name}`").cast("string"), F.lit(LOG_REGISTERS)).alias("distinct_sketch"),
            F.kll_sketch_agg_double(number(F.col(f"`{field.name}`")), F.lit(QUANTILE_SIZE)).alias("quantile_sketch"),
        )
        for field in df.schema
        if field.name != load
    ]
    return df.groupBy(F.col(load).alias("load")).agg(F.array(*packed).alias("_p")).select("load", F.inline("_p")).select("load", *_KEPT)


def sketched_profile(sketches: DataFrame, shares: dict[str, float] | None = None) -> DataFrame:
    """Profile of all loads in ``sketches``: one row per column and type.

    ``rows``, ``nulls`` and ``null_pct`` are exact; ``distinct_values`` counts null as one, as the exact profile
    does; ``loads`` says how many loads went in. ``shares`` (output name -> share) adds quantiles of the numbers, null for columns without any.
    """
    united = sketches.groupBy("column_name", "type").agg(
        F.count(F.lit(1)).alias("loads"),
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct_sketch").alias("_d"),
        F.kll_merge_agg_double("quantile_sketch", F.lit(QUANTILE_SIZE)).alias("_q"),
    )
    numbers = F.kll_sketch_get_n_double("_q") > 0
    quantiles = [F.when(numbers, F.kll_sketch_get_quantile_double("_q", F.lit(share).cast("double"))).alias(name) for name, share in (shares or {}).items()]
    return united.select(
        "column_name",
        "type",
        "loads",
        "rows",
        "nulls",
        F.round(F.try_divide(F.col("nulls") * 100.0, F.col("rows")), 1).alias("null_pct"),
        (F.hll_sketch_estimate("_d") + (F.col("nulls") > 0).cast("int")).alias("distinct_values"),
        *quantiles,
    )

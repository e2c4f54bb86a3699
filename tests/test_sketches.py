"""Profiles from stored sketches against exact ones."""

from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from depotline.operators import quality as Q, sketches as K


@pytest.fixture(scope="module")
def table(spark):
    """Three loads of unequal size; values overlap between loads, a third of all rows hold one value."""
    return spark.range(30000).select(
        F.when(F.col("id") < 20000, "a").when(F.col("id") < 29990, "b").otherwise("c").alias("load"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.pmod(F.xxhash64("id"), F.lit(9000))).alias("n"),
        F.when(F.col("id") % 10 == 0, None).otherwise((F.col("id") % 700).cast("string")).alias("text number"),
        F.concat(F.lit("w"), F.col("id") % 11).alias("word"),
        F.lit(None).cast("double").alias("nothing"),
    )


def test_united_profile_is_within_the_stated_errors(spark, table, tmp_path):
    kept = K.load_sketches(table, "load")
    for load in "abc":  # written one by one, as loads arrive
        kept.where(F.col("load") == load).write.mode("append").parquet(str(tmp_path / "sketches"))
    got = K.sketched_profile(spark.read.parquet(str(tmp_path / "sketches")), {"p10": 0.1, "p50": 0.5, "p99": 0.99})
    exact = {r.column_name: r for r in Q.profile(table.drop("load")).collect()}
    for r in got.collect():
        e = exact.pop(r.column_name)
        assert (r.type, r.loads, r["rows"], r.nulls, r.null_pct) == (e.type, 3, e["rows"], e.nulls, e.null_pct)
        assert abs(r.distinct_values - e.distinct_values) <= K.DISTINCT_ERROR * e.distinct_values
        value = K.number(F.col(f"`{r.column_name}`"))
        for name, share in {"p10": 0.1, "p50": 0.5, "p99": 0.99}.items():
            if r.column_name in ("word", "nothing"):
                assert r[name] is None
                continue
            below, upto, n = table.agg(F.count_if(value < r[name]), F.count_if(value <= r[name]), F.count(value)).first()
            assert below / n - K.RANK_ERROR <= share <= upto / n + K.RANK_ERROR
    assert not exact


def test_sketches_do_not_grow_with_the_load(table):
    sizes = K.load_sketches(table, "load").select("load", (F.length("distinct_sketch") + F.length("quantile_sketch")).alias("b"))
    assert sizes.agg(F.max("b")).first()[0] < 100_000


def test_one_load_and_no_rows(table):
    """Ten rows, three of which hold the hot value."""
    one = K.sketched_profile(K.load_sketches(table.where("load = 'c'"), "load"))
    assert rows(one.select("column_name", "rows", "nulls", "distinct_values"), "column_name") == [
        ("n", 10, 0, 8), ("nothing", 10, 10, 1), ("text number", 10, 1, 10), ("word", 10, 0, 10),
    ]
    assert K.sketched_profile(K.load_sketches(table.limit(0), "load"), {"p": 0.5}).count() == 0


def test_only_text_in_the_shape_of_a_number_is_cast(spark):
    """A failed cast raises an error inside, which cost most of a profile's time on columns of words and dates."""
    texts = ["1", "1.", "-.5", ".", "1e", "1e5", "1E+5d", "2f", "0x1p3", "-0x1P-2 ", "0xp", " inf ", "-Infinity", "+INF", "iNfInItY", "infin", "nan", "NaN",
             "1996-01-02", "\n12\n", "1 2", "--1", "", " ", "\x001", "\xa01", "١", "Monday", "SKU-000001", None]
    value = F.col("t").try_cast("double")
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", K.number(F.col("t")).alias("n"), F.when(~F.isnan(value), value).alias("cast"))
    assert [(r.t, r.n) for r in got.collect()] == [(r.t, r["cast"]) for r in got.collect()]
    # Nor does any text of other shape reach the cast.
    assert not spark.createDataFrame([(t,) for t in ("1996-01-02", "Monday", "SKU-000001", "01/01/1970", "n/a", "nan")], "t string").where(F.col("t").rlike(K._NUMBER)).count()


def test_the_joins_behind_the_raw_rows_run_once(spark, sf_dir):
    from depotline.workload.quality import sketch_error

    assert "lineitem.parquet" not in sketch_error(spark, sf_dir)._jdf.queryExecution().toString()

"""Statistics and retrieval against brute force on small fixtures."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from depotline.operators import enrich, evaluation as E, forecasting as M, retrieval as R, statistics as T
from depotline.plans.network import ModelNetwork, Network

MONDAY = dt.date(2023, 1, 2)


def test_mann_whitney_with_ties(spark):
    on, off = [3.0, 5.0, 5.0, 9.0], [1.0, 3.0, 5.0]
    df = spark.createDataFrame([(v, 1) for v in on] + [(v, 0) for v in off] + [(None, 1)], "total_units double, f int")
    row = T.mann_whitney(df, "f").first()
    u = sum((a > b) + 0.5 * (a == b) for a in on for b in off)
    n, ties = 7, sum(c**3 - c for c in (2, 3))
    z = (u - 6 - 0.5) / math.sqrt(12 / 12 * ((n + 1) - ties / (n * (n - 1))))
    assert (row.u_statistic, row.n_on, row.n_off, row.median_on, row.median_off) == (u, 4, 3, 5.0, 3.0)
    assert row.z_score == pytest.approx(z)
    assert row.p_value == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-6)


def test_normality_and_coverage(spark):
    values = [float(v) for v in np.random.default_rng(1).normal(size=200).round(4)]
    df = spark.createDataFrame([(v,) for v in values], "residual double")
    row = T.normality(df).first()
    x = np.array(values) - np.mean(values)
    skew = (x**3).mean() / (x**2).mean() ** 1.5
    kurt = (x**4).mean() / (x**2).mean() ** 2 - 3
    assert row.jarque_bera == pytest.approx(200 / 6 * (skew**2 + kurt**2 / 4))
    assert row.normal
    cover = T.interval_coverage(df).first()
    low, high = np.percentile(values, [10, 90])
    assert (cover.p_low, cover.p_high) == (pytest.approx(low), pytest.approx(high))
    assert cover.coverage == pytest.approx(np.mean([(low <= v <= high) for v in values]))


def brute_acf(values, lags):
    x = np.array(values) - np.mean(values)
    return [float((x[: len(x) - k] * x[k:]).sum() / (x * x).sum()) for k in range(lags + 1)]


def test_acf_and_pacf(spark):
    values = [float(v) for v in np.random.default_rng(2).normal(size=60).cumsum().round(3)]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "series string, t int, v double")
    for keys in ([], ["series"]):
        acf = T.autocorrelation(df, keys, "t", "v", max_lag=6)
        got = [r.acf for r in acf.orderBy("lag").collect()]
        assert got == pytest.approx(brute_acf(values, 6))
        pacf = [r.pacf for r in T.partial_autocorrelation(acf, keys).orderBy("lag").collect()]
        for k in range(1, 7):
            matrix = np.array([[got[abs(i - j)] for j in range(k)] for i in range(k)])
            assert pacf[k] == pytest.approx(np.linalg.solve(matrix, np.array(got[1 : k + 1]))[-1])


def test_vif_against_regression(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=80), rng.normal(size=80)
    c = a + 0.5 * rng.normal(size=80)
    data = [tuple(float(v) for v in row) for row in np.column_stack([a, b, c])]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {r.feature: r.vif for r in T.variance_inflation(df, ["a", "b", "c"]).collect()}
    frame = {"a": a, "b": b, "c": c}
    for name, y in frame.items():
        x = np.column_stack([np.ones(80), *[v for k, v in frame.items() if k != name]])
        residual = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
        assert got[name] == pytest.approx(((y - y.mean()) ** 2).sum() / (residual**2).sum())
    doubled = df.withColumn("d", F.col("a") * 2)
    flags = {r.feature: r.flag for r in T.variance_inflation(doubled, ["a", "b", "d"]).collect()}
    assert flags == {"a": "INF", "b": "OK", "d": "INF"}


def test_correlation_threshold(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0)], "a double, b double, k double")
    strong = rows(T.correlation_pairs(df, ["a", "b", "k"], threshold=0.85))
    assert [(x, y) for x, y, _ in strong] == [("a", "b")]


def test_anomalies_skip_constant_groups(spark):
    data = [("N", "T", float(v)) for v in [1] * 9 + [50]] + [("S", "T", 4.0)] * 3 + [("E", "T", 7.0)]
    df = spark.createDataFrame(data, "region string, category string, total_units double")
    found = T.anomalies(df)
    assert rows(found.select("region", "total_units")) == [("N", 50.0)]
    assert T.segment_z_scores(df).where("z_score IS NULL").count() == 4


@pytest.fixture(scope="module")
def table(spark):
    """Two segments, three years of weeks, a clear yearly pattern."""
    data = []
    for region, level in (("North", 100.0), ("South", 40.0)):
        for i in range(156):
            week = MONDAY + dt.timedelta(weeks=i)
            units = level + 30 * math.sin(2 * math.pi * i / 52) + (i * 7 % 5)
            data.append((week, region, "Toys", units, week.month, (week.month + 2) // 3, week.isocalendar()[1]))
    weekly = spark.createDataFrame(
        data, "week_start date, region string, category string, total_units double, month int, quarter int, week_number int")
    return enrich.add_velocity(enrich.add_short_features(enrich.add_epoch_features(weekly)))


def test_models_beat_a_flat_forecast(table):
    marked = E.holdout_split(table, 26)
    test = M.complete_rows(marked.where("NOT is_train"), M.FORWARD_FEATURES)
    boosted = M.fit(marked.where("is_train"), M.boosted_trees(M.FORWARD_FEATURES, rounds=60), M.FORWARD_FEATURES)
    linear = M.fit(marked.where("is_train"), M.linear_model(M.FORWARD_FEATURES), M.FORWARD_FEATURES)
    compared = E.compare_models(
        {"boosted": boosted.predict(test), "linear": linear.predict(test), "naive": E.last_value_forecast(marked)}, "naive")
    mae = {r.model: r.mae for r in compared.collect()}
    assert mae["boosted"] < mae["naive"] and mae["linear"] < mae["naive"]
    importance = M.feature_importance(boosted, table)
    assert importance.agg(F.sum("importance_pct")).first()[0] == pytest.approx(100.0)


def test_a_model_reaches_the_plan(spark, sf_dir):
    n = ModelNetwork.from_benchmark(spark, sf_dir)
    n.pipeline = M.linear_model(M.FORWARD_FEATURES)
    by_model = {(r.region, r.category): r.required_units for r in n.requirements().collect()}
    plain = {(r.region, r.category): r.required_units for r in Network.from_benchmark(spark, sf_dir).requirements().collect()}
    assert by_model.keys() == plain.keys() and all(v > 0 for v in by_model.values()) and by_model != plain
    served = n.plan().groupBy("scenario").agg(F.sum("units_allocated").alias("u")).collect()
    assert len(served) == 3 and all(r.u == pytest.approx(sum(by_model.values())) for r in served)


def test_young_segments_are_forecast_too(table):
    fitted = M.fit(table, M.linear_model(M.FORWARD_FEATURES), M.FORWARD_FEATURES)
    newest = table.agg(F.max("week_start")).first()[0]
    one = table.select("region").first().region
    young = table.where((F.col("region") == one) & (F.col("week_start") > newest - dt.timedelta(weeks=2))).withColumn("region", F.lit("Young"))
    got = M.forward_forecast(fitted, table.unionByName(young), horizon=2).where("region = 'Young'").collect()
    assert len(got) == 2 * young.select("category").distinct().count() and {r.history_weeks for r in got} == {2}
    assert all(r.predicted_units is not None for r in got)


def test_forward_forecast_feeds_back(table):
    fitted = M.fit(table, M.linear_model(M.FORWARD_FEATURES), M.FORWARD_FEATURES)
    forward = M.forward_forecast(fitted, table, horizon=3)
    assert forward.groupBy("region").count().where("count = 3").count() == 2
    first = {r.region: r.predicted_units for r in forward.where(F.col("week_start") == MONDAY + dt.timedelta(weeks=156)).collect()}
    # Step two by hand: append step one's prediction as history and predict again.
    extended = table.select("week_start", "region", "category", "total_units", "month", "quarter", "week_number")
    rows_one = [(MONDAY + dt.timedelta(weeks=156), r, "Toys", v, 12, 4, 1) for r, v in first.items()]
    week_two = [(MONDAY + dt.timedelta(weeks=157), r, "Toys", 0.0, 1, 1, 2) for r in first]
    more = table.sparkSession.createDataFrame(rows_one + week_two, extended.schema)
    rebuilt = enrich.add_short_features(enrich.add_epoch_features(extended.unionByName(more)))
    velocity = table.select("region", "category", "category_velocity", "region_demand_rank").distinct()
    second = fitted.predict(rebuilt.join(velocity, ["region", "category"]).where(F.col("week_start") == week_two[0][0]))
    expected = {r.region: r.predicted_units for r in second.collect()}
    got = {r.region: r.predicted_units for r in forward.where(F.col("week_start") == week_two[0][0]).collect()}
    assert got == pytest.approx(expected)


def test_cross_validation_rows(table):
    scores = M.cross_validate(E.walk_forward_folds(table, 2), M.linear_model(M.FORWARD_FEATURES), M.FORWARD_FEATURES, folds=2)
    assert [r.n for r in scores.orderBy("fold").collect()] == [104, 104]


def test_top_k_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(200, 8))
    vectors[17] = vectors[3]
    index = R.build_index(spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")).repartition(5)
    queries = R.build_index(spark.createDataFrame(
        [(q, [float(x) for x in vectors[q]]) for q in (3, 40, 77)], "query_id int, embedding array<float>"))
    monkeypatch.setattr(R, "BATCH_NUMBERS", 16)
    monkeypatch.setattr(R, "_SCORED_TOGETHER", 1)
    got = rows(R.top_k(index, queries, k=4).select("query_id", "rank", "vec_id"), "query_id", "rank")
    unit = vectors.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    expected = []
    for q in (3, 40, 77):
        scores = np.round(unit @ unit[q], 9)
        best = sorted(range(200), key=lambda i: (-scores[i], i))[:4]
        expected += [(q, r + 1, i) for r, i in enumerate(best)]
    assert got == expected


def test_top_k_without_queries(spark):
    index = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([], "query_id int, embedding array<double>")
    assert R.top_k(index, queries).count() == 0


def test_context_order(spark):
    hits = spark.createDataFrame([(1, 7, 2), (1, 9, 1)], "query_id int, vec_id int, rank int")
    chunks = spark.createDataFrame([(7, "second"), (9, "first")], "vec_id int, text string")
    assert rows(R.assemble_context(hits, chunks)) == [(1, "first\nsecond", 2)]


def test_group_centroids(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0]), (1, [3.0, 5.0])], "label int, embedding array<float>")
    assert rows(R.group_centroids(df)) == [(1, [2.0, 4.0])]


@pytest.mark.parametrize("key", ["m02", "m06", "d21"])
def test_registered_models_are_the_boosted_ones_with_all_rounds(spark, monkeypatch, key):
    from depotline.operators import forecasting
    from depotline.workload import domain, forecasting as queries

    class Fitted(Exception):
        pass

    def fitted(table, pipeline, *_):
        raise Fitted(pipeline)

    monkeypatch.setattr(forecasting, "fit", fitted)
    monkeypatch.setattr(forecasting, "cross_validate", fitted)
    run = {"m02": queries.boosted_trees, "m06": queries.cross_validation, "d21": domain.model_interval}[key]
    with pytest.raises(Fitted) as stopped:
        run(spark, "/root/testdata/sf0.001")
    model = stopped.value.args[0]
    assert type(model).__name__ == "BoostedTrees" and model.plan.rounds == 300 and len(model.features) == 36


def test_moments_by_brute_force(spark):
    """Pairs where both are present, far from zero, over many partitions; constants up to rounding have no correlation."""
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(1e6, 1, 300), rng.normal(-5, 2, 300), np.full(300, 0.1) * 3, rng.normal(size=300)])
    x[:, 3] += x[:, 1]
    x[150:, 2] = 0.1 + 0.2
    x[::7, 0] = np.nan
    x[::5, 1] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, k double, c double").repartition(9)
    got = {(r.feature_a, r.feature_b): r.pearson_r for r in T.correlation_pairs(df, ["a", "b", "k", "c"]).collect()}
    for (i, one), (j, two) in [((0, "a"), (1, "b")), ((0, "a"), (3, "c")), ((1, "b"), (3, "c"))]:
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got[one, two] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1])
    assert [got[p] for p in (("a", "k"), ("b", "k"), ("k", "c"))] == [None] * 3
    assert len(got) == 6 and {r.pearson_r for r in T.correlation_pairs(df.limit(0), ["a", "b"]).collect()} == {None}


def test_top_k_alike_in_place_and_in_blocks(spark, monkeypatch):
    """Many query blocks against many index blocks give what the scan of the index gives, for text ids and ties too."""
    rng = np.random.default_rng(11)
    vectors = np.round(rng.normal(size=(150, 4)), 1)
    index = R.build_index(spark.createDataFrame([(f"i{n:03d}", [float(x) for x in v]) for n, v in enumerate(vectors)], "vec_id string, embedding array<float>")).repartition(4)
    queries = R.build_index(spark.createDataFrame([(n, [float(x) for x in v]) for n, v in enumerate(vectors[:40])], "query_id long, embedding array<float>")).repartition(3)
    scanned = rows(R.top_k(index, queries, k=7), "query_id", "rank")
    monkeypatch.setattr(R, "BATCH_NUMBERS", 0)
    monkeypatch.setattr(R, "BLOCK_ROWS", 17)
    monkeypatch.setattr(R, "_SCORED_TOGETHER", 3)
    assert rows(R.top_k(index, queries, k=7), "query_id", "rank") == scanned and len(scanned) == 280
    assert R.top_k(index.limit(0), queries, k=7).count() == 0


def test_rank_sums_of_several_flags_at_once(spark):
    rng = np.random.default_rng(12)
    data = [(float(rng.integers(0, 9)), *[None if rng.random() < 0.1 else int(rng.random() < p) for p in (0.3, 0.6)]) for _ in range(200)]
    df = spark.createDataFrame(data, "total_units double, f int, g int")
    together = T.mann_whitney(df, ["f", "g"]).orderBy("flag").collect()
    assert together == [T.mann_whitney(df, flag).first() for flag in ("f", "g")]

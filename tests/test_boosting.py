from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from depotline.operators import boosting as B, evaluation as E, forecasting as M
from depotline.plans.network import ModelNetwork, Network
from depotline.session import store


def data(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    x[:, 2] = np.round(x[:, 2])
    y = 3 * (x[:, 0] > 0.3) + x[:, 1] * x[:, 2] + rng.normal(0, 0.1, n)
    return x, y


def frame(spark, x, y, model=0):
    rows = [(model, *[None if np.isnan(v) else float(v) for v in r], None if t is None else float(t)) for r, t in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "model int, a double, b double, c double, d double, y double")


FEATURES = ["a", "b", "c", "d"]


def slow_tree(codes, residual, leaves, least, rate):
    """Best-first growth by trying every cut of every leaf; gives each row's step."""
    def best(rows):
        top = (0.0, None)
        total = residual[rows].sum() ** 2 / len(rows)
        for f in range(codes.shape[1]):
            for cut in range(codes[:, f].max() + 1):
                low = rows[codes[rows, f] <= cut]
                high = rows[codes[rows, f] > cut]
                if len(low) >= least and len(high) >= least:
                    gain = residual[low].sum() ** 2 / len(low) + residual[high].sum() ** 2 / len(high) - total
                    if gain > top[0] * (1 + 1e-12):
                        top = (gain, (low, high))
        return top

    found = [(best(np.arange(len(residual))), np.arange(len(residual)))]
    while len(found) < leaves:
        at = max(range(len(found)), key=lambda i: found[i][0][0])
        if found[at][0][1] is None:
            break
        (_, (low, high)), _ = found.pop(at)
        found += [(best(low), low), (best(high), high)]
    step = np.zeros(len(residual))
    for _, rows in found:
        step[rows] = rate * residual[rows].mean()
    return step


def test_trees_by_brute_force(spark):
    x, y = data()
    x[::17, 1] = np.nan
    plan = B.Boosting(rounds=4, rate=0.3, leaves=7, least_rows=10, bins=12)
    model = B.fit_models(frame(spark, x, y), plan, FEATURES, "y")[0]
    codes = B.binned(x, model.edges)
    assert codes.max() < 12 and (codes[::17, 1] == 0).all()
    expected = np.full(len(y), y.mean())
    for _ in range(4):
        expected = expected + slow_tree(codes, y - expected, 7, 10, 0.3)
    assert model.score(x) == pytest.approx(expected, abs=1e-5)
    assert model.splits.sum() == sum((t[0] >= 0).sum() for t in model.trees) == 4 * 6


def test_shards_give_the_same_trees(spark):
    """Several tasks that add up their histograms, for two models at once, against one task each."""
    x, y = data(600)
    rows = frame(spark, x, y).union(frame(spark, *data(300, 2), model=1)).repartition(3)
    alone = B.fit_models(rows, B.Boosting(rounds=2, leaves=6, bins=16), FEATURES, "y")
    together = B.fit_models(rows, B.Boosting(rounds=2, leaves=6, bins=16, shard_rows=300), FEATURES, "y")
    for m in (0, 1):
        assert len(alone[m].trees) == 2 and alone[m].base == together[m].base
        assert all(np.array_equal(a, b) for one, other in zip(alone[m].trees, together[m].trees) for a, b in zip(one, other))


def test_looking_ahead_changes_nothing():
    x, y = data(500, 5)
    codes = B.binned(x, [np.quantile(x[:, j], np.linspace(0.1, 0.9, 9)) for j in range(4)])
    growers = [B.Grower(codes, np.rint(y * 2**20).astype(np.int64), len(y), 0, B.Boosting(rounds=6, leaves=9, least_rows=5), 12, 20) for _ in range(2)]
    B.grow_alone(growers[0])
    B.grow_together({0: [growers[1]]}, 6, lambda parts: parts)
    assert [t.arrays()[i].tolist() for t in growers[0].trees for i in range(5)] == [t.arrays()[i].tolist() for t in growers[1].trees for i in range(5)]


def test_many_rows_are_counted_by_feature(monkeypatch):
    x, y = data(300)
    codes = B.binned(x, [np.array([0.0])] * 4)
    grower = B.Grower(codes, np.rint(y * 2**20).astype(np.int64), len(y), 0, B.Boosting(), 5, 20)
    whole = grower.histogram(np.arange(300))
    monkeypatch.setattr(B, "TOGETHER", 0)
    assert np.array_equal(whole, grower.histogram(np.arange(300)))


def test_edge_cases(spark):
    x, y = data(30)
    x[:, 3] = np.nan
    constant = B.fit_models(frame(spark, x, [5.0] * 30), B.Boosting(rounds=3), FEATURES, "y")[0]
    assert constant.score(x) == pytest.approx([5.0] * 30) and constant.splits.sum() == 0
    few = B.fit_models(frame(spark, x[:3], [1.0, None, 3.0]), B.Boosting(rounds=3), FEATURES, "y")[0]
    assert few.score(x[:2]) == pytest.approx([2.0, 2.0])
    assert B.fit_models(frame(spark, x[:0], []), B.Boosting(), FEATURES, "y") == {}
    odd = np.array([[np.inf, -np.inf, np.nan, 0.0]])
    assert np.isfinite(constant.score(odd)).all()


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return store(Network.from_benchmark(spark, sf_dir).modelling_table(), "joined")


def test_error_against_the_library_trees(spark, table):
    """As good as MLlib's trees of like size on the same rows and features."""
    marked = E.holdout_split(M.complete_rows(table, M.MODEL_FEATURES), 26)
    train, test = marked.where("is_train"), marked.where("NOT is_train")
    own = M.fit(train, M.boosted_trees(M.MODEL_FEATURES, rounds=40), M.MODEL_FEATURES)
    assembler = VectorAssembler(inputCols=M.MODEL_FEATURES, outputCol="features")
    trees = GBTRegressor(featuresCol="features", labelCol=E.TARGET, predictionCol="predicted_units", maxIter=40, stepSize=0.05, maxDepth=5, seed=42)
    other = Pipeline(stages=[assembler, trees]).fit(train.coalesce(1).cache())
    maes = [E.metrics(df).first().mae for df in (own.predict(test), other.transform(test))]
    assert maes[0] <= 1.02 * maes[1]


def test_forward_path_by_hand(spark, sf_dir, table):
    """The recursion on every feature, one segment and step after another."""
    network = ModelNetwork.from_benchmark(spark, sf_dir)
    fitted = M.fit(table, M.boosted_trees(M.MODEL_FEATURES, rounds=15), M.MODEL_FEATURES)
    got = {(r.region, r.category, r.week_start): r.predicted_units for r in M.forward_forecast(fitted, table, 5, network.calendar).collect()}
    span = table.agg(F.min("week_start"), F.max("week_start")).first()
    events = {}
    for r in network.calendar.collect():
        own = events.setdefault(r.date - dt.timedelta(days=r.date.weekday()), [])
        own.append((r.holiday_peak_flag, r.prime_event_flag, r.marketing_push_flag, r.weather_disruption_index))
    segment = table.where("region = 'ASIA' OR region = 'Asia'").select("region", "category").first() or table.select("region", "category").first()
    history = table.where((F.col("region") == segment.region) & (F.col("category") == segment.category)).orderBy("week_start").collect()
    units = [r.total_units for r in history]
    last = history[-1].asDict()
    for step in range(1, 6):
        week = span[1] + dt.timedelta(weeks=step)
        same = [w for w in events if w <= span[1] and w.isocalendar()[1] == week.isocalendar()[1]]
        known = events.get(week) or (events[max(same)] if same else [(0, 0, 0, 0.0)])
        recent = units[-4:]
        row = last | {
            "year": week.year, "month": week.month, "quarter": (week.month + 2) // 3, "week_number": week.isocalendar()[1],
            "weeks_since_epoch": (week - span[0]).days // 7, "is_q4": int(week.month > 9), "lag_1_week_demand": recent[-1], "lag_2_week_demand": recent[-2],
            "lag_4_week_demand": recent[-4], "rolling_4wk_mean": np.mean(recent), "rolling_4wk_std": np.std(recent, ddof=1), "demand_trend": recent[-1] - recent[-4],
            **{flag: max(k[i] for k in known) for i, flag in enumerate(("holiday_peak_flag", "prime_event_flag", "marketing_push_flag"))},
            "weather_disruption": np.mean([k[3] for k in known]),
        }
        predicted = max(0.0, float(fitted.model.score(np.array([[float(row[f]) for f in M.MODEL_FEATURES]]))[0]))
        assert got[segment.region, segment.category, week] == pytest.approx(predicted)
        units.append(predicted)


def test_linear_model_without_spark(spark, table):
    fitted = M.fit(table, M.linear_model(M.MODEL_FEATURES), M.MODEL_FEATURES)
    rows = fitted.predict(fitted.usable(table)).limit(50).collect()
    matrix = np.array([[float(r[f]) for f in M.MODEL_FEATURES] for r in rows])
    assert fitted.matrix_score()(matrix) == pytest.approx([r.predicted_units for r in rows], rel=1e-6, abs=1e-6)


def test_no_history(spark, table):
    fitted = M.fit(table, M.boosted_trees(M.MODEL_FEATURES, rounds=1), M.MODEL_FEATURES)
    assert M.forward_forecast(fitted, table.limit(0)).collect() == []


def test_every_feature_is_in_the_joined_table(table):
    assert set(M.MODEL_FEATURES) <= set(E.numeric_columns(table)) and len(set(M.MODEL_FEATURES)) == 36

"""Shapiro-Wilk against published results and a slow version, the normal tail against the C library."""

from __future__ import annotations

import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from depotline.functions.normal import normal_quantile, normal_upper_tail
from depotline.operators import statistics as T

# Samples with W and significance as widely published (checks of other statistics packages).
FIRST = [0.11, 7.87, 4.61, 10.14, 7.95, 3.14, 0.46, 4.43, 0.21, 4.75, 0.71, 1.52, 3.24, 0.93, 0.42, 4.97, 9.53, 4.55, 0.47, 6.66]
SECOND = [1.36, 1.14, 2.92, 2.55, 1.46, 1.06, 5.27, -1.11, 3.48, 1.10, 0.88, -0.51, 1.46, 0.52, 6.20, 1.69, 0.08, 3.67, 2.81, 3.49]
WEIGHTS = [148.0, 154.0, 158.0, 160.0, 161.0, 162.0, 166.0, 170.0, 182.0, 195.0, 236.0]


def slow(values):
    """Weights one by one from the sorted list."""
    x, n = sorted(values), len(values)
    m = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    squares, u = sum(v * v for v in m), 1 / math.sqrt(n)
    a = [0.0] * n
    a[-1] = m[-1] / math.sqrt(squares) + 0.221157 * u - 0.147981 * u**2 - 2.07119 * u**3 + 4.434685 * u**4 - 2.706056 * u**5
    skip = 1
    rest, share = squares - 2 * m[-1] ** 2, 1 - 2 * a[-1] ** 2
    if n > 5:
        a[-2] = m[-2] / math.sqrt(squares) + 0.042981 * u - 0.293762 * u**2 - 1.752461 * u**3 + 5.682633 * u**4 - 3.582633 * u**5
        rest, share, skip = rest - 2 * m[-2] ** 2, share - 2 * a[-2] ** 2, 2
    if n == 3:
        a[-1] = math.sqrt(0.5)
    for i in range(skip):
        a[i] = -a[n - 1 - i]
    for i in range(skip, n - skip):
        a[i] = m[i] / math.sqrt(rest / share) if n > 3 else 0.0
    mean = sum(x) / n
    return sum(w * v for w, v in zip(a, x)) ** 2 / sum((v - mean) ** 2 for v in x)


def measured(spark, values):
    return T.shapiro_wilk(spark.createDataFrame([(v,) for v in values], "residual double")).first()


@pytest.mark.parametrize(("values", "w", "p"), [(FIRST, 0.900473, 0.042090), (SECOND, 0.959027, 0.524597)])
def test_published_results(spark, values, w, p):
    got = measured(spark, values)
    assert (got.n, got.w, got.p_value) == (20, pytest.approx(w, abs=1e-6), pytest.approx(p, abs=1e-5))
    assert got.normal == (p > 0.05) and got.fitted


def test_textbook_weights(spark):
    got = measured(spark, WEIGHTS)
    assert got.w == pytest.approx(0.79, abs=0.005) and got.p_value < 0.01


def test_against_slow_version(spark):
    random.seed(11)
    samples = [[random.gauss(1e6, 2) for _ in range(n)] for n in (3, 4, 5, 6, 11, 12, 300)]
    samples.append([float(random.choice([0, 0, 0, 1, 2, 9])) for _ in range(200)])  # ties
    for values in samples:
        got = measured(spark, values)
        assert got.w == pytest.approx(slow(values), abs=1e-6), len(values)
        assert 0 <= got.p_value <= 1


def test_hot_value_is_dealt_out_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(T, "STRETCH", 7)
    random.seed(2)
    values = [0.0] * 400 + [random.gauss(0, 1) for _ in range(800)]
    got = measured(spark, values)
    assert got.w == pytest.approx(slow(values), abs=1e-6)


def test_too_few_or_equal_values(spark):
    for values in ([], [None], [1.0, 2.0], [3.0] * 20):
        got = measured(spark, values)
        assert got.w is None and got.p_value is None and got.normal is None


def test_normal_tail_to_twelve_digits(spark):
    z = [i / 16 for i in range(-160, 320)]
    df = spark.createDataFrame([(v,) for v in z], "z double")
    for row in df.select("z", normal_upper_tail(F.col("z")).alias("p")).collect():
        assert row.p == pytest.approx(0.5 * math.erfc(row.z / math.sqrt(2)), rel=1e-12 if row.z < 7 else 1e-6), row.z
    back = df.where("abs(z) < 5").select("z", normal_quantile(1 - normal_upper_tail(F.col("z"))).alias("q"))
    assert all(r.q == pytest.approx(r.z, abs=1e-7) for r in back.collect())

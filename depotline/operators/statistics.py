"""Statistical tests and diagnostics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from depotline import settings as S
from depotline.functions.normal import normal_quantile, normal_upper_tail
from depotline.functions.numeric import ratio
from depotline.operators.brackets import exact_percentiles
from depotline.operators.prefix import running_totals, value_counts_running
from depotline.operators.weekly import SEGMENT
from depotline.session import store


def _median(count: str, upto: str, rows):
    """Median from running counts: mean of the two middle values."""
    low = F.min(F.when((F.col(count) > 0) & (F.col(upto) > F.floor((rows - 1) / 2)), F.col("value")))
    high = F.min(F.when((F.col(count) > 0) & (F.col(upto) > F.ceil((rows - 1) / 2)), F.col("value")))
    return (low + high) / 2


def mann_whitney(df: DataFrame, flags: str | list[str], target: str = "total_units") -> DataFrame:
    """One-sided rank-sum test that flagged rows are larger, with tie correction, one row per flag.

    Rows are first counted per distinct value, for all flags at once, so ties (and a value held by a
    third of all rows) cost one row; tie-averaged ranks then follow from running
    counts over the distinct values, again for all flags in one pass.
    """
    flags = [flags] if isinstance(flags, str) else flags
    numbers = range(len(flags))
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).cast("double").alias("value")).agg(
        *[F.count_if(F.col(flag) == side).alias(f"n{side}_{i}") for i, flag in enumerate(flags) for side in (1, 0)]
    )
    counts = store(counts, "value_counts")
    ranked = running_totals(counts, "value", {f"upto{side}_{i}": f"n{side}_{i}" for i in numbers for side in (1, 0)})
    sizes = counts.agg(F.struct(*[F.sum(f"n{side}_{i}").alias(f"n{side}_{i}") for i in numbers for side in (1, 0)])).scalar()

    def sums(i: int) -> Column:
        on, off = F.col(f"n1_{i}"), F.col(f"n0_{i}")
        all_on, all_off = F.col(f"_n.n1_{i}"), F.col(f"_n.n0_{i}")
        ties = on + off
        rank = F.col(f"upto1_{i}") + F.col(f"upto0_{i}") - (ties - 1) / 2
        return F.struct(
            F.lit(flags[i]).alias("flag"),
            F.max(all_on).alias("n_on"),
            F.max(all_off).alias("n_off"),
            F.sum(rank * on).alias("rank_sum"),
            F.sum(ties.cast("double") * ties * ties - ties).alias("tie_sum"),
            _median(f"n1_{i}", f"upto1_{i}", all_on).alias("median_on"),
            _median(f"n0_{i}", f"upto0_{i}", all_off).alias("median_off"),
            F.sum(F.col("value") * on).alias("sum_on"),
            F.sum(F.col("value") * off).alias("sum_off"),
        )

    summed = ranked.withColumn("_n", sizes).agg(F.array(*[sums(i) for i in numbers]).alias("tests")).select(F.inline("tests"))
    n1, n0 = F.col("n_on").cast("double"), F.col("n_off").cast("double")
    n = n1 + n0
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    variance = n1 * n0 / 12 * ((n + 1) - ratio(F.col("tie_sum"), n * (n - 1)))
    z = ratio(u - n1 * n0 / 2 - 0.5, F.sqrt(variance))
    return summed.select(
        "flag",
        "n_on",
        "n_off",
        "median_on",
        "median_off",
        ((ratio(ratio(F.col("sum_on"), n1), ratio(F.col("sum_off"), n0)) - 1) * 100).alias("mean_lift_pct"),
        u.alias("u_statistic"),
        z.alias("z_score"),
        normal_upper_tail(z).alias("p_value"),
    ).withColumn("significant", F.col("p_value") < 0.05)


def normality(df: DataFrame, column: str = "residual") -> DataFrame:
    """Skewness, excess kurtosis and the Jarque-Bera statistic with its p-value."""
    n, skew, kurt = F.count(column), F.skewness(column), F.kurtosis(column)
    statistic = n / 6 * (skew * skew + kurt * kurt / 4)
    return df.agg(
        n.alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        skew.alias("skewness"),
        kurt.alias("excess_kurtosis"),
        statistic.alias("jarque_bera"),
        # Chi-square with two degrees of freedom has a closed upper tail.
        F.exp(-statistic / 2).alias("p_value"),
    ).withColumn("normal", F.col("p_value") >= 0.05)


# --- Fixed values -----------------------------------------------------------
# P. Royston, "Remark AS R94" (Applied Statistics 44, 1995): corrections of the two
# outermost weights in powers of 1 / sqrt(n), from the fifth down to the first, and the moments of the
# transformed statistic, lowest power first, in n for 4 to 11 rows and in ln n from 12 on.
_OUTERMOST = [-2.706056, 4.434685, -2.07119, -0.147981, 0.221157]
_SECOND = [-3.582633, 5.682633, -1.752461, -0.293762, 0.042981]
_FEW_MEAN = [0.544, -0.39978, 0.025054, -6.714e-4]
_FEW_LOG_STD = [1.3822, -0.77857, 0.062767, -0.0020322]
_FEW_LIMIT = [-2.273, 0.459]
_MANY_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
_MANY_LOG_STD = [-0.4803, -0.082676, 0.0030302]
# --- End of fixed values ----------------------------------------------------

#: Ranks to a stretch: a value that more rows hold is dealt out in stretches.
STRETCH = 1 << 14
#: Rows up to which the published significance of W was fitted.
SIGNIFICANCE_ROWS = 5000


def _powers(coefficients: list[float], x: Column) -> Column:
    """Polynomial, lowest power first."""
    total = F.lit(coefficients[-1])
    for c in coefficients[-2::-1]:
        total = total * x + F.lit(c)
    return total


def _score(rank: Column, rows: Column) -> Column:
    """Expected normal order statistic of a rank from 1 (Blom)."""
    return normal_quantile((rank - F.lit(0.375)) / (rows + F.lit(0.25)))


def _score_sums(counted: DataFrame, rows: Column) -> DataFrame:
    """``value, score, square``: sums of the scores, and of their squares, over the ranks that share a value.

    Ties of more than ``STRETCH`` rows are cut into stretches and spread over the cluster.
    """
    ranks = counted.select("value", (F.col("upto") - F.col("n") + 1).alias("_from"), F.col("upto").alias("_to"))
    long = F.col("_to") - F.col("_from") >= STRETCH
    begins = F.explode(F.sequence(F.col("_from"), F.col("_to"), F.lit(STRETCH).cast("bigint")))
    cut = ranks.where(long).select("value", begins.alias("_from"), "_to").withColumn("_to", F.least(F.col("_to"), F.col("_from") + STRETCH - 1))
    parts = ranks.where(~long).unionByName(cut.repartition("_from")).withColumn("_rows", rows.cast("double"))
    scores = F.transform(F.sequence("_from", "_to"), lambda rank: _score(rank, F.col("_rows")))
    return parts.withColumn("_s", scores).select(
        "value",
        F.aggregate("_s", F.lit(0.0), lambda total, s: total + s).alias("score"),
        F.aggregate("_s", F.lit(0.0), lambda total, s: total + s * s).alias("square"),
    )


def shapiro_wilk(df: DataFrame, column: str = "residual") -> DataFrame:
    """Shapiro-Wilk W of all non-null values, with Royston's weights and significance: ``n, w, p_value, normal``.

    Values are counted and ranked over the cluster (``prefix``); each row of that table sums the normal scores of
    its own ranks, so W comes from one pass over ranks and never from a sorted copy in one place. W is null for fewer than
    three values or if all are equal. The significance was fitted for up to 5000 rows (``SIGNIFICANCE_ROWS``);
    beyond, ``p_value`` follows the same curve and ``fitted`` is false.
    """
    counted = value_counts_running(df, column)
    x, upto = F.col("value"), F.col("upto")
    facts = counted.agg(F.max("upto").alias("n"), F.min("value").alias("first"), F.max("value").alias("last"), (F.sum(x * F.col("n")) / F.sum("n")).alias("mean"))
    known = facts.first()
    rows, mean = int(known.n or 0), F.lit(known.mean).cast("double")
    n = F.lit(rows)
    ends = counted.agg(
        F.struct(
            F.min(F.when(upto >= 2, x)).alias("second"),
            F.min(F.when(upto >= n - 1, x)).alias("last_but_one"),
            F.sum((x - mean) * (x - mean) * F.col("n")).alias("spread"),
        )
    )
    sums = _score_sums(counted, n).agg(F.sum((x - mean) * F.col("score")).alias("product"), F.sum("square").alias("squares"))
    outer_gap = F.lit(known.last).cast("double") - F.lit(known.first).cast("double")
    one = sums.withColumn("_ends", ends.scalar()).select(
        "product", "squares", n.cast("bigint").alias("n"), "_ends.spread", outer_gap.alias("_outer_gap"), (F.col("_ends.last_but_one") - F.col("_ends.second")).alias("_gap")
    )
    size = F.col("n").cast("double")
    u = F.lit(1.0) / F.sqrt(size)
    top, next_ = _score(size, size), _score(size - 1, size)
    length = F.sqrt("squares")
    outer = F.when(size == 3, F.lit(0.5**0.5)).otherwise(top / length + _powers([0.0, *_OUTERMOST[::-1]], u))
    second = next_ / length + _powers([0.0, *_SECOND[::-1]], u)
    two = size > 5  # below, only the outermost weight is corrected
    rest = F.col("squares") - 2 * top * top - F.when(two, 2 * next_ * next_).otherwise(0.0)
    phi = rest / (1 - 2 * outer * outer - F.when(two, 2 * second * second).otherwise(0.0))
    inner = F.col("product") - top * F.col("_outer_gap") - F.when(two, next_ * F.col("_gap")).otherwise(0.0)
    numerator = F.when(size == 3, F.lit(0.0)).otherwise(inner / F.sqrt(phi)) + outer * F.col("_outer_gap") + F.when(two, second * F.col("_gap")).otherwise(0.0)
    w = F.when((size >= 3) & (F.col("spread") > 0), F.least(numerator * numerator / F.col("spread"), F.lit(1.0)))
    found = one.withColumn("w", w)
    left, log_n = F.ln(1 - F.col("w")), F.ln(size)
    few = (-F.ln(_powers(_FEW_LIMIT, size) - left) - _powers(_FEW_MEAN, size)) / F.exp(_powers(_FEW_LOG_STD, size))
    many = (left - _powers(_MANY_MEAN, log_n)) / F.exp(_powers(_MANY_LOG_STD, log_n))
    exact = F.lit(6 / np.pi) * (F.asin(F.sqrt("w")) - F.lit(float(np.arcsin(np.sqrt(0.75)))))
    # Where 1 - W leaves the range of the fit for few rows, the values could hardly be less normal.
    beyond = (size <= 11) & (left >= _powers(_FEW_LIMIT, size))
    p = F.when(size == 3, F.greatest(exact, F.lit(0.0))).when(F.col("w") >= 1, F.lit(1.0)).when(beyond, F.lit(0.0)).otherwise(
        normal_upper_tail(F.when(size <= 11, few).otherwise(many))
    )
    return found.select("n", "w", F.when(F.col("w").isNotNull(), p).alias("p_value")).withColumns(
        {"normal": F.col("p_value") > 0.05, "fitted": F.col("n") <= SIGNIFICANCE_ROWS}
    )


def interval_coverage(residuals: DataFrame, low: float = 0.1, high: float = 0.9, column: str = "residual") -> DataFrame:
    """Share of residuals between their own percentiles against the target share.

    Residuals are stored as one column, on which both limits are sought and the coverage is counted.
    """
    kept = store(residuals.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("value")), "residual-values")
    limits = exact_percentiles(kept, "value", {"p_low": low, "p_high": high}).first()
    p_low, p_high = F.lit(limits.p_low).cast("double"), F.lit(limits.p_high).cast("double")
    n, inside = F.count("value"), F.count_if(F.col("value").between(p_low, p_high))
    return kept.agg(
        p_low.alias("p_low"),
        p_high.alias("p_high"),
        n.alias("n"),
        ratio(inside, n).alias("coverage"),
    ).withColumn("target", F.lit(round(high - low, 10)))


def autocorrelation(series: DataFrame, keys: list[str], index: str, value: str, max_lag: int = 27) -> DataFrame:
    """ACF per series for lags 0..max_lag.

    Each observation meets its partner at every lag through an equi-join on the
    shifted index; a series contributes at most ``max_lag + 1`` pairs per row.
    """
    means = series.groupBy(*keys).agg(F.avg(value).alias("_m"))
    base = series.join(means, keys) if keys else series.withColumn("_m", series.agg(F.avg(value)).scalar())
    centred = base.select(*keys, F.col(index).alias("_t"), (F.col(value) - F.col("_m")).alias("_d"))
    shifted = centred.select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"),
        F.col("_t"),
        F.col("_d").alias("_later"),
    ).withColumn("_t", F.col("_t") - F.col("lag"))
    sums = centred.join(shifted, [*keys, "_t"]).groupBy(*keys, "lag").agg(F.sum(F.col("_d") * F.col("_later")).alias("_c"))
    if keys:
        scale = centred.groupBy(*keys).agg(F.sum(F.col("_d") * F.col("_d")).alias("_v"), F.count(F.lit(1)).alias("n"))
        joined = sums.join(scale, keys)
    else:
        total = centred.agg(F.struct(F.sum(F.col("_d") * F.col("_d")).alias("v"), F.count(F.lit(1)).alias("n"))).scalar()
        joined = sums.withColumn("_s", total).select("lag", "_c", F.col("_s.v").alias("_v"), F.col("_s.n").alias("n"))
    return joined.select(
        *keys,
        "lag",
        ratio(F.col("_c"), F.col("_v")).alias("acf"),
        (F.lit(1.96) / F.sqrt("n")).alias("band_95"),
    )


def partial_autocorrelation(acf: DataFrame, keys: list[str]) -> DataFrame:
    """PACF from ACF rows by the Durbin-Levinson recursion, as a fold over each series' array of max_lag + 1 values."""
    packed = acf.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda x: x["acf"]).alias("_rho"))
    rho = F.col("_rho")

    def step(state: Column, k: Column) -> Column:
        weights, error = state["weights"], state["error"]
        # The weight at position j applies to lag j + 1; it meets rho at k - 1 - j.
        earlier = F.zip_with(weights, F.reverse(F.slice(rho, F.lit(2), k - 1)), lambda w, r: w * r)
        found = (F.get(rho, k) - F.aggregate(earlier, F.lit(0.0), lambda total, x: total + x)) / error

        def with_step(x: Column) -> Column:
            moved = F.zip_with(weights, F.reverse(weights), lambda w, r: w - x * r)
            return F.struct(F.concat(moved, F.array(x)).alias("weights"), (error * (1 - x * x)).alias("error"), F.concat(state["out"], F.array(x)).alias("out"))

        done = F.struct(weights.alias("weights"), error.alias("error"), F.concat(state["out"], F.array(F.lit(None).cast("double"))).alias("out"))
        # In a one-element array, so that the step is computed once and used three times.
        return F.when(error <= 1e-12, done).otherwise(F.get(F.transform(F.array(found), with_step), F.lit(0)))

    none = F.array().cast("array<double>")
    start = F.struct(none.alias("weights"), F.lit(1.0).alias("error"), F.array(F.lit(1.0)).alias("out"))
    lags = F.filter(F.sequence(F.lit(0), F.size(rho) - 1), lambda k: k > 0)
    folded = packed.withColumn("_out", F.aggregate(lags, start, step)["out"])
    return folded.select(*keys, F.posexplode("_out").alias("lag", "pacf"))


#: Deviation, as a share of the mean, up to which a column counts as constant.
CONSTANT = 1e-10


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers, sums and cross-products of every column pair (``i`` <= ``j``) over rows that have both, about ``origin``.

    Each task adds up small matrices over its rows, and Spark adds those of all tasks: one pass, and p (p + 1) / 2
    rows a task to shuffle. Sums are about some row of the table, so large offsets cancel and constants vary by nothing.
    """
    values = [F.col(c).cast("double") for c in columns]
    finite = [F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x) for x in values]
    rows = df.select(F.array(*finite).alias("x"))
    first = df.select(*[F.first(x, ignorenulls=True).alias(c) for x, c in zip(finite, columns)]).first() if columns else []
    origin = np.array([0.0 if v is None else v for v in first])
    p = len(columns)
    upper = np.triu_indices(p)
    names = ["i", "j", "n", "sum_i", "sum_j", "square_i", "square_j", "cross"]

    def run(batches):
        total = np.zeros((6, p, p))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, p) - origin
            known = (~np.isnan(x)).astype(float)
            x = np.where(known > 0, x, 0.0)
            total += [known.T @ known, x.T @ known, known.T @ x, (x * x).T @ known, known.T @ (x * x), x.T @ x]
        yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), *[pa.array(m[upper]) for m in total]], names=names)

    kinds = ", ".join(f"{name} {'int' if name in 'ij' else 'double'}" for name in names)
    # A row of zeros for each pair stands for a table without rows.
    zeros = df.sparkSession.createDataFrame([(int(i), int(j), *[0.0] * 6) for i, j in zip(*upper, strict=True)], kinds)
    summed = rows.mapInArrow(run, kinds).union(zeros).groupBy("i", "j").agg(*[F.sum(name).alias(name) for name in names[2:]])
    place = F.array(*[F.lit(float(v)) for v in origin])
    return summed.withColumns({"origin_i": F.get(place, F.col("i")), "origin_j": F.get(place, F.col("j"))})


def correlation_pairs(df: DataFrame, columns: list[str], threshold: float | None = None) -> DataFrame:
    """Pearson r of every column pair from one matrix of moments; constant input gives null."""
    name = F.array(*[F.lit(c) for c in columns])
    n = F.col("n")
    spread_i = F.col("square_i") - ratio(F.col("sum_i") * F.col("sum_i"), n)
    spread_j = F.col("square_j") - ratio(F.col("sum_j") * F.col("sum_j"), n)
    mean_i, mean_j = F.col("origin_i") + ratio(F.col("sum_i"), n), F.col("origin_j") + ratio(F.col("sum_j"), n)
    # A constant that was computed differs from itself by rounding; that is no variation.
    varies = (spread_i > n * CONSTANT * CONSTANT * mean_i * mean_i) & (spread_j > n * CONSTANT * CONSTANT * mean_j * mean_j)
    r = F.when(varies, (F.col("cross") - F.col("sum_i") * F.col("sum_j") / n) / F.sqrt(spread_i) / F.sqrt(spread_j))
    pairs = moments(df, columns).where("i < j").select(
        F.get(name, F.col("i")).alias("feature_a"), F.get(name, F.col("j")).alias("feature_b"), F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r).alias("pearson_r")
    )
    return pairs if threshold is None else pairs.where(F.abs("pearson_r") > threshold)


def variance_inflation(df: DataFrame, columns: list[str], moderate: float = 5.0, severe: float = 10.0) -> DataFrame:
    """VIF per feature; infinite for features that take part in an exact linear relation.

    The correlation matrix is computed on the cluster; only its p x p numbers
    (p = number of features) reach the driver. A feature is singular when some
    null direction of the matrix involves it; for the others the
    pseudo-inverse diagonal equals 1 / (1 - R2).
    """
    complete = df.na.drop(subset=columns)
    position = {c: i for i, c in enumerate(columns)}
    matrix = np.eye(len(columns))
    for row in correlation_pairs(complete, columns).collect():
        i, j = position[row.feature_a], position[row.feature_b]
        matrix[i, j] = matrix[j, i] = row.pearson_r if row.pearson_r is not None else 0.0
    values, vectors = np.linalg.eigh(matrix)
    null = vectors[:, values < 1e-9]
    singular = (np.abs(null) > 1e-6).any(axis=1)
    diagonal = np.diag(np.linalg.pinv(matrix, rcond=1e-9, hermitian=True))
    rows = [(c, float("inf") if singular[i] else float(diagonal[i])) for c, i in position.items()]
    vif = F.col("vif")
    return df.sparkSession.createDataFrame(rows, "feature string, vif double").withColumn(
        "flag", F.when(vif == float("inf"), "INF").when(vif > severe, "SEVERE").when(vif > moderate, "MODERATE").otherwise("OK")
    )


def segment_z_scores(df: DataFrame, target: str = "total_units", keys: list[str] | None = None) -> DataFrame:
    """z-score of each row in its group; a constant group has none.

    Group moments are aggregated (with map-side combining) and joined back, so a
    dominant group is never gathered in one task the way a window would.
    """
    by = keys or SEGMENT
    moments = df.groupBy(*by).agg(F.avg(target).alias("group_mean"), F.stddev_samp(target).alias("group_std"))
    moments = moments.withColumn("group_std", F.nullif("group_std", F.lit(0.0)))
    return df.join(moments, by, "left").withColumn(
        "z_score", ratio(F.col(target) - F.col("group_mean"), F.col("group_std"))
    )


def anomalies(df: DataFrame, target: str = "total_units", keys: list[str] | None = None, threshold: float = S.ANOMALY_Z) -> DataFrame:
    """Rows more than ``threshold`` deviations from their group mean."""
    return segment_z_scores(df, target, keys).where(F.abs("z_score") > threshold)


def top_anomalies(found: DataFrame, tie_break: list[str], top: int = S.ANOMALY_TOP) -> DataFrame:
    """The most extreme rows first; part of the report, detection itself returns all rows."""
    return found.orderBy(F.abs("z_score").desc(), *tie_break).limit(top)

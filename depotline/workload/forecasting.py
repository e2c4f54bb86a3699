"""Forecasting, statistics and retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from depotline.operators import enrich, evaluation as E, forecasting as M, retrieval as R, statistics as T
from depotline.plans.network import Network
from depotline.session import store
from depotline.sources import bridge
from depotline.workload.fragments import normal_cdf_sql
from depotline.workload.registry import query


def network(spark: SparkSession, sf_dir: str) -> Network:
    return Network.from_benchmark(spark, sf_dir)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined table, one row per week and segment with every feature, stored once.

    Velocity and rank see the training weeks only.
    """
    n = network(spark, sf_dir)
    last_training_week = F.date_sub(n.stored_weekly.agg(F.max("week_start")).scalar(), 56)
    return store(n.modelling_table(last_training_week), "features")


def boosted(train: DataFrame) -> M.FittedForecast:
    return M.fit(train, M.boosted_trees(M.MODEL_FEATURES), M.MODEL_FEATURES)


@query(
    "m01_training_frame",
    "rows:l first_week:d features:l",
    "SELECT count(*) AS rows, min(week_start) AS first_week, (SELECT count(*) FROM (DESCRIBE SELECT * EXCLUDE (year, total_units), 1 AS weeks_since_epoch, 1 AS is_q4 "
    "FROM short_features) WHERE column_type IN ('INTEGER', 'BIGINT', 'DOUBLE')) AS features FROM short_features "
    "WHERE rolling_4wk_std IS NOT NULL AND lag_4_week_demand IS NOT NULL AND avg_price_usd IS NOT NULL AND weather_disruption IS NOT NULL",
)
def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric feature discovery, incomplete rows dropped."""
    table = enrich.add_short_features(enrich.add_epoch_features(network(spark, sf_dir).stored_weekly))
    rows, features = E.training_frame(table.drop("year"))
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.min("week_start").alias("first_week"), F.lit(len(features)).alias("features")
    )


def scored_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Hold-out predictions of the boosted, linear and persistence models."""
    marked = E.holdout_split(feature_table(spark, sf_dir))
    train, test = marked.where("is_train"), marked.where("NOT is_train")
    linear = M.fit(train, M.linear_model(M.MODEL_FEATURES), M.MODEL_FEATURES)
    return {
        "Boosted trees": boosted(train).predict(test),
        "Linear regression": linear.predict(linear.usable(test)),
        "Naive": E.last_value_forecast(marked),
    }


@query("m02_boosted_trees", "week_start:d region category total_units:2 predicted_units:2")
def boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = E.holdout_split(feature_table(spark, sf_dir))
    return boosted(marked.where("is_train")).predict(marked.where("NOT is_train"))


def sane(predictions: DataFrame, weekly: DataFrame) -> DataFrame:
    """Whether each prediction is one that the data allow: known, and within twice the largest weekly demand."""
    most = weekly.agg(F.max(F.abs("total_units"))).scalar()
    return predictions.withColumn("sane", F.col("predicted_units").isNotNull() & (F.abs("predicted_units") <= 2 * most))


@query("m02_row_set", "week_start:d region category total_units:2 sane:b", "SELECT week_start, region, category, total_units, true AS sane FROM holdout WHERE NOT is_train")
def boosted_row_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boosted model predicts every hold-out row, within bounds; the trees themselves are held against brute force in the tests."""
    table = feature_table(spark, sf_dir)
    marked = E.holdout_split(table)
    return sane(boosted(marked.where("is_train")).predict(marked.where("NOT is_train")), table)


_METRICS = """round(avg(abs(total_units - predicted_units)), 2) AS mae, round(sqrt(avg(power(total_units - predicted_units, 2))), 2) AS rmse,
    round(sum(abs(total_units - predicted_units)) / greatest(sum(abs(total_units)), 1) * 100, 1) AS wape,
    round(1 - sum(power(total_units - predicted_units, 2)) / nullif(var_pop(total_units) * count(*), 0), 4) AS r2, count(*) AS n"""


@query(
    "m03_metrics",
    "region mae:2 rmse:2 wape:1 r2:4 n:l",
    f"SELECT region, {_METRICS} FROM naive WHERE predicted_units IS NOT NULL GROUP BY region",
)
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = E.holdout_split(network(spark, sf_dir).stored_weekly)
    return E.metrics(E.last_value_forecast(marked), ["region"])


@query("m04_naive_forecast", "week_start:d region category total_units:2 predicted_units:2", "SELECT * FROM naive")
def naive_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.last_value_forecast(E.holdout_split(network(spark, sf_dir).stored_weekly))


@query("m05_linear_regression", "week_start:d region category total_units:2 predicted_units:2")
def linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = E.holdout_split(feature_table(spark, sf_dir))
    fitted = M.fit(marked.where("is_train"), M.linear_model(M.MODEL_FEATURES), M.MODEL_FEATURES)
    return fitted.predict(fitted.usable(marked.where("NOT is_train")))


@query(
    "m05_single_feature",
    "week_start:d region category predicted_units:3",
    """SELECT h.week_start, h.region, h.category, b + s * h.week_number AS predicted_units FROM holdout h
       JOIN (SELECT region, category, regr_slope(total_units, week_number) AS s, regr_intercept(total_units, week_number) AS b
             FROM holdout WHERE is_train GROUP BY 1, 2) f ON h.region = f.region AND h.category = f.category
       WHERE NOT is_train""",
)
def single_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-form regression of units on the week number, per segment."""
    return M.single_feature_forecast(E.holdout_split(network(spark, sf_dir).stored_weekly), "week_number")


@query("m06_cross_validation", "fold:i n:l mae:2 rmse:2 wape:1 r2:4")
def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four expanding-window folds of the boosted model."""
    folded = E.walk_forward_folds(feature_table(spark, sf_dir))
    return M.cross_validate(folded, M.boosted_trees(M.MODEL_FEATURES), M.MODEL_FEATURES)


_FOLDS = """folds AS (
  SELECT w.*, f.fold, i < n - (n // 5) * (5 - f.fold) AS is_train
  FROM (SELECT w.*, dense_rank() OVER (ORDER BY week_start) - 1 AS i, (SELECT count(DISTINCT week_start) FROM weekly) AS n FROM weekly w) w
  CROSS JOIN (SELECT unnest(range(1, 5)) AS fold) f WHERE i < n - (n // 5) * (5 - f.fold) + n // 5)"""


@query(
    "m06_row_set",
    "fold:l week_start:d region category total_units:2 sane:b",
    f"WITH {_FOLDS} SELECT fold, week_start, region, category, total_units, true AS sane FROM folds WHERE NOT is_train",
)
def fold_row_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every validation row of every fold is predicted by the boosted model of its fold, within bounds."""
    table = feature_table(spark, sf_dir)
    return sane(M.fold_predictions(E.walk_forward_folds(table), M.boosted_trees(M.MODEL_FEATURES), M.MODEL_FEATURES), table)


@query(
    "m06_fold_baseline",
    "fold:l mae:2 rmse:2 wape:1 r2:4 n:l",
    f"""WITH {_FOLDS}
       SELECT t.fold, {_METRICS} FROM folds t
       JOIN (SELECT fold, region, category, arg_max(total_units, week_start) AS predicted_units FROM folds WHERE is_train GROUP BY 1, 2, 3) l
         ON t.fold = l.fold AND t.region = l.region AND t.category = l.category
       WHERE NOT is_train GROUP BY t.fold""",
)
def fold_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persistence on the same folds, all folds in one job."""
    folded = E.walk_forward_folds(network(spark, sf_dir).stored_weekly)
    return E.metrics(E.last_value_forecast(folded, ["fold"]), ["fold"])


@query(
    "m07_holdout_split",
    "week_start:d region category is_train:b",
    "SELECT week_start, region, category, is_train FROM holdout",
)
def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.holdout_split(network(spark, sf_dir).stored_weekly)


@query("m08_forward_forecast", "week_start:d region category history_weeks:i predicted_units:2")
def forward_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve recursive steps of the boosted model, one row per week and segment."""
    table = feature_table(spark, sf_dir)
    return M.forward_forecast(boosted(table), table, calendar=network(spark, sf_dir).calendar)


@query(
    "m08_row_set",
    "week_start:d region category history_weeks:i sane:b",
    """SELECT CAST((SELECT max(week_start) FROM weekly) + 7 * step AS DATE) AS week_start, region, category, least(n, 4) AS history_weeks, true AS sane
       FROM (SELECT region, category, count(*) AS n FROM weekly GROUP BY 1, 2) s CROSS JOIN (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS step) h""",
)
def forward_row_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve weeks of every segment, within bounds."""
    table = feature_table(spark, sf_dir)
    return sane(M.forward_forecast(boosted(table), table, calendar=network(spark, sf_dir).calendar), table)


@query(
    "m09_residuals",
    "week_start:d region category total_units:2 predicted_units:2 residual:2",
    "SELECT * FROM residuals",
)
def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network(spark, sf_dir).residuals()


@query("m10_feature_importance", "feature importance:6 importance_pct:4 rank:i category")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = feature_table(spark, sf_dir)
    return M.feature_importance(boosted(table), table)


@query(
    "m10_feature_set",
    "feature total_pct:2 ranks_are_ordered:b",
    "SELECT unnest(["
    + ", ".join(f"'{f}'" for f in M.MODEL_FEATURES)
    + "]) AS feature, 100.0 AS total_pct, true AS ranks_are_ordered",
)
def feature_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature of the joined table is ranked, by falling importance, and the shares are a whole."""
    ranked = M.feature_importance(boosted(table := feature_table(spark, sf_dir)), table)
    above = F.lag("importance").over(Window.orderBy("rank"))
    checked = ranked.withColumn("ranks_are_ordered", F.coalesce(above >= F.col("importance"), F.lit(True)))
    return checked.withColumn("total_pct", F.sum("importance_pct").over(Window.partitionBy()))


@query("m11_model_comparison", "model n:l mae:2 rmse:2 wape:1 r2:4 mae_improvement_pct:1 wape_improvement_pct:1")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.compare_models(scored_models(spark, sf_dir), "Naive")


@query(
    "m11_baseline_comparison",
    "model mae:2 rmse:2 wape:1 r2:4 n:l mae_improvement_pct:1",
    f"""WITH s AS (
         SELECT 'Naive' AS model, total_units, predicted_units FROM naive
         UNION ALL SELECT 'Training mean', h.total_units, m.u FROM holdout h
           JOIN (SELECT region, category, avg(total_units) AS u FROM holdout WHERE is_train GROUP BY 1, 2) m
             ON h.region = m.region AND h.category = m.category WHERE NOT is_train),
         t AS (SELECT model, {_METRICS} FROM s GROUP BY model)
       SELECT *, ((SELECT mae FROM t WHERE model = 'Naive') - mae) / (SELECT mae FROM t WHERE model = 'Naive') * 100 AS mae_improvement_pct FROM t""",
)
def baseline_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparison table of two models SQL can also compute."""
    marked = E.holdout_split(network(spark, sf_dir).stored_weekly)
    means = marked.where("is_train").groupBy("region", "category").agg(F.avg("total_units").alias("predicted_units"))
    flat = marked.where("NOT is_train").join(means, ["region", "category"])
    return E.compare_models({"Naive": E.last_value_forecast(marked), "Training mean": flat}, "Naive")


@query(
    "m12_mann_whitney",
    "flag n_on:l n_off:l median_on:3 median_off:3 mean_lift_pct:4 u_statistic:1 z_score:4",
    " UNION ALL ".join(
        f"""SELECT '{f}' AS flag, n1 AS n_on, n0 AS n_off, median_on, median_off, (mean_on / mean_off - 1) * 100 AS mean_lift_pct,
               r - n1 * (n1 + 1) / 2 AS u_statistic,
               (r - n1 * (n1 + 1) / 2 - n1 * n0 / 2 - 0.5) / sqrt(n1 * n0 / 12 * ((n1 + n0 + 1) - ties / ((n1 + n0) * (n1 + n0 - 1)))) AS z_score
        FROM (SELECT count(*) FILTER (WHERE {f} = 1)::DOUBLE AS n1, count(*) FILTER (WHERE {f} = 0)::DOUBLE AS n0,
                     median(total_units) FILTER (WHERE {f} = 1) AS median_on, median(total_units) FILTER (WHERE {f} = 0) AS median_off,
                     avg(total_units) FILTER (WHERE {f} = 1) AS mean_on, avg(total_units) FILTER (WHERE {f} = 0) AS mean_off,
                     sum(rk) FILTER (WHERE {f} = 1) AS r, sum(c * c - 1) AS ties
              FROM (SELECT {f}, total_units, rank() OVER (ORDER BY total_units) + (count(*) OVER (PARTITION BY total_units) - 1) / 2.0 AS rk,
                           count(*) OVER (PARTITION BY total_units)::DOUBLE AS c FROM weekly))"""
        for f in ("holiday_peak_flag", "marketing_push_flag")
    ),
)
def mann_whitney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holiday and marketing lift tests."""
    weekly = network(spark, sf_dir).stored_weekly
    return T.mann_whitney(weekly, ["holiday_peak_flag", "marketing_push_flag"])


@query(
    "m13_normality",
    "n:l mean:4 std:4 skewness:4 excess_kurtosis:4 jarque_bera:2 normal:b",
    """SELECT n, mean, std, s AS skewness, k AS excess_kurtosis, n / 6 * (s * s + k * k / 4) AS jarque_bera,
              exp(-n / 12 * (s * s + k * k / 4)) >= 0.05 AS normal
       FROM (SELECT count(*)::DOUBLE AS n, avg(residual) AS mean, stddev_samp(residual) AS std, kurtosis_pop(residual) AS k,
                    (avg(power(residual, 3)) - 3 * avg(residual) * avg(power(residual, 2)) + 2 * power(avg(residual), 3))
                      / power(var_pop(residual), 1.5) AS s FROM residuals)""",
)
def normality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.normality(network(spark, sf_dir).residuals())


@query(
    "m13_shapiro_wilk",
    "n:l w:6 p_value:6 normal:b fitted:b",
    # Scores of the upper half by Newton's method on the series of the normal distribution, every weight from the sorted rows.
    f"""WITH RECURSIVE x AS (SELECT residual AS v, row_number() OVER (ORDER BY residual) AS i, count(*) OVER () AS n FROM residuals),
            q AS (SELECT i, n, (i - 0.375) / (n + 0.25) AS p, 0.0::DOUBLE AS z, 0 AS step FROM x WHERE 2 * i > n + 1
                  UNION ALL SELECT i, n, p, z - ({normal_cdf_sql('z', 100)} - p) / (exp(-z * z / 2) / sqrt(2 * pi())), step + 1 FROM q WHERE step < 25),
            half AS (SELECT i, n, z FROM q WHERE step = 25),
            m AS (SELECT i, z FROM half UNION ALL SELECT n + 1 - i, -z FROM half),
            k AS (SELECT sum(z * z) AS mm, max(z) AS top, (SELECT z FROM half WHERE i = n - 1) AS second, (SELECT max(n) FROM x)::DOUBLE AS n FROM m),
            e AS (SELECT *, 1 / sqrt(n) AS u FROM k),
            c AS (SELECT *, top / sqrt(mm) + 0.221157 * u - 0.147981 * u ** 2 - 2.07119 * u ** 3 + 4.434685 * u ** 4 - 2.706056 * u ** 5 AS a1,
                         second / sqrt(mm) + 0.042981 * u - 0.293762 * u ** 2 - 1.752461 * u ** 3 + 5.682633 * u ** 4 - 3.582633 * u ** 5 AS a2 FROM e),
            a AS (SELECT m.i, CASE WHEN m.i = n THEN a1 WHEN m.i = 1 THEN -a1 WHEN m.i = n - 1 THEN a2 WHEN m.i = 2 THEN -a2
                         ELSE z / sqrt((mm - 2 * top * top - 2 * second * second) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) END AS weight FROM m, c),
            w AS (SELECT (SELECT sum(v * weight) FROM x JOIN a USING (i)) ** 2 / (SELECT var_pop(v) * count(*) FROM x) AS w, (SELECT max(n) FROM x) AS n),
            s AS (SELECT *, (ln(1 - w) - (-1.5861 - 0.31082 * ln(n) - 0.083751 * ln(n) ** 2 + 0.0038915 * ln(n) ** 3))
                            / exp(-0.4803 - 0.082676 * ln(n) + 0.0030302 * ln(n) ** 2) AS t FROM w)
        SELECT n, w, 1 - ({normal_cdf_sql('t')}) AS p_value, 1 - ({normal_cdf_sql('t')}) > 0.05 AS normal, n <= 5000 AS fitted FROM s""",
)
def shapiro_wilk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-statistic normality of the residuals."""
    return T.shapiro_wilk(network(spark, sf_dir).residuals())


@query(
    "m14_interval_coverage",
    "p_low:4 p_high:4 n:l coverage:6 target:2",
    """SELECT p_low, p_high, count(*) AS n, avg(CASE WHEN residual BETWEEN p_low AND p_high THEN 1.0 ELSE 0.0 END) AS coverage, 0.8 AS target
       FROM residuals CROSS JOIN (SELECT quantile_cont(residual, 0.1) AS p_low, quantile_cont(residual, 0.9) AS p_high FROM residuals)
       GROUP BY p_low, p_high""",
)
def interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.interval_coverage(network(spark, sf_dir).residuals())


def network_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly totals of the whole network with a dense week index."""
    from depotline.operators.weekly import week_index

    weekly = network(spark, sf_dir).stored_weekly
    totals = weekly.groupBy("week_start").agg(F.sum("total_units").alias("units"))
    return week_index(totals)


@query(
    "m15_autocorrelation",
    "lag:i acf:5 band_95:5",
    """SELECT lag, sum(a.d * b.d) / (SELECT sum(d * d) FROM c) AS acf, 1.96 / sqrt((SELECT count(*) FROM c)) AS band_95
       FROM (SELECT unnest(range(0, 28)) AS lag) CROSS JOIN c a JOIN c b ON b.t = a.t + lag GROUP BY lag""".replace(
        "c a JOIN c b", "(SELECT t, units - avg(units) OVER () AS d FROM network_weeks) a JOIN (SELECT t, units - avg(units) OVER () AS d FROM network_weeks) b"
    ).replace("FROM c)", "FROM (SELECT units - avg(units) OVER () AS d FROM network_weeks))"),
)
def autocorrelation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.autocorrelation(network_weeks(spark, sf_dir), [], "week_index", "units")


@query(
    "m15_segment_autocorrelation",
    "region category lag:i acf:5",
    """WITH c AS (SELECT region, category, (week_start - (SELECT min(week_start) FROM weekly)) // 7 AS t,
                         total_units - avg(total_units) OVER (PARTITION BY region, category) AS d FROM weekly)
       SELECT a.region, a.category, lag, sum(a.d * b.d) / any_value(v) AS acf
       FROM (SELECT unnest(range(0, 28)) AS lag) CROSS JOIN c a
       JOIN c b ON b.t = a.t + lag AND a.region = b.region AND a.category = b.category
       JOIN (SELECT region, category, sum(d * d) AS v FROM c GROUP BY 1, 2) s ON a.region = s.region AND a.category = s.category
       GROUP BY 1, 2, 3""",
)
def segment_autocorrelation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ACF per segment, lags 0 to 27 in calendar weeks."""
    weekly = network(spark, sf_dir).stored_weekly
    first = weekly.agg(F.min("week_start")).scalar()
    indexed = weekly.withColumn("t", F.floor(F.datediff("week_start", first) / 7).cast("int"))
    return T.autocorrelation(indexed, ["region", "category"], "t", "total_units")


@query(
    "m16_partial_autocorrelation",
    "lag:i pacf:5",
    """WITH RECURSIVE centred AS (SELECT t, units - avg(units) OVER () AS d FROM network_weeks),
         rho AS (SELECT list(r ORDER BY lag) AS r FROM (
           SELECT lag, sum(a.d * b.d) / (SELECT sum(d * d) FROM centred) AS r
           FROM (SELECT unnest(range(0, 28)) AS lag) CROSS JOIN centred a JOIN centred b ON b.t = a.t + lag GROUP BY lag)),
         steps AS (
           SELECT 0 AS lag, CAST([] AS DOUBLE[]) AS w, CAST(1.0 AS DOUBLE) AS e, CAST(1.0 AS DOUBLE) AS pacf
           UNION ALL
           SELECT lag, list_concat(list_transform(w, lambda x, i: x - p * w[len(w) + 1 - i]), [p]), e * (1 - p * p), p
           FROM (SELECT lag + 1 AS lag, w, e,
                        (r[lag + 2] - coalesce(list_sum(list_transform(w, lambda x, i: x * r[lag + 2 - i])), 0.0)) / e AS p
                 FROM steps CROSS JOIN rho WHERE lag + 1 < len(r)))
       SELECT lag, pacf FROM steps""",
)
def partial_autocorrelation(spark: SparkSession, sf_dir: str) -> DataFrame:
    acf = T.autocorrelation(network_weeks(spark, sf_dir), [], "week_index", "units")
    return T.partial_autocorrelation(acf, [])


def _correlations(features: list[str], source: str) -> str:
    """All pairs; a constant has no correlation."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    varying = "CASE WHEN stddev_pop({0}) > 1e-10 * abs(avg({0})) AND stddev_pop({1}) > 1e-10 * abs(avg({1})) THEN corr({0}::DOUBLE, {1}::DOUBLE) END"
    rows = ", ".join(f"{{'feature_a': '{a}', 'feature_b': '{b}', 'pearson_r': {varying.format(a, b)}}}" for a, b in pairs)
    return f"SELECT unnest(rows, recursive := true) FROM (SELECT [{rows}] AS rows FROM {source})"


@query("m17_correlation_pairs", "feature_a feature_b pearson_r:4", _correlations(M.MODEL_FEATURES, "modelling"))
def correlation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of the features that the models see."""
    return T.correlation_pairs(network(spark, sf_dir).modelling_table(), M.MODEL_FEATURES)


def _inflation(features: list[str]) -> str:
    """Gauss-Jordan elimination of the correlation matrix, a step per feature; a feature whose pivot is gone depends on those
    before it, and so do those that it needs."""
    complete = " AND ".join(f"{f} IS NOT NULL" for f in features)
    names = ", ".join(f"'{f}'" for f in features)
    steps = [
        f"""g0 AS MATERIALIZED (SELECT list_position([{names}], feature_a) AS i, list_position([{names}], feature_b) AS j, coalesce(pearson_r, 0.0) AS v FROM pairs
            UNION ALL SELECT list_position([{names}], feature_b), list_position([{names}], feature_a), coalesce(pearson_r, 0.0) FROM pairs
            UNION ALL SELECT CAST(k AS INTEGER), CAST(k AS INTEGER), 1.0 FROM (SELECT unnest(range(1, {len(features) + 1})) AS k))"""
    ]
    for k in range(1, len(features) + 1):
        steps.append(
            f"""g{k} AS MATERIALIZED (SELECT a.i, a.j, CASE WHEN p.v < 1e-9 THEN a.v WHEN a.i = {k} AND a.j = {k} THEN 1 / p.v WHEN a.i = {k} THEN a.v / p.v
                WHEN a.j = {k} THEN -a.v / p.v ELSE a.v - c.v * r.v / p.v END AS v
              FROM g{k - 1} a JOIN g{k - 1} c ON c.i = a.i AND c.j = {k} JOIN g{k - 1} r ON r.i = {k} AND r.j = a.j CROSS JOIN (SELECT v FROM g{k - 1} WHERE i = {k} AND j = {k}) p)"""
        )
    skipped = " UNION ALL ".join(f"SELECT {k} AS k FROM g{k - 1} WHERE i = {k} AND j = {k} AND v < 1e-9" for k in range(1, len(features) + 1))
    last = f"g{len(features)}"
    return f"""WITH complete AS (SELECT * FROM modelling WHERE {complete}), pairs AS MATERIALIZED ({_correlations(features, "complete")}), {", ".join(steps)},
      skipped AS ({skipped}),
      singular AS (SELECT k FROM skipped UNION SELECT g.i FROM {last} g JOIN skipped s ON g.j = s.k WHERE abs(g.v) > 1e-6)
      SELECT [{names}][i] AS feature, vif, CASE WHEN isinf(vif) THEN 'INF' WHEN vif > 10 THEN 'SEVERE' WHEN vif > 5 THEN 'MODERATE' ELSE 'OK' END AS flag
      FROM (SELECT i, CASE WHEN i IN (SELECT k FROM singular) THEN CAST('inf' AS DOUBLE) ELSE v END AS vif FROM {last} WHERE i = j)"""


@query("m18_variance_inflation", "feature vif:3 flag", _inflation(M.MODEL_FEATURES))
def variance_inflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features; lag 1, lag 4 and their difference are exactly collinear, and so are many prices and distances."""
    return T.variance_inflation(network(spark, sf_dir).modelling_table(), M.MODEL_FEATURES)


@query(
    "m19_weather_response",
    "region pearson_r:3 trend_slope:4 trend_intercept:4",
    """SELECT region, corr(total_units, weather_disruption) AS pearson_r, regr_slope(total_units, weather_disruption) AS trend_slope,
              regr_intercept(total_units, weather_disruption) AS trend_intercept FROM weekly GROUP BY region""",
)
def weather_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotline.operators.weekly import weather_response as respond

    return respond(network(spark, sf_dir).weekly())


@query(
    "m20_distribution_shift",
    "train_mean:4 test_mean:4 shift_pct:4",
    """SELECT avg(total_units) FILTER (WHERE is_train) AS train_mean, avg(total_units) FILTER (WHERE NOT is_train) AS test_mean,
              (avg(total_units) FILTER (WHERE NOT is_train) / avg(total_units) FILTER (WHERE is_train) - 1) * 100 AS shift_pct FROM holdout""",
)
def distribution_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.distribution_shift(E.holdout_split(network(spark, sf_dir).stored_weekly))


@query(
    "m21_anomalies",
    "region category year_week total_units:2 z_score:4",
    """SELECT * FROM (SELECT region, category, year_week, total_units,
              (total_units - avg(total_units) OVER w) / nullif(stddev_samp(total_units) OVER w, 0) AS z_score
       FROM weekly WINDOW w AS (PARTITION BY region, category)) WHERE abs(z_score) > 2""",
)
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every weekly row beyond two deviations."""
    return T.anomalies(network(spark, sf_dir).stored_weekly)


@query(
    "m22_mape",
    "category mape_pct:4 undefined_rows:l",
    """SELECT category, avg(abs(total_units - predicted_units) / nullif(abs(total_units), 0)) * 100 AS mape_pct,
              count(*) FILTER (WHERE total_units = 0) AS undefined_rows FROM naive GROUP BY category""",
)
def mape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.mape(E.last_value_forecast(E.holdout_split(network(spark, sf_dir).stored_weekly)), ["category"])


# --- retrieval ---------------------------------------------------------------------


def label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per label: the direction of its mean vector."""
    centroids = R.group_centroids(bridge.table(spark, sf_dir, "embeddings"))
    return R.build_index(centroids).withColumnRenamed("label", "query_id")


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = R.build_index(bridge.table(spark, sf_dir, "embeddings"))
    return R.top_k(index, label_queries(spark, sf_dir))


@query(
    "r02_build_index",
    "vec_id position:i x:6",
    "SELECT vec_id, unnest(range(0, len(v))) AS position, unnest(v) AS x FROM unit_index",
)
def build_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = R.build_index(bridge.table(spark, sf_dir, "embeddings"))
    return index.select("vec_id", F.posexplode("embedding").alias("position", "x"))


@query("r03_top_k", "query_id:i vec_id:l score:6 rank:l", "SELECT * FROM hits")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact nearest items per label direction over the whole index."""
    return hits(spark, sf_dir)


@query(
    "r04_context",
    "query_id:i passages:l context",
    """SELECT query_id, count(*) AS passages, string_agg(printf('item %d with label %d', e.vec_id, e.label), chr(10) ORDER BY rank) AS context
       FROM hits h JOIN embeddings e ON h.vec_id = e.vec_id GROUP BY query_id""",
)
def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieved texts joined best first."""
    chunks = bridge.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.format_string("item %d with label %d", "vec_id", "label").alias("text")
    )
    return R.assemble_context(hits(spark, sf_dir), chunks)

"""Forecast models on the weekly grain and the recursive forward forecast.

Boosted trees come from ``operators.boosting``, which takes rows with missing features; the
linear model is MLlib's and takes complete rows only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

from depotline import settings as S
from depotline.functions.numeric import intercept, slope
from depotline.operators.boosting import Boosting, TreeModel, fit_models, score_column
from depotline.operators.enrich import event_weeks
from depotline.operators.evaluation import TARGET, metrics
from depotline.operators.weekly import SEGMENT
from depotline.session import store

# Features that the weekly grain alone gives.
FORWARD_FEATURES = [
    "month",
    "quarter",
    "week_number",
    "weeks_since_epoch",
    "is_q4",
    "lag_1_week_demand",
    "lag_2_week_demand",
    "lag_4_week_demand",
    "rolling_4wk_mean",
    "rolling_4wk_std",
    "demand_trend",
    "category_velocity",
    "region_demand_rank",
]
_EVENTS = [*S.EVENT_FLAGS, "weather_disruption"]
# All features of the joined table (``enrich.modelling_table``); every one of them is known, or carried forward, for a future week.
MODEL_FEATURES = [
    *FORWARD_FEATURES,
    "year",
    *_EVENTS,
    "avg_price_usd",
    "avg_unit_cost_usd",
    "avg_selling_price_usd",
    "avg_gross_margin_usd",
    "avg_margin_pct",
    "avg_cube_ft",
    "avg_volume_m3",
    "avg_holding_cost_daily",
    "avg_stockout_penalty",
    "home_wh_capacity",
    "home_wh_fixed_cost",
    "home_ship_cost",
    "home_lead_time",
    "home_distance_km",
    "home_lane_efficiency",
    "carbon_distance_km",
    "carbon_weight_tonnes",
    "carbon_kg_per_unit",
]
_MEMORY = 4


@dataclass(frozen=True)
class BoostedTrees:
    """What to fit to which columns."""

    features: list[str]
    target: str
    plan: Boosting


def boosted_trees(
    features: list[str],
    target: str = TARGET,
    rounds: int = S.BOOSTING_ROUNDS,
    rate: float = S.BOOSTING_RATE,
    leaves: int = S.BOOSTING_LEAVES,
) -> BoostedTrees:
    """Gradient-boosted regression trees."""
    return BoostedTrees(features, target, Boosting(rounds, rate, leaves))


def linear_model(features: list[str], target: str = TARGET) -> Pipeline:
    """Least squares on standardised features; a trace of a penalty settles which of collinear features carry the weight."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            LinearRegression(featuresCol="features", labelCol=target, predictionCol="predicted_units", solver="normal", regParam=1e-6),
        ]
    )


def single_feature_fit(train: DataFrame, feature: str, target: str = TARGET, by: list[str] | None = None) -> DataFrame:
    """Closed-form one-feature regression per group, as plain aggregates."""
    x, y = F.col(feature), F.col(target)
    return train.groupBy(*(by or [])).agg(slope(x, y).alias("slope"), intercept(x, y).alias("intercept"))


def single_feature_forecast(marked: DataFrame, feature: str, target: str = TARGET, by: list[str] | None = None) -> DataFrame:
    """Fit on the training rows, predict the test rows."""
    keys = by or SEGMENT
    fitted = single_feature_fit(marked.where("is_train"), feature, target, keys)
    return marked.where("NOT is_train").join(fitted, keys, "left").withColumn(
        "predicted_units", F.col("intercept") + F.col("slope") * F.col(feature)
    )


Estimator = BoostedTrees | Pipeline


def features_of(estimator: Estimator) -> list[str]:
    return estimator.features if isinstance(estimator, BoostedTrees) else estimator.getStages()[0].getInputCols()


@dataclass
class FittedForecast:
    """A fitted model, as a column (``predict``) and as a function of a feature matrix (``score``)."""

    model: TreeModel | PipelineModel
    features: list[str]

    def predict(self, df: DataFrame) -> DataFrame:
        if isinstance(self.model, TreeModel):
            return df.withColumn("predicted_units", score_column(self.model, self.features))
        return self.model.transform(df).drop("features", "raw_features")

    def usable(self, df: DataFrame) -> DataFrame:
        """Rows that the model can predict: trees take missing features."""
        return df if isinstance(self.model, TreeModel) else complete_rows(df, self.features)

    def matrix_score(self):
        """The model without Spark, for rows that feed on their own predictions."""
        if isinstance(self.model, TreeModel):
            return self.model.score
        scaler, line = self.model.stages[1], self.model.stages[2]
        mean, spread, weights, offset = scaler.mean.toArray(), scaler.std.toArray(), line.coefficients.toArray(), line.intercept
        factor = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1.0), 0.0)
        return lambda matrix: ((matrix - mean) * factor) @ weights + offset


def fit(train: DataFrame, estimator: Estimator, features: list[str]) -> FittedForecast:
    """Train on all rows that the model can use. MLlib reads them repeatedly, so they are kept."""
    if isinstance(estimator, BoostedTrees):
        rows = train.select(*features, estimator.target, F.lit(0).alias("model"))
        return FittedForecast(fit_models(rows, estimator.plan, features, estimator.target)[0], features)
    rows = train.select(*features, TARGET).na.drop().persist()
    try:
        return FittedForecast(estimator.fit(rows), features)
    finally:
        rows.unpersist()


def complete_rows(df: DataFrame, features: list[str]) -> DataFrame:
    return df.na.drop(subset=features)


def fold_predictions(folded: DataFrame, estimator: Estimator, features: list[str], folds: int = 4) -> DataFrame:
    """Validation rows of every fold with the predictions of that fold's model.

    The folded rows are stored, so the input is expanded once. Boosted folds are fitted in one job and
    scored in one pass; linear ones are fitted one after another (a handful), each of them distributed.
    """
    rows = store(folded.select("fold", "is_train", "week_start", *SEGMENT, TARGET, *[f for f in features if f != "week_start"]), "folds")
    if isinstance(estimator, BoostedTrees):
        models = fit_models(rows.where("is_train").withColumnRenamed("fold", "model"), estimator.plan, features, estimator.target)
        score = _score_by(models, len(features))
        return rows.where("NOT is_train").withColumn("predicted_units", score(F.col("fold").cast("int"), *[F.col(f).cast("double") for f in features]))
    scored = []
    for fold in range(1, folds + 1):
        part = complete_rows(rows, features).where(F.col("fold") == fold)
        scored.append(fit(part.where("is_train"), estimator, features).predict(part.where("NOT is_train")))
    return reduce(DataFrame.unionByName, scored)


def _score_by(models: dict[int, TreeModel], width: int):
    @F.pandas_udf("double")
    def score(fold: pd.Series, *columns: pd.Series) -> pd.Series:
        matrix = np.column_stack([c.to_numpy(float, na_value=np.nan) for c in columns]).reshape(len(fold), width)
        out = np.full(len(fold), np.nan)
        for number in np.unique(fold).tolist():
            if number in models:
                at = (fold == number).to_numpy()
                out[at] = models[number].score(matrix[at])
        return pd.Series(out).replace(np.nan, None)

    return score


def cross_validate(folded: DataFrame, estimator: Estimator, features: list[str], folds: int = 4) -> DataFrame:
    """Metrics per fold of a model that saw only the weeks before the fold."""
    return metrics(fold_predictions(folded, estimator, features, folds).select("fold", TARGET, "predicted_units"), ["fold"])


def feature_importance(fitted: FittedForecast, df: DataFrame) -> DataFrame:
    """Number of splits by feature with share, rank and group, one row per feature; of equal ones the larger gain leads."""
    rows = [(name, float(n), float(g)) for name, n, g in zip(fitted.features, fitted.model.splits, fitted.model.gains, strict=True)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double, gain double")
    total = table.agg(F.sum("importance")).scalar()
    order = Window.orderBy(F.col("importance").desc(), F.col("gain").desc(), "feature")
    return table.withColumns(
        {
            "importance_pct": F.coalesce(F.try_divide(F.col("importance") * 100, total), F.lit(0.0)),
            "rank": F.row_number().over(order),
            "category": feature_group(F.col("feature")),
        }
    )


def feature_group(name: Column) -> Column:
    calendar = ["week_number", "month", "quarter", "year", "weeks_since_epoch", "is_q4"]
    return (
        F.when(name.isin(calendar), "Calendar")
        .when(name.rlike("lag_|rolling_|trend"), "Lag / Rolling")
        .when(name.rlike("cost|price|volume|carbon|distance|penalty"), "Cost / Volume")
        .otherwise("Other")
    )


# Features that a step computes from the values before it, and those that the calendar gives.
_FROM_RECENT = ["lag_1_week_demand", "lag_2_week_demand", "lag_4_week_demand", "rolling_4wk_mean", "rolling_4wk_std", "demand_trend"]
_FROM_DATE = ["year", "month", "quarter", "week_number", "weeks_since_epoch", "is_q4"]


def _recent_state(table: DataFrame, static: list[str]) -> DataFrame:
    """One row per segment: its last weeks of demand (oldest first) and the last known value of each ``static`` column.

    A younger segment's first known week stands for the weeks before it; ``history_weeks`` says how many are known.
    """
    newest = Window.partitionBy(*SEGMENT).orderBy(F.col("week_start").desc())
    last = table.withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= _MEMORY)
    recent = F.array_sort(F.collect_list(F.struct("week_start", F.col(TARGET).cast("double").alias("units"))))
    values = [F.max_by(F.col(c).cast("double"), F.when(F.col(c).isNotNull(), F.col("week_start"))) for c in static]
    state = last.groupBy(*SEGMENT).agg(
        F.transform(recent, lambda x: x["units"]).alias("recent"), F.array(*values).cast("array<double>").alias("static")
    )
    known = F.size("recent")
    padded = F.concat(F.array_repeat(F.element_at("recent", 1), F.lit(_MEMORY) - known), F.col("recent"))
    return state.withColumns({"history_weeks": known, "recent": padded})


def future_weeks(first: dt.date, last: dt.date, horizon: int, calendar: DataFrame) -> DataFrame:
    """Date parts and events of the weeks after ``last``.

    Events are those the calendar plans for the week, else those of the same ISO week in the latest year that has it;
    without either there is no event and no disruption.
    """
    spark = calendar.sparkSession
    weeks = spark.range(1, horizon + 1).select(F.date_add(F.lit(last), (F.col("id") * 7).cast("int")).alias("week_start"))
    known = event_weeks(calendar.withColumn("year_week", F.date_sub("date", F.weekday("date")))).withColumnRenamed("year_week", "monday")
    renamed = {f"week_{flag}": flag for flag in S.EVENT_FLAGS} | {"week_weather": "weather_disruption"}
    events = known.select("monday", *[F.col(a).alias(b) for a, b in renamed.items()])
    by_number = events.where(F.col("monday") <= F.lit(last)).groupBy(F.weekofyear("monday").alias("week_number")).agg(
        *[F.max_by(c, "monday").alias(f"{c}_before") for c in _EVENTS]
    )
    dated = weeks.withColumns(
        {
            "year": F.year("week_start"),
            "month": F.month("week_start"),
            "quarter": F.quarter("week_start"),
            "week_number": F.weekofyear("week_start"),
            "weeks_since_epoch": F.floor(F.datediff("week_start", F.lit(first)) / 7).cast("int"),
            "is_q4": (F.quarter("week_start") == 4).cast("int"),
        }
    )
    joined = dated.join(events, dated["week_start"] == events["monday"], "left").join(by_number, "week_number", "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"{c}_before"), F.lit(0)) for c in _EVENTS}
    return joined.withColumns(filled).select("week_start", *_FROM_DATE, *_EVENTS)


def forward_forecast(fitted: FittedForecast, table: DataFrame, horizon: int = S.FORECAST_WEEKS, calendar: DataFrame | None = None) -> DataFrame:
    """Recursive forecast: each step's prediction feeds the next step's lags.

    The state is one row per segment: its last four values, the last known value of what stays fixed or is carried
    forward (economics, home site, lane, price, velocity), and, the same for all segments, what the calendar says of
    the coming weeks. All steps are taken row by row in one pass, so the horizon needs no shuffle after the state is built.
    """
    spark = table.sparkSession
    span = table.agg(F.min("week_start"), F.max("week_start")).first()
    if span[0] is None:
        return table.sparkSession.createDataFrame([], "region string, category string, history_weeks int, week_start date, predicted_units double")
    if calendar is None:
        calendar = spark.createDataFrame([], ", ".join(["date date", *[f"{f} int" for f in S.EVENT_FLAGS], "weather_disruption_index double"]))
    coming = [c for c in [*_FROM_DATE, *_EVENTS] if c in fitted.features]
    plan = future_weeks(span[0], span[1], horizon, calendar).orderBy("week_start").collect()  # a row per week of the horizon
    known = np.array([[np.nan if r[c] is None else float(r[c]) for c in coming] for r in plan]).reshape(horizon, len(coming))
    static = [f for f in fitted.features if f not in coming and f not in _FROM_RECENT]
    places = {f: i for i, f in enumerate(fitted.features)}
    score, weeks = fitted.matrix_score(), [r.week_start for r in plan]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            recent = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, _MEMORY)
            fixed = batch.column(4).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, len(static))
            path = np.zeros((n, horizon))
            for step in range(horizon):
                matrix = np.zeros((n, len(places)))
                lags = dict(zip(_FROM_RECENT, (recent[:, -1], recent[:, -2], recent[:, -4], recent.mean(axis=1), recent.std(axis=1, ddof=1), recent[:, -1] - recent[:, -4]), strict=True))
                for name, at in places.items():
                    if name in lags:
                        matrix[:, at] = lags[name]
                    elif name in coming:
                        matrix[:, at] = known[step, coming.index(name)]
                    else:
                        matrix[:, at] = fixed[:, static.index(name)]
                path[:, step] = np.maximum(score(matrix), 0.0)
                recent = np.column_stack([recent[:, 1:], path[:, step]])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(path.tolist(), pa.list_(pa.float64()))], names=[*SEGMENT, "history_weeks", "path"])

    state = _recent_state(table, static).select(*SEGMENT, "history_weeks", "recent", "static")
    kinds = dict(state.dtypes)
    paths = state.mapInArrow(run, ", ".join([*[f"{c} {kinds[c]}" for c in SEGMENT], "history_weeks int", "path array<double>"]))
    dates = F.array(*[F.lit(w) for w in weeks])
    steps = F.transform("path", lambda x, i: F.struct(F.get(dates, i).alias("week_start"), x.alias("predicted_units")))
    return paths.select(*SEGMENT, "history_weeks", F.inline(steps))

"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. The
first three return the columns of ``documents``: quality drops what the classifier
rejects, near_duplicates keeps one document of each group, secrets masks every span
found and keeps the document. The last gives one row per piece of a packed sequence.
A stage sets the session's runtime settings itself, so that it also holds to them when called alone.
"""

from __future__ import annotations

import inspect
import sys
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.llm import jaccard, packing, quality, secrets
from depotline.session import apply_runtime_settings
from depotline.stages import Job, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_settings(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(apply_runtime_settings(spark), docs, sf_dir)

    return run_stage


@with_settings
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = quality.learnable(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.where(F.col("score") >= quality.THRESHOLD).select("record.*")


@with_settings
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each_group(docs)


@with_settings
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


@with_settings
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [("quality", keep_good), ("near_duplicates", keep_one_of_each_group), ("secrets", mask_secrets), ("packing", pack)]

#: SQL can't train the classifier nor tokenise; the tests hold the stages against brute force.
ORACLE_SQL = None


def resumable(spark: SparkSession, sf_dir: str, name: str) -> Job:
    """Stages of the pipeline that a restart under the same name reads again; its owner closes it in the end."""
    inputs = [f"{sf_dir}/{table}.parquet" for table in ("documents", "labels")]
    return Job(spark, name, inputs, inspect.getsource(sys.modules[__name__]))


def run(spark: SparkSession, sf_dir: str, job: Job | None = None) -> DataFrame:
    """All stages, one after another; without a ``job`` every run starts from the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(job, f"pipeline-{name}", lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

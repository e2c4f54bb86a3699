"""Session construction and stored intermediate stages."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Runtime SQL settings the operators rely on. They are ordinary session
# settings: a caller's cluster defaults for memory, cores and shuffle width
# stay untouched.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows travel to Python in batches that both sides hold whole, twice while they are copied: 10,000 texts by default.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # Files are read by so many rows at a time, 4096 by default: each column of a batch is one array, of texts a long one that doubles as it fills.
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}


# Stages written by this process, for ``drop_stages``.
_STORED: list[str] = []


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "depotline", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for stored stages and checkpoints.

    The cluster's own ``spark.checkpoint.dir`` wins. Only a session without one
    (local runs, tests) falls back to a folder below its warehouse; a non-local
    master without the setting is refused because a machine-local folder would
    lose blocks together with their executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/depotline-stages"
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def write_stage(df: DataFrame, label: str) -> str:
    """Write ``df`` below the shared folder; gives the path."""
    path = f"{checkpoint_dir(df.sparkSession)}/stages/{label}-{uuid4().hex}"
    _STORED.append(path)
    df.write.parquet(path)
    return path


def read_stage(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared folder and continue from the files.

    Used for small tables that several branches read with different columns:
    without it each branch would repeat the scan and the joins behind them.
    """
    return read_stage(df.sparkSession, write_stage(df, label), df.schema)


def _delete(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete one stage of this process, once what follows from it is complete."""
    _STORED.remove(path)
    _delete(spark, path)


def drop_stages(spark: SparkSession) -> int:
    """Delete the stages this process has written; for the end of a job, when nothing reads them any more."""
    dropped = 0
    while _STORED:
        dropped += _delete(spark, _STORED.pop())
    return dropped

"""Jobs that resume: stages that outlive the driver that wrote them.

A job has a name its owner chooses and the inputs it reads. A stage of it is complete once its
commit marker exists, which is put in place by a rename after the write has ended and names the
folder of that attempt. A restarted job with the same name, the same input files (path, length, time of
change) and the same library code reads complete stages and builds the others; leftovers of an
attempt that was killed are never read. Anything else changed gives other stages. ``close``
drops all the job has written, under any inputs, and belongs at the end of a job that succeeded.

Resuming is asked for by name. Without a name, ``stored`` writes a stage of this process as
``session.store`` does, and nothing of an earlier run is read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from importlib import resources
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from depotline.session import checkpoint_dir, store


def _sources(folder) -> Iterator[bytes]:
    for entry in sorted(folder.iterdir(), key=lambda e: e.name):
        if entry.is_dir():
            yield from _sources(entry)
        elif entry.name.endswith(".py"):
            yield entry.name.encode() + b"\0" + entry.read_bytes()


def code_digest() -> str:
    """Of the library's sources, wherever they are read from."""
    digest = hashlib.sha256()
    for source in _sources(resources.files("depotline")):
        digest.update(hashlib.sha256(source).digest())
    return digest.hexdigest()


def input_digest(spark: SparkSession, paths: list[str]) -> str:
    """Of the files below ``paths``: names, lengths and times of change, listed by Spark; contents are not read."""
    if not paths:
        return "none"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", "length", "modificationTime")
    row = files.agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("mix"),
        F.sum(F.xxhash64(F.lit(1), "path", "length", "modificationTime").cast("decimal(38,0)")).alias("total"),
    ).first()
    return ":".join(map(str, row))


class Job:
    """Resumable stages of the job ``name`` over ``inputs``; one driver at a time runs a job.

    ``parameters`` is any text the stages depend on besides the library: settings, or the caller's own source.
    """

    def __init__(self, spark: SparkSession, name: str, inputs: list[str], parameters: str = "") -> None:
        if not re.fullmatch(r"[A-Za-z0-9_.-]*[A-Za-z0-9_-][A-Za-z0-9_.-]*", name):
            raise ValueError(f"a job's name is made of letters, digits, '.', '_' and '-': {name!r}")
        self.spark, self.name = spark, name
        self._root = f"{checkpoint_dir(spark)}/jobs/{name}"
        facts = [code_digest(), input_digest(spark, inputs), parameters]
        self._folder = f"{self._root}/{hashlib.sha256(json.dumps(facts).encode()).hexdigest()[:32]}"

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self):
        return self._path(self._root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _committed(self, label: str) -> DataFrame | None:
        marker = f"{self._folder}/{label}/commit.json"
        if not self._system().exists(self._path(marker)):
            return None
        found = json.loads(self.spark.read.text(marker, wholetext=True).first()[0])
        return self.spark.read.schema(StructType.fromJson(found["schema"])).parquet(f"{self._folder}/{label}/{found['attempt']}")

    def stage(self, label: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The rows of the complete stage ``label``; built and written first if it isn't complete.

        A label stands for one table of the job: two builds under one label would be taken for each other.
        """
        done = self._committed(label)
        if done is not None:
            return done
        df, attempt = build(), f"attempt-{uuid4().hex}"
        df.write.parquet(f"{self._folder}/{label}/{attempt}")
        system, written = self._system(), self._path(f"{self._folder}/{label}/{attempt}.json")
        out = system.create(written, False)
        out.write(bytearray(json.dumps({"attempt": attempt, "schema": df.schema.jsonValue()}).encode()))
        out.close()
        system.rename(written, self._path(f"{self._folder}/{label}/commit.json"))
        return self._committed(label)

    def close(self) -> bool:
        """Drop all stages of this name; whether there were any."""
        return self._system().delete(self._path(self._root), True)


def stored(job: Job | None, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage of ``job``, or one of this process alone."""
    return store(build(), label) if job is None else job.stage(label, build)

from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text) pairs or from (doc_id, text, source) triples."""

    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture
def table(frame, tmp_path):
    """The same, written as ``documents`` in a folder of its own; gives the folder."""

    def make(rows, parts=2, **others):
        frame(rows).repartition(parts).write.parquet(str(tmp_path / "documents.parquet"))
        for name, df in others.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make

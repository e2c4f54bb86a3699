from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from depotline.llm import quality
from depotline.llm.quality import Terms, context_sums, fit, fit_temperature, index_vectors, op5_quality, score, shape


def test_held_out_accuracy_and_contract(spark):
    """On the larger table, whose held-out fold has enough rows of both labels."""
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op5_quality(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()
    assert set(got) == {r.doc_id for r in docs}
    for r in got.values():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    labels = [(got[r.doc_id].predicted, r.quality) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert np.mean([p == q for p, q in labels]) > 0.95
    assert np.mean([p for p, q in labels if q == 1]) > 0.97


def test_context_sums_equal_brute_force(frame):
    texts = ["Aa bb, CC bb dd", "bb", None, "", "x " * 40, "Aa bb, CC bb dd"]
    places, signs = index_vectors()
    want, terms = np.zeros((quality.TERMS, quality.DIMENSIONS)), Terms()
    for text in texts:
        numbers = terms.of(text)
        for rows in ([n // quality.SHAPES for n in numbers], [quality.WORDS + n % quality.SHAPES for n in numbers]):
            for i, here in enumerate(rows):
                for j, there in enumerate(rows):
                    if 0 < abs(i - j) <= quality.REACH:
                        np.add.at(want[here], places[there], signs[there])
    assert (context_sums(frame(list(enumerate(texts))).repartition(3)) == want).all()


def test_shapes_and_temperature():
    assert [shape(w.encode()) for w in ("Über.", "AND,!!", "|", "a1b22")] == [b"x.", b"X,!", b"|", b"x9x9"]
    rng = np.random.default_rng(1)
    logit = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-logit))).astype(float)
    assert abs(fit_temperature(3 * logit, y) - 3) < 0.3 and abs(fit_temperature(logit, y) - 1) < 0.1


def test_edges(spark, frame):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "w " * 50_000)]
    docs = frame(rows).withColumn("score", F.lit("clash")).withColumn("features", F.lit(1))
    labels = spark.createDataFrame([(1, 1, None), (2, 0, None), (3, 1, None), (3, 0, None), (4, None, None), (None, 1, None)], "doc_id bigint, quality int, score string")
    scored = score(docs, fit(docs, labels))
    assert scored.select("record.*").columns == docs.columns
    got = scored.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.record.doc_id == 3}) == 1
    none = labels.where("false")
    assert {r.score for r in score(docs, fit(docs, none)).collect()} == {1.0}
    empty = docs.where("false")
    assert score(empty, fit(empty, labels)).collect() == []

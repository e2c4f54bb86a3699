from __future__ import annotations

import numpy as np
import pytest

from depotline.llm import neighbours
from depotline.llm.neighbours import op10_nearest_neighbours, search, valid_vectors

NAN, INF = float("nan"), float("inf")


def brute(rows, k=20):
    """rows: (vec_id, vector) that take part."""
    out = {}
    ids, points = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    for i, q in zip(ids, points, strict=True):
        if i % 20 == 0:
            scores = (points * q).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    hits = [len({v for v, _ in got.get(q, [])} & {v for v, _ in near}) / max(1, len(near)) for q, near in want.items()]
    return sum(hits) / len(hits)


def test_embeddings_recall_and_scores(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = found(op10_nearest_neighbours(spark, sf_dir)), brute(rows)
    assert got.keys() == want.keys() and recall(got, want) > 0.99
    exact = {q: dict(brute_all) for q, brute_all in brute(rows, len(rows)).items()}
    assert all(score == pytest.approx(exact[q][v], abs=1e-12) for q, near in got.items() for v, score in near)


def test_several_lists_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 300)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 128)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(24) + (i % 5)]) for i in range(2000)]
    vectors = valid_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3))
    assert recall(found(search(vectors, vectors.where("vec_id % 20 = 0"))), brute(rows)) > 0.99
    assert recall(found(search(vectors, vectors.where("vec_id % 20 = 0"), probes=3)), brute(rows)) > 0.9


def test_more_lists_than_probes(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 20)
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(24)]) for i in range(2000)]
    vectors = valid_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3))
    got = found(search(vectors, vectors.where("vec_id % 20 = 0"), probes=4))
    assert recall(got, brute(rows)) > 0.99 and all(len(near) == 20 for near in got.values())


def test_fewer_rows_in_the_first_lists_than_wanted(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 4)
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)]
    vectors = valid_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    got = found(search(vectors, vectors.where("vec_id % 20 = 0"), probes=1))
    assert got == brute(rows)


def test_a_common_vector_ties_and_unsound_rows(spark, table):
    same = [0.5, -1.0, 2.0]
    rows = [(i, same) for i in range(100)] + [(100, [1.0, 0.0, 0.0]), (101, [3.0, 3.0, 3.0])]
    unsound = [(120, None), (140, [0.0, 0.0, 0.0]), (160, [NAN, 1.0, 1.0]), (180, [None, 1.0, 1.0]), (200, [INF, 1.0, 1.0]), (220, [1.0]), (None, same), (240, [])]
    df = spark.createDataFrame(rows + unsound, "vec_id bigint, embedding array<double>").selectExpr("*", "1 list", "'x' code", "2 block")
    assert found(op10_nearest_neighbours(spark, table([], embeddings=df))) == brute(rows)


def test_few_rows_repeats_and_empty(spark):
    schema = "vec_id bigint, embedding array<float>"
    two = valid_vectors(spark.createDataFrame([(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, 1.0])], schema))
    assert found(search(two, two.where("vec_id % 20 = 0"))) == {0: [(1, 5.0)]}
    none = valid_vectors(spark.createDataFrame([], schema))
    assert search(none, none).collect() == []

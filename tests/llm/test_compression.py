from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from depotline.llm import compression
from depotline.llm.compression import Lists, compress, next_listed, op11_compression
from depotline.llm.registry import CHECKS

ROW = "vec_id bigint, embedding array<double>, label int"


def floor(x):
    n, d = float(x).as_integer_ratio()
    return n * 4096 // d


def slow(rows, parts=8, entries=16, rounds=6):
    """Plain search over all entries in unbounded integers; rows are (vec_id, vector, label)."""
    sound = [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not sound:
        return [], ""
    sizes = [len(v) for _, v, _ in sound]
    size = min(set(sizes), key=lambda n: (-sizes.count(n), n))
    sound = sorted((r for r in sound if len(r[1]) == size), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width, more = divmod(size, parts)
    x, at = [], 0
    for p in range(parts):
        end = at + width + (p < more)
        x.append([[floor(c) for c in v[at:end]] for _, v, _ in sound])
        at = end
    books = [part[:entries] for part in x]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v, e)), n) for n, e in enumerate(book)) for v in part] for part, book in zip(x, books)]

    for _ in range(rounds):
        found = assign()
        for p, book in enumerate(books):
            members = [[v for v, f in zip(x[p], found[p]) if f[1] == e] for e in range(len(book))]
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else e for m, e in zip(members, book)]
    found = assign()
    codes = ["".join(f"{found[p][r][1]:02x}" for p in range(parts)) for r in range(len(sound))]
    errors = [sum(found[p][r][0] for p in range(parts)) for r in range(len(sound))]
    by_label = {}
    for (_, _, label), e in zip(sound, errors):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, code, e if e < 1 << 63 else None, by_label[label]) for (i, _, label), code, e in zip(sound, codes, errors)), key=repr), sha


@pytest.fixture
def embeddings(spark, tmp_path):
    def make(rows, schema=ROW):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
        return str(tmp_path)

    return make


def got(df):
    rows = df.collect()
    assert len({r.codebooks_sha256 for r in rows}) <= 1
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in rows), key=repr), rows[0].codebooks_sha256 if rows else ""


def test_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(op11_compression(spark, sf_dir)) == slow(rows)


def test_sql_equals(spark, embeddings):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(300)]
    folder = embeddings(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    found = con.execute(CHECKS["op11_compression"]).fetchall()
    assert (sorted((r[:4] for r in found), key=repr), found[0][4]) == got(op11_compression(spark, folder)) == slow(rows)


def test_edges(spark, embeddings):
    """Nulls, odd dimensions, ties, repeated rows, no ids, no labels, coarse grids where nearly all distances tie."""
    rng = random.Random(4)
    rows = [(rng.choice([i, i, i // 2, None]), [rng.randint(-2, 2) / 4096 for _ in range(19)], rng.choice([None, 1, 2])) for i in range(200)]
    rows += [(900, None, 1), (901, [], 1), (902, [float("nan")] * 19, 1), (903, [float("inf")] * 19, 1), (904, [None] * 19, None), (905, [0.5] * 8, 1)]
    rows += rows[:20] + [(i, [0.25] * 19, 7) for i in range(2000, 2100)]
    assert got(op11_compression(spark, embeddings(rows))) == slow(rows)


@pytest.mark.parametrize("largest", [1e4, 1e7, 1e30, 1e200, 1.7e308])
def test_large_components(spark, embeddings, largest):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1, 1, 1e-3, 1e-9]) * rng.random() * largest for _ in range(9)], 1 if i % 2 else None) for i in range(60)]
    expected, sha = slow(rows)
    found = op11_compression(spark, embeddings(rows)).collect()
    assert sorted(((r.vec_id, r.code, r.error) for r in found), key=repr) == [e[:3] for e in expected] and found[0].codebooks_sha256 == sha


def test_few_and_none(spark, embeddings, tmp_path_factory):
    rows = [(i, [0.1 * i, -0.2 * i, 0.3], None) for i in range(5)]
    assert got(op11_compression(spark, embeddings(rows))) == slow(rows)
    empty = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([(1, None, 3)], ROW).write.parquet(f"{empty}/embeddings.parquet")
    df = op11_compression(spark, empty)
    assert df.count() == 0 and df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_other_columns(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    names = ("x", "ids", "bounds", "totals", "depths", "codes", "error", "vector", "of")
    wide = table.select("*", *[F.lit("z").alias(c) for c in names])
    assert sorted(map(str, compress(wide)[0].collect())) == sorted(map(str, compress(table)[0].collect()))


def test_bounds_spare_distances(spark):
    """On clustered vectors few parts look beyond their own entry after some rounds, lists get shorter, and codes are exact."""
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (12, 32))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(0, 0.05, 32)], i % 3) for i in range(1500)]
    table = spark.createDataFrame(rows, ROW)
    coded, books, history = compress(table)
    expected, sha = slow(rows)
    assert sorted((r.vec_id, r.codes.hex(), r.error) for r in coded.collect()) == sorted(e[:3] for e in expected) and books.sha256() == sha
    last_listed, last = history[-1]
    assert sum(sum(d[compression.LISTED :]) for d in last) < 0.1 * 8 * len(rows) and sum(last_listed) < sum(history[0][0])


def test_lists_hold_true_bounds():
    """After any movement every bound is on its side of the true distance, and the first entry is the nearest."""
    rng = np.random.default_rng(0)
    x = rng.integers(-50, 50, (400, 4))
    entries = rng.integers(-50, 50, (16, 4))
    lists = Lists.measured(x, entries, 4)
    for step in range(12):
        moved = entries + rng.integers(-9 + step // 2, 10 - step // 2, entries.shape) if step % 3 else entries
        drift = np.nextafter(np.sqrt(((moved - entries) ** 2).sum(1).astype(float)), np.inf)
        entries = moved
        lists.moved(x, entries, drift)
        squared = compression.squares(x, entries)
        assert (lists.ids[:, 0] == squared.argmin(axis=1)).all()
        distance = np.sqrt(squared)
        listed = lists.ids.shape[1]
        for r in range(len(x)):
            assert lists.bounds[r, 0] >= distance[r, lists.ids[r, 0]]
            others = np.delete(distance[r], lists.ids[r])
            assert lists.bounds[r, listed] <= others.min()
            for z in range(1, listed):
                assert lists.bounds[r, z] <= distance[r, lists.ids[r, z]]
        if step == 6:
            lists.cut(3)


def test_next_listed():
    assert next_listed(4, [90, 5, 5, 0, 0, 0, 0], 16) == 2
    assert next_listed(4, [50, 0, 20, 20, 10, 0, 0], 16) == 4
    assert next_listed(4, [10, 0, 0, 0, 0, 90, 0], 16) == 8
    assert next_listed(4, [100, 0, 0, 0, 0, 0, 0], 16) == 2


def test_column_kinds(spark, tmp_path):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.StringType())])
    rows = [(i, [i / 7, -i / 3, 0.5, 1.0, 2.0, 3.0, 4.0, 5.0], "ab"[i % 2]) for i in range(40)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "embeddings.parquet"))
    single = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert got(op11_compression(spark, str(tmp_path))) == slow(single)

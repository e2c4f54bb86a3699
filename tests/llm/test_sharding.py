from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from depotline.llm import sharding
from depotline.llm.sharding import op1_sharding, shard_rows, size_of, write_shards


def check(got, rows):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = defaultdict(list)
    for r in got:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 16
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    counts = [len(slots[s]) for s in range(16)]
    assert max(counts) - min(counts) <= 1


def test_whole_table_one_slot_each(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check(op1_sharding(spark, sf_dir).collect(), rows)


def test_many_buckets_ties_nulls_and_long_texts(spark, table, monkeypatch):
    rows = [(7, "same")] * 60 + [(None, None), (None, ""), (1, "é" * 5000), (2, "x")]
    monkeypatch.setattr(sharding.shard_rows, "__defaults__", (16, 100, 17))
    check(op1_sharding(spark, table(rows)).collect(), rows)


def test_empty(spark, table):
    assert op1_sharding(spark, table([])).collect() == []


def test_same_seed_same_order_and_a_real_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("shard", F.lit("clash"))
    runs = [
        [(r.shard, r.slot, r.record.doc_id) for r in shard_rows(docs, [F.col("doc_id")], size_of(F.col("text")), 4, 50_000, seed).collect()]
        for seed in (1, 1, 2)
    ]
    assert sorted(runs[0]) == sorted(runs[1]) != sorted(runs[2])
    order = [x[2] for x in sorted(runs[0])]
    rising = sum(a < b for a, b in zip(order, order[1:], strict=False))
    assert 0.3 < rising / len(order) < 0.7


def test_written_shards_hold_the_rows(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_shards(shard_rows(docs, [F.col("doc_id")], size_of(F.col("text")), 4, 100_000), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.select("record.*").exceptAll(docs).count() == 0 and back.count() == docs.count()

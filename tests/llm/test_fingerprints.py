from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from depotline.llm import fingerprints
from depotline.llm.fingerprints import BOUND, containment, likeness, merged, op4_fingerprints, with_fingerprint

EDGES = [
    (4, "one two three four five six seven eight nine ten " * 30), (1, None), (2, ""), (3, " \t\n"), (5, "é😀漢字 " * 41), (6, "short one"), (6, "short one"), (9, "x"),
    (None, "no id here at all but six words"), (11, "w " * 30_000), (6, "another text with the same id"),
]


def brute(rows):
    """(doc_id, n_chars, edited_sha256) for ids that don't repeat."""
    texts = [(i, t or "") for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))]
    out = {}
    for n, (i, text) in enumerate(texts):
        following = texts[(n + 1) % len(texts)][1]
        k = len(text) // 4
        out[i] = (len(text), hashlib.sha256((text[: len(text) - k] + following[:k]).encode()).hexdigest(), following, text[: len(text) - k] + following[:k])
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(x, y):
    return len(x & y) / len(x | y) if x | y else 1.0


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want, got = brute(rows), op4_fingerprints(spark, sf_dir).collect()
    assert len(got) == len(rows)
    off, texts, prints = [], dict(rows), {}
    for r in got:
        n_chars, sha, following, edited = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n_chars, sha)
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        own = shingles(texts[r.doc_id] or "")
        if len(own) > 400:
            off.append(abs(r.near_edited - jaccard(own, shingles(edited))))
            off.append(abs(r.near_next - jaccard(own, shingles(following))))
    assert len(off) > 40 and max(off) < 0.25 and sum(off) / len(off) < 0.04


def test_edges(spark, table):
    got = op4_fingerprints(spark, table(EDGES)).collect()
    assert len(got) == len(EDGES)
    want = brute([r for r in EDGES if r[0] != 6] + [(5.5, "short one")])
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and r.n_chars in {len(t or "") for i, t in EDGES if i == r.doc_id}
        if r.doc_id in (1, 2, 3, 4, 9, 11, None):
            assert (r.n_chars, r.edited_sha256) == want[r.doc_id][:2]
    assert len({r.fingerprint for r in got if r.doc_id == 6}) == 2
    assert all((r.fingerprint == "") == (r.doc_id in (1, 2, 3)) for r in got)


def test_one_document_and_none(spark, table, tmp_path):
    assert op4_fingerprints(spark, table([(1, "abcd efgh")])).collect()[0].edited_sha256 == hashlib.sha256(b"abcd efab").hexdigest()


def test_empty(spark, table):
    assert op4_fingerprints(spark, table([])).collect() == []


def test_every_low_hash_is_kept_and_merging_is_exact(frame, monkeypatch):
    a, b = " ".join(f"a{i}" for i in range(500)), " ".join(f"b{i}" for i in range(30))
    df = with_fingerprint(frame([(1, a), (2, b), (3, f"{a} {b}")]), "text", "print")
    got = {r.doc_id: r["print"] for r in df.collect()}
    hashed = frame([(1, a)]).select(F.split("text", " ").alias("w")).select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 4), lambda i: F.xxhash64(F.slice("w", i, 5)))).alias("h"))
    assert got[1] == sorted({r.h for r in hashed.collect() if r.h < BOUND}) and 30 < len(got[1]) < 100
    pair = df.where("doc_id = 1").select(F.col("print").alias("x")).crossJoin(df.where("doc_id = 2").select(F.col("print").alias("y")))
    r = pair.select(merged(F.col("x"), F.col("y")).alias("m"), containment(F.col("x"), merged(F.col("x"), F.col("y"))).alias("c"), likeness(F.col("x"), F.col("y")).alias("l")).first()
    assert set(r.m) <= set(got[3]) and r.c == 1.0 and r.l == 0.0
    assert fingerprints.SCALE == 8 and pytest.approx(sum(map(len, got.values())) / (496 + 26 + 526), abs=0.06) == 1 / 8


def test_columns_of_the_table_survive(frame):
    names = ["words", "hashes", "low", "lowest", "_words", "_hashes", "_low", "_lowest", "WORDS_"]
    docs = frame([(1, "a b c d e f"), (2, None)]).select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    got = with_fingerprint(docs, "text", "print")
    assert got.columns == [*docs.columns, "print"]
    assert all(tuple(r)[-len(names) - 1 : -1] == tuple(range(len(names))) for r in got.collect())

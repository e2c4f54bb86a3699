from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotline.llm import jaccard
from depotline.llm.jaccard import BANDS, RATIO, band_difference, components, one_of_each_group, op6_jaccard_join, shingle_set, sketch


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs of distinct sets."""
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append(frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)]) if w else frozenset())
    distinct = sorted({s for s in sets if s}, key=repr)
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for x, y in combinations(distinct, 2):
        if min(len(x), len(y)) * 10 >= max(len(x), len(y)) * 9 and 100 * len(x & y) >= 90 * len(x | y):
            root[find(x)] = find(y)
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[find(s)] = min(i, least.get(find(s), i))
    return sorted(((i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(rows, sets, strict=True)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "one\x1ctwo"), (7, "a b c"), (7, "a b c"), (7, "x y z w"), (None, "a b c"), (None, None),
    (None, "only null ids"), (8, "É b c"), (9, "é b c"), (10, "w " * 30_000), (11, "w " * 40_000),
]


def near_copies(seed, groups=8, size=12):
    """Groups around a text, with edits that lie on both sides of the threshold, and chains."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(4000)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 11, 13, 20, 45, 120, 400]))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                at = rng.randrange(len(text))
                if rng.random() < 0.4:
                    del text[at]
                else:
                    text[at] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
            if rng.random() < 0.3:
                base = text
    rng.shuffle(rows)
    return rows


def test_edges(spark, table):
    assert result(op6_jaccard_join(spark, table(EDGES))) == brute(EDGES)


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op6_jaccard_join(spark, sf_dir)) == brute(rows)


@pytest.mark.parametrize(("seed", "few"), [(1, 8), (2, 0)])
def test_near_copies(frame, monkeypatch, seed, few):
    monkeypatch.setattr(jaccard, "GROUP", 4)
    monkeypatch.setattr(jaccard, "SKETCHES", 100)
    monkeypatch.setattr(jaccard, "FEW", few)
    rows = near_copies(seed)
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows)
    assert result(components(frame(rows))) == want


def test_empty(spark, table):
    assert op6_jaccard_join(spark, table([])).collect() == []


def test_bands_cover_every_linked_pair():
    """Sizes of linked pairs lie in adjacent bands, and their difference within the larger one's bound."""
    for b in range(1, 1500):
        band = int(np.searchsorted(BANDS, b, "right")) - 1
        for a in range(-(-9 * b // 10), b + 1):
            assert a >= BANDS[max(band - 1, 0)] and (a + b) // RATIO <= band_difference(band)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(200):
        x = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.95], rng.integers(0, 2**63, 9).astype(np.uint64)]))
        band = int(np.searchsorted(BANDS, 300, "right")) - 1
        distance = int(np.bitwise_count((sketch(x, band) ^ sketch(y, band)).view(np.uint64)).sum())
        assert distance <= len(np.setxor1d(x, y))
    assert len(shingle_set("a b c a b c a b c")) == 3


def test_one_row_of_each_group_stays(frame):
    docs = frame(EDGES).withColumn("group", F.lit("clash")).withColumn("k0", F.lit(1))
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, (r.text or "")[:14]) for r in kept.collect()), key=repr)
    assert got == sorted([
        (1, ""), (2, ""), (3, " \n\t"), (4, "One two"), (6, "one\x1ctwo"), (7, "a b c"), (7, "x y z w"), (None, ""), (None, "only null ids"), (8, "É b c"), (9, "é b c"),
        (10, "w " * 7),
    ], key=repr)


def test_bands_of_another_similarity():
    for b in range(1, 600):
        band = int(np.searchsorted(jaccard.bands(9), b, "right")) - 1
        for a in range(-(-8 * b // 10), b + 1):
            assert a >= jaccard.bands(9)[max(band - 1, 0)] and (a + b) // 9 <= band_difference(band, 9)


def test_one_of_each_group_by_five_words_and_four_fifths(frame):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(0, 30, 3):
        words = [f"w{n}" for n in rng.integers(0, 10**6, 1000)]
        rows.append((i, " ".join(words)))
        for n, edits in ((1, 21), (2, 26)):  # similarity 0.81 and 0.77
            copy = list(words)
            for k in range(edits):
                copy[20 + k * 37] = f"x{i}y{n}z{k}"
            rows.append((i + n, " ".join(copy)))
    kept = one_of_each_group(frame(rows), words=5, ratio=9)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _ in rows if i % 3 != 1]
    assert one_of_each_group(frame(rows)).count() == len(rows)


def test_a_third_of_equal_rows_and_many_short_templates(spark, frame, monkeypatch):
    """A class counts once in shared words, and groups are compared in parts."""
    monkeypatch.setattr(jaccard, "PART_ROWS", 64)
    rows = [(i, "the same text that very many rows hold without any change at all") for i in range(600)]
    rows += [(1000 + i, f"dear customer {i} your order number {i * 7} has been sent on its way today") for i in range(600)]
    rows += [(5000 + i, t) for i, (_, t) in enumerate(near_copies(9, groups=3, size=10))]
    assert result(components(frame(rows).repartition(5))) == brute(rows)
    stored = jaccard.profiles(frame(rows[:600]), 3, RATIO)
    one = stored.groupBy("id").agg(F.max(F.struct("n_shingles", "band", "own", "up")).alias("set"))
    assert one.count() == 1 and jaccard.shared_words(one).count() == 0

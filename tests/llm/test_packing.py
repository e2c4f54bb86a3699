from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from depotline.llm import packing
from depotline.llm.packing import Mixture, WordEncoder, op8_packing, pack

PATH = P.path("word_bpe_49k.json")


def ids_of(text):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(got, rows, window=2048):
    """Every id in one piece, sequences gapless, all full but the last."""
    want = defaultdict(list)
    for i, text, *_ in rows:
        want[i].append(ids_of(text))
    have, sequences = defaultdict(int), defaultdict(list)
    for r in got:
        assert r.length > 0
        options = [ids for ids in want[r.doc_id] if len(ids) == r.doc_tokens and zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length])) == r.ids_crc32]
        assert options
        have[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert have == {i: sum(map(len, ids)) for i, ids in want.items()}
    for number, pieces in sequences.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == window or number == len(sequences) - 1 and at < window
    assert set(sequences) == set(range(len(sequences)))


EDGES = [
    (1, None, "a"), (2, "", None), (3, "It's  the\n\tend <|endoftext|> 42é é", "b"), (4, "word " * 9000, "a"), (5, "\x1c x\xa0y z", "b"), (6, "same", "c"),
    (6, "same", "c"), (7, "ÅNGSTRÖM ſs İ", "a"), (None, "no id", None),
]


def test_edges(spark, table):
    check(op8_packing(spark, table(EDGES)).collect(), EDGES)


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(op8_packing(spark, sf_dir).collect(), rows)


def test_empty(spark, table):
    assert op8_packing(spark, table([])).collect() == []


def test_every_window_holds_the_mixture(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise("cold")).cache()
    pieces = pack(docs, PATH).join(docs.select("doc_id", "source"), "doc_id")
    shares = {(r.sequence_id, r.source): r.n for r in pieces.groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).collect()}
    last = max(s for s, _ in shares)
    total = sum(shares.values())
    for source in ("hot", "cold"):
        share = sum(n for (_, s), n in shares.items() if s == source) / total
        assert all(abs(shares[w, source] - 2048 * share) < 2 for w in range(last))


def test_targets_hold_until_a_queue_is_empty():
    mixture = Mixture([10_000, 50_000, 3000], [1.0, 1.0, 2.0], 100)
    served = mixture.served(__import__("numpy").arange(mixture.windows + 1))
    assert (served.sum(axis=0)[:-1] == [100 * w for w in range(mixture.windows)]).all() and served[:, -1].tolist() == [10_000, 50_000, 3000]
    assert (served[:, 1:] >= served[:, :-1]).all()
    assert served[:, 20].tolist() == [500, 500, 1000] and served[:, 300].tolist()[2] == 3000


def test_totals_never_fall_for_a_queue_of_a_few_tokens():
    np = __import__("numpy")
    for few in (1, 12, 60, 300):
        sizes = [200_000 + 6000 * i for i in range(20)] + [few]
        mixture = Mixture(sizes, [float(s) for s in sizes])
        served = mixture.served(np.arange(mixture.windows + 1))
        shares = np.diff(served, axis=1)
        assert (shares >= 0).all() and (shares.sum(axis=0)[:-1] == 2048).all() and served[:, -1].tolist() == sizes
        # By the order itself.
        order = np.lexsort((np.repeat(np.arange(21), sizes), np.concatenate([(np.arange(s) + 0.5) / s for s in sizes])))
        queues = np.repeat(np.arange(21), sizes)[order]
        for window in (1, 2, 1000, mixture.windows - 1):
            assert np.bincount(queues[: 2048 * window], minlength=21).tolist() == served[:, window].tolist()


def test_many_small_sources_share_a_queue(spark, table):
    rows = [(i, f"text number {i}", f"s{i}") for i in range(600)]
    check(op8_packing(spark, table(rows, parts=3)).collect(), rows)


def shares_over_runs(pieces, rows, windows):
    """Tokens by source in each run of so many windows."""
    source = {i: s for i, _, s in rows}
    runs = defaultdict(lambda: defaultdict(int))
    for r in pieces:
        runs[r.sequence_id // windows][source[r.doc_id]] += r.length
    return runs


def check_fast(got, rows, monkeypatch):
    """``check`` with each text encoded once."""
    known = {text: ids_of(text) for text in {text for _, text, _ in rows}}
    monkeypatch.setitem(globals(), "ids_of", known.get)
    check(got, rows)


def test_many_equal_sources_hold_their_shares(spark, table, monkeypatch):
    rows = [(i, "one two three four " * 5, f"s{i % 600}") for i in range(24_000)]
    rows += [(24_000 + i, "five six seven eight " * 200, f"s{i}") for i in range(600)]
    got = pack(spark.read.parquet(table(rows, parts=3) + "/documents.parquet"), PATH).collect()
    check_fast(got, rows, monkeypatch)
    runs = shares_over_runs(got, rows, 150)
    for number in range(max(runs) - 1):
        assert all(abs(runs[number][f"s{i}"] - 150 * 2048 / 600) < 300 for i in range(600))


def test_a_small_source_has_its_own_target(spark, table, monkeypatch):
    rows = [(i, "one two three four " * 5, f"s{i % 600}") for i in range(24_000)]
    wanted = {f"s{i}": 1.0 for i in range(599)} | {"s0": 2.0}
    got = pack(spark.read.parquet(table(rows, parts=3) + "/documents.parquet"), PATH, targets=wanted).collect()
    check_fast(got, rows, monkeypatch)
    runs = shares_over_runs(got, rows, 100)
    fair = 100 * 2048 / 600
    assert abs(runs[0]["s0"] - 2 * fair) < 64 and all(abs(runs[0][f"s{i}"] - fair) < 64 for i in range(1, 599)) and runs[0]["s599"] == 0
    assert runs[max(runs)]["s599"] > 0


def test_words_of_letters_and_marks_take_no_pattern(monkeypatch):
    """Most words are met once; splitting them by a pattern cost a fifth of the time."""
    encoder = WordEncoder(PATH)
    text = "Thti,### réréelle TOORESIN!! osjaie. 'quoted' Straße; it's don't 64.245.247.29 a_b --- µm² x\x1cy ſs \xad"
    assert np.frombuffer(encoder.encode(text), "<u2").tolist() == ids_of(text)[:-1]
    fresh = WordEncoder(PATH)
    monkeypatch.setattr(fresh, "split", None)
    text = "Thti,### réréelle TOORESIN!! osjaie. Straße; thntingor"
    assert np.frombuffer(fresh.encode(text), "<u2").tolist() == ids_of(text)[:-1]


def test_words_come_back_from_the_older_generation(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 3)
    encoder, text = WordEncoder(PATH), "one two three four one two five one six seven eight one " + "long" * 40
    for _ in range(2):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == ids_of(text)[:-1]
        assert len(encoder.words) <= 3 and len(encoder.words.older) <= 3


def test_texts_reach_python_in_bounded_batches(spark):
    """Ten thousand texts at a time, whatever their size, took the executors of the pipeline beyond their memory."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    texts = spark.range(4000).coalesce(1).select(F.repeat(F.lit("x"), 8000).alias("text"))
    assert max(r.n for r in texts.mapInArrow(sizes, "n bigint").collect()) < 9 << 20

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from depotline.llm import language_model as lm
from depotline.llm.language_model import Lanes, Lexicon, Trainer, op2_language_model, score_documents, unit_log_probability, views


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def brute(rows):
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    counts = Counter(t for i, text in rows if not held[i] for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, text in rows:
        tokens = tokens_of(text)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        out[i] = (held[i], len(tokens), sum(counts[t] > 0 for t in tokens), n, base)
    return out


def check(got, want):
    for r in got:
        held, n_tokens, n_known, n, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n_tokens, n_known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9) and r.score <= 1e-9


def test_documents_base_and_a_better_model(spark, monkeypatch):
    sf_dir = "/root/testdata/sf0.01"
    monkeypatch.setattr(lm, "FREQUENT", 3000)  # so that most words go through the join
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = op2_language_model(spark, sf_dir).collect()
    assert len(got) == len(rows)
    check(got, brute(rows))
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) + 0.15 * sum(r.n_tokens for r in unseen)


EDGES = [(1, None), (2, ""), (3, "The THE the."), (4, "a\x1cb é É"), (None, "the end"), (5, "word " * 30_000), (6, " \n"), (7, "x " * 3 + "unseen"), (1, None)]


def test_edges(spark, table):
    got = op2_language_model(spark, table(EDGES)).collect()
    assert len(got) == len(EDGES)
    check(got, brute(EDGES))
    assert len({r.score for r in got if r.doc_id == 1}) == 1


def test_empty_and_nothing_to_learn_from(spark, table, frame):
    assert op2_language_model(spark, table([])).collect() == []
    r = score_documents(frame([(1, "a b")]), F.lit(False)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.base_score == 0


def network(seed=1):
    flat = lm.initial(seed).astype(np.float64)
    return flat, views(flat)


def slow_log_probability(net, units):
    """One step after another, one document."""
    state, before, total, h = np.zeros(lm.HIDDEN), lm.UNITS, 0.0, lm.HIDDEN
    for u in units:
        into, rec = net["input"][before], state @ net["state"]
        gate = 1 / (1 + np.exp(-(into[: 2 * h] + rec[: 2 * h])))
        fresh = np.tanh(into[2 * h :] + gate[h:] * rec[2 * h :])
        state = (1 - gate[:h]) * fresh + gate[:h] * state
        c, m = divmod(u, lm.MEMBERS)
        classes, members = state @ net["class_w"] + net["class_b"], state @ net["member_w"][c] + net["member_b"][c]
        total += classes[c] - np.log(np.exp(classes).sum()) + members[m] - np.log(np.exp(members).sum())
        before = u
    return total


def test_state_is_carried_through_whole_documents():
    _, net = network()
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, lm.UNITS, n).tolist() for n in (1, 700, 3, 90, 33, 5, 1)]
    assert lm.log_probabilities(net, docs) == pytest.approx([slow_log_probability(net, d) for d in docs], rel=1e-4)


def test_units_and_words_are_distributions():
    _, net = network()
    states = np.random.default_rng(0).normal(size=(1, lm.HIDDEN)).repeat(lm.UNITS, axis=0)
    found, _ = unit_log_probability(net, states, np.arange(lm.UNITS))
    assert np.exp(found).sum() == pytest.approx(1, rel=1e-5)
    words = [(f"w{i}".encode(), 5000 - i) for i in range(2000)]
    rest = words[lm.UNITS - lm.SHARED :]
    totals = {}
    for w, c in rest:
        a, b = totals.get(lm.shared_unit(w), (0, 0))
        totals[lm.shared_unit(w)] = a + c, b + 1
    lexicon = Lexicon(words, totals)
    mass = 10.0 ** (math.log10(0.5) - lexicon.log_total)  # the unknown word of each shared unit
    np.add.at(mass, lexicon.unit[lm.UNITS - lm.SHARED :], 10.0 ** lexicon.share[lm.UNITS - lm.SHARED :])
    assert mass == pytest.approx(np.ones(lm.SHARED)) and (lexicon.share[: lm.UNITS - lm.SHARED] == 0).all()


def test_slopes_equal_differences():
    """Back-propagation through one window against numeric slopes."""
    flat, net = network()
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, lm.UNITS, n).tolist() for n in (9, 4, 6)]
    lanes = Lanes(docs, 2)
    ((at, real),) = lanes.windows(20)
    before, keep, target = lanes.before[at], lanes.keep[at].astype(float), lanes.target[at[real]]
    start = rng.normal(size=(2, lm.HIDDEN))

    def loss(parameters):
        out, _ = lm.run_states(views(parameters), before, keep, start)
        return -unit_log_probability(views(parameters), out[real], target)[0].mean()

    slope = np.zeros_like(flat)
    out, kept = lm.run_states(net, before, keep, start, record=True)
    slope_out = np.zeros_like(out)
    _, slope_out[real] = unit_log_probability(net, out[real], target, views(slope))
    lm.back_through(net, before, keep, kept, slope_out, views(slope))
    big = np.argsort(-np.abs(slope))[:400]
    for i in rng.choice(big, 40, replace=False):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(slope[i], rel=0.05, abs=2e-4)


def test_training_learns_what_follows():
    docs = [[1, 2, 3, 4, 5] * 8 for _ in range(60)] + [[9, 8, 7] * 10 for _ in range(60)]
    trainer = Trainer(lm.initial())
    for _ in range(120):
        trainer.learn(docs)
    assert trainer.tokens == 120 * sum(map(len, docs))
    per_token = lm.log_probabilities(views(trainer.flat), docs) / [len(d) for d in docs]
    assert per_token.min() > -0.7


def test_the_network_is_whole():
    assert lm.CLASSES * lm.MEMBERS == lm.UNITS >= 1024 and lm.UNITS - lm.SHARED >= 832 and lm.SHARED >= 192 and lm.HIDDEN >= 16
    assert views(lm.initial())["member_w"].shape == (lm.CLASSES, lm.HIDDEN, lm.MEMBERS)


def test_a_window_is_worked_on_in_whole_pieces(monkeypatch):
    """What a step works on has the lanes last, also in what is recorded; the members of all classes are normalised together."""
    _, net = network()
    rng = np.random.default_rng(5)
    before, keep = rng.integers(0, lm.UNITS, (7, 30)), np.ones((7, 30), np.float32)
    out, (old, gates, inner) = lm.run_states(net, before, keep, np.zeros((30, lm.HIDDEN), np.float32), record=True)
    assert out.shape == (7, 30, lm.HIDDEN) and old.shape == inner.shape == (7, lm.HIDDEN, 30) and gates.shape == (7, 3 * lm.HIDDEN, 30)
    assert (out[:-1].transpose(0, 2, 1) == old[1:]).all()
    calls, known = [], lm._exponentials
    monkeypatch.setattr(lm, "_exponentials", lambda logits: calls.append(1) or known(logits))
    unit_log_probability(net, out.reshape(-1, lm.HIDDEN), before.ravel())
    assert len(calls) == 2


ODD = ["", None, "  The THE\tthe.\n", "\x0b\x0c a\x1cb é É İ x y ", " ", "x" * 5000, "a  b\r\n\r\nc", "\x00 \x1f\x85", "end"]


def test_words_split_together_are_the_words_of_each():
    texts = pa.array(ODD * 3)
    for part in (texts, texts.slice(4, 9), texts.slice(0, 0)):
        words, lengths = lm.split_words(part)
        want = [[(t or "").encode() for t in tokens_of(text)] for text in part.to_pylist()]
        assert lengths.tolist() == [len(w) for w in want] and words.to_pylist() == sum(want, [])


def test_counts_are_added_up(frame):
    rows = [(i, f"a b{i % 7} c{i} A") for i in range(300)]
    want = Counter((t or "").encode() for _, text in rows for t in tokens_of(text))
    assert {bytes(r.word): r["count"] for r in lm.count_words(frame(rows)).collect()} == want


@pytest.mark.parametrize("n_frequent", [0, 5, 900, 1100])
def test_looked_up_words_have_their_unit_count_and_share(n_frequent):
    words = [b""] + [f"w{i}".encode() for i in range(1200)]
    lexicon = Lexicon([(w, 3000 - i) for i, w in enumerate(words[:n_frequent])], {u: (50, 9) for u in range(0, lm.SHARED, 2)})
    asked = [*words, b"z", "é€".encode(), b"w7", b""]
    found = [a.tolist() for a in lexicon.look_up(pa.array(asked, pa.binary()))]
    own = lm.UNITS - lm.SHARED
    for i, (word, unit, log_count, share, rare) in enumerate(zip(asked, *found, strict=True)):
        rank = words.index(word) if word in words else n_frequent
        shared = zlib.crc32(word[-3:]) % lm.SHARED
        log_total = math.log10((0 if shared % 2 else 50) + 0.5 * ((0 if shared % 2 else 9) + 1))
        assert rare == (rank >= n_frequent) and unit == (lm.SHARED + rank if rank < min(own, n_frequent) else shared), i
        assert log_count == pytest.approx(0 if rare else math.log10(3000 - rank + 0.5))
        assert share == pytest.approx(-log_total if rare else 0 if rank < own else log_count - log_total)


def test_training_and_scoring_read_the_stored_units(frame, monkeypatch):
    read = []
    for name in ("train", "add_model"):
        monkeypatch.setattr(lm, name, lambda encoded, *more, known=getattr(lm, name): read.append(encoded) or known(encoded, *more))
    rows = [(i, text) for i, text in enumerate(ODD * 5)]
    got = score_documents(frame(rows), F.col("doc_id") % 5 != 1).collect()
    assert len(got) == len(rows) and {r.doc_id: r.n_tokens for r in got} == {i: len(tokens_of(text)) for i, text in rows}
    assert len(read) == 2
    for encoded in read:
        assert "text" not in encoded.columns and all("lm-encoded" in f for f in encoded.inputFiles())
        for r in encoded.collect():
            assert len(r.units) == 2 * r.n_tokens and r.n_tokens - r.n_frequent == len(r.rare)


def test_exponentials_are_scaled_only_where_they_might_leave_their_range():
    rng = np.random.default_rng(6)
    small = rng.normal(0, 10, (5, 32)).clip(-50, 50).astype(np.float32)
    exponentials, sums = lm._exponentials(small.copy())
    assert exponentials == pytest.approx(np.exp(small.astype(float)), rel=1e-5) and sums == pytest.approx(np.exp(small.astype(float)).sum(axis=1), rel=1e-5)
    for shift in (0, 500, -500):
        large = small + np.float32(shift) + np.arange(5, dtype=np.float32)[:, None] * 100
        exponentials, sums = lm._exponentials(large.copy())
        exact = np.exp(large.astype(float) - large.max(axis=1, keepdims=True))
        assert exponentials / sums[:, None] == pytest.approx(exact / exact.sum(axis=1, keepdims=True), rel=1e-4, abs=1e-30)


@pytest.mark.parametrize("scale", [1, 300])
def test_units_have_the_probability_of_the_formula(scale):
    """Targets in any order, classes without targets, logits within and beyond the bound."""
    flat, net = network(7)
    flat *= scale
    rng = np.random.default_rng(8)
    net["class_b"][:], net["member_b"][:] = rng.normal(size=lm.CLASSES), rng.normal(size=(lm.CLASSES, lm.MEMBERS))
    states, target = rng.uniform(-1, 1, (90, lm.HIDDEN)), rng.choice(np.append(np.arange(70), lm.UNITS - 1), 90)
    kind, member = target // lm.MEMBERS, target % lm.MEMBERS
    classes, members = states @ net["class_w"] + net["class_b"], np.einsum("nh,nhm->nm", states, net["member_w"][kind]) + net["member_b"][kind]
    at, most = np.arange(90), [x.max(axis=1) for x in (classes, members)]
    want = classes[at, kind] + members[at, member] - sum(m + np.log(np.exp(x - m[:, None]).sum(axis=1)) for x, m in zip((classes, members), most, strict=True))
    assert unit_log_probability(net, states, target)[0] == pytest.approx(np.maximum(want, np.log(1e-37)), rel=1e-9)


def test_windows_record_what_is_read_again_and_slopes_of_32_bits_are_those_of_64():
    flat, _ = network(9)
    rng = np.random.default_rng(10)
    lanes = Lanes([rng.integers(0, 40, n).tolist() for n in (20, 20, 13, 7, 5)], 3)  # few units, each of them often
    assert lanes.target.dtype == lanes.before.dtype == np.int16 and lanes.keep.dtype == bool
    found = []
    for kind in (np.float32, np.float64):
        slope, net = np.zeros_like(flat, kind), views(flat.astype(kind))
        for at, real in lanes.windows(20):
            within = lm.places_within(real)
            out, kept = lm.run_states(net, lanes.before[at], lanes.keep[at], np.zeros((at.shape[1], lm.HIDDEN), kind), record=True)
            assert all(part.flags.c_contiguous and part.base is None for part in kept)
            back = np.zeros((at.size, lm.HIDDEN), kind)
            _, back[within] = unit_log_probability(net, out.reshape(-1, lm.HIDDEN)[within], lanes.target[at.ravel()[within]], views(slope))
            lm.back_through(net, lanes.before[at], lanes.keep[at], kept, back.reshape(out.shape), views(slope))
        found.append(slope)
    assert found[0].dtype == np.float32 and np.abs(found[1]).max() > 0.01
    assert found[0] == pytest.approx(found[1], rel=1e-3, abs=1e-6)
    assert not views(found[0])["input"][40 : lm.UNITS].any()  # units that never stand before another

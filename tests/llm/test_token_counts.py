from __future__ import annotations

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from depotline.llm.byte_bpe import load
from depotline.llm.token_counts import allocate, count_by_section, op3_token_counts

PATH = P.path("byte_bpe_50k.tiktoken")
EDGES = [
    (1, None), (2, ""), (3, "\n"), (4, "one\ntwo three\n\n\n  four"), (5, "é😀\n漢字😀\n😀"), (6, "x" * 3000 + "\n" * 500 + "tail"), (7, "same\nrow"), (7, "same\nrow"),
    (None, "no id\n"), (8, "\n\n a\r\n\tb"), (9, "word " * 20_000),
]


def brute(text, sections, rule="largest"):
    """Tokens per section by walking over all tokens and characters."""
    text = text or ""
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load(PATH).ranks, special_tokens={})
    character, at = [], 0
    for n, c in enumerate(text):
        character += [n] * len(c.encode())
    counts, crossing = [0] * len(sections), [0] * len(sections)
    none, ids = 0, enc.encode_ordinary(text)
    for i in ids:
        size = len(enc.decode_single_token_bytes(i))
        touched = sorted(set(character[at : at + size]))
        at += size
        held = [sum(a <= c < b for c in touched) for a, b in sections]
        if not any(held):
            none += 1
            continue
        best = held.index(max(held)) if rule == "largest" else next(k for k, n in enumerate(held) if n)
        counts[best] += 1
        crossing[best] += held[best] < len(touched)
    return counts, crossing, none, len(ids)


def line_spans(text):
    out, at = [], 0
    for line in (text or "").split("\n"):
        out.append((at, at + len(line) + 1))
        at += len(line) + 1
    if len(out) > 1 and out[-1][1] - out[-1][0] == 1:
        out.pop()  # nothing behind the last line feed
    return [(a, min(b, len(text or ""))) for a, b in out]


def check(got, rows):
    want = []
    for i, text in rows:
        spans = line_spans(text)
        counts, crossing, _, total = brute(text, spans)
        want += [(i, n, a, b, c, x, total) for n, ((a, b), c, x) in enumerate(zip(spans, counts, crossing, strict=True))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_edges(spark, table):
    got = op3_token_counts(spark, table([r for r in EDGES if r[0] not in (6, 9)])).collect()
    check(got, [r for r in EDGES if r[0] not in (6, 9)])
    assert any(r.n_crossing for r in got)


def test_long_texts_add_up(spark, table):
    got = op3_token_counts(spark, table([r for r in EDGES if r[0] in (6, 9)])).collect()
    for i in (6, 9):
        assert len({r.doc_tokens for r in got if r.doc_id == i}) == 1
        assert sum(r.n_tokens for r in got if r.doc_id == i) == next(r.doc_tokens for r in got if r.doc_id == i)


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    short = [r for r in rows if len(r[1] or "") < 3000][:60]
    got = op3_token_counts(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == {i for i, _ in rows}
    check([r for r in got if r.doc_id in dict(short)], short)


@pytest.mark.parametrize("rule", ["largest", "first"])
def test_given_sections_with_gaps(spark, frame, rule):
    rows = [(1, "abc defgh ijklmnop qrs tuvwxyz" * 3), (2, "no sections"), (3, None)]
    spans = [(1, 10, 0, 5), (1, 11, 5, 17), (1, 12, 30, 31), (1, 13, 31, 60), (3, 20, 0, 0), (None, 1, 0, 3)]
    got = count_by_section(frame(rows), spark.createDataFrame(spans, "doc_id bigint, section int, start bigint, end bigint"), PATH, rule=rule).collect()
    counts, crossing, none, total = brute(rows[0][1], [s[2:] for s in spans[:4]], rule)
    assert {(r.section, r.n_tokens, r.n_crossing) for r in got if r.doc_id == 1} == {*zip((10, 11, 12, 13), counts, crossing, strict=True), (None, none, 0)}
    assert [(r.section, r.n_tokens == r.doc_tokens) for r in got if r.doc_id == 2] == [(None, True)]
    assert [(r.section, r.n_tokens) for r in got if r.doc_id == 3] == [(20, 0)]


def test_empty(spark, table):
    assert op3_token_counts(spark, table([])).collect() == []


def test_ties_go_to_the_first_section():
    chosen, crossing = allocate(np.array([0, 4]), np.array([4, 6]), np.array([0, 2, 5]), np.array([2, 5, 9]), "largest")
    assert chosen.tolist() == [0, 1] and crossing.tolist() == [True, True]

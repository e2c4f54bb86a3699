from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from depotline.llm import alignment
from depotline.llm.alignment import align, byte_of_character, document_counts, link, op12_alignment, sides, with_counts

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def slow_tokens(text, one, two):
    """Ids with byte spans by the two libraries themselves, or nothing."""
    if not text:
        return [], []
    byte = byte_of_character()
    a = [(t, bytes(byte[c] for c in one.id_to_token(t))) for t in one.encode(" " + text, add_special_tokens=False).ids]
    names = [(t, two.id_to_piece(t)) for t in two.encode(text)]
    b = [(t, bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace("\u2581", " ").encode()) for t, n in names]
    raw = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])


def slow(rows):
    """All links one by one."""
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    documents = []
    for doc_id, text in rows:
        a, b = slow_tokens(text, one, two)
        groups, at_a, at_b = [], 0, 0
        own_a, own_b, end_a, end_b = [], [], 0, 0
        while at_a < len(a) or at_b < len(b):
            if end_a <= end_b and at_a < len(a):
                own_a.append(a[at_a][0])
                end_a += len(a[at_a][1])
                at_a += 1
            else:
                own_b.append(b[at_b][0])
                end_b += len(b[at_b][1])
                at_b += 1
            if end_a == end_b:
                groups.append((own_a, own_b))
                own_a, own_b = [], []
        documents.append((doc_id, len(a), len(b), groups, [(x, y) for g in groups for x in g[0] for y in g[1]]))
    counts = Counter(pair for *_, links in documents for pair in set(links))
    highest = {}
    for (x, _), n in counts.items():
        highest[x] = max(n, highest.get(x, 0))
    out = []
    for doc_id, n_a, n_b, groups, links in documents:
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=repr)


def got(df):
    assert df.columns[:8] == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


EDGES = [
    (1, None), (2, ""), (3, " "), (4, "\n\n  \t x "), (5, "a" * 300), (6, "=" * 1001 + " " * 70 + "\u00e9\U0001f600\u6f22\u5b57" * 50), (7, "It's we'll <|endoftext|> <s>x</s> <unk>"),
    (8, "\x1c\x1d a\x85b\xa0c d\u200be\x00"), (9, "same"), (9, "same"), (None, "no id"), (10, "changed by the \u2581 mark"), (11, "the  same " * 2000), (12, "    " * 40), (13, "x" + " " * 33),
]


def test_edges(spark, table):
    assert got(op12_alignment(spark, table(EDGES))) == slow(EDGES)


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op12_alignment(spark, sf_dir)) == slow(rows)


def test_empty_table(spark, table):
    assert got(op12_alignment(spark, table([]))) == []


def test_other_columns(spark, frame):
    docs = frame(EDGES).select("doc_id", "text", *[F.lit("z").alias(c) for c in ("a_ids", "pairs", "groups", "n_best", "n_a", "pair")])
    plain = link(frame(EDGES), A, B)
    same = link(docs, A, B)
    assert sorted(map(str, with_counts(same, document_counts(same)).collect())) == sorted(map(str, with_counts(plain, document_counts(plain)).collect()))


def test_ids_and_borders(spark, frame):
    """The operator's own output: ids of both sides and the ends of the groups in either."""
    one, two = sides(A, B)
    for row in align(frame(EDGES), A, B).collect():
        a, b, a_ends, b_ends = (np.frombuffer(x, "<u4").tolist() for x in row[1:])
        text = dict(EDGES)[row.doc_id]
        joined = b"".join(one.bytes_of[t] for t in a)
        assert joined == b"".join(two.bytes_of[t] for t in b) and joined in (b"", b" " + (text or "").encode())
        assert [sum(one.lengths[a[:n]]) for n in a_ends] == [sum(two.lengths[b[:n]]) for n in b_ends]
        assert (a_ends[-1:], b_ends[-1:]) == (([len(a)], [len(b)]) if a else ([], []))


def test_slices_give_the_same(spark, frame):
    linked = link(frame(EDGES), A, B)
    counts = document_counts(linked)
    sizes = alignment._slices(counts, 10)
    assert len(sizes) > 3 and all(x[1] < y[0] for x, y in zip(sizes, sizes[1:]))
    assert sorted(map(str, with_counts(linked, counts, most=10).collect())) == sorted(map(str, with_counts(linked, counts).collect()))


def test_wide_groups_expand_alike(monkeypatch):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 5, 400).astype("<u4"), rng.integers(0, 7, 500).astype("<u4")
    ends = np.array([1, 150, 400], "<u4"), np.array([2, 300, 500], "<u4")
    whole = alignment.linked_pairs(a, b, *ends)
    monkeypatch.setattr(alignment, "WIDE", 0)
    again = alignment.linked_pairs(a, b, *ends)
    assert whole[0].tolist() == again[0].tolist() and whole[1].tolist() == again[1].tolist()
    assert whole[1].sum() == 2 + 149 * 298 + 250 * 200


def test_long_group_without_common_end():
    """A long run of one character costs its distinct pairs only."""
    one, two = sides(A, B)
    text = "=" * 400_000
    a, b = one.encode(text), two.encode(text)
    ends = alignment.borders(np.cumsum(one.lengths[a]), np.cumsum(two.lengths[b]))
    pairs, times = alignment.linked_pairs(a, b, *ends)
    sizes = np.diff(ends[0], prepend=np.uint32(0)).astype(int) * np.diff(ends[1], prepend=np.uint32(0)).astype(int)
    assert times.sum() == sizes.sum() and len(pairs) < 100

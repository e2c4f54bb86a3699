from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers as P
import tiktoken

from depotline.llm.byte_bpe import load, encoder, op7_byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")


def library(path=PATH):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load(path).ranks, special_tokens={})


def expected(rows):
    out, enc = [], library()
    for i, text in rows:
        ids = enc.encode_ordinary(text or "")
        out.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


EDGES = [
    (1, None), (2, ""), (3, " "), (4, "\n\n  \t x"), (5, "a" * 3000), (6, "=" * 1001 + " " * 700 + "é😀漢字" * 50), (7, "It's we'll I'VE 3.14159 <|endoftext|>"),
    (8, "\x1c\x1d a\x85b\xa0c d​e"), (9, "same"), (9, "same"), (None, "no id"), (10, "ünïcödé ﬁ ǆ ſ K"), (11, "the " * 20000),
]


def test_edges(spark, table):
    got = sorted((tuple(r) for r in op7_byte_bpe(spark, table(EDGES)).collect()), key=repr)
    assert got == expected(EDGES)


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op7_byte_bpe(spark, sf_dir).collect()), key=repr) == expected(rows)


def test_empty(spark, table):
    assert op7_byte_bpe(spark, table([])).collect() == []


def test_pieces_of_every_shape():
    """Random bytes, random joins of tokens and every code point of the first planes, in both vocabularies."""
    rng = random.Random(5)
    for path in (PATH, P.path("byte_bpe_multi_50k.tiktoken")):
        vocabulary, enc = load(path), library(path)
        for _ in range(6000):
            if rng.random() < 0.5:
                piece = b"".join(vocabulary.bytes_of[rng.randrange(len(vocabulary.bytes_of))] for _ in range(rng.randint(1, 6)))
            else:
                piece = bytes(rng.choice(b"aeinrst ") for _ in range(rng.randint(1, 40)))
            assert vocabulary.encode_piece(piece) == enc._encode_single_piece(piece)


def test_split_agrees_on_code_points():
    own, enc = encoder(PATH, P.PATTERN), library()
    chars = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(chars), 3):
        text = "a" + "".join(chars[i : i + 3]) + " 1" + chars[i] + chars[i]
        assert own.encode(text) == struct.pack(f"<{len(ids := enc.encode_ordinary(text))}I", *ids), hex(ord(chars[i]))

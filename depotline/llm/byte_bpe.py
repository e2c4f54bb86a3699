"""Byte-level BPE without a merge loop.

An Aho-Corasick automaton over the vocabulary (bytes as Latin-1 characters) names the
longest token at every byte of a piece. The encoder walks from left to right, takes the
longest token that is compatible with the one before it, falls back to shorter prefixes
of it, and steps back one token when none fits; positions found to be dead ends are
never entered again, which keeps the work linear. Two adjacent tokens are compatible if
undoing their merges from the latest to the earliest never meets a pair that would have
merged earlier across the border. Answers to that test are memoised, and so are whole
pieces, both in tables of bounded size. The result equals applying the merges by rank.

Defined cases: null text is empty and has no ids; repeated rows give repeated results; an
empty table an empty result; texts of any length are encoded whole; other input columns
are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.llm.batches import emit, records
from depotline.llm.registry import documents, query

NO_LIMIT = 1 << 62
#: Entries held in the tables of pieces and of token pairs, in each Python worker.
PIECES = 400_000
PAIRS = 1_000_000


class Vocabulary:
    """Ranks of a byte-level BPE; bytes have the lowest ranks, every other token is a merge of two lower ones."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.merged: dict[tuple[int, int], int] = {}
        self.halves = [(rank, rank) for rank in range(len(self.bytes_of))]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            self._add(token, rank)
        self.prefix = [self._longest_prefix(token) for token in self.bytes_of]
        self.automaton.make_automaton()

    def _add(self, token: bytes, rank: int) -> None:
        """Find the last merge of ``token``. One that merging can't reach only ever stands for a whole piece."""
        for n in range(len(token) - 1, 0, -1):
            if self._usable(token[:n]) and self._usable(token[n:]):
                left, right = self.ranks[token[:n]], self.ranks[token[n:]]
                if self._apart(left, right):
                    self.merged[left, right] = rank
                    self.halves[rank] = (left, right)
                    break
        if len(token) == 1 or self.halves[rank][0] != rank:
            self.automaton.add_word(token.decode("latin-1"), rank)

    def _longest_prefix(self, token: bytes) -> int:
        return next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if self._usable(token[:n])), -1)

    def _usable(self, token: bytes) -> bool:
        return token.decode("latin-1") in self.automaton

    def _apart(self, left: int, right: int) -> bool:
        """Whether merging by rank can leave ``left`` and ``right`` side by side."""
        limit = NO_LIMIT
        while True:
            if self.merged.get((left, right), NO_LIMIT) < limit:
                return False
            # Undo the later merge of the two; a byte can't be undone.
            undo_left = left > right and self.halves[left][0] != left or self.halves[right][0] == right
            if undo_left:
                if self.halves[left][0] == left:
                    return True
                limit, left = left, self.halves[left][1]
            else:
                limit, right = right + 1, self.halves[right][0]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._apart(left, right)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = [-1] * len(piece)
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end - len(self.bytes_of[token]) + 1] = token  # ends rise, so the longest comes last
        out: list[int] = []
        alive = bytearray(b"\1") * (len(piece) + 1)
        at, token = 0, longest[0] if piece else -1
        while at < len(piece):
            end = at + len(self.bytes_of[token])
            if alive[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < len(piece) else -1
            elif self.prefix[token] >= 0:
                token = self.prefix[token]
            else:
                alive[at] = 0
                token = out.pop()  # its end is dead now, so a prefix of it comes next
                at -= len(self.bytes_of[token])
        return out


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    with open(path, "rb") as file:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())})


class Encoder:
    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, out = self.known, []
        for piece in self.find(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= PIECES:
                    known.clear()
                ids = np.array(self.vocabulary.encode_piece(piece.encode()), "<u4").tobytes()
                if len(piece) <= 64:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(load(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers) of every whole ``text``.

    ``path`` names a rank file that every executor can open, ``pattern`` splits the text.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode
        rows = ((doc_id, encode(text or "")) for doc_id, text in records(batches, "doc_id", "text"))
        return emit(((row, len(row[1])) for row in rows), schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the bytes ``decoded`` from them."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = load(path).bytes_of.__getitem__
        rows = ((doc_id, ids, b"".join(map(token, np.frombuffer(ids, "<u4").tolist()))) for doc_id, ids in records(batches, "doc_id", "ids"))
        return emit(((row, len(row[1]) + len(row[2])) for row in rows), schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, decoded binary")


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = decode_documents(encode_documents(documents(spark, sf_dir), path), path)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

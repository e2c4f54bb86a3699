"""Alignment of the tokens of two tokenizers by the byte offsets where both end.

A document's ids by tokenizer A (byte-level BPE) and by tokenizer B (sentence pieces)
cover the same bytes. A dictionary from the cumulative end of each token to its index is
built on either side; the ends in both, found by intersecting the two key sets and
sorted, cut both id lists into groups. Within a group every A token is linked with
every B token.

Links are expanded group by group over distinct ids with their numbers of occurrences, so
a group without a common end over a million equal characters costs its distinct id pairs
and not its occurrence pairs. What a document links is stored once per distinct pair;
from that the number of documents per pair is counted (in tasks, then by one shuffle of
pairs), and the counts are brought back to the documents in slices of whole A ids with at
most ``SLICE`` pairs, each broadcast alone, so a task never holds more than one slice and
no document is shuffled.

Defined cases: texts that are null, empty, or that either tokenizer changes (its tokens do
not join to a space and the text) have no tokens and zeros; repeated rows are documents
of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, count

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from depotline.llm.batches import emit, records
from depotline.llm.registry import documents, query
from depotline.session import store

#: Most pairs of ids that are broadcast together; one A id with more is still one slice.
SLICE = 2_000_000
#: Distinct pairs a task counts before it hands them on.
COUNTED = 1_000_000
#: Characters of the documents that a worker aligns together.
BLOCK = 4_000_000
#: Product of a group's token numbers from which it is expanded by distinct ids.
WIDE = 4096

#: A space between two characters that are none: no token of either tokenizer crosses it, and neither looks beyond it.
CLEAN = re.compile(r"(?<=\S) (?=\S)")

WORD = np.dtype("<u4")
NONE = np.empty(0, WORD)


class ByteLevel:
    """Tokenizer A from its JSON file: a byte-level BPE whose ids rank its merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, vocabulary = held["model"], held["model"]["vocab"]
        if held["normalizer"] or held["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
            raise ValueError(f"{path}: ids do not rank the merges")
        byte = byte_of_character()
        special = {token["content"] for token in held["added_tokens"] if token["special"]}
        ranks = {bytes(byte[c] for c in token): rank for token, rank in vocabulary.items() if token not in special}
        self.engine = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = _by_id(ranks)

    def encode(self, text: str) -> np.ndarray:
        return self.engine.encode_to_numpy(" " + text, disallowed_special=()).astype(WORD)


class Pieces:
    """Tokenizer B from its model file; it adds the space itself."""

    def __init__(self, path: str):
        self.engine = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.engine.id_to_piece(i) for i in range(self.engine.get_piece_size())]
        self.bytes_of = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace("▁", " ").encode() for n in names]

    def encode(self, text: str) -> np.ndarray:
        # In stretches, as one long text costs the engine more than its parts.
        return np.fromiter(chain.from_iterable(self.engine.encode(CLEAN.split(text), num_threads=1)), WORD)


def byte_of_character() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the other bytes in order for 256 and on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def _by_id(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


class Side:
    """One tokenizer with the bytes of its ids."""

    def __init__(self, tokenizer: ByteLevel | Pieces):
        self.encode, self.bytes_of = tokenizer.encode, tokenizer.bytes_of
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)

    def covers(self, ids: np.ndarray, raw: bytes) -> bool:
        return int(self.lengths[ids].sum()) == len(raw) and b"".join(map(self.bytes_of.__getitem__, ids.tolist())) == raw


@lru_cache(maxsize=4)
def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    return Side(ByteLevel(path_a)), Side(Pieces(path_b))


def borders(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of A and of B tokens up to the end of each group."""
    index_a, index_b = dict(zip(ends_a.tolist(), count(1))), dict(zip(ends_b.tolist(), count(1)))
    common = list(filter(index_b.__contains__, index_a))  # in ascending order, as the ends of A were entered
    return np.fromiter(map(index_a.__getitem__, common), WORD, len(common)), np.fromiter(map(index_b.__getitem__, common), WORD, len(common))


@dataclass
class Stretches:
    """Tokens of many stretches one after another, the sizes of their groups, and where each stretch starts in either."""

    a: np.ndarray
    b: np.ndarray
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    a_starts: np.ndarray
    b_starts: np.ndarray
    group_starts: np.ndarray
    whole: np.ndarray

    @classmethod
    def of(cls, text: str, lengths: np.ndarray, side_a: Side, side_b: Side) -> Stretches | None:
        """Stretches of ``lengths`` bytes that make up a space and ``text``; None if a tokenizer changes the text."""
        raw = b" " + text.encode()
        a, b = side_a.encode(text), side_b.encode(text)
        if not (side_a.covers(a, raw) and side_b.covers(b, raw)):
            return None
        ends = np.cumsum(lengths)
        ends_a, ends_b = np.cumsum(side_a.lengths[a]), np.cumsum(side_b.lengths[b])
        a_ends, b_ends = borders(ends_a, ends_b)
        group_ends = ends_a[a_ends.astype(np.int64) - 1]
        starts = [np.append(0, np.searchsorted(found, ends, "right")) for found in (ends_a, ends_b, group_ends)]
        return cls(a, b, np.diff(a_ends, prepend=WORD.type(0)), np.diff(b_ends, prepend=WORD.type(0)), *starts, np.ones(len(lengths), bool))

    @classmethod
    def joined(cls, parts: list[Stretches | None]) -> Stretches:
        """Single stretches one after another; those without tokens are not whole."""
        own = [p or cls(NONE, NONE, NONE, NONE, *[np.zeros(2, np.int64)] * 3, np.zeros(1, bool)) for p in parts]
        arrays = [np.concatenate([NONE, *[getattr(p, name) for p in own]]) for name in ("a", "b", "a_sizes", "b_sizes")]
        starts = [np.cumsum([0, *[len(getattr(p, name)) for p in own]]) for name in ("a", "b", "a_sizes")]
        return cls(*arrays, *starts, np.array([bool(p.whole[0]) for p in own], bool))


def gathered(values: np.ndarray, starts: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the stretches ``picked``, one after another, and where each of them ends."""
    sizes = starts[picked + 1] - starts[picked]
    ends = np.cumsum(sizes)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[picked] - ends + sizes, sizes)], ends


Aligned = tuple[int | None, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def align_block(rows: list[tuple[int | None, str]], side_a: Side, side_b: Side) -> Iterator[Aligned]:
    """Ids and borders of some documents. A stretch between clean spaces has the same tokens wherever it stands, so each
    distinct one is encoded and aligned once, all of them as one text, and documents are put together from theirs."""
    cuts = [CLEAN.split(text) for _, text in rows]
    # Stretches at the ends of a text may border on its white space; they are aligned alone.
    edges = sorted({c[i] for c in cuts for i in (0, -1) if c[i] != c[i].strip()})
    within = set(chain.from_iterable(cuts)).difference(edges, [""])
    index = {s: i for i, s in enumerate(chain(within, edges))}
    order = list(within)
    lengths = np.array([len(s.encode()) + 1 for s in order], np.int64)
    plain = Stretches.of(" ".join(order), lengths, side_a, side_b) if order else None
    singles = edges if plain else [*order, *edges]
    alone = [Stretches.of(s, np.array([len(s.encode()) + 1]), side_a, side_b) for s in singles]
    parts = Stretches.joined(alone)
    if plain:
        parts = Stretches(
            *[np.concatenate([getattr(plain, n), getattr(parts, n)]) for n in ("a", "b", "a_sizes", "b_sizes")],
            *[np.concatenate([getattr(plain, n), getattr(parts, n)[1:] + getattr(plain, n)[-1]]) for n in ("a_starts", "b_starts", "group_starts")],
            np.concatenate([plain.whole, parts.whole]),
        )
    for (doc_id, text), cut in zip(rows, cuts, strict=True):
        picked = np.fromiter(map(index.__getitem__, cut), np.int64, len(cut)) if text else np.empty(0, np.int64)
        if not parts.whole[picked].all():
            picked = picked[:0]
        a, b = gathered(parts.a, parts.a_starts, picked)[0], gathered(parts.b, parts.b_starts, picked)[0]
        sizes = gathered(parts.a_sizes, parts.group_starts, picked)[0], gathered(parts.b_sizes, parts.group_starts, picked)[0]
        yield doc_id, a, b, np.cumsum(sizes[0], dtype=WORD), np.cumsum(sizes[1], dtype=WORD)


def aligned_rows(batches: Iterable[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[Aligned]:
    both = sides(path_a, path_b)
    held, size = [], 0
    for doc_id, text in records(batches, "doc_id", "text"):
        held.append((doc_id, text or ""))
        size += len(held[-1][1])
        if size >= BLOCK:
            yield from align_block(held, *both)
            held, size = [], 0
    yield from align_block(held, *both)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id``, ids ``a_ids`` and ``b_ids`` of every whole ``text``, and where its groups end in either
    (``a_ends``, ``b_ends``: tokens up to there), all as little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.binary()) for n in ("a_ids", "b_ids", "a_ends", "b_ends")]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = ((doc_id, *[x.tobytes() for x in arrays]) for doc_id, *arrays in aligned_rows(batches, path_a, path_b))
        return emit(((row, sum(map(len, row[1:]))) for row in held), schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, a_ids binary, b_ids binary, a_ends binary, b_ends binary")


def linked_pairs(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked pairs (A id in the upper, B id in the lower 32 bits, ascending), and how often each is linked."""
    a, b = a.astype(np.uint64) << np.uint64(32), b.astype(np.uint64)
    a_starts, b_starts = np.concatenate([[0], a_ends[:-1]]).astype(np.int64), np.concatenate([[0], b_ends[:-1]]).astype(np.int64)
    n_a, n_b = a_ends - a_starts, b_ends - b_starts
    sizes = n_a * n_b
    wide = np.flatnonzero(sizes > WIDE)
    sizes[wide] = 0
    group = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    pairs, times = np.unique(a[a_starts[group] + within // n_b[group]] | b[b_starts[group] + within % n_b[group]], return_counts=True)
    if len(wide):
        found, often = [pairs], [times]
        for g in wide:
            own_a, times_a = np.unique(a[a_starts[g] : a_ends[g]], return_counts=True)
            own_b, times_b = np.unique(b[b_starts[g] : b_ends[g]], return_counts=True)
            found.append((own_a[:, None] | own_b).ravel())
            often.append((times_a[:, None] * times_b).ravel())
        pairs, at = np.unique(np.concatenate(found), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, at, np.concatenate(often))
    return pairs, times


class Writer:
    """Groups as text: ``a1,a2|b1;a3|b2,b3`` in decimal ids."""

    def __init__(self, n_a: int, n_b: int):
        self.a = np.array([f"{i}{s}" for s in ",|" for i in range(n_a)], bytes)
        self.b = np.array([f"{i}{s}" for s in ",;" for i in range(n_b)], bytes)
        self.n_a, self.n_b = n_a, n_b

    def write(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> bytes:
        if not len(a):
            return b""
        # A token stands behind all tokens of the groups before it, a B token also behind its own group's A tokens.
        a_sizes, b_sizes = np.diff(a_ends, prepend=WORD.type(0)), np.diff(b_ends, prepend=WORD.type(0))
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[a_ends - 1], last_b[b_ends - 1] = self.n_a, self.n_b
        out = np.empty(len(a) + len(b), max(self.a.dtype, self.b.dtype, key=lambda t: t.itemsize))
        out[np.arange(len(a)) + np.repeat(b_ends - b_sizes, a_sizes)] = self.a[a + last_a]
        out[np.arange(len(b)) + np.repeat(a_ends, b_sizes)] = self.b[b + last_b]
        return out.tobytes().translate(None, b"\0")[:-1]


@lru_cache(maxsize=4)
def writer(path_a: str, path_b: str) -> Writer:
    return Writer(*(len(side.bytes_of) for side in sides(path_a, path_b)))


def link(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document its numbers of tokens, groups and links, ``groups`` (as text), and its linked ``pairs`` (64 bits
    each, see linked_pairs) with ``times`` (how often; 64 bits each)."""
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")], *[(n, pa.binary()) for n in ("groups", "pairs", "times")]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = writer(path_a, path_b).write

        def rows():
            for doc_id, *own in aligned_rows(batches, path_a, path_b):
                pairs, times = linked_pairs(*own) if len(own[0]) else (np.empty(0, np.uint64), np.empty(0, np.int64))
                groups = write(*own)
                yield (doc_id, len(own[0]), len(own[1]), len(own[2]), int(times.sum()), groups, pairs.tobytes(), times.astype("<i8").tobytes()), len(groups) + 16 * len(pairs)

        return emit(rows(), schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups binary, pairs binary, times binary")


def document_counts(linked: DataFrame) -> DataFrame:
    """Number of documents ``n`` of every linked ``pair``, its A id ``a``, and the ``highest`` n of that A id."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def together() -> tuple[np.ndarray, np.ndarray]:
            pairs, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return pairs, np.bincount(at, np.concatenate([h[1] for h in held]), len(pairs)).astype(np.int64)

        for (pairs,) in records(batches, "pairs"):
            own = np.frombuffer(pairs, "<i8")
            held.append((own, np.ones(len(own), np.int64)))
            waiting += len(own)
            if waiting >= 2 * COUNTED:
                held = [together()]
                waiting = len(held[0][0])
                if waiting >= COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], schema=schema)
                    held, waiting = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in together()], schema=schema)

    counted = linked.select("pairs").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    # An A id is linked with the ids of one vocabulary at most, which bounds the window.
    return counted.withColumn("a", F.shiftright("pair", 32).cast("int")).withColumn("highest", F.max("n").over(Window.partitionBy("a")))


def _slices(counts: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of A ids (ends included) with at most ``most`` pairs each, or of one A id."""
    sizes = sorted((r.a, r.n) for r in counts.groupBy("a").agg(F.count(F.lit(1)).alias("n")).collect())  # one row per id of a vocabulary
    out, held = [], 0
    for a, n in sizes:
        if out and held + n <= most:
            out[-1], held = (out[-1][0], a), held + n
        else:
            out.append((a, a))
            held = n
    return out


def with_counts(linked: DataFrame, counts: DataFrame, most: int = SLICE) -> DataFrame:
    """``linked`` with ``n_best`` (links whose count is the highest of their A id) and ``count_sum`` (counts over links)."""
    context = linked.sparkSession.sparkContext
    sums = linked.withColumn("n_best", F.lit(0).cast("long")).withColumn("count_sum", F.lit(0).cast("long"))
    kept = [c for c in linked.columns if c not in ("pairs", "times")]
    kinds = dict(sums.dtypes)
    fields = sums.columns

    def adding(shared):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, n, best = shared.value
            for batch in batches:
                best_so_far, sum_so_far = (batch.column(batch.schema.get_field_index(c)).to_numpy().copy() for c in ("n_best", "count_sum"))
                for i, (pairs, times) in enumerate(records([batch], "pairs", "times")):
                    own = np.frombuffer(pairs, "<i8")
                    low, high = np.searchsorted(own, (known[0], known[-1] + 1))
                    own, often = own[low:high], np.frombuffer(times, "<i8")[low:high]
                    at = np.searchsorted(known, own)
                    best_so_far[i] += int(often[best[at]].sum())
                    sum_so_far[i] += int((often * n[at]).sum())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(best_so_far), pa.array(sum_so_far)], names=fields)

        return run

    for number, (low, high) in enumerate(_slices(counts, most)):
        if number:  # stored, as two slices in one stage would be held side by side
            sums = store(sums, "alignment-slice")
        part = counts.where(F.col("a").between(low, high)).select("pair", "n", (F.col("n") == F.col("highest")).alias("best")).toArrow()
        pairs, n, best = (part.column(c).to_numpy() for c in part.column_names)
        order = np.argsort(pairs)
        shared = context.broadcast((pairs[order], n[order], best[order]))
        sums = sums.mapInArrow(adding(shared), ", ".join(f"{c} {kinds[c]}" for c in fields))
    return sums.select(*kept, "n_best", "count_sum")


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    linked = link(documents(spark, sf_dir), *paths)
    digested = linked.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"), "pairs", "times")
    linked = store(digested, "alignment-links")
    counts = store(document_counts(linked), "alignment-counts")
    return with_counts(linked, counts).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

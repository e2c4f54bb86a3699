"""Packing to a mixture: every window takes from each source queue what is due to it.

Every source is a queue of its documents' tokens, end to end. Serving the queues by
weighted deficit round-robin gives a queue, after any number of windows, its share of
all tokens served so far; what a window gives too much or too little is the deficit
carried into the next. In closed form: token j of a queue of weight g is due at the level
``(j + 0.5) / g``, and a window takes the next tokens in the order of (level, queue). Its
border is found by bisection; as the order is one for all windows, no total ever falls.
When a queue runs dry, the others go on in proportion. So a window's pieces follow from
the totals of the queues and the place of a document in its queue, without a pass over
earlier windows:
deficits are carried across partitions by one running sum over (block, source) totals.

Every window but the last is full, and every window holds all queues in proportion. The
default weights are the sources' sizes, so that all run dry together.

Sources with less than 1/256 of all tokens and of all weight share queues, which bounds
the table of totals. Those that run dry at about the same level share one; inside it
they take turns by the same rule, in stretches of at most ``STRETCH`` tokens instead of
single ones: a stretch is due at the level of its middle, and a running total over that
order gives its place in the queue. However many sources there are, each is a stretch away
from its share at most, and a queue has their weights together.

Two passes over the data: documents are tokenised once and stored; the second pass cuts
the stored ids. Only sums per (block, source) are shuffled, no text and no ids, but for
the documents of sources that share a queue.

Defined cases: null text is empty and packs as the end id alone; null source is a source;
repeated rows are packed separately; an empty table gives an empty result; other columns
are ignored; a document longer than a window goes on in the next ones.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from depotline.llm.batches import emit, records
from depotline.llm.registry import documents, query
from depotline.operators.prefix import running_totals
from depotline.session import store

WINDOW = 2048
END_ID = 1
#: Words whose ids each Python worker holds in each of two generations (and pieces of words), none of them longer than LONGEST bytes.
WORDS = 250_000
LONGEST = 64
#: ASCII characters that are neither letters, digits nor white space.
PUNCTUATION = string.punctuation
#: Sources with a smaller share of tokens and weight than one in so many share queues.
QUEUES = 256
#: Tokens that a source in a shared queue gives at a time.
STRETCH = 256
#: Windows whose totals are computed and held together.
CHUNK = 1024
#: Offsets of (block, source), 64 bytes each, are broadcast up to this size and joined by shuffle beyond it.
BROADCAST_BYTES = 8 << 20


def byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else the next free one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(free)) for b in range(256)]


class _Words(dict):
    """Ids by word, in two generations; a word that is in neither is encoded."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode, self.older = encode, {}

    def __missing__(self, word: bytes) -> bytes:
        known = self.older.get(word) or self.encode(word.decode())
        if len(word) <= LONGEST:
            if len(self) >= WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = known
        return known


class WordEncoder:
    """Ids of a byte-level BPE with word ends that never merges across white space, word by word.

    The tokenizer's file gives vocabulary and merges. Words of plain Latin-1 characters are
    lower-cased, split and merged here, which spares the bookkeeping that a whole encoding
    carries; any other word goes to the tokenizer itself. Words and pieces are remembered.

    The merges run in a library without word ends, so the last byte of a piece is marked by
    a byte that no text has, and mark and byte are merged before all else.
    """

    MARK = b"\xff"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        model = json.loads(self.tokenizer.to_str())["model"]
        end, names = model["end_of_word_suffix"], byte_names()
        byte_of = {name: bytes([b]) for b, name in enumerate(names)}

        def marked(token: str) -> bytes:
            body = b"".join(byte_of[c] for c in token.removesuffix(end))
            return body[:-1] + self.MARK + body[-1:] if token.endswith(end) else body

        tokens = [*names, *[name + end for name in names], *[left + right for left, right in model["merges"]]]
        ranks = {marked(token): rank for rank, token in enumerate(tokens)}
        self.merge = tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.id_of = [np.array(model["vocab"][token], "<u2").tobytes() for token in tokens]
        self.plain = re.compile(r"[!-~\xa1-\xff]+").fullmatch
        # Fixed value: the pattern of the tokenizer for lower-case Latin-1.
        self.split = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\sa-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+").findall
        self.words = _Words(self._fresh)
        self.pieces: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 16-bit integers."""
        return b"".join(map(self.words.__getitem__, text.encode().split()))

    def _fresh(self, word: str) -> bytes:
        # The first test is the second one for ASCII, without a pattern.
        if not (word.isascii() and word.isprintable() or self.plain(word)):
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u2").tobytes()
        lower = word.lower()
        stem = lower.rstrip(PUNCTUATION)
        if not stem.isalpha():
            return b"".join([self.pieces.get(piece) or self._piece(piece) for piece in self.split(lower)])
        # Letters and then marks, as most words are: a piece each.
        ids = self.pieces.get(stem) or self._piece(stem)
        if len(stem) == len(lower):
            return ids
        tail = lower[len(stem) :]
        return ids + (self.pieces.get(tail) or self._piece(tail))

    def _piece(self, piece: str) -> bytes:
        body = piece.encode()
        ids = b"".join([self.id_of[rank] for rank in self.merge(body[:-1] + self.MARK + body[-1:])])
        if len(body) <= LONGEST:
            if len(self.pieces) >= WORDS:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokenise(docs: DataFrame, path: str) -> DataFrame:
    """Ids of every document and its place in its block's share of the queue."""
    schema = pa.schema([("block", pa.int32()), ("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("tokens", pa.int64()), ("ids", pa.binary())])
    end = np.array([END_ID], "<u2").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, block, filled = word_encoder(path).encode, TaskContext.get().partitionId(), Counter()

        def rows():
            for doc_id, source, text in records(batches, "doc_id", "source", "text"):
                ids = encode(text or "") + end
                yield (block, doc_id, source, filled[source], len(ids) // 2, ids), len(ids)
                filled[source] += len(ids) // 2

        return emit(rows(), schema)

    return docs.select("doc_id", "source", "text").mapInArrow(run, "block int, doc_id bigint, source string, start bigint, tokens bigint, ids binary")


class Mixture:
    """Running totals of every queue after each window."""

    def __init__(self, sizes: list[int], weights: list[float], window: int = WINDOW):
        self.sizes, self.weights, self.window = np.array(sizes, np.int64), np.array(weights, float), window
        self.total = int(self.sizes.sum())
        self.windows = -(-self.total // window)
        self.levels = np.unique(np.append(self.sizes / self.weights, 0.0))
        self.served_at = np.minimum(self.sizes, np.outer(self.levels, self.weights)).sum(axis=1)
        self.chunk = lru_cache(maxsize=16)(self._chunk)

    def due(self, level: np.ndarray) -> np.ndarray:
        """Tokens (queue by level) that are due at a level or before it."""
        sizes, weights = self.sizes[:, None], self.weights[:, None]
        count = np.clip(np.floor(weights * level + 0.5), 0, sizes).astype(np.int64)
        # The product is rounded: what counts is the level of each token.
        count += (count < sizes) & ((count + 0.5) / weights <= level)
        count -= (count > 0) & ((count - 0.5) / weights > level)
        return count

    def served(self, windows: np.ndarray) -> np.ndarray:
        """Tokens (queue by window) taken from each queue by the end of so many windows."""
        wanted = np.minimum(windows * self.window, self.total)
        # A queue's total is within half a token of its level times its weight, so the border lies between these levels.
        low, high = (np.interp(wanted + n, self.served_at, self.levels) for n in (-len(self.sizes), len(self.sizes)))
        below, above = self.due(low), self.due(high)
        while len(at := np.flatnonzero((above - below > 1).any(axis=0))):
            middle = (low[at] + high[at]) / 2
            count = self.due(middle)
            few = count.sum(axis=0) <= wanted[at]
            low[at[few]], high[at[~few]] = middle[few], middle[~few]
            below[:, at[few]], above[:, at[~few]] = count[:, few], count[:, ~few]
        # One token of a queue at most lies between: the next in order fill the window.
        level = np.where(above > below, (below + 0.5) / self.weights[:, None], np.inf)
        rank = np.argsort(np.argsort(level, axis=0, kind="stable"), axis=0, kind="stable")
        return below + (rank < wanted - below.sum(axis=0))

    def _chunk(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Totals at the borders of CHUNK windows, and where each queue's share begins in each of them."""
        totals = self.served(np.arange(number * CHUNK, (number + 1) * CHUNK + 1))
        shares = np.diff(totals, axis=1)
        return totals, np.cumsum(shares, axis=0) - shares

    def find(self, queue: int, place: int) -> int:
        """A window at or shortly before the one that holds this token of the queue."""
        level = min(place, int(self.sizes[queue])) / self.weights[queue]
        return max(0, int(np.interp(level, self.levels, self.served_at) - len(self.sizes)) // self.window - 2)

    def pieces(self, queue: int, begin: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, window, offset) of the pieces that a stretch of a queue falls into."""
        end, window = begin + length, self.find(queue, begin)
        while begin < end:
            totals, shares = self.chunk(window // CHUNK)
            borders, base = totals[queue], window // CHUNK * CHUNK
            at = max(int(np.searchsorted(borders, begin, "right")) - 1, 0)
            while begin < end and at < CHUNK:
                low, high = int(borders[at]), min(int(borders[at + 1]), end)
                if high > begin:
                    yield length - (end - begin), high - begin, base + at, int(shares[queue, at]) + begin - low
                    begin = high
                at += 1
            window = base + CHUNK


def weighted(per_source: DataFrame, targets: dict[str | None, float] | None) -> DataFrame:
    """``per_source`` with ``weight``: the target, by default the tokens. Sources without a target are served last."""
    if targets is None:
        return per_source.withColumn("weight", F.col("tokens").cast("double"))
    wanted = per_source.sparkSession.createDataFrame([(s, float(w)) for s, w in targets.items() if w > 0], "name string, target double")
    joined = per_source.join(wanted, per_source["source"].eqNullSafe(wanted["name"]), "left").select("source", "tokens", "target")
    known = joined.agg(F.sum("tokens").alias("total"), F.min("target").alias("least")).first()
    # Half a token of so light a source is due when all others have run dry.
    last = (known.least or 1.0) / ((known.total or 0) + 1) if known.least else 1.0
    return joined.select("source", "tokens", F.coalesce("target", F.lit(last)).alias("weight"))


def queue_table(stored: DataFrame, targets: dict[str | None, float] | None) -> tuple[DataFrame, DataFrame | None, list[int], list[float]]:
    """Offsets of each (block, source) with a queue of its own, the stretches of all others, and the sizes and weights of the queues."""
    spark = stored.sparkSession
    per_block = store(stored.groupBy("block", "source").agg(F.sum("tokens").alias("tokens")), "packing-blocks")
    sources = weighted(per_block.groupBy("source").agg(F.sum("tokens").alias("tokens")), targets)
    total, weight = sources.agg(F.sum("tokens"), F.sum("weight")).first()
    alone = (F.col("tokens") * QUEUES >= (total or 0)) | (F.col("weight") * QUEUES >= (weight or 0.0))
    own = sources.where(alone).orderBy("source").collect()  # 2 * QUEUES rows at most
    # Sources that run dry within a fifth of the same level; a few hundred steps at most.
    step = F.floor(4 * F.log2(F.col("tokens") / F.col("weight"))).cast("int")
    shared = sources.where(~alone).withColumn("step", step)
    steps = shared.groupBy("step").agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")).orderBy("step").collect()
    sizes, weights = [r.tokens for r in (*own, *steps)], [r.weight for r in (*own, *steps)]
    # Blocks of a source are one running sum over as many rows as there are blocks.
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = per_block.select("block", "source", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"))
    names = spark.createDataFrame([(r.source, i) for i, r in enumerate(own)], "name string, queue int")
    offsets = begins.join(F.broadcast(names), begins["source"].eqNullSafe(names["name"])).select("block", "source", "queue", "offset")
    if not steps:
        return offsets, None, sizes, weights
    numbers = F.broadcast(spark.createDataFrame([(r.step, len(own) + i, sum(sizes[len(own) : len(own) + i])) for i, r in enumerate(steps)], "step int, queue int, earlier bigint"))
    named = shared.join(numbers, "step").select(F.col("source").alias("name"), "weight", "queue", "earlier")
    of_block = begins.join(named, begins["source"].eqNullSafe(named["name"])).select(F.col("block").alias("of_block"), "name", "offset", "weight", "queue", "earlier")
    rows = stored.select("block", "source", "start", "tokens")
    rows = rows.join(of_block, (rows["block"] == of_block["of_block"]) & rows["source"].eqNullSafe(of_block["name"]))
    cut = rows.withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tokens") - 1, F.lit(STRETCH).cast("bigint"))))
    cut = cut.withColumn("length", F.least(F.lit(STRETCH).cast("bigint"), F.col("tokens") - F.col("at")))
    level = (F.col("offset") + F.col("start") + F.col("at") + F.col("length") / 2) / F.col("weight")
    dealt = running_totals(cut.withColumn("level", level), "queue", {"upto": "length"}, tie_break=["level", "source", "block", "start", "at"])
    return offsets, dealt.select("block", "source", "start", "at", "length", "queue", (F.col("upto") - F.col("length") - F.col("earlier")).alias("begin")), sizes, weights


def pack(docs: DataFrame, path: str, targets: dict[str | None, float] | None = None, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: where each lies in its document and in which sequence at which offset.

    With the checksum of its ids and, unless only the layout is wanted, the ids (little-endian unsigned 32-bit integers).

    ``path`` names a tokenizer file that every executor can open, with ids below 65,536.
    ``targets`` gives weights by source; sources of equal weight are served at equal rates
    while they last, and sources without one after all others. The default is each source's own share.
    """
    stored = store(tokenise(docs, path), "packing-ids")
    offsets, stretches, sizes, weights = queue_table(stored, targets)
    offsets = store(offsets, "packing-offsets")
    if offsets.count() * 64 <= BROADCAST_BYTES:
        offsets = F.broadcast(offsets)
    offsets = offsets.select(F.col("block").alias("of_block"), F.col("source").alias("of_source"), "queue", "offset")
    placed = stored.join(offsets, (stored["block"] == offsets["of_block"]) & stored["source"].eqNullSafe(offsets["of_source"]))
    placed = placed.select("doc_id", "queue", (F.col("offset") + F.col("start")).alias("begin"), F.lit(0).cast("bigint").alias("at"), "tokens", "ids")
    if stretches is not None:
        cut = stretches.select(F.col("block").alias("of_block"), F.col("source").alias("of_source"), F.col("start").alias("of_start"), "at", "length", "queue", "begin")
        met = stored.join(cut, (stored["block"] == cut["of_block"]) & stored["source"].eqNullSafe(cut["of_source"]) & (stored["start"] == cut["of_start"]))
        part = F.substring("ids", (2 * F.col("at") + 1).cast("int"), (2 * F.col("length")).cast("int"))
        placed = placed.unionByName(met.select("doc_id", "queue", "begin", "at", "tokens", part.alias("ids")))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ("ids_crc32", pa.int64()), ("ids", pa.binary()),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = Mixture(sizes, weights, window)

        def rows():
            for doc_id, queue, begin, at, tokens, stored_ids in records(batches, "doc_id", "queue", "begin", "at", "tokens", "ids"):
                ids = np.frombuffer(stored_ids, "<u2").astype("<u4").tobytes()
                n = len(ids) // 4
                for start, length, sequence, offset in mixture.pieces(queue, begin, n):
                    piece = ids[4 * start : 4 * (start + length)]
                    yield (doc_id, at + start, length, tokens, sequence, offset, zlib.crc32(piece), piece if with_ids else None), 64 + 4 * length * with_ids

        return emit(rows(), schema)

    columns = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids_crc32 bigint, ids binary"
    return placed.mapInArrow(run, columns)


def packed(docs: DataFrame) -> DataFrame:
    """One row per piece, as the contract of the query names its columns."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))

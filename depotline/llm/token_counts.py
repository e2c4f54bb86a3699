"""Token counts by section, from one encoding of the whole document.

Encoding sections apart would give other tokens at their borders. Here a document is
encoded once; the lengths of its tokens give each token's span of code points, and the
spans are joined to the document's sections, both in order. A token whose span
touches several sections is allocated by a rule:

``largest``  to the section that holds most of its code points, of equals to the first
``first``    to the first section it touches

so the counts of a document's sections, and of what lies in none, add up to its tokens.
Two tokens that share a code point (parts of one character) both touch it.

Sections are the lines of a text, each with the line feed that ends it, or are given as a
table of spans. Given spans of a document must not overlap; they may leave gaps, which
form section null.

Defined cases: null and empty texts are one empty section without tokens; repeated rows
are counted one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.llm.batches import emit, records
from depotline.llm.byte_bpe import encoder
from depotline.llm.registry import documents, query

COLUMNS = "doc_id bigint, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint, doc_tokens bigint"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("section", pa.int32()), *[(c, pa.int64()) for c in ("start", "end", "n_tokens", "n_crossing", "doc_tokens")]])


def character_of_byte(text: bytes) -> np.ndarray:
    """Number of the code point that each byte belongs to."""
    return np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1


def token_spans(lengths: np.ndarray, of_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First code point of each token, and the one after its last, from the tokens' lengths in bytes."""
    ends = np.cumsum(lengths)
    return of_byte[ends - lengths], of_byte[ends - 1] + 1


def lines(text: bytes, of_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines in code points; a text without any is one empty line."""
    total = int(of_byte[-1]) + 1 if len(of_byte) else 0
    feeds = of_byte[np.frombuffer(text, np.uint8) == 10] + 1
    ends = feeds if len(feeds) and feeds[-1] == total else np.append(feeds, total)
    return np.append(0, ends[:-1]), ends


def allocate(starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of every token (-1: none) and whether it reaches beyond that section; sections in order and apart."""
    first = np.searchsorted(high, starts, "right")
    last = np.searchsorted(low, ends, "left") - 1
    chosen = np.where(first <= last, first, -1)
    if rule == "largest":
        for t in np.flatnonzero(first < last):
            at = slice(first[t], last[t] + 1)
            chosen[t] = first[t] + int(np.argmax(np.minimum(high[at], ends[t]) - np.maximum(low[at], starts[t])))
    elif rule != "first":
        raise ValueError(f"no such rule: {rule}")
    inside = (chosen >= 0) & (low[chosen] <= starts) & (ends <= high[chosen]) if len(low) else np.zeros(len(starts), bool)
    return chosen, ~inside & (chosen >= 0)


def _counts(doc_id: int | None, names: Iterable, low: np.ndarray, high: np.ndarray, spans: tuple, rule: str) -> Iterator[tuple]:
    chosen, crossing = allocate(*spans, low, high, rule)
    total = len(chosen)
    tokens = np.bincount(chosen + 1, minlength=len(low) + 1)
    beyond = np.bincount(chosen[crossing] + 1, minlength=len(low) + 1)
    if tokens[0]:
        yield doc_id, None, None, None, int(tokens[0]), 0, total
    for n, name in enumerate(names):
        yield doc_id, name, int(low[n]), int(high[n]), int(tokens[n + 1]), int(beyond[n + 1]), total


def count_by_line(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, rule: str = "largest") -> DataFrame:
    """Tokens of every line of every whole ``text``; ``path`` names a rank file that every executor can open."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        length = np.array([len(b) for b in own.vocabulary.bytes_of])

        def rows():
            for doc_id, text in records(batches, "doc_id", "text"):
                raw = (text or "").encode()
                of_byte = character_of_byte(raw)
                spans = token_spans(length[np.frombuffer(own.encode(text or ""), "<u4")], of_byte)
                low, high = lines(raw, of_byte)
                for row in _counts(doc_id, range(len(low)), low, high, spans, rule):
                    yield row, 60

        return emit(rows(), SCHEMA)

    return docs.select("doc_id", "text").mapInArrow(run, COLUMNS)


def count_by_section(docs: DataFrame, sections: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, rule: str = "largest") -> DataFrame:
    """The same for given ``sections`` (doc_id, section, start, end) of documents with unique ids.

    The spans of a document travel with it; documents without spans have all tokens in none.
    """
    spans = sections.where("doc_id is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "section"))).alias("spans"))
    joined = docs.select("doc_id", "text").join(spans, "doc_id", "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        length = np.array([len(b) for b in own.vocabulary.bytes_of])

        def rows():
            for doc_id, text, given in records(batches, "doc_id", "text", "spans"):
                of_byte = character_of_byte((text or "").encode())
                found = token_spans(length[np.frombuffer(own.encode(text or ""), "<u4")], of_byte)
                given = given or []
                low, high = np.array([s["start"] for s in given], np.int64), np.array([s["end"] for s in given], np.int64)
                for row in _counts(doc_id, [s["section"] for s in given], low, high, found, rule):
                    yield row, 60

        return emit(rows(), SCHEMA)

    return joined.mapInArrow(run, COLUMNS)


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_line(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))

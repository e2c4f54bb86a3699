"""Quality classifier on random-indexing word vectors.

Every term has a sparse random index vector. A term's word vector is the sum of the
index vectors of the terms around it over the whole corpus, centred and scaled to
length one. Terms are words, in the case and with the marks they stand in, and shapes
of words (``Xx.`` for a capitalised word before a full stop); both are hashed into
tables of fixed size, so the statistics are one bounded matrix however large the
vocabulary grows. Tasks sum over their share of the documents and Spark adds the sums.

A document is the mean and the spread of its terms' vectors. A two-layer network maps
that to a logit, and one temperature, fitted on labelled rows that the network has not
seen, turns logits into calibrated probabilities. The network learns from at most
``SAMPLE`` labelled rows, chosen by a hash of their id; everything else covers all rows.

Defined cases: null text is empty; an empty text is scored from zeros; repeated rows score
alike; contradictory labels of a document are not learned from; with no labels, or those of
one class only, the score is one constant, ``(positives + 1) / (labels + 1)``; an empty
table gives an empty result; other columns, whatever their names, travel in ``record``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.llm.registry import documents, query

WORDS, SHAPES, DIMENSIONS, NONZERO, REACH = 8192, 512, 32, 2, 2
TERMS = WORDS + SHAPES
SAMPLE = 20_000
HIDDEN, EPOCHS, DECAY = 32, 60, 1e-4
THRESHOLD = 0.7
#: Words whose terms each Python worker remembers.
KNOWN = 250_000
#: Tokens that are counted at a time.
STRETCH = 1 << 18

_CLASSES = bytes(
    ord("X") if 65 <= c <= 90 else ord("x") if 97 <= c <= 122 or c >= 128 else ord("9") if 48 <= c <= 57 else c for c in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)


def shape(word: bytes) -> bytes:
    return _RUN.sub(rb"\1", word.translate(_CLASSES))


class Terms:
    """Word and shape numbers of texts."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> list[int]:
        """One number per word: its word row times SHAPES plus its shape row."""
        words, known = (text or "").encode().split(), self.known
        if len(known) > KNOWN:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = zlib.crc32(word) % WORDS * SHAPES + zlib.crc32(shape(word)) % SHAPES
        return [known[w] for w in words]


def index_vectors(seed: int = 23) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero components of every term."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIMENSIONS, (TERMS, NONZERO)), rng.choice([-1.0, 1.0], (TERMS, NONZERO))


def context_sums(docs: DataFrame) -> np.ndarray:
    """Sums of the index vectors around each term, over all documents (TERMS x DIMENSIONS)."""
    columns = [f"d{i}" for i in range(DIMENSIONS)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        terms, sums = Terms(), np.zeros(TERMS * DIMENSIONS)

        def count(held: list[list[int]]) -> None:
            number = np.repeat(np.arange(len(held)), [len(h) for h in held])
            both = np.concatenate([np.array(h, np.int64) for h in held])
            for rows in (both // SHAPES, WORDS + both % SHAPES):
                for reach in range(1, REACH + 1):
                    near = number[reach:] == number[:-reach]
                    before, after = rows[:-reach][near], rows[reach:][near]
                    for here, there in ((before, after), (after, before)):
                        for j in range(NONZERO):
                            sums[:] += np.bincount(here * DIMENSIONS + places[there, j], signs[there, j], TERMS * DIMENSIONS)

        held, tokens = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(terms.of(text.as_py()))
                tokens += len(held[-1])
                if tokens >= STRETCH:
                    count(held)
                    held, tokens = [], 0
        if held:
            count(held)
        matrix = sums.reshape(TERMS, DIMENSIONS)
        rows = np.flatnonzero(matrix.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), *[pa.array(matrix[rows, i].astype(np.int64)) for i in range(DIMENSIONS)]], names=["term", *columns]
        )

    partial = docs.select("text").mapInArrow(run, "term int, " + ", ".join(f"{c} bigint" for c in columns))
    total = partial.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns])
    out = np.zeros((TERMS, DIMENSIONS))
    for row in total.collect():  # TERMS rows at most
        out[row.term] = row[1:]
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Context sums, in each table centred on the usual context and scaled to length one; zero for unseen terms."""
    out = np.zeros_like(sums, dtype=np.float32)
    for table in (slice(0, WORDS), slice(WORDS, TERMS)):
        rows = sums[table]
        length = np.sqrt((rows**2).sum(axis=1, keepdims=True))
        seen = length[:, 0] > 0
        unit = rows / np.maximum(length, 1e-12)
        unit[seen] -= unit[seen].mean(axis=0) if seen.any() else 0
        again = np.sqrt((unit**2).sum(axis=1, keepdims=True))
        out[table] = np.where(seen[:, None], unit / np.maximum(again, 1e-12), 0)
    return out


def pooled(terms: list[int], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of a document's word and shape vectors, and the logarithm of its length."""
    both = np.array(terms, np.int64)
    parts = [np.array([np.log1p(len(both))], np.float32)]
    for rows in (both // SHAPES, WORDS + both % SHAPES):
        if not len(rows):
            parts += [np.zeros(2 * DIMENSIONS, np.float32)]
            continue
        distinct, times = np.unique(rows, return_counts=True)
        weight, own = (times / len(rows)).astype(np.float32), vectors[distinct]
        mean = weight @ own
        parts += [mean, np.sqrt(np.maximum(weight @ own**2 - mean**2, 0))]
    return np.concatenate(parts)


def _forward(x: np.ndarray, net: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ net["w1"] + net["b1"])
    return hidden, hidden @ net["w2"] + net["b2"]


def train_network(x: np.ndarray, y: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Two layers, fitted to the labels by Adam on the cross-entropy."""
    rng = np.random.default_rng(seed)
    net = {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, 0.1, HIDDEN), "b2": np.zeros(1)}
    first, second = {k: np.zeros_like(v) for k, v in net.items()}, {k: np.zeros_like(v) for k, v in net.items()}
    step, size = 0, 128
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        rate = 3e-3 * (1 - epoch / EPOCHS) + 1e-4
        for start in range(0, len(y), size):
            at = order[start : start + size]
            hidden, logit = _forward(x[at], net)
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[at]) / len(at)
            back = error[:, None] * net["w2"] * (1 - hidden**2)
            slopes = {"w1": x[at].T @ back + DECAY * net["w1"], "b1": back.sum(0), "w2": hidden.T @ error + DECAY * net["w2"], "b2": error.sum(keepdims=True)}
            step += 1
            for k, slope in slopes.items():
                first[k] += 0.1 * (slope - first[k])
                second[k] += 0.001 * (slope**2 - second[k])
                net[k] = net[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def fit_temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """The divisor of logits with the least cross-entropy."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
    losses = [np.logaddexp(0, np.where(y > 0, -logit, logit) / t).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


@dataclass
class Model:
    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    net: dict[str, np.ndarray] | None
    temperature: float
    constant: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.full(len(x), self.constant)
        _, logit = _forward((x - self.centre) / self.spread, self.net)
        return 1 / (1 + np.exp(-np.clip(logit / self.temperature, -40, 40)))


def features(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """``doc_id`` and the pooled vector of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            rows = [pooled(terms.of(t.as_py()), vectors).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float32()))], names=["doc_id", "features"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, features array<float>")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``labels`` (doc_id, quality 0 or 1). The caller leaves out what must not be learned from."""
    vectors = word_vectors(context_sums(docs))
    agreed = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where(F.col("quality") == F.col("most")).select("doc_id", "quality")
    )
    chosen = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    # One row a document, so SAMPLE rows at most, also where a doc_id repeats.
    once = features(labelled, vectors).groupBy("doc_id").agg(F.min("features").alias("features")).join(chosen, "doc_id")
    rows = once.select("doc_id", "features", "quality").collect()
    rows.sort(key=lambda r: r.doc_id)
    x, y = np.array([r.features for r in rows], float), np.array([r.quality for r in rows], float)
    if not 0 < y.sum() < len(y):
        return Model(vectors, np.zeros(1), np.ones(1), None, 1.0, (y.sum() + 1) / (len(y) + 1))
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - centre) / spread
    aside = np.array([zlib.crc32(f"calibration {r.doc_id}".encode()) % 5 == 0 for r in rows])
    net = train_network(x[~aside], y[~aside]) if (~aside).any() else train_network(x, y)
    temperature = fit_temperature(_forward(x[aside], net)[1], y[aside]) if aside.any() else 1.0
    return Model(vectors, centre, spread, net, temperature, 0.0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``record`` (the whole row) and its ``score``."""
    columns = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            record = batch.column(0)
            rows = [pooled(terms.of(t.as_py()), model.vectors) for t in record.field("text")]
            scores = model.score(np.array(rows, float)) if rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([record, pa.array(scores, pa.float64())], names=["record", "score"])

    return columns.mapInArrow(run, columns.withColumn("score", F.lit(0.0)).schema)


def learnable(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out fold of the query."""
    return labels.where(~held_out(F.col("doc_id")))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score(docs.select("doc_id", "text"), fit(docs, learnable(labels)))
    return scored.select(
        F.col("record.doc_id").alias("doc_id"),
        held_out(F.col("record.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

"""Nearest neighbours by inner product through randomly rotated one-bit codes.

A vector is stored as the signs of its rotated residual from a coarse centroid, 64
dimensions in 8 bytes, with two scalars: the length of the residual, and the inner
product of its direction with the code. From those a query estimates its inner product
with every vector of a list without bias and with a known bound on the error. Vectors
whose upper bound reaches the k-th best lower bound are scored exactly in double
precision from the originals; the rest can't be among the k best unless the bound fails,
which ``EPSILON`` standard deviations make rare.

Lists are the cells of a coarse k-means, fitted on a bounded sample; every row is
indexed. A query first visits the ``probes`` lists that promise most. The k-th best score
found there is its floor, and it then visits every other list that can hold as much: by
Cauchy-Schwarz no vector of a list scores more than the query's product with the centre
plus its length times the largest residual of the list. So no list is left out by
count, whatever the table's size. A list is split into blocks of bounded size, so that a
vector that a third of all rows hold only makes more blocks. Blocks and the queries that
visit them meet in one shuffle; within a task the codes of one block are held and queries
stream past. What a block gives a query is the k best rows that reach its floor.

Vectors take no part if they are null, all zero, hold null or non-finite components, or
have a dimension other than the most common one, or a null id. Rows with the query's
own id are not its neighbours; an id that repeats is one query (its smallest vector) and
several candidates. Ties go to the smaller id. Fewer than k candidates give fewer rows;
an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from depotline.llm.registry import query
from depotline.session import store

EPSILON = 2.5
#: Rows that the coarse cells are fitted on.
SAMPLE = 16_384
#: Rows to a list, and the largest number of lists.
LIST_ROWS = 16_384
MAX_LISTS = 2048
#: Lists a query visits before its floor is known.
PROBES = 32
#: Numbers of blocks in a batch of queries.
VISITS = 1 << 20
#: Rows whose codes and vectors a task holds.
BLOCK_ROWS = 4096
QUERY_ROWS = 256


def valid_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` of the rows that take part."""
    sound = table.select("vec_id", F.col(vector).alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    sizes = sound.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return sound.where(F.size("vector") == (sizes["size"] if sizes else 0))


def fit_cells(vectors: DataFrame, n_lists: int, seed: int) -> np.ndarray:
    """Centres of the lists, from at most SAMPLE rows chosen by a hash of their id."""
    picked = vectors.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    points = np.array([r.vector for r in picked], float)
    centres = points[np.random.default_rng(seed).choice(len(points), min(n_lists, len(points)), replace=False)]
    for _ in range(8):
        nearest = _nearest(points, centres)
        members = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None], centres)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)


def rotation(dimension: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dimension)


def build_index(vectors: DataFrame, centres: np.ndarray, turn: np.ndarray) -> DataFrame:
    """Every vector with its ``list``, its one-bit ``code`` and the scalars ``length`` and ``match``."""
    kind = dict(vectors.dtypes)["vector"]
    dimension = len(turn)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column(1), dimension)
            nearest = _nearest(points, centres)
            residual = points - centres[nearest]
            length = np.sqrt((residual**2).sum(1))
            turned = residual @ turn
            match = np.abs(turned).sum(1) / np.sqrt(dimension) / np.where(length > 0, length, 1.0)
            codes = np.packbits(turned >= 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nearest, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(match)],
                names=["vec_id", "vector", "list", "code", "length", "match"],
            )

    return vectors.mapInArrow(run, f"vec_id bigint, vector {kind}, list int, code binary, length double, match double")


def inner_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision, component after component, so that equal vectors score alike wherever they lie."""
    out = np.zeros(len(vectors))
    for column, x in zip(vectors.T, query, strict=True):
        out += column * x
    return out


class Block:
    """Codes and vectors of one block, ready for queries."""

    def __init__(self, parts: list[pa.RecordBatch], centres: np.ndarray, turn: np.ndarray):
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        dimension = len(turn)
        self.ids = rows.column("vec_id").to_numpy()
        self.vectors = _matrix(rows.column("vector"), dimension)
        packed = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(self.ids), -1)
        self.signs = np.unpackbits(packed, axis=1, count=dimension).astype(np.float32) * 2 - 1
        self.length, match = rows.column("length").to_numpy(), rows.column("match").to_numpy()
        safe = np.where(match > 0, match, 1.0)
        self.scale = self.length / safe / np.sqrt(dimension)
        # The estimate of a direction's inner product with a unit vector is off by this much at EPSILON deviations.
        self.slack = self.length * np.sqrt(np.maximum(1 - safe**2, 0.0)) / safe * EPSILON / np.sqrt(max(dimension - 1, 1))
        self.centre = centres[rows.column("list")[0].as_py()]
        self.turn = turn

    def search(self, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its id, and ids and scores of its k best here that score ``least`` or more."""
        estimate = (self.signs @ (queries @ self.turn).astype(np.float32).T).T * self.scale + (queries @ self.centre)[:, None]
        slack = np.sqrt((queries**2).sum(1))[:, None] * (self.slack + 1e-6 * (self.length + 1.0))  # and the rounding of single precision
        others = query_ids[:, None] != self.ids
        lower = np.where(others, estimate - slack, -np.inf)
        floor = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] > k else np.full(len(queries), -np.inf)
        hopeful = others & (estimate + slack >= np.maximum(floor, least)[:, None])
        for i, query_id in enumerate(query_ids):
            at = np.flatnonzero(hopeful[i])
            scores = inner_products(self.vectors[at], queries[i])
            best = np.lexsort((self.ids[at], -scores))[:k]
            yield int(query_id), self.ids[at][best], scores[best]


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, probes: int = PROBES, seed: int = 11) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k vectors of largest inner product with each query."""
    spark = vectors.sparkSession
    first, n = vectors.select(F.size("vector").alias("d")).first(), vectors.count()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    turn = rotation(first.d, seed)
    centres = fit_cells(vectors, min(MAX_LISTS, -(-n // LIST_ROWS)), seed)
    index = build_index(vectors, centres, turn)
    sized = {r["list"]: r for r in index.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("radius")).collect()}  # MAX_LISTS rows at most
    blocks = [-(-sized[i].n // BLOCK_ROWS) if i in sized else 0 for i in range(len(centres))]
    firsts = [sum(blocks[:i]) for i in range(len(blocks))]
    radius = np.array([sized[i].radius if i in sized else 0.0 for i in range(len(centres))])
    size_of = F.element_at(F.array(*map(F.lit, blocks)), F.col("list") + 1)
    first_of = F.element_at(F.array(*map(F.lit, firsts)), F.col("list") + 1)
    kind = dict(vectors.dtypes)["vector"]
    stored = index.select((first_of + F.pmod(F.xxhash64(F.lit(seed), "vec_id", "vector"), size_of)).cast("int").alias("block"), F.lit(0).alias("part"), "vec_id", "vector", "list", "code", "length", "match", F.lit(None).cast("double").alias("least"))
    dimension = first.d

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            promise = _matrix(batch.column(1), dimension) @ centres.T
            lists = np.argsort(-promise, axis=1, kind="stable")[:, :probes].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists.tolist(), pa.list_(pa.int32()))], names=["vec_id", "vector", "lists"])

    def visits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Without a floor the chosen lists, with one all others that can reach it."""
        rows = max(1, VISITS // max(1, sum(blocks)))
        for batch in (whole.slice(start, rows) for whole in batches for start in range(0, whole.num_rows, rows)):
            points = _matrix(batch.column(1), dimension)
            promise, lengths = points @ centres.T, np.sqrt((points**2).sum(1))[:, None]
            bound = promise + lengths * (radius + 1e-9 * (radius + np.sqrt((centres**2).sum(1))))  # and the rounding
            visited = []
            for i, (seen, least) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                lists = seen if least is None else sorted(set(np.flatnonzero(bound[i] >= least).tolist()).difference(seen))
                visited.append([b for c in lists for b in range(firsts[c], firsts[c] + blocks[c])])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(visited, pa.list_(pa.int32())), batch.column(3)], names=["vec_id", "vector", "blocks", "least"])

    none = F.lit(None)

    def meeting(asked: DataFrame) -> DataFrame:
        """Scores of the queries ``asked`` (vec_id, vector, lists, least) in the blocks they visit."""
        visiting = asked.select("vec_id", "vector", "lists", "least").mapInArrow(visits, f"vec_id bigint, vector {kind}, blocks array<int>, least double")
        askers = visiting.select(F.explode("blocks").alias("block"), F.lit(1).alias("part"), "vec_id", "vector", none.cast("int").alias("list"), none.cast("binary").alias("code"), none.cast("double").alias("length"), none.cast("double").alias("match"), "least")
        met = stored.unionByName(askers).repartition("block").sortWithinPartitions("block", "part", "vec_id")
        return met.mapInArrow(run, "query_id bigint, vec_id bigint, score double")

    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number, block = -1, None
        for batch in batches:
            keys = batch.column(0).to_numpy().astype(np.int64) * 2 + batch.column(1).to_numpy()
            borders = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for low, high in zip(borders, borders[1:], strict=False):
                at, part = divmod(int(keys[low]), 2)
                if at != number:
                    number, held, block = at, [], None
                if part == 0:
                    held.append(batch.slice(low, high - low))
                    continue
                if block is None and held:
                    block, held = Block(held, centres, turn), []
                for start in range(low, high, QUERY_ROWS) if block else ():
                    part_rows = batch.slice(start, min(QUERY_ROWS, high - start))
                    least = part_rows.column(8).fill_null(-np.inf).to_numpy()
                    found = list(block.search(part_rows.column(2).to_numpy(), _matrix(part_rows.column(3), dimension), least, k))
                    ids = np.concatenate([np.full(len(f[1]), f[0], np.int64) for f in found])
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate([f[1] for f in found]), pa.int64()), pa.array(np.concatenate([f[2] for f in found]))], schema=schema)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    asked = queries.groupBy("vec_id").agg(F.min("vector").alias("vector")).mapInArrow(chosen, f"vec_id bigint, vector {kind}, lists array<int>")
    if len(centres) <= probes:
        return ranked(meeting(asked.withColumn("least", none.cast("double"))))
    asked = store(asked, "neighbours-queries")
    near = store(ranked(meeting(asked.withColumn("least", none.cast("double")))), "neighbours-near")
    # A query with fewer than k rows so far has no floor yet: everything reaches it.
    floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("of"), "score")
    others = asked.join(floors, asked["vec_id"] == floors["of"], "left").withColumn("least", F.coalesce("score", F.lit(float("-inf"))))
    return ranked(near.drop("rank").unionByName(meeting(others)))


# Brute force over all pairs; the search has to find the same rows on tables of this size.
_SQL = """WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 20"""


@query("op10_nearest_neighbours", _SQL)
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = valid_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0))

"""Exact cosine retrieval over embedding columns, and text chunks built from tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from depotline import settings as S
from depotline.functions.vectors import unit_vector

# Largest query matrix that is sent to all workers, in numbers (64 MB of doubles); more queries meet the index in blocks.
BATCH_NUMBERS = 8 << 20
# Rows of an index block and of a query block, where both are dealt.
BLOCK_ROWS = 1 << 16
# Queries scored together inside a task; bounds the score block of one Arrow batch.
_SCORED_TOGETHER = 256


def build_index(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Normalise vectors once, so that a dot product is the cosine."""
    return df.withColumn(vector, unit_vector(F.col(vector)))


def _best(names: np.ndarray, scores: np.ndarray, items: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, items and scores of the k best columns of each row, ties by item."""
    picked = [np.lexsort((items, -row))[:k] for row in scores]
    counts = [len(p) for p in picked]
    at = np.concatenate(picked) if picked else np.zeros(0, int)
    rows = np.repeat(np.arange(len(picked)), counts)
    return names[rows], items[at], scores[rows, at]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def top_k(
    index: DataFrame,
    queries: DataFrame,
    k: int = S.RETRIEVAL_TOP_K,
    item_id: str = "vec_id",
    query_id: str = "query_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` most similar items per query: exact, ties by item id.

    A query set of at most 64 MB is sent to the tasks, each of which scores its share of the index against it and
    keeps its ``k`` best items per query. A larger one stays a table: query blocks and index blocks, both of bounded
    size, meet once each by their block numbers, so neither the driver nor a task holds more than a block of either.
    What is shuffled of results is at most k rows per query and task or block. Both sides must hold unit vectors.
    """
    items, asked = index.select(item_id, vector), queries.select(query_id, vector)
    shape = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("width")).first()
    schema = f"{query_id} {dict(asked.dtypes)[query_id]}, {item_id} {dict(items.dtypes)[item_id]}, score double"
    if not shape.n:
        return index.sparkSession.createDataFrame([], f"{schema}, rank int")
    few = shape.n * (shape.width or 1) <= BATCH_NUMBERS
    found = _scan(items, asked, k, schema) if few else _meet(items, asked, k, schema, shape.n)
    order = Window.partitionBy(query_id).orderBy(F.col("score").desc(), item_id)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _scored(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    # Twelve digits: summation order must not decide between equal vectors.
    return np.round(matrix @ vectors.T, 12)


def _scan(items: DataFrame, asked: DataFrame, k: int, schema: str) -> DataFrame:
    """The index in place against a query set of checked size."""
    held = asked.toArrow().combine_chunks()
    names, matrix = np.array(held.column(0).to_pylist(), object), _matrix(held.column(1).combine_chunks())
    together = _SCORED_TOGETHER
    fields = schema.split(", ")

    def local_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        kinds = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = batch.schema.field(0).type
            ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            for start in range(0, len(names), together):
                scores = _scored(matrix[start : start + together], vectors)
                for n, row in enumerate(scores, start):
                    have = best.get(n)
                    own_ids, own = (ids, row) if have is None else (np.concatenate([have[0], ids]), np.concatenate([have[1], row]))
                    at = np.lexsort((own_ids, -own))[:k]
                    best[n] = own_ids[at], own[at]
        for start in range(0, len(names) if best else 0, 4096):
            part = [(n, *best[n]) for n in range(start, min(start + 4096, len(names)))]
            rows = [(names[n], i, s) for n, own_ids, own in part for i, s in zip(own_ids.tolist(), own.tolist(), strict=True)]
            columns = [pa.array([r[0] for r in rows], held.schema.field(0).type), pa.array([r[1] for r in rows], kinds), pa.array([r[2] for r in rows], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split(" ")[0] for f in fields])

    return items.mapInArrow(local_best, schema)


def _meet(items: DataFrame, asked: DataFrame, k: int, schema: str, n_queries: int) -> DataFrame:
    """Index blocks and query blocks, every two of them once."""
    (item_id, vector), query_id = items.columns, asked.columns[0]
    index_blocks, query_blocks = (max(1, -(-n // BLOCK_ROWS)) for n in (items.count(), n_queries))
    none = F.lit(None)

    def dealt(df: DataFrame, name: str, own: str, blocks: int, other: str, others: int, part: int) -> DataFrame:
        number = F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int")
        return df.withColumn(own, number).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).withColumn("part", F.lit(part))

    left = dealt(items, item_id, "i", index_blocks, "j", query_blocks, 0).select("i", "j", "part", F.col(item_id).alias("item"), none.cast(dict(asked.dtypes)[query_id]).alias("query"), F.col(vector).cast("array<double>").alias("v"))
    right = dealt(asked, query_id, "j", query_blocks, "i", index_blocks, 1).select("i", "j", "part", none.cast(dict(items.dtypes)[item_id]).alias("item"), F.col(query_id).alias("query"), F.col(vector).cast("array<double>").alias("v"))
    names = [field.split(" ")[0] for field in schema.split(", ")]
    together = _SCORED_TOGETHER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, block = None, [], None
        for batch in batches:
            keys = list(zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True))
            starts = [n for n in range(len(keys)) if not n or keys[n] != keys[n - 1]]
            for low, high in zip(starts, [*starts[1:], len(keys)], strict=True):
                i, j, part = keys[low]
                if (i, j) != cell:
                    cell, held, block = (i, j), [], None
                rows = batch.slice(low, high - low)
                if part == 0:
                    held.append((rows.column(3).to_numpy(zero_copy_only=False), _matrix(rows.column(5))))
                    continue
                if block is None and held:
                    block, held = (np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])), []
                for at in range(0, rows.num_rows if block else 0, together):
                    own = rows.slice(at, together)
                    numbers, found, scores = _best(np.arange(own.num_rows), _scored(_matrix(own.column(5)), block[1]), block[0], k)
                    yield pa.RecordBatch.from_arrays([own.column(4).take(pa.array(numbers)), pa.array(found, batch.schema.field(3).type), pa.array(scores)], names=names)

    return left.unionByName(right).repartition("i", "j").sortWithinPartitions("i", "j", "part").mapInArrow(run, schema)


def group_centroids(df: DataFrame, group: str = "label", vector: str = "embedding") -> DataFrame:
    """Mean vector per group: exploded by position so that partial sums combine early."""
    positions = df.select(group, F.posexplode(vector).alias("pos", "x"))
    means = positions.groupBy(group, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    listed = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(group).agg(F.transform(listed, lambda e: e["x"]).alias(vector))


def chunk(df: DataFrame, source: str, key: Column, text: Column) -> DataFrame:
    return df.select(F.lit(source).alias("source"), key.alias("key"), text.alias("text"))


def table_chunks(
    utilisation: DataFrame, warehouses: DataFrame, lanes: DataFrame, forecast: DataFrame, skus: DataFrame
) -> DataFrame:
    """One line of text per warehouse load, warehouse, lane, forecast segment and category."""

    def number(column: str, digits: int = 2) -> Column:
        return F.format_string(f"%.{digits}f", F.round(column, digits))

    segments = forecast.groupBy("region", "category").agg(
        F.avg("predicted_units").alias("mean_units"),
        F.min("predicted_units").alias("min_units"),
        F.max("predicted_units").alias("max_units"),
    )
    categories = skus.groupBy("category").agg(
        F.count(F.lit(1)).alias("skus"), F.avg("selling_price_usd").alias("price"), F.avg("unit_cost_usd").alias("cost")
    )
    parts = [
        chunk(
            utilisation, "warehouse_utilization", F.col("warehouse_id"),
            F.format_string(
                "Warehouse %s in %s holds %s units of capacity %d, utilisation %s percent, status %s.",
                "warehouse_id", "region", number("inventory_units", 0), "capacity_units", number("utilization_pct"), "status",
            ),
        ),
        chunk(
            warehouses, "warehouses", F.col("warehouse_id"),
            F.format_string(
                "Warehouse %s serves %s with capacity %d units at a fixed cost of %s USD per day.",
                "warehouse_id", "region", "capacity_units", number("fixed_daily_cost_usd"),
            ),
        ),
        chunk(
            lanes, "warehouse_region_costs", F.concat_ws("->", "warehouse_id", "demand_region"),
            F.format_string(
                "Lane %s to %s costs %s USD per unit, takes %d days and scores %s.",
                "warehouse_id", "demand_region", number("ship_cost_per_unit"), "lead_time_days",
                number("lane_efficiency_score", 4),
            ),
        ),
        chunk(
            segments, "forecast_12wk_forward", F.concat_ws("|", "region", "category"),
            F.format_string(
                "Forecast for %s in %s: mean %s, lowest %s, highest %s units per week.",
                "category", "region", number("mean_units", 1), number("min_units", 1), number("max_units", 1),
            ),
        ),
        chunk(
            categories, "sku_master", F.col("category"),
            F.format_string(
                "Category %s has %d SKUs, mean price %s USD, mean unit cost %s USD.",
                "category", "skus", number("price"), number("cost"),
            ),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def assemble_context(hits: DataFrame, chunks: DataFrame, item_id: str = "vec_id", query_id: str = "query_id") -> DataFrame:
    """The retrieved texts of each query, best first, joined by newlines (k rows per query)."""
    listed = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return hits.join(chunks.select(item_id, "text"), item_id).groupBy(query_id).agg(
        F.array_join(F.transform(listed, lambda x: x["text"]), "\n").alias("context"),
        F.count(F.lit(1)).alias("passages"),
    )

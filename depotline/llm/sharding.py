"""Global shuffle into shards: scatter into memory-sized buckets, then shuffle each bucket.

Pass one counts the bytes, chooses as many buckets as hold ``bucket_bytes`` each and
sends every row to the bucket its seeded hash names. Pass two puts the rows of one
bucket into one array, orders them by a second seeded hash (so the arrival order of
blocks does not matter) and applies ``shuffle``, which is a Fisher-Yates permutation,
seeded by the partition, which is the bucket. Buckets laid end to end are a uniform
permutation of the table; shards are its equal consecutive slices, so their counts
differ by one row at most (law ``rows``) and slots are gapless.

Defined cases: null or empty text has no bytes and is sharded like any other row; rows
repeated in full are separate rows; an empty table gives an empty result; input columns
of any name travel inside ``record``. A single row larger than a bucket is a bucket of
its own size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from depotline.llm.registry import query

BUCKET_BYTES = 32 << 20
#: Offsets (16 bytes a bucket) are broadcast up to this size and joined by shuffle beyond it.
BROADCAST_BYTES = 8 << 20


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text, none for null, plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_rows(
    rows: DataFrame, row_key: list[Column], size: Column, n_shards: int = 16, bucket_bytes: int = BUCKET_BYTES, seed: int = 17
) -> DataFrame:
    """``shard``, ``slot`` and the whole row as struct ``record``.

    ``rows`` has to read a stored table (``session.store`` writes one), and ``row_key``
    has to name each of its rows alike in every scan: file and position in it, or a key.
    Both scans and every retry after a lost executor then agree on the buckets. A key
    that repeats only makes its bucket larger.
    """
    total, n_rows = rows.agg(F.sum(size), F.count(F.lit(1))).first()
    n_buckets = max(1, -(-(total or 0) // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), *row_key), F.lit(n_buckets)).cast("int")

    counts = rows.select(bucket.alias("bucket")).groupBy("bucket").count()
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    offsets = counts.select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    if n_buckets * 16 <= BROADCAST_BYTES:
        offsets = F.broadcast(offsets)

    scattered = rows.select(
        bucket.alias("bucket"), F.xxhash64(F.lit(seed + 1), *row_key).alias("order"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("record")
    ).repartitionById(n_buckets, "bucket")
    shuffled = (
        scattered.sortWithinPartitions("order")
        .groupBy("bucket")
        .agg(F.collect_list("record").alias("records"))
        .join(offsets, "bucket")
        .select("offset", F.posexplode(F.shuffle("records", F.lit(seed))).alias("pos", "record"))
    )
    # The first n_rows % n_shards slices hold one row more than the others.
    short = n_rows // n_shards
    cut = (n_rows % n_shards) * (short + 1)
    place, width = F.col("offset") + F.col("pos"), max(1, short)
    front = place < cut

    def whole(value: Column, by: int) -> Column:
        return F.call_function("div", value, F.lit(by))

    return shuffled.select(
        F.when(front, whole(place, short + 1)).otherwise(n_rows % n_shards + whole(place - cut, width)).cast("int").alias("shard"),
        F.when(front, place % (short + 1)).otherwise((place - cut) % width).cast("long").alias("slot"),
        "record",
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard. A bucket lies in one or two shards and is written in slot order."""
    sharded.write.partitionBy("shard").parquet(path)


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    row_key = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    sharded = shard_rows(rows, row_key, size_of(F.col("text")))
    text = F.col("record.text")
    return sharded.select(
        F.col("record.doc_id").alias("doc_id"),
        size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Document fingerprints: every shingle hash below a fixed fraction of the hash range.

A fingerprint is the sorted set of the 64-bit hashes of a text's five-word shingles that
fall into the lowest ``1 / SCALE`` of all hashes. Whether a hash is kept depends on
nothing else, so the fingerprint of a union is the union of fingerprints, and the share of
one fingerprint found in another estimates containment however unequal the documents
are. A text none of whose hashes is that low keeps its lowest one, so that only texts
without words have empty fingerprints; merging keeps the lowest hash in the same way.

Words are the stretches without ASCII white space; a text of fewer than five words is
one shingle. Null text is empty. Two empty fingerprints are alike (1), an empty and another
are not (0). Repeated rows have equal fingerprints; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from depotline.llm.registry import documents, query
from depotline.session import store

SHINGLE = 5
SCALE = 8
#: Signed hashes below this are the lowest 1 / SCALE of all.
BOUND = -(1 << 63) + (1 << 64) // SCALE
_BLANKS = " \t\n\x0b\x0c\r"


def with_fingerprint(df: DataFrame, text: str, name: str, words: int = SHINGLE) -> DataFrame:
    """``df`` with the fingerprint of column ``text`` as an array of longs; no other column is touched."""
    # Steps are columns, so that each is computed once; their names are none of the table's.
    listed, hashed, low, lowest = (_free_name(df, c) for c in ("words", "hashes", "low", "lowest"))
    split = df.withColumn(listed, F.split(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(_BLANKS)), r"[\x20\x09-\x0D]+"))
    shingles = F.transform(F.sequence(F.lit(1), F.size(listed) - (words - 1)), lambda at: F.xxhash64(F.slice(listed, at, words)))
    hashes = (
        F.when(F.col(listed)[0] == "", F.array().cast("array<bigint>"))
        .when(F.size(listed) < words, F.array(F.xxhash64(listed)))
        .otherwise(shingles)
    )
    every = split.withColumn(hashed, hashes).drop(listed)
    few = every.withColumn(low, F.filter(hashed, lambda h: h < BOUND)).withColumn(lowest, F.array_min(hashed)).drop(hashed)
    kept = F.when(F.size(low) > 0, F.sort_array(F.array_distinct(low))).when(F.col(lowest).isNotNull(), F.array(lowest)).otherwise(F.col(low))
    return few.withColumn(name, kept).drop(low, lowest)


def _free_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def merged(one: Column, other: Column) -> Column:
    """Fingerprint of two documents taken together."""
    both = F.sort_array(F.array_union(one, other))
    low = F.filter(both, lambda h: h < BOUND)
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def likeness(one: Column, other: Column) -> Column:
    """Jaccard similarity estimated from fingerprints."""
    together = F.size(F.array_union(one, other))
    return F.when(together == 0, 1.0).otherwise(F.size(F.array_intersect(one, other)) / together)


def containment(part: Column, whole: Column) -> Column:
    """Share of the shingles of ``part`` that ``whole`` has, estimated from fingerprints."""
    return F.when(F.size(part) == 0, 1.0).otherwise(F.size(F.array_intersect(part, whole)) / F.size(part))


def listed(fingerprint: Column) -> Column:
    return F.array_join(fingerprint.cast("array<string>"), ",")


_KEY = ["present", "id", "text_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key of plain columns: rows are equal in it if they are equal in id and text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").isNotNull().alias("present"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def successors(docs: DataFrame) -> DataFrame:
    """Each document's key and ``n_chars`` with the key of the next one by ascending id (``next_*``).

    A null id comes first, ids that repeat go by a hash of the text, and the last document
    is followed by the first. Ids are dealt by range; only the first key of every range
    meets in one task.
    """
    spark = docs.sparkSession
    ids = _keyed(docs).select(*_KEY, F.length("text").alias("n_chars")).distinct()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Stored, because ranges are drawn by sampling and would differ from run to run of the plan.
    stored = store(ids.repartitionByRange(parts, *_KEY).withColumn("part", F.spark_partition_id()), "fingerprint-ids")
    key = F.struct(*_KEY)
    heads = stored.groupBy("part").agg(F.min(key).alias("head"))
    by_part = Window.orderBy("part")
    first = F.min("head").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = heads.select("part", F.coalesce(F.lead("head").over(by_part), first).alias("following"))
    order = Window.partitionBy("part").orderBy(*_KEY)
    linked = stored.withColumn("next", F.lead(key).over(order)).join(after, "part").withColumn("next", F.coalesce("next", "following"))
    return linked.select(*_KEY, "n_chars", *[F.col(f"next.{c}").alias(f"next_{c}") for c in _KEY])


def with_next(docs: DataFrame) -> DataFrame:
    """Every row with its text, fingerprint, ``edited`` text and the next document's fingerprint.

    ``edited`` has the last quarter of the code points replaced by the first as many of the
    next document. The texts are shuffled once by their key; what the next document gives,
    at most a quarter of the asking text and a fingerprint, is shuffled back to who asks.
    """
    rows = with_fingerprint(_keyed(docs), "text", "fingerprint")
    asks = successors(docs).select(
        *[F.col(c).alias(f"asker_{c}") for c in _KEY], F.floor(F.col("n_chars") / 4).cast("int").alias("wanted"), *[F.col(f"next_{c}").alias(c) for c in _KEY]
    )
    # Repeats of a row give the same to the same asker.
    given = rows.join(asks, _KEY).select(
        *[F.col(f"asker_{c}").alias(c) for c in _KEY], "wanted", F.expr("left(text, wanted)").alias("given"), F.col("fingerprint").alias("next_fingerprint")
    ).dropDuplicates(_KEY)
    both = rows.join(given, _KEY)
    edited = F.concat(F.expr("left(text, length(text) - wanted)"), "given")
    return both.select(F.when(F.col("present"), F.col("id")).alias("doc_id"), "text", "fingerprint", edited.alias("edited"), "next_fingerprint")


@query("op4_fingerprints")
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_fingerprint(with_next(documents(spark, sf_dir)), "edited", "edited_fingerprint")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        listed(F.col("fingerprint")).alias("fingerprint"),
        listed(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )

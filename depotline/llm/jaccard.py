"""Similarity join on shingle sets through parity sketches.

A pair of sets of sizes a, b and symmetric difference D has Jaccard similarity of
``(ratio - 1) / (ratio + 1)`` or more exactly if ``ratio * D <= a + b``: 19 for 0.9, 9 for 0.8. A parity sketch of m bits flips one bit per element, so
two sketches differ in at most D bits: the Hamming distance bounds D from below.

Sizes fall into bands so narrow that partners lie in the same or in adjacent bands. A
band fixes the largest D a pair in it can have, and its sketches consist of one 64-bit
word more than that: by the pigeonhole principle a pair that links agrees in at least
one word. A set gives its sketch for its own band and, as a possible smaller partner,
for the next one. Sets that share a word of a band are candidates.

Equal sets are one class and are never compared. Within a shared word no full list of
pairs is made:

1. Each class is verified against one hub, the member of its words that shares the most
   words. Verified links merge classes into components.
2. Words that still hold more than one component go to the largest of them, the host. What
   shares such words with a host is compared by sketches, in blocks of bounded size, and a
   spanning forest of the pairs within the bound is verified. This repeats while it
   merges anything.
3. What pairs within the bound still lie in different components are verified all.

After that every pair that could link is verified or lies within one component, so the
components are exact. Shingles and sets are told apart by 64-bit hashes.

Defined cases: null, empty and blank texts have no shingles and link with nothing; a
text of fewer words than a shingle is one shingle; repeated rows are one class; null ids
take part and are ignored when the smallest id is taken; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from depotline.llm.batches import emit, records
from depotline.llm.registry import documents, query
from depotline.session import store

WORDS = 3
#: Similarity of 9 / 10 by default: a pair links if ratio * D <= a + b.
RATIO = 19
#: Members of a hub that are verified in one group.
GROUP = 1024
#: Bytes of sketches in a part; two parts are held for comparison with each other.
SKETCHES = 8 << 20
#: Rows of such a part, which bounds the comparisons of two parts.
PART_ROWS = 16_384
MAX_SIZE = 1 << 40
#: Pairs per member up to which a group gives all its pairs at once; the last pass gives ALL.
FEW, ALL = 8, 1 << 40
#: Classes whose texts are wanted (64 bytes each) are broadcast up to this size and joined by shuffle beyond it.
BROADCAST_BYTES = 8 << 20


@lru_cache(maxsize=8)
def bands(ratio: int = RATIO) -> np.ndarray:
    """First size of every band: a partner of a size in one band lies in it or in the band before."""
    first = [1]
    while first[-1] < MAX_SIZE:
        first.append(max(first[-1] + 1, -(-first[-1] * (ratio + 1) // (ratio - 1))))
    return np.array(first)


BANDS = bands()


def band_difference(band: int, ratio: int = RATIO) -> int:
    """Largest symmetric difference of a linked pair whose larger set lies in the band."""
    return 2 * (int(bands(ratio)[band + 1]) - 1) // ratio


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (fixed values: the constants of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text, lower-cased in A-Z."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(t) for t in tokens], np.uint64)
    width = min(words, len(hashes))
    state = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        state = _mixed(state * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(state)


def set_id(hashes: np.ndarray) -> int | None:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())))) if len(hashes) else None


def sketch(hashes: np.ndarray, band: int, ratio: int = RATIO) -> np.ndarray:
    """Parity sketch for a band as 64-bit words, none where only equal sets link."""
    words = band_difference(band, ratio) + 1
    if words == 1:
        return np.zeros(0, np.int64)
    bits = np.bincount((hashes % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def profiles(docs: DataFrame, words: int = WORDS, ratio: int = RATIO) -> DataFrame:
    """Per document: size and id of its set, its band, and its sketches for that band and the next."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("id", pa.int64()), ("band", pa.int32()), ("own", pa.list_(pa.int64())), ("up", pa.list_(pa.int64())),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text_hash, text in records(batches, "doc_id", "text_hash", "text"):
                hashes = shingle_set(text, words)
                if not len(hashes):
                    yield (doc_id, text_hash, 0, None, None, None, None), 64
                    continue
                band = int(np.searchsorted(bands(ratio), len(hashes), "right")) - 1
                own, up = sketch(hashes, band, ratio), sketch(hashes, band + 1, ratio)
                yield (doc_id, text_hash, len(hashes), set_id(hashes), band, own, up), 64 + 8 * (len(own) + len(up))

        return emit(rows(), schema)

    columns = "doc_id bigint, text_hash bigint, n_shingles bigint, id bigint, band int, own array<bigint>, up array<bigint>"
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, columns)


def shared_words(classes: DataFrame) -> DataFrame:
    """``key``, ``band``, ``id``: words of sketches that more than one class has; a class counts once, however many copies."""
    both = F.explode(F.array(
        F.struct(F.col("band").alias("band"), F.col("own").alias("words")), F.struct((F.col("band") + 1).alias("band"), F.col("up").alias("words"))
    ))
    at = classes.select("id", "set.*").select("id", both.alias("side")).select("id", "side.band", F.posexplode("side.words").alias("place", "word"))
    keys = at.select(F.xxhash64("band", "place", "word").alias("key"), "band", "id")
    same = Window.partitionBy("key")
    known = same.orderBy("id")
    marked = keys.select("*", F.lag("id").over(known).alias("before"), F.min("id").over(same).alias("low"), F.max("id").over(same).alias("high"))
    return marked.where((F.col("low") < F.col("high")) & (F.col("before").isNull() | (F.col("before") != F.col("id")))).select("key", "band", "id")


def hub_pairs(shared: DataFrame) -> DataFrame:
    """``a``, ``b``: every class in a shared word with the hub it shares most words with."""
    degree = shared.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    rated = shared.join(degree, "id").withColumn("rating", F.struct("degree", "id"))
    hubs = rated.groupBy("key").agg(F.max("rating")["id"].alias("hub"))
    common = rated.join(hubs, "key").where("id != hub").groupBy("id", "hub").agg(F.count(F.lit(1)).alias("n"), F.first("degree").alias("degree"))
    best = common.groupBy("id").agg(F.max(F.struct("n", "hub"))["hub"].alias("hub"))
    return best.select(F.col("id").alias("a"), F.col("hub").alias("b"))


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int = WORDS, ratio: int = RATIO) -> DataFrame:
    """The pairs (a, b) of classes that link, by their whole sets.

    The text of each class is fetched once per hub it belongs to. The members of a hub
    are dealt over groups of bounded size, each with a copy of the hub.
    """
    sized = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts"))
    members = pairs.join(sized, "b").select("b", F.pmod(F.xxhash64("a"), F.col("parts")).alias("part"), F.lit(1).alias("role"), F.col("a").alias("id"))
    hubs = sized.select("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("b").alias("id"))
    named = classes.select("id", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"))
    asks = store(members.unionByName(hubs).join(named, "id"), "jaccard-asks")
    if asks.count() * 64 <= BROADCAST_BYTES:
        asks = F.broadcast(asks)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    met = texts.join(asks, texts["doc_id"].eqNullSafe(asks["rep_id"]) & (texts["text_hash"] == asks["rep_hash"])).select("b", "part", "role", "id", "text")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            group, hub = None, np.zeros(0, np.uint64)
            for b, part, role, name, text in records(batches, "b", "part", "role", "id", "text"):
                hashes = shingle_set(text, words)
                if role == 0:
                    group, hub = (b, part), hashes
                elif group == (b, part):
                    common = len(np.intersect1d(hub, hashes, assume_unique=True))
                    total = len(hub) + len(hashes)
                    if ratio * (total - 2 * common) <= total:
                        yield (name, b), 16

        return emit(rows(), schema)

    return met.repartition("b", "part").sortWithinPartitions("b", "part", "role").mapInArrow(run, "a bigint, b bigint").distinct()


def merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` (id, comp) after uniting what ``links`` (a, b) connect; comp is the smallest id of each."""
    def side(name: str) -> DataFrame:
        return components.select(F.col("id").alias(name), F.col("comp").alias(f"{name}_comp"))

    between = links.join(side("a"), "a").join(side("b"), "b").where("a_comp != b_comp").select(F.col("a_comp").alias("x"), F.col("b_comp").alias("y"))
    edges = store(between.unionByName(between.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "jaccard-edges")
    labels = store(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")), "jaccard-labels")
    small = edges.count() * 64 <= BROADCAST_BYTES  # labels are no more than edges

    def lookup(of: str, label: str) -> DataFrame:
        found = labels.select(F.col("x").alias(of), F.col("label").alias(label))
        return F.broadcast(found) if small else found

    while True:
        # The smallest label among the neighbours and its own, then the label of that label.
        spread = edges.join(lookup("y", "label"), "y").select("x", "label", F.lit(None).cast("bigint").alias("own"))
        lower = spread.unionByName(labels.withColumn("own", F.col("label"))).groupBy("x").agg(F.min("label").alias("label"), F.max("own").alias("old"))
        after = store(lower.join(lookup("label", "next"), "label", "left").select("x", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "jaccard-labels")
        labels = after.select("x", "label")
        if after.where("label != old").isEmpty():
            break
    renamed = labels.select(F.col("x").alias("comp"), F.col("label").alias("new"))
    return store(components.join(renamed, "comp", "left").select("id", F.coalesce("new", "comp").alias("comp")), "jaccard-components")


def open_words(shared: DataFrame, components: DataFrame) -> DataFrame:
    """Rows of ``shared`` in words that hold more than one component, with the word's ``host``, its largest component."""
    own = Window.partitionBy("key")
    sizes = components.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    rows = shared.join(components, "id").join(sizes, "comp")
    marked = rows.select("*", F.min("comp").over(own).alias("low"), F.max(F.struct("size", "comp")).over(own).alias("largest"), F.max("comp").over(own).alias("high"))
    return marked.where("low < high").select("key", "band", "id", "comp", F.col("largest.comp").alias("host"))


def sketch_pairs(words: DataFrame, classes: DataFrame, few: int, ratio: int = RATIO) -> DataFrame:
    """``host``, ``band``, ``a``, ``b``, ``whole``: pairs of different components whose sketches are within the bound.

    Everything that shares open words with one host meets in one group, so a sketch is sent
    there once, however many words it shares. A group of more than ``few`` pairs per
    member gives only as many as connect what all would, and is not ``whole``.
    """
    # A group with many members is dealt into parts, and every two parts meet.
    members = words.select("host", "band", "id", "comp").distinct()
    sketch_bytes = F.element_at(F.array(*[F.lit(8 * band_difference(band, ratio) + 8) for band in range(len(bands(ratio)) - 1)]), F.col("band") + 1)
    needed = F.greatest(F.ceil(F.count(F.lit(1)) * sketch_bytes / SKETCHES), F.ceil(F.count(F.lit(1)) / PART_ROWS))
    sized = members.join(members.groupBy("host", "band").agg(needed.alias("parts")), ["host", "band"])
    dealt = sized.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    met = dealt.join(classes.select("id", "set"), "id").select(
        "host", "band", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id", "comp", F.col("set.n_shingles").alias("size"),
        F.when(F.col("set.band") == F.col("band"), F.col("set.own")).otherwise(F.col("set.up")).alias("sketch"),
    )
    schema = pa.schema([("host", pa.int64()), ("band", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("whole", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            held, name = [], None
            for batch in batches:
                sketches = batch.column(batch.schema.get_field_index("sketch"))
                for n, (host, band, i, j, *row) in enumerate(records([batch], "host", "band", "i", "j", "part", "id", "comp", "size")):
                    if (host, band, i, j) != name:
                        if held:
                            yield name, held
                        held, name = [], (host, band, i, j)
                    held.append((i == j, *row, sketches[n].values.to_numpy()))
            if held:
                yield name, held

        def rows():
            for (host, band, _, _), held in groups():
                for pair in close_pairs(held, few, ratio):
                    yield (host, band, *pair), 32

        return emit(rows(), schema)

    group = ["host", "band", "i", "j"]
    return met.repartition(*group).sortWithinPartitions(*group, "id").mapInArrow(run, "host bigint, band int, a bigint, b bigint, whole boolean")


def close_pairs(held: list[tuple], few: int, ratio: int = RATIO) -> Iterator[tuple[int, int, bool]]:
    """Pairs of a group whose components differ and whose sketches allow a link, all of them or a spanning forest."""
    alone = held[0][0]
    part, ids, comps, sizes = (np.array([row[k] for row in held], np.int64) for k in range(1, 5))
    words = np.stack([row[5] for row in held]).view(np.uint64)
    root: dict[int, int] = {}
    found: list[tuple[int, int]] = []
    forest: list[tuple[int, int]] = []

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    for n in range(len(ids)):
        may = comps[n + 1 :] != comps[n]
        if not alone:
            may &= part[n + 1 :] != part[n]
        at = np.flatnonzero(may) + n + 1
        if not len(at):
            continue
        distance = np.bitwise_count(words[at] ^ words[n]).sum(axis=1, dtype=np.int64)
        for m in at[ratio * distance <= sizes[at] + sizes[n]].tolist():
            pair = int(ids[n]), int(ids[m])
            if few >= ALL:  # nothing is held back, so nothing is held
                yield *pair, True
                continue
            if len(found) <= few * len(ids):
                found.append(pair)
            x, y = find(int(comps[n])), find(int(comps[m]))
            if x != y:
                root[max(x, y)] = min(x, y)
                forest.append(pair)
    whole = len(found) <= few * len(ids)
    for a, b in found if whole else forest:
        yield a, b, whole


def components(docs: DataFrame, words: int = WORDS, ratio: int = RATIO) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``group`` and ``component_id`` of every row, by shingles of so many words.

    ``group`` names the component (null without shingles), ``component_id`` is the smallest doc_id in it.
    """
    stored = store(profiles(docs, words, ratio), "jaccard-profiles")
    classes = store(
        stored.where("id is not null").groupBy("id").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.min("doc_id").alias("least"), F.max(F.struct("n_shingles", "band", "own", "up")).alias("set")
        ),
        "jaccard-classes",
    )
    shared = store(shared_words(classes), "jaccard-words")
    united = store(shared.select("id", F.col("id").alias("comp")).distinct(), "jaccard-components")
    united = merged(united, store(verified(docs, classes, store(hub_pairs(shared), "jaccard-pairs"), words, ratio), "jaccard-links"))
    rows, few = shared, FEW
    while True:
        words_open = store(open_words(rows, united), "jaccard-open")
        pairs = store(sketch_pairs(words_open, classes, few, ratio), "jaccard-pairs")
        if pairs.isEmpty():
            break
        links = store(verified(docs, classes, pairs.select("a", "b").distinct(), words, ratio), "jaccard-links")
        # A group is done if all its pairs were given, or if those given connect what all would.
        failed = pairs.where("NOT whole").join(links, ["a", "b"], "left_anti").select("host", "band").distinct()
        rows = store(words_open.join(failed, ["host", "band"], "left_semi").select("key", "band", "id"), "jaccard-words")
        some = not links.isEmpty()
        if some:
            united = merged(united, links)
        if rows.isEmpty():
            break
        few = few if some else ALL
    named = classes.join(united, "id", "left").select("id", "least", F.coalesce("comp", "id").alias("group"))
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    of_class = named.join(smallest, "group").select(F.col("id").alias("class_id"), "group", "component_id")
    rows = stored.select("doc_id", "text_hash", "n_shingles", "id")
    return rows.join(of_class, rows["id"] == of_class["class_id"], "left").select(
        "doc_id", "text_hash", "n_shingles", "group", F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each_group(docs: DataFrame, words: int = WORDS, ratio: int = RATIO) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id, and of those the smallest text hash.

    A null id counts as the largest. Rows without shingles belong to no group and stay.
    """
    found = components(docs, words, ratio).where("n_shingles > 0")
    # Rows of one component have one class at least, so its class id names it also where all ids are null.
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("k0"), F.coalesce("doc_id", F.lit(0)).alias("k1"), F.col("text_hash").alias("k2"))).alias("key"))
    keep, keys = first.select("key.*"), ["k0", "k1", "k2"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), F.col("doc_id").isNull().alias("k0"), F.coalesce("doc_id", F.lit(0)).alias("k1"), F.xxhash64("text").alias("k2")
    )
    worded = F.coalesce(F.col("record.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # The join has dealt the rows by the same keys, so dropping repeats moves nothing.
    kept = rows.where(worded).join(keep, keys, "left_semi").dropDuplicates(keys)
    return kept.select("record.*").unionByName(rows.where(~worded).select("record.*"))


@query("op6_jaccard_join")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")

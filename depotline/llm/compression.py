"""Vector codes from k-means per part, with adaptive distance bounds.

Vectors become integers and are cut into parts; every part position has a codebook of its
own. A row keeps, for each of its parts, the ``b`` entries that were closest when last
measured: an upper bound of the distance to the one assigned, ordered lower bounds for the
others, and one outer bound for every entry not listed. When a codebook moves, bounds are
widened by how far its entries moved. A part whose upper bound stays below all lower ones
keeps its entry without a distance. The others are verified in integers: first against
their own entry alone, then, up to the depth that the ordered bounds leave open, against
the entries listed, and only where the outer bound fails against the whole codebook. Bounds
are rounded outwards and compared strictly, so a tie is always verified and codes equal
those of plain search.

``b`` is adapted per part position after each round: down to the depth that settles nearly
all verified parts (as the memory held by lists is only worth it if used), up to twice as
many where too many parts fall through to the whole codebook.

Between rounds rows with their lists and bounds are a table in the shared folder, and the
one before is dropped when its successor is complete; a lost executor costs a re-read. A
task adds up the parts of its rows per entry; Spark adds those sums, so what reaches the
driver is one number per entry and position, whatever the rows.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no
part, nor do those of another dimension than the most common one (of equals the smaller); a
dimension that the number of parts does not divide gives its first parts one component
more, and one that is smaller leaves the last parts empty (entry 0, error 0). Rows without
an id come last in the order of ids, equal ids in the order of their vectors. Fewer rows
than entries give shorter codebooks. Components too large for 64-bit distances are computed
in unbounded integers; an error beyond 64 bits is null, as is a label's sum that holds or makes one. Repeated rows are rows of their
own, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.llm.registry import query
from depotline.session import drop_stage, read_stage, write_stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Entries listed at first, and the fewest ever listed.
LISTED = 4
FEWEST = 2
#: Share of verified parts that may need more than ``b`` entries before ``b`` is held, and share of all parts
#: measured against the whole codebook from which it is doubled.
SPARE = 0.05
WHOLE = 0.25
#: Bits of a summand in the sums of unbounded integers.
LIMB = 60


@dataclass(frozen=True)
class Shape:
    """Integer vectors of ``dimension`` components, held as ``dtype`` (None: unbounded, as decimal text)."""

    dimension: int
    parts: int
    dtype: str | None

    @classmethod
    def of(cls, dimension: int, parts: int, largest: float, scale: int) -> Shape:
        top = (int(largest) + 1) * scale
        width = -(-dimension // parts)
        fits = (2 * top) ** 2 * width < 1 << 62
        return cls(dimension, parts, next(d for d, bits in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if top < 1 << bits) if fits else None)

    @property
    def cuts(self) -> list[slice]:
        """Components of each part."""
        width, more = divmod(self.dimension, self.parts)
        ends = np.cumsum([width + (p < more) for p in range(self.parts)]).tolist()
        return [slice(low, high) for low, high in zip([0, *ends], ends, strict=False)]

    def integers(self, column: pa.Array, scale: int) -> np.ndarray:
        """floor(scale * x) of a column of vectors."""
        x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, self.dimension)
        if self.dtype:
            return np.floor(x * scale).astype(np.int64)
        return np.array([[_floor(v, scale) for v in row] for row in x.tolist()], object).reshape(x.shape)

    def pack(self, x: np.ndarray) -> pa.Array:
        if self.dtype:
            return packed(x.astype(self.dtype))
        return pa.array([",".join(map(str, row)).encode() for row in x.tolist()], pa.binary())

    def unpack(self, column: pa.Array) -> np.ndarray:
        if self.dtype:
            return unpacked(column, self.dtype, self.dimension).astype(np.int64)
        return np.array([[int(v) for v in row.split(b",")] for row in column.to_pylist()], object).reshape(-1, self.dimension)

    def entries(self, codebook: list[list[int]], part: int) -> np.ndarray:
        cut = self.cuts[part]
        return np.array(codebook, np.int64 if self.dtype else object).reshape(len(codebook), cut.stop - cut.start)


def _floor(x: float, scale: int) -> int:
    numerator, denominator = x.as_integer_ratio()
    return numerator * scale // denominator


def packed(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as a column of bytes."""
    width = matrix.shape[1] * matrix.dtype.itemsize
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def unpacked(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries; ``entries`` are common to all rows or given per row."""
    away = x[:, None, :] - (entries if entries.ndim == 3 else entries[None])
    return (away * away).sum(axis=2)


def roots(squared: np.ndarray) -> np.ndarray:
    """Distances, infinite where a square has no double."""
    if squared.dtype != object:
        return np.sqrt(squared.astype(float))
    return np.sqrt(np.array([float(v) if v < 1 << 1000 else np.inf for v in squared.ravel().tolist()]).reshape(squared.shape))


def rounded_up(bound: np.ndarray) -> np.ndarray:
    return np.nextafter(bound.astype(np.float32), np.float32(np.inf))


def rounded_down(bound: np.ndarray) -> np.ndarray:
    """A distance without a double is at least the largest single."""
    return np.nextafter(bound.astype(np.float32), np.float32(-np.inf))


class Lists:
    """Per row the closest entries of one part position: ``ids``, and ``bounds``: an upper one for the first, ordered
    lower ones for the others, the outer one."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        self.ids, self.bounds = ids, bounds

    @classmethod
    def measured(cls, x: np.ndarray, entries: np.ndarray, listed: int) -> Lists:
        """From distances to all entries."""
        n = len(entries)
        listed = min(listed, n)
        squared = squares(x, entries)
        # A stable order by distance keeps the lower of tied entries first.
        order = np.argsort(squared, axis=1, kind="stable")[:, : listed + 1]
        distance = roots(np.take_along_axis(squared, order, axis=1))
        outer = rounded_down(distance[:, listed]) if n > listed else np.full(len(x), np.inf)
        bounds = np.column_stack([rounded_up(distance[:, 0]), rounded_down(distance[:, 1:listed]), outer])
        return cls(order[:, :listed].astype(np.uint8), bounds)

    def moved(self, x: np.ndarray, entries: np.ndarray, drift: np.ndarray) -> np.ndarray:
        """Follow ``entries`` that moved by ``drift``; gives the depth to which each row had to look: 0 not at all, 1 its
        own entry, up to the number listed, and one more for the whole codebook."""
        listed = self.ids.shape[1]
        bounds = self.bounds.astype(float)
        bounds[:, 0] += drift[self.ids[:, 0]]
        bounds[:, 1:listed] -= drift[self.ids[:, 1:]]
        outside = np.isfinite(bounds[:, listed])  # else every entry is listed
        bounds[outside, listed] -= drift.max()
        # Ordered: what stands at a rank is below all that come later.
        bounds[:, 1:] = np.minimum.accumulate(bounds[:, :0:-1], axis=1)[:, ::-1]
        bounds = np.column_stack([rounded_up(bounds[:, 0]), np.where(bounds[:, 1:] < np.inf, rounded_down(bounds[:, 1:]), np.inf)])
        depth = np.zeros(len(x), np.int64)
        open_rows = np.flatnonzero(~(bounds[:, 0] < bounds[:, 1]))
        own = roots(squares(x[open_rows], entries[self.ids[open_rows, :1].astype(int)])[:, 0])
        bounds[open_rows, 0] = rounded_up(own)
        depth[open_rows] = 1 + (bounds[open_rows, 1:] <= bounds[open_rows, :1]).sum(axis=1)
        self.bounds = bounds
        near = np.flatnonzero((depth > 1) & (depth <= listed))
        if len(near):
            # Entries in ascending order, so that of tied ones the lower comes first.
            ids = np.sort(self.ids[near], axis=1)
            squared = squares(x[near], entries[ids.astype(int)])
            order = np.argsort(squared, axis=1, kind="stable")
            self.ids[near] = np.take_along_axis(ids, order, axis=1)
            distance = roots(np.take_along_axis(squared, order, axis=1))
            bounds[near, 0] = rounded_up(distance[:, 0])
            bounds[near, 1:listed] = rounded_down(distance[:, 1:])
            bounds[near, 1:] = np.minimum.accumulate(bounds[near, :0:-1], axis=1)[:, ::-1]
        far = np.flatnonzero(depth > listed)
        if len(far):
            again = Lists.measured(x[far], entries, listed)
            self.ids[far], self.bounds[far] = again.ids, again.bounds
        return depth

    def cut(self, listed: int) -> None:
        """Keep fewer entries; ordered bounds make that of the first one dropped the outer bound."""
        if listed < self.ids.shape[1]:
            self.ids, self.bounds = self.ids[:, :listed], self.bounds[:, : listed + 1]


def next_listed(listed: int, depths: list[int], n_entries: int) -> int:
    """Entries to list in the next round, from the numbers of parts by depth."""
    total, verified = sum(depths), sum(depths[2:])
    if total and sum(depths[listed + 1 :]) > WHOLE * total:
        return min(2 * listed, n_entries)
    settled = 0
    for b in range(2, listed + 1):
        settled += depths[b]
        if settled >= (1 - SPARE) * verified:
            return min(max(b, FEWEST), listed)
    return listed


def sound_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` of the rows whose vector is whole and finite."""
    return table.select("vec_id", "label", F.col(vector).alias("vector")).where(
        (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )


class Codebooks:
    """Entries of every part position, as lists of integers."""

    def __init__(self, shape: Shape, books: list[list[list[int]]]):
        self.shape, self.books = shape, books

    @classmethod
    def first(cls, shape: Shape, starts: np.ndarray) -> Codebooks:
        return cls(shape, [starts[:, cut].tolist() for cut in shape.cuts])

    def means(self, totals: dict[tuple[int, int], dict[int, int]]) -> Codebooks:
        """Entries replaced by the floors of their parts' means; ``totals`` has sums by position, the count at -1."""
        books = []
        for p, book in enumerate(self.books):
            books.append([[t[i] // t[-1] for i in range(len(entry))] if (t := totals.get((p, e))) else entry for e, entry in enumerate(book)])
        return Codebooks(self.shape, books)

    def drift(self, later: Codebooks) -> list[np.ndarray]:
        """How far each entry moved, rounded up."""
        out = []
        for p in range(self.shape.parts):
            away = self.shape.entries(later.books[p], p) - self.shape.entries(self.books[p], p)
            out.append(np.nextafter(roots((away * away).sum(axis=1)), np.inf))
        return out

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.books for entry in book for x in entry).encode()).hexdigest()


def _totals(sums: list[np.ndarray], counts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
    """Sums of a task as rows (part, entry, position, limb, value), position -1 for the count."""
    out = []
    for p, (total, count) in enumerate(zip(sums, counts, strict=True)):
        for e in np.flatnonzero(count).tolist():
            out.append((p, e, -1, 0, int(count[e])))
            for i, value in enumerate(total[e].tolist()):
                limb = 0
                while not -(1 << LIMB) <= value < 1 << LIMB:
                    out.append((p, e, i, limb, value & ((1 << LIMB) - 1)))
                    value, limb = value >> LIMB, limb + 1
                out.append((p, e, i, limb, value))
    return out


_TOTALS = "totals array<struct<part: int, entry: int, position: int, limb: int, value: bigint>>, depths array<array<bigint>>"
_TOTALS_SCHEMA = [
    ("totals", pa.list_(pa.struct([(c, pa.int32()) for c in ("part", "entry", "position", "limb")] + [("value", pa.int64())]))),
    ("depths", pa.list_(pa.list_(pa.int64()))),
]


def _pass(
    books: Codebooks, listed: list[int], follow: Callable[[int, np.ndarray, Lists | None], tuple[Lists, np.ndarray]], parse: Callable, fields: list[tuple]
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One reading of all rows: new lists for each, and at the end of a task its sums per entry."""
    shape = books.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.int64 if shape.dtype else object
        sums = [np.zeros((len(book), cut.stop - cut.start), kind) for book, cut in zip(books.books, shape.cuts, strict=True)]
        counts = [np.zeros(len(book), np.int64) for book in books.books]
        depths = [[0] * (ENTRIES + 2) for _ in books.books]
        schema = pa.schema([*fields, ("x", pa.binary()), ("ids", pa.binary()), ("bounds", pa.binary()), *_TOTALS_SCHEMA])
        for batch in batches:
            x, held = parse(batch)
            lists = []
            for p, cut in enumerate(shape.cuts):
                own, depth = follow(p, x[:, cut], held[p] if held else None)
                for at, n in enumerate(np.bincount(depth).tolist()):
                    depths[p][at] += n
                own.cut(listed[p])
                lists.append(own)
                nearest = own.ids[:, 0].astype(int)
                np.add.at(sums[p], nearest, x[:, cut])
                counts[p] += np.bincount(nearest, minlength=len(counts[p]))
            ids, bounds = np.concatenate([o.ids for o in lists], axis=1), np.concatenate([o.bounds for o in lists], axis=1)
            columns = [batch.column(0), batch.column(1), shape.pack(x), packed(ids), packed(bounds.astype("<f4"))]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(x), t) for _, t in _TOTALS_SCHEMA]], schema=schema)
        ends = [pa.nulls(1, f.type) for f in schema][:-2]
        named = [dict(zip(("part", "entry", "position", "limb", "value"), row, strict=True)) for row in _totals(sums, counts)]
        yield pa.RecordBatch.from_arrays([*ends, pa.array([named], schema.field("totals").type), pa.array([depths], schema.field("depths").type)], schema=schema)

    return run


def _collected(stage: DataFrame, parts: int) -> tuple[dict, list[list[int]]]:
    """Sums of all tasks by (part, entry) and position, and numbers of parts by depth; bounded by the codebooks' size."""
    ends = stage.where("totals is not null")
    summed = ends.select(F.inline("totals")).groupBy("part", "entry", "position", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    totals: dict[tuple[int, int], dict[int, int]] = {}
    for r in summed.collect():
        own = totals.setdefault((r.part, r.entry), {})
        own[r.position] = own.get(r.position, 0) + (int(r.value) << (LIMB * r.limb))
    by_depth = ends.select(F.posexplode("depths").alias("part", "n")).select("part", F.posexplode("n").alias("depth", "n")).groupBy("part", "depth").agg(F.sum("n").alias("n"))
    depths = [[0] * (ENTRIES + 2) for _ in range(parts)]
    for r in by_depth.collect():
        depths[r.part][r.depth] = r.n
    return totals, depths


def compress(table: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks, list]:
    """Codes of all sound rows (``vec_id``, ``label``, ``codes``: a byte per part, ``error``), the final codebooks, and
    per round the entries listed and the numbers of parts by depth."""
    if not 0 < entries <= ENTRIES:
        raise ValueError(f"between 1 and {ENTRIES} entries")
    spark = table.sparkSession
    sound = sound_vectors(table, vector)
    kinds = dict(sound.dtypes)
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    size = sound.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(largest).alias("largest")).orderBy(F.desc("n"), "size").first()
    if size is None:
        none = spark.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes binary, error bigint")
        return none, Codebooks(Shape(0, parts, "<i2"), [[] for _ in range(parts)]), []
    shape = Shape.of(size["size"], parts, size["largest"], scale)
    kept = sound.where(F.size("vector") == shape.dimension)
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").toArrow()
    books = Codebooks.first(shape, shape.integers(first.column(0).combine_chunks(), scale))
    fields = [(f.name, f.type) for f in kept.select("vec_id", "label").limit(0).toArrow().schema]
    columns = f"vec_id {kinds['vec_id']}, label {kinds['label']}, x binary, ids binary, bounds binary, {_TOTALS}"
    listed = [min(LISTED, len(books.books[0]))] * parts
    path, history, moves = "", [], []

    def measure(now: Codebooks, b: list[int]):
        def follow(p: int, x: np.ndarray, _: Lists | None) -> tuple[Lists, np.ndarray]:
            return Lists.measured(x, shape.entries(now.books[p], p), b[p]), np.full(len(x), ENTRIES + 1)

        return follow

    def update(now: Codebooks, moves: list[np.ndarray], before: list[int], b: list[int]):
        def follow(p: int, x: np.ndarray, held: Lists) -> tuple[Lists, np.ndarray]:
            depth = held.moved(x, shape.entries(now.books[p], p), moves[p])
            if b[p] > before[p]:
                held = Lists.measured(x, shape.entries(now.books[p], p), b[p])
            return held, depth

        return follow

    def raw(batch: pa.RecordBatch) -> tuple[np.ndarray, None]:
        return shape.integers(batch.column(2), scale), None

    def stored(b: list[int]):
        def parse(batch: pa.RecordBatch) -> tuple[np.ndarray, list[Lists]]:
            x = shape.unpack(batch.column(2))
            ids, bounds = unpacked(batch.column(3), "u1", sum(b)), unpacked(batch.column(4), "<f4", sum(b) + parts)
            ends = np.cumsum(b).tolist()
            own = [Lists(ids[:, e - n : e].copy(), bounds[:, e - n + p : e + p + 1].copy()) for p, (n, e) in enumerate(zip(b, ends, strict=True))]
            return x, own

        return parse

    def rows(path: str) -> DataFrame:
        return read_stage(spark, path, columns).where("totals is null").select("vec_id", "label", "x", "ids", "bounds")

    before = listed
    for number in range(rounds):
        if number == 0:
            step = kept.mapInArrow(_pass(books, listed, measure(books, listed), raw, fields), columns)
        else:
            step = rows(path).mapInArrow(_pass(books, listed, update(books, moves, before, listed), stored(before), fields), columns)
        done, path = path, write_stage(step, "compression-lists")
        if done:
            drop_stage(spark, done)
        totals, depths = _collected(read_stage(spark, path, columns), parts)
        history.append((listed, depths))
        later = books.means(totals)
        moves, books = books.drift(later), later
        before = listed
        if number:
            listed = [next_listed(b, d, len(books.books[0])) for b, d in zip(listed, depths, strict=True)]

    def final(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*fields, ("codes", pa.binary()), ("error", pa.int64())])
        parse = stored(before) if rounds else raw
        follow = update(books, moves, before, before) if rounds else measure(books, listed)
        for batch in batches:
            x, held = parse(batch)
            error = np.zeros(len(x), np.int64 if shape.dtype else object)
            codes = np.zeros((len(x), parts), np.uint8)
            for p, cut in enumerate(shape.cuts):
                own, _ = follow(p, x[:, cut], held[p] if held else None)
                codes[:, p] = own.ids[:, 0]
                error += squares(x[:, cut], shape.entries(books.books[p], p)[codes[:, p].astype(int)][:, None, :])[:, 0]
            whole = pa.array(error) if shape.dtype else pa.array([e if e < 1 << 63 else None for e in error.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed(codes), whole], schema=schema)

    out = f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes binary, error bigint"
    coded = read_stage(spark, write_stage((rows(path) if rounds else kept).mapInArrow(final, out), "compression-codes"), out)
    if path:
        drop_stage(spark, path)
    return coded, books, history


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """Plain search in every round, on vectors whose dimension the number of parts divides."""
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT row, part, arg_min(entry, d * {entries} + entry) AS entry, min(d) AS d FROM ("
            f"SELECT x.row, x.part, c.entry, SUM((x.v - c.v) * (x.v - c.v))::BIGINT AS d FROM x JOIN c{r} c USING (part, position) GROUP BY ALL) GROUP BY row, part)"
        )
        if r < rounds:
            steps.append(
                f"c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, c.position, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN ("
                f"SELECT part, entry, position, ((s - ((s % n) + n) % n) // n)::BIGINT AS v FROM ("
                f"SELECT a.part, a.entry, x.position, SUM(x.v)::BIGINT AS s, COUNT(*) AS n FROM a{r} a JOIN x USING (row, part) GROUP BY ALL)) m USING (part, entry, position))"
            )
    return f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0),
u AS (SELECT row, unnest(e) AS y, unnest(range(len(e))) AS i, len(e) // {parts} AS width FROM kept),
x AS MATERIALIZED (SELECT row, CAST(i // width AS INTEGER) AS part, i % width AS position, CAST(floor({SCALE} * y) AS BIGINT) AS v FROM u),
c0 AS MATERIALIZED (SELECT part, row - 1 AS entry, position, v FROM x WHERE row <= {entries}),
{", ".join(steps)},
coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(SUM(d) AS BIGINT) AS error FROM a{rounds} GROUP BY row),
books AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, position)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row) CROSS JOIN books"""


@query("op11_compression", _sql())
def op11_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books, _ = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error")).alias("label_error"))
    met = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return met.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))

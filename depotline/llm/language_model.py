"""Document log-likelihood under a gated recurrent language model.

The model predicts units. The most frequent words of the training documents are units
of their own; all other words share a fixed number of units by their last bytes, and a
word's probability is its unit's times its share of the unit in the training counts. The
output is factored: a softmax over classes of units and one over the members of the
class. The recurrent part is a gated recurrent unit, trained by back-propagation through
windows of ``WINDOW`` steps, with the state carried from window to window within a
document and reset between documents
(and, in training, between the segments of a very long one).

Every training document is learned from, in rounds: each task trains a copy on its share
of the round's documents, Spark averages the copies weighted by tokens, and the next
round starts from the average. Words are looked up once: documents are stored as units,
which the rounds and the scoring read. Counts cover all training documents; the vocabulary is
never gathered in one place: words counted often enough (``FREQUENT`` at most) are sent
to the tasks, and the counts of all others are joined to the documents that hold them.

An unknown word counts as one unknown type of its unit, with half a count; the same half
counts smooth the base, a unigram model over all training tokens.

Defined cases: null and empty texts consist of the end token; a null id belongs to the
training documents; repeated rows are separate documents; with no training documents every
word is unknown; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from depotline.llm.registry import documents, query
from depotline.session import store

CLASSES, MEMBERS = 32, 32
UNITS = CLASSES * MEMBERS
#: Units that words without one of their own share, by their last SUFFIX bytes.
SHARED, SUFFIX = 192, 3
HIDDEN = 16
WINDOW, LANES = 20, 256
#: Longest stretch of a document that is trained on with one state.
SEGMENT = 2048
#: Shares of the training documents in the rounds, in 1/16; the copies drift least apart while the rounds are short.
ROUNDS = (1, 3, 12)
RATE = 0.01
#: Words whose counts every task holds, at most.
FREQUENT = 200_000
#: Distinct words a task counts before it hands them on, and tokens it trains on or scores together.
COUNTED, STRETCH, SCORED = 900_000, 1_000_000, 5_000_000
#: Bytes of text whose words a task looks up together.
LOOKED_UP = 8 << 20
SEED = 3


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words without ASCII white space, A-Z lower-cased, each text's followed by the end token (empty); and how many each text has."""
    # A space behind a text leaves an empty string after its last word, the end token; white space before it leaves one that is no token.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.binary_join_element_wise(pc.fill_null(texts, ""), "", " ")))
    words, lengths = lists.flatten().cast(pa.binary()), lists.value_lengths().to_numpy().astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    led = (pc.binary_length(words).to_numpy()[starts] == 0) & (lengths > 1)
    if led.any():
        kept = np.ones(len(words), bool)
        kept[starts[led]] = False
        words, lengths = words.filter(pa.array(kept)), lengths - led
    return words, lengths


# ---- counts


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (bytes) and its ``count`` over all documents; the end token is the empty word."""
    schema = pa.schema([("word", pa.binary()), ("count", pa.int64())])

    def summed(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("count", "sum")]).rename_columns(schema.names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            found = pc.value_counts(split_words(batch.column(0))[0])
            parts.append(pa.Table.from_arrays(found.flatten(), schema=schema))
            held += len(found)
            if held >= 2 * COUNTED:
                parts = [summed(parts)]
                held = len(parts[0])
                if held >= COUNTED:
                    yield from parts[0].to_batches(max_chunksize=50_000)
                    parts, held = [], 0
        if parts:
            yield from summed(parts).to_batches(max_chunksize=50_000)

    return docs.select("text").mapInArrow(run, "word binary, count bigint").groupBy("word").agg(F.sum("count").alias("count"))


def frequent_words(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The words above a count that at most FREQUENT words reach, most frequent first."""
    step = F.floor(F.log2("count") * 8).cast("int")
    steps = {r.step: r.n for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()}  # 512 rows at most
    least, total = max(steps, default=0) + 1, 0
    for at in sorted(steps, reverse=True):
        total += steps[at]
        if total > FREQUENT:
            break
        least = at
    rows = counts.where(step >= least).collect()
    return sorted(((bytes(r.word), r["count"]) for r in rows), key=lambda item: (-item[1], item[0]))


def shared_unit(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX:]) % SHARED


class Lexicon:
    """Units of words, and what a word's probability within its unit takes."""

    def __init__(self, frequent: list[tuple[bytes, int]], totals: dict[int, tuple[int, int]]):
        """``totals``: occurrences and distinct words by shared unit, over words without a unit of their own."""
        own = frequent[: UNITS - SHARED]
        self.words = pa.array([word for word, _ in frequent], pa.binary())
        self.unit = np.array([SHARED + i if i < len(own) else shared_unit(w) for i, (w, _) in enumerate(frequent)], np.int16)
        self.log_count = np.log10(np.array([c for _, c in frequent], float) + 0.5)
        sums = np.array([totals.get(u, (0, 0)) for u in range(SHARED)], float).reshape(-1, 2)
        self.log_total = np.log10(sums[:, 0] + 0.5 * (sums[:, 1] + 1))
        # A word with a unit of its own is all of it.
        self.share = np.array([0.0 if i < len(own) else self.log_count[i] - self.log_total[u] for i, u in enumerate(self.unit)])

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Unit, logarithm of the count and share of each word, and which words have no count here.

        These have 0 for the logarithm of their count, and it is missing from their share.
        """
        rank = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy()
        # The last place of each stands for the words without a rank.
        unit, log_count, share = (np.append(known, known.dtype.type(0))[rank] for known in (self.unit, self.log_count, self.share))
        rare = rank < 0
        if rare.any():
            tails = pc.binary_slice(words.filter(pa.array(rare)), -SUFFIX).dictionary_encode()
            unit[rare] = np.array([shared_unit(t) for t in tails.dictionary.to_pylist()], np.int16)[tails.indices.to_numpy()]
            share[rare] = -self.log_total[unit[rare]]
        return unit, log_count, share, rare


# ---- the network


_SHAPES = {
    "input": (UNITS + 1, 3 * HIDDEN),  # by the unit before, the last row before the first word
    "state": (HIDDEN, 3 * HIDDEN),
    "class_w": (HIDDEN, CLASSES), "class_b": (CLASSES,),
    "member_w": (CLASSES, HIDDEN, MEMBERS), "member_b": (CLASSES, MEMBERS),
}
_SIZE = sum(math.prod(s) for s in _SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        out[name] = flat[at : at + math.prod(shape)].reshape(shape)
        at += math.prod(shape)
    return out


def initial(seed: int = 3) -> np.ndarray:
    flat = np.zeros(_SIZE, np.float32)
    rng, net = np.random.default_rng(seed), views(flat)
    net["input"][:] = rng.normal(0, 0.3, _SHAPES["input"])
    net["state"][:] = rng.normal(0, 1 / math.sqrt(HIDDEN), _SHAPES["state"])
    net["class_w"][:] = rng.normal(0, 0.1, _SHAPES["class_w"])
    net["member_w"][:] = rng.normal(0, 0.1, _SHAPES["member_w"])
    return flat


class Lanes:
    """Whole documents laid end to end in parallel lanes, the longest lane first."""

    def __init__(self, units: list, n_lanes: int, firsts: np.ndarray | int = UNITS):
        """``firsts``: the unit before each document."""
        lengths = [len(u) for u in units]
        heap = [(0, i) for i in range(min(n_lanes, len(units)))]
        held: list[list[int]] = [[] for _ in heap]
        for doc in sorted(range(len(units)), key=lambda d: -lengths[d]):
            filled, lane = heapq.heappop(heap)
            held[lane].append(doc)
            heapq.heappush(heap, (filled + lengths[doc], lane))
        held.sort(key=lambda docs: -sum(lengths[d] for d in docs))
        order = [d for docs in held for d in docs]
        self.ends = np.array([sum(lengths[d] for d in docs) for docs in held])
        self.offsets = np.cumsum(self.ends) - self.ends
        self.target = np.concatenate([np.asarray(units[d], np.int16) for d in order])
        self.doc = np.repeat(np.array(order, np.int32), [lengths[d] for d in order])
        starts = np.flatnonzero(np.diff(self.doc, prepend=-1))
        self.before = np.roll(self.target, 1)
        self.before[starts] = firsts if np.isscalar(firsts) else firsts[order]
        self.keep = np.ones(len(self.doc), bool)
        self.keep[starts] = False

    def windows(self, steps: int, places: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (steps x lanes still going) of each window, and which of them lie within their lane.

        Windows grow where few lanes are left, up to so many ``places``.
        """
        start, last = 0, int(self.ends[0]) if len(self.ends) else 0
        while start < last:
            going = int((self.ends > start).sum())
            at = np.arange(start, min(start + max(steps, places // going), last))[:, None]
            yield self.offsets[:going] + np.minimum(at, self.ends[:going] - 1), at < self.ends[:going]
            start += len(at)


def places_within(real: np.ndarray) -> np.ndarray | slice:
    """Places of a window that lie within their lanes, counted through; most windows have no others."""
    return slice(None) if real.all() else np.flatnonzero(real)


def run_states(net: dict, before: np.ndarray, keep: np.ndarray, state: np.ndarray, record: bool = False) -> tuple[np.ndarray, tuple]:
    """States after each step of a window and, if asked to ``record``, what going back takes.

    Lanes are the last axis within (and of what is recorded), so that a gate is one piece of memory.
    """
    steps, lanes = before.shape
    table, h = net["input"], HIDDEN
    # The logistic function is taken through tanh of half its argument; halves are exact.
    half = np.repeat(np.array([0.5, 1], table.dtype), [2 * h, h])
    table, recurrent = table * half, np.ascontiguousarray((net["state"] * half).T)
    out = np.empty((steps, h, lanes), table.dtype)
    kept = steps if record else 1  # without a record one step's place is used over and over
    old, gates, inner = (np.empty((kept, rows, lanes), table.dtype) for rows in (h, 3 * h, h))
    rows, into, from_state = np.empty((lanes, 3 * h), table.dtype), np.empty((3 * h, lanes), table.dtype), np.empty((3 * h, lanes), table.dtype)
    into_gates, into_fresh, gates_from_state, fresh_from_state = into[: 2 * h], into[2 * h :], from_state[: 2 * h], from_state[2 * h :]
    resets, before = ~keep.all(axis=1), before.astype(np.intp)
    state = np.ascontiguousarray(state.T)
    for t in range(steps):
        at = t if record else 0
        if resets[t]:
            state = np.multiply(state, keep[t], out=old[at])
        elif record:
            old[at] = state
        table.take(before[t], axis=0, out=rows, mode="clip")  # with this mode it writes to its place at once
        into[:] = rows.T
        np.matmul(recurrent, state, out=from_state)
        if record:
            inner[at] = fresh_from_state
        gate, fresh = gates[at, : 2 * h], gates[at, 2 * h :]
        np.add(into_gates, gates_from_state, out=gate)
        np.tanh(gate, out=gate)
        gate += 1
        gate *= 0.5
        np.multiply(gate[h:], fresh_from_state, out=fresh)
        fresh += into_fresh
        np.tanh(fresh, out=fresh)
        moved = np.subtract(state, fresh, out=out[t])
        moved *= gate[:h]
        moved += fresh
        state = moved
    return out.transpose(0, 2, 1), (old, gates, inner)


#: Logits up to here, of either sign, have exponentials and sums of exponentials far within the range of 32 bits.
BOUNDED = 60.0


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials by row, and their sums; where they might leave their range, scaled so that each row's largest is one."""
    if max(logits.max(), -logits.min()) > BOUNDED:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    return logits, logits @ np.ones(logits.shape[1], logits.dtype)


def unit_log_probability(net: dict, states: np.ndarray, target: np.ndarray, slopes: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log-probability of each target; with ``slopes``, also adds those of the mean loss and gives the states'.

    Rows are sorted by target, so that those of a class lie together. A last column of ones takes the biases in.
    """
    target = target.astype(np.int16)
    order = np.argsort(target, kind="stable")
    target, n = target[order], len(order)
    rows = np.ones((n, HIDDEN + 1), states.dtype)
    rows[:, :HIDDEN] = states.take(order, axis=0)
    borders = np.searchsorted(target, np.arange(CLASSES + 1) * MEMBERS).tolist()
    parts = [(c, a, b) for c, (a, b) in enumerate(zip(borders, borders[1:], strict=False)) if a < b]
    member_w = np.concatenate([net["member_w"], net["member_b"][:, None]], axis=1)
    logits = np.empty((n, MEMBERS), rows.dtype)
    for c, a, b in parts:
        np.matmul(rows[a:b], member_w[c], out=logits[a:b])
    members, of_members = _exponentials(logits)
    classes, of_classes = _exponentials(rows @ np.vstack([net["class_w"], net["class_b"]]))
    kind = target // MEMBERS
    kind_at = np.arange(n) * CLASSES + kind
    member_at = np.arange(n) * MEMBERS + (target - kind * MEMBERS)
    found, back = classes.ravel()[kind_at] / of_classes * (members.ravel()[member_at] / of_members), None
    if slopes is not None:
        for shares, total, hit in ((classes, of_classes, kind_at), (members, of_members, member_at)):
            shares *= (1 / (total * n))[:, None]
            shares.ravel()[hit] -= 1 / n
        slope = rows.T @ classes
        slopes["class_w"] += slope[:HIDDEN]
        slopes["class_b"] += slope[HIDDEN]
        sent = np.empty((n, HIDDEN), rows.dtype)
        for c, a, b in parts:
            slope = rows[a:b].T @ members[a:b]
            slopes["member_w"][c] += slope[:HIDDEN]
            slopes["member_b"][c] += slope[HIDDEN]
            np.matmul(members[a:b], net["member_w"][c].T, out=sent[a:b])
        sent += classes @ net["class_w"].T
        back = np.empty_like(sent)
        back[order] = sent
    out = np.empty(n)
    out[order] = np.log(np.maximum(found, 1e-37))
    return out, back


def back_through(net: dict, before: np.ndarray, keep: np.ndarray, kept: tuple, slope_out: np.ndarray, slopes: dict) -> None:
    """Slopes of the recurrent part, back through the steps of one window."""
    old, gates, inner = kept
    steps, h, lanes = old.shape
    update, reset, fresh = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
    # What a slope of the state is multiplied by on its way into each gate; the steps turn it into the gates' slopes.
    into = np.empty_like(gates)
    to_update, to_reset, to_fresh = into[:, :h], into[:, h : 2 * h], into[:, 2 * h :]
    stay = 1 - update
    np.multiply(fresh, fresh, out=to_fresh)
    np.subtract(1, to_fresh, out=to_fresh)
    to_fresh *= stay
    np.subtract(1, reset, out=to_reset)
    to_reset *= reset
    to_reset *= inner
    to_reset *= to_fresh
    np.subtract(old, fresh, out=to_update)
    stay *= update
    to_update *= stay
    slope_out = np.ascontiguousarray(slope_out.transpose(0, 2, 1))
    recurrent, resets = net["state"], ~keep.all(axis=1)
    by_state, later, passed = np.empty_like(into[0]), np.zeros_like(old[0]), np.empty_like(old[0])
    for t in range(steps - 1, -1, -1):
        later += slope_out[t]
        by_gate = into[t]
        by_gate.reshape(3, h, lanes)[:] *= later
        by_state[: 2 * h] = by_gate[: 2 * h]
        np.multiply(by_gate[2 * h :], reset[t], out=by_state[2 * h :])
        slopes["state"] += old[t] @ by_state.T
        later *= update[t]
        later += np.matmul(recurrent, by_state, out=passed)
        if resets[t]:
            later *= keep[t]
    flat = before.ravel()
    order = np.argsort(flat.astype(np.int16), kind="stable")
    first = np.flatnonzero(np.diff(flat[order], prepend=-1))
    rows = into.transpose(0, 2, 1).reshape(-1, 3 * h).take(order, axis=0)
    # As complex numbers two columns are added at a time.
    slopes["input"][flat[order][first]] += np.add.reduceat(rows.view(np.result_type(rows, 1j)), first, axis=0).view(rows.dtype)


class Trainer:
    """Truncated back-propagation with Adam steps from given parameters."""

    def __init__(self, flat: np.ndarray, rate: float = RATE):
        self.flat, self.rate = flat.copy(), rate
        self.net, self.slope = views(self.flat), np.zeros_like(flat)
        self.slopes, self.first, self.second, self.step, self.tokens = views(self.slope), np.zeros_like(flat), np.zeros_like(flat), 0, 0
        self.change, self.size = np.empty_like(flat), np.empty_like(flat)  # places the steps work in

    def learn(self, units: list) -> None:
        """One pass over documents, as many in parallel as leave some hundred steps.

        Long documents are cut into segments, so that no lane is left alone; the state starts anew there.
        """
        cuts = [(u, n) for u in units for n in range(0, len(u), SEGMENT)]
        firsts = np.array([u[n - 1] if n else UNITS for u, n in cuts], np.int32)
        lanes = Lanes([u[n : n + SEGMENT] for u, n in cuts], min(max(sum(map(len, units)) // 4000, 32), LANES), firsts)
        state = np.zeros((len(lanes.ends), HIDDEN), np.float32)
        for at, real in lanes.windows(WINDOW):
            before, keep = lanes.before[at], lanes.keep[at]
            out, kept = run_states(self.net, before, keep, state[: at.shape[1]], record=True)
            self.slope[:] = 0
            within = places_within(real)
            _, back = unit_log_probability(self.net, out.reshape(-1, HIDDEN)[within], lanes.target[at.ravel()[within]], self.slopes)
            slope_out = np.zeros((at.size, HIDDEN), out.dtype)
            slope_out[within] = back
            back_through(self.net, before, keep, kept, slope_out.reshape(out.shape), self.slopes)
            self._adam()
            state = out[-1]
            self.tokens += int(real.sum())

    def _adam(self) -> None:
        self.step += 1
        norm = float(np.sqrt(self.slope @ self.slope))
        if norm > 1:
            self.slope /= norm
        change, size = self.change, self.size
        np.subtract(self.slope, self.first, out=change)
        change *= 0.1
        self.first += change
        np.multiply(self.slope, self.slope, out=change)
        change -= self.second
        change *= 0.01
        self.second += change
        scale = self.rate * math.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        np.sqrt(self.second, out=size)
        size += 1e-8
        np.multiply(self.first, scale, out=change)
        change /= size
        self.flat -= change


def log_probabilities(net: dict, units: list) -> np.ndarray:
    """Natural log-probability of every document's units, the state carried through each whole document."""
    lanes, total = Lanes(units, 2 * LANES), np.zeros(len(units))
    state = np.zeros((len(lanes.ends), HIDDEN), np.float32)
    for at, real in lanes.windows(WINDOW, 8192):
        out, _ = run_states(net, lanes.before[at], lanes.keep[at], state[: at.shape[1]])
        within = places_within(real)
        at = at.ravel()[within]
        found, _ = unit_log_probability(net, out.reshape(-1, HIDDEN)[within], lanes.target[at])
        total += np.bincount(lanes.doc[at], found, len(units))
        state = out[-1]
    return total


# ---- on Spark


def encode(docs: DataFrame, lexicon: Lexicon, log_all: float) -> DataFrame:
    """``docs`` (doc_id, training, fold, text) with ``units``, of 16 bits each, in place of the text.

    ``n_tokens`` counts all tokens, ``n_frequent`` those whose counts the tasks hold; ``rare`` are the others. Without what these add,
    ``base`` is the base score and ``within`` what the words' shares of their units add to the score. ``row`` tells repeated rows apart.
    """
    schema = pa.schema([
        ("row", pa.int64()), ("doc_id", pa.int64()), ("training", pa.bool_()), ("fold", pa.int32()), ("n_tokens", pa.int64()), ("n_frequent", pa.int64()), ("base", pa.float64()),
        ("within", pa.float64()), ("rare", pa.list_(pa.binary())), ("units", pa.binary()),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for part in together(batches, LOOKED_UP, lambda batch: batch.nbytes):
            words, n_tokens = split_words(part.column("text"))
            unit, log_count, share, rare = lexicon.look_up(words)
            ends = np.append(0, np.cumsum(n_tokens))
            before = np.append(0, np.cumsum(rare))[ends]  # rare words before each document
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(n_tokens))), *(part.column(c) for c in ("doc_id", "training", "fold")), pa.array(n_tokens), pa.array(n_tokens - np.diff(before)),
                    pa.array(np.add.reduceat(log_count, ends[:-1]) - n_tokens * log_all), pa.array(np.add.reduceat(share, ends[:-1])),
                    pa.ListArray.from_arrays(pa.array(before, pa.int32()), words.filter(pa.array(rare))),
                    pa.Array.from_buffers(pa.binary(), len(n_tokens), [None, pa.py_buffer((2 * ends).astype(np.int32)), pa.py_buffer(unit)]),
                ],
                schema=schema,
            )
            row += len(n_tokens)

    columns = "row bigint, doc_id bigint, training boolean, fold int, n_tokens bigint, n_frequent bigint, base double, within double, rare array<binary>, units binary"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "training", F.col("fold").cast("int").alias("fold"), "text").mapInArrow(run, columns)


def together(batches: Iterable[pa.RecordBatch], most: int, size: Callable[[pa.RecordBatch], int]) -> Iterator[pa.RecordBatch]:
    """Batches put together while their sizes do not exceed ``most``; none without rows."""
    held, total = [], 0
    for batch in batches:
        if held and total + size(batch) > most:
            yield pa.concat_batches(held)
            held, total = [], 0
        if batch.num_rows:
            held.append(batch)
            total += size(batch)
    if held:
        yield pa.concat_batches(held)


def units_of(column: pa.Array) -> list[np.ndarray]:
    """Units of each document."""
    _, offsets, values = column.buffers()
    borders = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1] // 2
    units = np.frombuffer(values, np.int16)
    return [units[a:b] for a, b in zip(borders, borders[1:], strict=False)]


def train(encoded: DataFrame, seed: int = SEED) -> np.ndarray:
    """Parameters after all rounds over ``encoded`` (fold, units), each of which is learned from once."""
    width = 64
    columns = [f"p{i}" for i in range(width)]
    flat, low = initial(seed), 0
    for share in ROUNDS:
        start = flat

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer, held, tokens = Trainer(start), [], 0
            for batch in batches:
                for units in units_of(batch.column(0)) if batch.num_rows else ():
                    held.append(units)
                    tokens += len(units)
                    if tokens >= STRETCH:
                        trainer.learn(held)
                        held, tokens = [], 0
            if held:
                trainer.learn(held)
            if trainer.tokens:
                padded = np.append(trainer.flat.astype(float), np.zeros(-_SIZE % width)).reshape(-1, width) * trainer.tokens
                n = len(padded)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(n), pa.int32()), pa.array([trainer.tokens] * n, pa.int64()), *[pa.array(padded[:, i]) for i in range(width)]], names=["part", "tokens", *columns]
                )

        own = encoded.where((F.col("fold") >= low) & (F.col("fold") < low + share)).select("units")
        copies = own.mapInArrow(run, "part int, tokens bigint, " + ", ".join(f"{c} double" for c in columns))
        mean = copies.groupBy("part").agg(*[(F.sum(c) / F.sum("tokens")).alias(c) for c in columns])
        rows = sorted(tuple(r) for r in mean.collect())  # as many as the network has parameters / 64
        if rows:
            flat = np.array([r[1:] for r in rows]).ravel()[:_SIZE].astype(np.float32)
        low += share
    return flat


def add_model(encoded: DataFrame, flat: np.ndarray) -> DataFrame:
    """``encoded`` with ``model``, the score without what rare words add, in place of the words and units."""
    kept = ["row", "doc_id", "training", "n_tokens", "n_frequent", "base"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = views(flat)
        for part in together(batches, SCORED, lambda batch: pc.sum(batch.column("n_tokens")).as_py() or 0):
            log10 = log_probabilities(net, units_of(part.column("units"))) / math.log(10)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(log10 + part.column("within").to_numpy())], names=[*kept, "model"])

    return encoded.select(*kept, "within", "units").mapInArrow(run, "row bigint, doc_id bigint, training boolean, n_tokens bigint, n_frequent bigint, base double, model double")


def score_documents(docs: DataFrame, training: Column) -> DataFrame:
    """Log-likelihoods of all ``docs`` (doc_id, text), learned from those where ``training`` holds.

    Gives ``doc_id``, ``training``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10).
    """
    fold = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", F.length("text")), F.lit(sum(ROUNDS)))
    docs = docs.select("doc_id", "text", F.coalesce(training, F.lit(True)).alias("training"), fold.alias("fold"))
    counts = store(count_words(docs.where("training")), "lm-counts")
    summary = counts.agg(F.sum("count"), F.count(F.lit(1))).first()
    total, distinct = summary[0] or 0, summary[1]
    frequent = frequent_words(counts)
    own = [bytes(w) for w, _ in frequent[: UNITS - SHARED]]
    # The end token and the words with units of their own are few; the others are summed by unit.
    unit = F.crc32(F.substring("word", -SUFFIX, SUFFIX)) % SHARED
    rest = counts.where(~F.col("word").isin(own)) if own else counts
    totals = {r.unit: (r.total, r.n) for r in rest.groupBy(unit.cast("int").alias("unit")).agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("n")).collect()}
    lexicon = Lexicon(frequent, totals)
    log_all = math.log10(total + 0.5 * (distinct + 1))
    encoded = store(encode(docs, lexicon, log_all), "lm-encoded")
    scored = store(add_model(encoded, train(encoded.where("training"))), "lm-scored")
    # What the words that tasks don't hold add to both scores.
    seen = encoded.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    of_row = seen.groupBy("row").agg(F.sum(F.log10(F.coalesce("count", F.lit(0)) + 0.5)).alias("log_count"), F.count("count").alias("n_rare_known"))
    log_count = F.coalesce("log_count", F.lit(0.0))
    return scored.join(of_row, "row", "left").select(
        "doc_id", "training", "n_tokens", (F.col("n_frequent") + F.coalesce("n_rare_known", F.lit(0))).alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + log_count).alias("base_score"), (F.col("model") + log_count).alias("score"),
    )


@query("op2_language_model")
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score_documents(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

"""Exact percentiles by narrowing brackets around their ranks.

A pass keeps a bounded sketch per wanted rank, which names two values of the column
close to either side of it. The next pass counts what lies below, at and between the two:
either the rank falls on one of them, or it lies strictly between, among a share of about
``4 / accuracy`` of the rows, and the search goes on there. Counts are exact, so a sketch
that is off costs a pass and never the result; a value held by a third of all rows leaves
the bracket as soon as it becomes one of its ends.

Nothing is shuffled but one row of counts and sketches a task, and no distinct values are
stored. Every pass reads the one column that was stored first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from depotline.session import store

#: Rows between the ends of a bracket up to which they are sorted in one array.
SMALL = 1 << 16
#: ``percentile_approx`` keeps ranks to within rows / ACCURACY.
ACCURACY = 10_000


@dataclass
class _Bracket:
    """The value at zero-based ``rank`` lies strictly between ``low`` and ``high`` (None: no end);
    ``below`` rows come before the inside, ``inside`` rows are in it."""

    rank: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None
    found: bool = False
    value: float | None = None

    def holds(self, value: Column) -> Column:
        after = F.lit(True) if self.low is None else value > F.lit(self.low)
        return after if self.high is None else after & (value < F.lit(self.high))

    def settle(self, value: float) -> None:
        self.found, self.value = True, value


def _sorted_inside(value: Column, bracket: _Bracket) -> Column:
    inside = F.sort_array(F.collect_list(F.when(bracket.holds(value), value)))
    return F.get(inside, F.lit(bracket.rank - bracket.below))


def _ends(value: Column, bracket: _Bracket, accuracy: int) -> Column:
    """Two values of the inside, to either side of the rank as far as the sketch can tell."""
    inside = F.when(bracket.holds(value), value)
    share, margin = (bracket.rank - bracket.below + 0.5) / bracket.inside, 2.0 / accuracy
    ends = F.percentile_approx(inside, [max(share - margin, 0.0), min(share + margin, 1.0)], accuracy)
    return F.struct(F.coalesce(F.get(ends, F.lit(0)), F.min(inside)).alias("low"), F.coalesce(F.get(ends, F.lit(1)), F.max(inside)).alias("high"))


def _counts(value: Column, bracket: _Bracket, low: float, high: float) -> Column:
    inside = bracket.holds(value)
    return F.struct(
        F.count_if(inside & (value < F.lit(low))).alias("before"),
        F.count_if(inside & (value == F.lit(low))).alias("at_low"),
        F.count_if(inside & (value > F.lit(low)) & (value < F.lit(high))).alias("between"),
        F.count_if(inside & (value == F.lit(high)) & (value != F.lit(low))).alias("at_high"),
    )


def _narrow(bracket: _Bracket, low: float, high: float, counts) -> None:
    """Move the bracket to the part that holds its rank."""
    offset = bracket.rank - bracket.below
    parts = [
        (counts.before, bracket.low, low, None),
        (counts.at_low, None, None, low),
        (counts.between, low, high, None),
        (counts.at_high, None, None, high),
        (bracket.inside - counts.before - counts.at_low - counts.between - counts.at_high, high, bracket.high, None),
    ]
    for size, start, end, value in parts:
        if offset < size:
            if value is not None:
                bracket.settle(value)
            else:
                bracket.low, bracket.high, bracket.inside = start, end, size
            return
        offset -= size
        bracket.below += size


def values_at_ranks(df: DataFrame, column: str, ranks: list[int], rows: int, small: int = SMALL, accuracy: int = ACCURACY) -> list[float]:
    """Values at zero-based ``ranks`` of the ``rows`` non-null values of ``column``.

    ``df`` is read once or twice per pass and should be a stored table. A pass leaves
    about 4 / ``accuracy`` of the rows in question, so three suffice for 10^12 rows.
    """
    value = F.col(column)
    brackets = {rank: _Bracket(rank, 0, rows) for rank in ranks}
    while open_ := [b for b in brackets.values() if not b.found]:
        few, many = [b for b in open_ if b.inside <= small], [b for b in open_ if b.inside > small]
        # A rank next to another in the same bracket goes by its ends: percentiles between two rows ask for both.
        leader = {b.rank: b for b in many}
        for b in sorted(many, key=lambda b: b.rank):
            before = leader.get(b.rank - 1)
            if before is not None and before.rank == b.rank - 1 and (before.low, before.high) == (b.low, b.high):
                leader[b.rank] = before
        sought = [b for b in many if leader[b.rank] is b]
        first = df.agg(*[_sorted_inside(value, b).alias(f"v{b.rank}") for b in few], *[_ends(value, b, accuracy).alias(f"e{b.rank}") for b in sought]).first()
        for b in few:
            b.settle(first[f"v{b.rank}"])
        if many:
            ends = {b.rank: (first[f"e{b.rank}"].low, first[f"e{b.rank}"].high) for b in sought}
            counted = df.agg(*[_counts(value, b, *ends[b.rank]).alias(f"c{b.rank}") for b in sought]).first()
            for b in many:
                shared = leader[b.rank].rank
                _narrow(b, *ends[shared], counted[f"c{shared}"])
    return [brackets[rank].value for rank in ranks]


def exact_percentiles(df: DataFrame, column: str, names: dict[str, float], small: int = SMALL, accuracy: int = ACCURACY) -> DataFrame:
    """One row of exact, linearly interpolated percentiles (output name -> share); null where there are no values.

    The built-in ``percentile`` keeps every distinct value in one task's memory; this
    returns the same number from bounded state. ``df`` is read once.
    """
    values = store(df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("value")), "percentile-values")
    rows = values.count()
    positions = {name: (rows - 1) * share for name, share in names.items()}
    found: dict[str, float | None] = dict.fromkeys(names)
    if rows:
        ranks = sorted({rank for p in positions.values() for rank in (int(p), min(int(p) + 1, rows - 1))})
        at = dict(zip(ranks, values_at_ranks(values, "value", ranks, rows, small, accuracy), strict=True))
        for name, position in positions.items():
            low, high = at[int(position)], at[min(int(position) + 1, rows - 1)]
            share = position - int(position)
            found[name] = low + (high - low) * share if share else low
    return df.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"`{name}` double" for name in found))

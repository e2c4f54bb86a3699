"""Arrow batches in, bounded Arrow batches out."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

OUT_BYTES = 8 << 20
OUT_ROWS = 20_000


def emit(rows: Iterable[tuple[tuple, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of ``rows``, each given with its rough size, cut before they grow large."""
    held, size = [], 0
    for row, weight in rows:
        held.append(row)
        size += weight
        if size >= OUT_BYTES or len(held) >= OUT_ROWS:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def records(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of the named columns, converted one at a time."""
    for batch in batches:
        picked = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in picked)

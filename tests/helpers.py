"""Helpers that several test modules import."""

from __future__ import annotations


def rows(df, *order):
    """Rows as tuples, in a fixed order."""
    frame = df.orderBy(*order) if order else df
    return [tuple(r) for r in frame.collect()]

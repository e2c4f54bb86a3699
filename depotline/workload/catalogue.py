"""Importing this module registers every workload query."""

from depotline.workload import aggregates, columns, domain, forecasting, joins, quality, scans_sinks, windows  # noqa: F401
from depotline.workload.registry import QUERIES

__all__ = ["QUERIES"]

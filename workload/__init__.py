"""Queries over the given tables, one or more per operator, with their SQL oracles."""

from workload import columns, loads, passthrough, quality, sinks, sources, timed, transforms  # noqa: F401
from workload.registry import oracles, queries

__all__ = ["oracles", "queries"]

"""Queries over the driver tables, each with the SQL that must give the same rows where SQL can say it."""

from tidemark.workload import audit, facts, gold, series, storage  # noqa: F401  (they register queries)
from tidemark.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

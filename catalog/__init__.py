"""The registered queries: every operator on the given tables, with its SQL twin."""

from catalog import files, plans, reads, sinks, streams  # noqa: F401
from catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

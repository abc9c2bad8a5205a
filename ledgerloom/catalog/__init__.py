"""Queries over the given tables."""

from ledgerloom.catalog import analysis, cleaning, files, grouping, jobs, mapping, quality  # noqa: F401
from ledgerloom.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]

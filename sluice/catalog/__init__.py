"""Queries over the driver tables, one or more per operator."""

from sluice.catalog import analysis, claims, documents, lines, loads  # noqa: F401
from sluice.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Queries over the driver tables, each next to independent SQL for the same result."""

from driver_queries.registry import ORACLES, QUERIES
from driver_queries import classify, language, sources, standardize, state, text, usage  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]

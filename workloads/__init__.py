"""Runnable queries on layers derived from the driver tables."""

from workloads import coordinates, requests, retrieval, selection  # noqa: F401
from workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

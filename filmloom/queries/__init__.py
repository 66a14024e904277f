"""Registered queries, by section."""

from filmloom.queries import increments, order, relations, requests, scans, search, shapes  # noqa: F401
from filmloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

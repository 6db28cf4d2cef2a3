"""Registered queries over the given tables and their SQL counterparts."""

from articleflow.plans import dates, incremental, pages, scans, stored, verdicts
from articleflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Imports every query module, which fills the registry."""

from . import (  # noqa: F401
    queries_aggregates,
    queries_gold,
    queries_io,
    queries_joins,
    queries_metrics,
    queries_narrative,
    queries_quality,
    queries_records,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

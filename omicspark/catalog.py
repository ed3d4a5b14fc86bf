"""All queries of the library: importing the modules registers them."""

from . import format_queries, further_queries, interval_queries, qc_queries, queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Feature plans and the registered queries."""

from . import group_queries, hotel_queries, model_queries, rank_queries, source_queries, time_queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "group_queries", "hotel_queries", "model_queries", "rank_queries", "source_queries", "time_queries"]

"""The registered queries, by subject, with their oracles."""

from demand_engine.catalog import cleaning, demand, exploration, models, scoring, series, streams, tables  # noqa: F401
from demand_engine.catalog.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

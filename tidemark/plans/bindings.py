"""All registered queries."""

from tidemark.plans import bind_aggregates, bind_monitor, bind_positions, bind_records, bind_streams  # noqa: F401
from tidemark.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

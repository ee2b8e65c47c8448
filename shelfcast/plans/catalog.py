"""All registered queries."""

from __future__ import annotations

from shelfcast.plans import (  # noqa: F401
    drift_queries,
    explore_queries,
    forecast_queries,
    model_queries,
    monitor_queries,
    prepare_queries,
    retrieval_queries,
    series_queries,
    source_queries,
)
from shelfcast.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]

"""All registered queries."""

from __future__ import annotations

from plumbline.plans import (  # noqa: F401
    function_queries,
    ingest_queries,
    metric_queries,
    model_queries,
    response_queries,
    sampling_queries,
)
from plumbline.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

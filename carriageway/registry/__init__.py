"""All registered queries and their check queries."""

from carriageway.registry import (  # noqa: F401
    datasets, report_queries, relational_queries, scalar_queries, geo_queries, quality_queries,
    table_queries, stream_queries, feed_queries, model_queries, job_queries,
)
from carriageway.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

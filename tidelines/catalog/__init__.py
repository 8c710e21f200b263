"""All named queries and their SQL counterparts."""

from tidelines.catalog import feature_queries, file_queries, job_queries, table_queries
from tidelines.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "feature_queries", "file_queries", "job_queries", "table_queries"]

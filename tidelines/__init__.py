"""Spark-native feature engineering, medallion ETL and quality checks for panel time series."""

from tidelines.panel import Panel
from tidelines.session import build_session, scratch_dir, staged

__all__ = ["Panel", "build_session", "scratch_dir", "staged"]

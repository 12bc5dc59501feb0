"""Registry of the gridded-rainfall queries and of the SQL with the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pluvio.plans import composites, forecasting, housekeeping, monitoring, outlines, spatial, verification
from pluvio.plans._registry import QUERIES, SQL

__all__ = ["composites", "flagship", "forecasting", "housekeeping", "monitoring", "oracle_sql", "outlines", "queries", "spatial", "verification"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ninety-day accumulation, anomaly, percentile score and drought class of every cell."""
    return monitoring.sta2_scores(spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

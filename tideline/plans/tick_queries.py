"""All queries of the tick library, and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.plans import aggregate_queries, discovery_queries, dispatch_queries, evidence_queries, filter_queries, interval_queries, join_queries, label_queries, proof_queries, response_queries, sample_queries, scalar_queries, source_queries, state_queries, window_queries  # noqa: F401
from tideline.plans.registry import QUERIES, SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands with their turns, or the reason why there is none."""
    return QUERIES["win_1_transitions"](spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

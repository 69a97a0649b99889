"""Registry of plans: key -> (builder(spark, sf_dir) -> DataFrame, oracle SQL).

Oracle SQL runs in DuckDB over the same parquet tables (one view per table).
A key without SQL is checked on row counts only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def plan(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in PLANS:
            raise ValueError(f"duplicate plan key {key}")
        PLANS[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their keys register."""
    from moodframe.plans import (  # noqa: F401
        catalogue_plans, evaluation_plans, feature_plans, field_plans, io_plans, label_plans, large_plans,
        scoring_plans, segment_plans, sequence_plans, stats_plans, stream_plans, text_plans,
    )

"""Registry of named queries: each has a Spark builder ``(spark, sf_dir) ->
DataFrame`` and, where SQL can express it, an oracle text for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def r6(c) -> Column:
    """Doubles leave the engine rounded to 6 places, so that two engines that sum
    in different orders still hash equal."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def load_all():
    from glossa.plans import (q_ensemble, q_io, q_labels, q_metrics, q_model,  # noqa: F401
                              q_prepare, q_relational, q_sampling, q_text, q_tokens, q_augment)
    return QUERIES, ORACLE

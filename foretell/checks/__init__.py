"""Registered queries and the SQL each is checked against.

A module per area registers (name, Spark query, SQL). The SQL is written from the
rules on the given tables, not generated from the Spark code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.plans.fixtures import Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the tables have them."""
    zoned = {c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"}
    return df.withColumns(zoned) if zoned else df


def check(name: str, sql: str | None = None):
    """Register ``build(fixtures) -> DataFrame`` as a query, with its SQL."""

    def register(build: Callable[[Fixtures], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain_times(build(Fixtures(spark, folder)))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def load() -> None:
    from foretell.checks import alerting, ingestion, joining, scoring, storing, streams, texts  # noqa: F401

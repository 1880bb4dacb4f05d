"""One row per key.

``row_number() = 1`` lets Spark cut every key to a single row per input
partition before the exchange (WindowGroupLimit), so a key that holds a third of
all rows still sends at most one row per task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK, _ALONE = "__rank", "__alone"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], *newest_first: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc() for c in newest_first])


def latest_with_ties(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """All rows that share their key's newest timestamp."""
    window = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    return df.withColumn(_RANK, F.rank().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def _in_order(arrival: str | Sequence[str]) -> list[Column]:
    return [F.col(c) for c in ([arrival] if isinstance(arrival, str) else arrival)]


def prefer_closed(polls: DataFrame, arrival: str | Sequence[str]) -> DataFrame:
    """First poll of a market, replaced by its first closed poll; null ids drop."""
    closed_first = F.coalesce(F.col("closed"), F.lit(False)).desc()
    known = polls.where(F.col("condition_id").isNotNull() & (F.col("condition_id") != ""))
    return first_per_key(known, ["condition_id"], [closed_first, *_in_order(arrival)])


def prefer_winner(correlations: DataFrame, arrival: str | Sequence[str]) -> DataFrame:
    """First record, replaced by the first decided one; rows without id all stay.

    A row without id gets a number of its own as key, so one pass ranks all rows.
    """
    has_id = F.coalesce(F.col("condition_id") != "", F.lit(False))
    decided_first = F.col("correlation_method").eqNullSafe(F.lit("winner_known")).desc()
    order = [decided_first, *_in_order(arrival)]
    numbered = correlations.withColumn(_ALONE, F.when(~has_id, F.monotonically_increasing_id()))
    return first_per_key(numbered, ["condition_id", _ALONE], order).drop(_ALONE)


def first_seen(records: DataFrame, arrival: str | Sequence[str]) -> DataFrame:
    known = records.where(F.col("condition_id").isNotNull() & (F.col("condition_id") != ""))
    return first_per_key(known, ["condition_id"], _in_order(arrival))

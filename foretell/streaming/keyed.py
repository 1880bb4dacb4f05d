"""Counts of a stream by key, and by key and window with a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LATENESS = "15 minutes"


def key_by(stream: DataFrame, key: str, absent: str = "unknown") -> DataFrame:
    """Rows for each key; a null key counts under ``absent``."""
    named = F.coalesce(F.col(key), F.lit(absent)).alias(key)
    return stream.groupBy(named).agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(
    stream: DataFrame, ts: str, keys: Sequence[str | Column], size: str = "1 hour", lateness: str = LATENESS
) -> DataFrame:
    """Rows for each key and window, given out once the watermark passes the window's end.

    Rows that come later than ``lateness`` behind the newest one, for a window closed by
    then, are dropped.
    """
    counted = stream.withWatermark(ts, lateness).groupBy(*keys, F.window(ts, size).alias("__w"))
    return counted.agg(F.count(F.lit(1)).alias("n")).withColumn("window_start", F.col("__w.start")).drop("__w")

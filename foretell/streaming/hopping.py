"""Sliding-window accuracy over a correlation stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from foretell.operators.accuracy import hopping

LATENESS = "15 minutes"


def stream_hopping(
    correlations: DataFrame, ts: str = "poll_ts", lateness: str = LATENESS
) -> DataFrame:
    """Append mode emits a window once the watermark passes its end; rows of windows
    already emitted are dropped."""
    return hopping(correlations.withWatermark(ts, lateness), ts)

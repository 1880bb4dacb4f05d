"""Event time, date keys and latencies. ``as_of`` is always a parameter."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value) -> Column:
    """A point in time given as Column, datetime or ISO text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp")


def parse_instant(col: Column) -> Column:
    """ISO-8601 text to timestamp; empty or unparsable text gives null.

    ``try_to_timestamp`` without a pattern reads ``Z`` and ``+00:00`` suffixes
    and up to microseconds.
    """
    return F.try_to_timestamp(col)


def ms_to_iso(col: Column) -> Column:
    shown = F.date_format(F.timestamp_millis(col), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(col != 0, shown)


def event_time(poll_text: Column, ingest_ts: Column, window_end_text: Column | None = None) -> Column:
    candidates = [parse_instant(poll_text)]
    if window_end_text is not None:
        candidates.append(parse_instant(window_end_text))
    return F.coalesce(*candidates, ingest_ts)


def date_key(end_date_text: Column, missing: str = "current") -> Column:
    head = F.substring(end_date_text, 1, 10)
    return F.when(F.length(end_date_text) > 0, head).otherwise(F.lit(missing))


def latency_signed(poll_ts: Column, correlated_ts: Column) -> Column:
    """Whole seconds, truncated toward zero, poll to correlation."""
    micros = F.unix_micros(correlated_ts) - F.unix_micros(poll_ts)
    return (micros / F.lit(1000000)).cast("bigint")


def latency_between_polls(prediction_ts: Column, weather_ts: Column) -> Column:
    return F.abs(latency_signed(prediction_ts, weather_ts))


def historical_eligible(date_text: Column, as_of) -> Column:
    """True for an ISO date strictly before the day of ``as_of``."""
    day = F.try_to_date(date_text, "yyyy-MM-dd")
    return F.coalesce(day < F.to_date(instant(as_of)), F.lit(False))


def within(col: Column, as_of, span: str, inclusive: bool = True) -> Column:
    """Does ``col`` fall in the last ``span`` before ``as_of``? A plain comparison of
    the column with a constant, so it reaches the scan."""
    start = instant(as_of) - F.expr(f"interval {span}")
    return col >= start if inclusive else col > start

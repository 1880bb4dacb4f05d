"""INSERT ... ON CONFLICT as joins, and as a fold over a change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.operators.toprow import first_per_key

# -- fixed values: which columns a conflict overwrites ---------------------------
CORRELATION_UPDATES = ("actual_outcome", "prediction_error", "correlation_method", "correlation_latency")
AGGREGATE_KEYS = ("location_name", "market_type", "window_start")
AGGREGATE_UPDATES = (
    "total_predictions", "correct_predictions", "accuracy_rate",
    "avg_prediction_error", "volume_weighted_accuracy", "bias_score", "updated_at",
)
ALERT_KEYS = ("alert_type", "location_name", "market_type")
ALERT_UPDATES = ("severity", "message", "metric_value", "detected_at")
CITY_KEYS = ("city_name",)
CITY_UPDATES = ("lat", "lon", "timezone", "updated_at")


def _known(df: DataFrame, keys: Sequence[str]) -> Column:
    """Rows all of whose keys are given; only they can conflict."""
    known = F.lit(True)
    for k in keys:
        known = known & df[k].isNotNull()
    return known


def insert_missing(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Conflict -> do nothing. Only the keys of ``existing`` take part in the join.

    Of incoming rows with one key the first in ``order`` is inserted (any one without it);
    rows with a null key never conflict and are all inserted.
    """
    fresh = incoming.where(_known(incoming, keys)).join(existing.select(*keys), list(keys), "left_anti")
    fresh = first_per_key(fresh, keys, [F.col(c) for c in order] or [F.lit(1)])
    loose = incoming.where(~_known(incoming, keys))
    return existing.unionByName(fresh.select(*existing.columns)).unionByName(loose.select(*existing.columns))


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    keyed: bool = False,
) -> DataFrame:
    """Conflict -> overwrite ``update_cols``, keep the rest. Keys unique on both sides.

    One full outer join: each side is exchanged once, and a side that is stored bucketed by
    the keys (``sources.bucketed``) is not. Rows with a null key never conflict; they pass the
    join by, so many of them are not one task's work. ``keyed``: no row has one.
    """
    loose = []
    if not keyed:
        loose = [df.where(~_known(df, keys)).select(*existing.columns) for df in (existing, incoming)]
        existing, incoming = (df.where(_known(df, keys)) for df in (existing, incoming))
    old = existing.select(*[F.col(c).alias(f"o_{c}") for c in existing.columns], F.lit(True).alias("o__"))
    new = incoming.select(*[F.col(c).alias(f"n_{c}") for c in existing.columns], F.lit(True).alias("n__"))
    on = [old[f"o_{k}"] == new[f"n_{k}"] for k in keys]
    joined = old.join(new, on, "full_outer")
    stored, given = F.col("o__").isNotNull(), F.col("n__").isNotNull()
    out = []
    for c in existing.columns:
        if c in update_cols:
            out.append(F.when(given, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c))
        else:
            out.append(F.when(stored, F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c))
    merged = joined.select(*out)
    for rows in loose:
        merged = merged.unionByName(rows)
    return merged


def fold_changes(
    log: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    seq: str,
) -> DataFrame:
    """State after applying a log of upserts in ``seq`` order.

    Kept columns come from a key's first record, updated ones from its last; both
    are partial aggregates, so appending to a log replaces rewriting the table.
    """
    kept = [c for c in log.columns if c not in (*keys, *update_cols, seq)]
    sides = [F.max_by(F.struct(*update_cols), F.col(seq)).alias("__new")]
    if kept:
        sides.append(F.min_by(F.struct(*kept), F.col(seq)).alias("__old"))
    folded = log.groupBy(*keys).agg(*sides)
    columns = [c for c in log.columns if c != seq]
    picked = [
        F.col(c)
        if c in keys
        else F.col(f"__new.{c}").alias(c)
        if c in update_cols
        else F.col(f"__old.{c}").alias(c)
        for c in columns
    ]
    return folded.select(*picked)

"""Accuracy metrics: one grouped pass of conditional sums.

Every aggregate is a count, a bigint sum, a decimal sum or a min/max, so Spark
combines map-side and a hot group ships one buffer row per task. Ratios divide
exact totals once.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.functions.numeric import FINE, exact_volume, finite, round_to, sum_units, summed, to_units
from foretell.functions.outcomes import SNAPSHOT, hit
from foretell.functions.times import instant

GROUP = ("location_name", "market_type")
# totals that do not merge by addition
_MERGE = {"min_error": F.min, "max_error": F.max}


def group_keys() -> list[Column]:
    return [
        F.coalesce(F.col("location_name"), F.lit("unknown")).alias("location_name"),
        F.coalesce(F.col("market_type"), F.lit("WEATHER")).alias("market_type"),
    ]


def drop_snapshot(correlations: DataFrame) -> DataFrame:
    return correlations.where(~F.col("correlation_method").eqNullSafe(F.lit(SNAPSHOT)))


def _sum_if(condition: Column, value) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def _ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole.cast("double")


def batch_totals() -> list[Column]:
    price, outcome = F.col("price"), F.col("actual_outcome")
    reliable = ~F.col("correlation_method").eqNullSafe(F.lit(SNAPSHOT))
    error = F.col("prediction_error")
    volume = exact_volume(F.coalesce(F.col("volume"), F.lit(1.0)))
    correct = hit(price, outcome)
    shown = F.coalesce(price, F.lit(0.0))
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(reliable).alias("n_reliable"),
        F.count_if(reliable & correct).alias("n_correct"),
        F.count(error).alias("n_error"),
        *sum_units(to_units(error, FINE, signed=False), "error_units"),
        F.min(error).alias("min_error"),
        F.max(error).alias("max_error"),
        F.sum(volume).alias("volume"),
        _sum_if(correct, volume).alias("hit_volume"),
        F.count(outcome).alias("n_outcome"),
        *sum_units(to_units(F.when(outcome.isNotNull(), F.coalesce(price, F.lit(0.5))), FINE, signed=False), "price_units"),
        F.coalesce(F.sum(outcome.cast("bigint")), F.lit(0)).alias("outcome_sum"),
        F.count_if((shown > 0.5) & (outcome == 0)).alias("n_over"),
        F.count_if((shown <= 0.5) & (outcome == 1)).alias("n_under"),
    ]


def batch_metrics(totals: DataFrame, keep: Sequence[str]) -> DataFrame:
    c = F.col
    denominator = F.when(c("n_reliable") > 0, c("n_reliable")).otherwise(c("n"))
    accuracy = _ratio(c("n_correct"), denominator)
    avg_error = _ratio(summed("error_units"), c("n_error")) / F.lit(float(10**FINE))
    weighted = F.when(
        c("volume") > 0, c("hit_volume").cast("double") / c("volume").cast("double")
    ).otherwise(accuracy)
    bias = summed("price_units") / F.lit(float(10**FINE)) / c("n_outcome") - _ratio(c("outcome_sum"), c("n_outcome"))
    return totals.select(
        *keep,
        c("n").alias("total_predictions"),
        c("n_correct").alias("correct_predictions"),
        round_to(accuracy, 4, signed=False).alias("accuracy_rate"),
        F.when(c("n_error") > 0, round_to(avg_error, 4, signed=False)).otherwise(0.0).alias("avg_prediction_error"),
        F.coalesce(round_to(c("min_error"), 4, signed=False), F.lit(0.0)).alias("min_prediction_error"),
        F.coalesce(round_to(c("max_error"), 4, signed=False), F.lit(0.0)).alias("max_prediction_error"),
        round_to(c("volume").cast("double"), 2).alias("total_volume"),
        round_to(weighted, 4, signed=False).alias("volume_weighted_accuracy"),
        F.when(c("n_outcome") > 0, round_to(bias, 4)).otherwise(0.0).alias("bias_score"),
        c("n_over").alias("over_prediction_count"),
        c("n_under").alias("under_prediction_count"),
    )


def stream_totals() -> list[Column]:
    """Only decided non-snapshot rows count, apart from the overall total."""
    price = F.col("price")
    outcome = F.col("actual_outcome")
    reliable = ~F.col("correlation_method").eqNullSafe(F.lit(SNAPSHOT))
    counted = reliable & outcome.isNotNull() & price.isNotNull()
    # a volume of null or zero weighs 1
    volume = exact_volume(F.coalesce(F.nullif(F.col("volume"), F.lit(0.0)), F.lit(1.0)))
    correct = counted & hit(price, outcome)
    error = F.when(reliable, F.col("prediction_error"))
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(counted).alias("n_counted"),
        F.count_if(correct).alias("n_correct"),
        F.count(error).alias("n_error"),
        *sum_units(to_units(error, FINE, signed=False), "error_units"),
        _sum_if(counted, volume).alias("volume"),
        _sum_if(correct, volume).alias("hit_volume"),
        *sum_units(to_units(F.when(counted, price), FINE, signed=False), "price_units"),
        _sum_if(counted, outcome.cast("bigint")).alias("outcome_sum"),
        F.count_if(counted & (price > 0.5) & (outcome == 0)).alias("n_over"),
        F.count_if(counted & (price <= 0.5) & (outcome == 1)).alias("n_under"),
    ]


def stream_metrics(totals: DataFrame, keep: Sequence) -> DataFrame:
    c = F.col
    counted = F.greatest(c("n_counted"), F.lit(1))
    accuracy = _ratio(c("n_correct"), counted)
    bias = summed("price_units") / F.lit(float(10**FINE)) / counted - _ratio(c("outcome_sum"), counted)
    weighted = F.when(
        c("volume") > 0, c("hit_volume").cast("double") / c("volume").cast("double")
    ).otherwise(accuracy)
    avg_error = _ratio(summed("error_units"), c("n_error")) / F.lit(float(10**FINE))
    return totals.select(
        *keep,
        c("n").alias("total_predictions"),
        c("n_correct").alias("correct_predictions"),
        round_to(accuracy, 4, signed=False).alias("accuracy_rate"),
        F.when(c("n_error") > 0, round_to(avg_error, 4, signed=False)).otherwise(0.0).alias("avg_prediction_error"),
        round_to(weighted, 4, signed=False).alias("volume_weighted_accuracy"),
        F.when(c("n_counted") > 0, round_to(bias, 4)).otherwise(0.0).alias("bias_score"),
        c("n_over").alias("over_prediction_count"),
        c("n_under").alias("under_prediction_count"),
    )


def _measured() -> list[Column]:
    """Numbers that are summed; one that is not finite counts as absent."""
    return [finite(F.col(c)).alias(c) for c in ("price", "prediction_error", "volume")]


def accuracy(correlations: DataFrame, variant: str = "batch", extra_keys: Sequence[Column] = ()) -> DataFrame:
    """Metrics per place and market type; ``extra_keys`` are aliased columns."""
    totals, metrics = {
        "batch": (batch_totals, batch_metrics),
        "stream": (stream_totals, stream_metrics),
    }[variant]
    frame = correlations.select(
        *group_keys(),
        *extra_keys,
        "actual_outcome",
        "correlation_method",
        *_measured(),
    )
    value_columns = {"price", "actual_outcome", "prediction_error", "correlation_method", "volume"}
    keys = [name for name in frame.columns if name not in value_columns]
    return metrics(frame.groupBy(*keys).agg(*totals()), keys)


def hopping(
    correlations: DataFrame,
    ts: str = "poll_ts",
    window: str = "1 hour",
    slide: str = "15 minutes",
    variant: str = "stream",
) -> DataFrame:
    """Sliding-window metrics of a batch or stream.

    In a batch, rows are first summed per slide-long pane and only the panes enter
    the overlapping windows, so no row is copied once per window. A stream updates
    its windows directly.
    """
    totals, metrics = {
        "batch": (batch_totals, batch_metrics),
        "stream": (stream_totals, stream_metrics),
    }[variant]
    keys = group_keys()
    correlations = correlations.select(ts, *GROUP, "actual_outcome", "correlation_method", *_measured())
    whole_panes = pd.Timedelta(window) % pd.Timedelta(slide) == pd.Timedelta(0)
    if correlations.isStreaming or not whole_panes:
        grouped = correlations.groupBy(F.window(ts, window, slide).alias("w"), *keys).agg(*totals())
    else:
        panes = correlations.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(*totals())
        merged = [
            _MERGE.get(c, F.sum)(c).alias(c) for c in panes.columns if c not in ("pane", *GROUP)
        ]
        grouped = (
            panes.withColumn("at", F.col("pane.start"))
            .groupBy(F.window("at", window, slide).alias("w"), *GROUP)
            .agg(*merged)
        )
    bounds = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    return metrics(grouped, [*GROUP, *bounds])


def label_window(aggregates: DataFrame, as_of, hours: int = 1) -> DataFrame:
    """The batch job's window is a label around ``as_of``, not a filter."""
    end = instant(as_of)
    return aggregates.withColumn("window_start", end - F.expr(f"interval {hours} hours")).withColumn(
        "window_end", end
    )


def window_metadata(windowed: DataFrame, as_of) -> DataFrame:
    """Window bounds and processing time as ISO text, as a topic record carries them."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    return windowed.withColumns(
        {
            "window_start": F.date_format("window_start", iso),
            "window_end": F.date_format("window_end", iso),
            "poll_timestamp": F.date_format(instant(as_of), iso),
        }
    )

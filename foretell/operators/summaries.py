"""Run reports and counters. Each is one grouped or global partial aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell import constants as C
from foretell.functions.numeric import round_to, to_units


def beside(*one_row: DataFrame) -> DataFrame:
    """One-row frames with distinct columns as one row: a union folded by max."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def method_breakdown(correlations: DataFrame) -> DataFrame:
    mean = F.sum(to_units(F.col("prediction_error"), 4)) / F.count("prediction_error") / F.lit(1e4)
    return correlations.groupBy("correlation_method").agg(
        F.count(F.lit(1)).alias("n"), round_to(mean, 4).alias("avg_error")
    )


def poll_summary(records: DataFrame, n_fetched: DataFrame, n_cross: DataFrame) -> DataFrame:
    """One row per poll. ``n_fetched``/``n_cross`` are one-row frames (``fetched``,
    ``cross_arbitrage``); the per-type counts nest into one sorted list. Records shrink to
    one row per type and city before anything is listed."""
    by_pair = records.groupBy("market_type", "location_name").agg(
        F.count(F.lit(1)).alias("sent"),
        F.count_if(F.col("market_status") == "closed").alias("closed"),
        F.count_if(F.col("is_arbitrage")).alias("arbitrage"),
    )
    by_type = by_pair.groupBy("market_type").agg(*[F.sum(c).alias(c) for c in ("sent", "closed", "arbitrage")])
    named = by_pair.where(F.col("location_name").isNotNull()).select("location_name").distinct()
    listed = named.agg(F.array_sort(F.collect_list("location_name")).alias("cities"))
    one = by_type.agg(
        F.coalesce(F.sum("sent"), F.lit(0)).alias("sent"),
        F.coalesce(F.sum("closed"), F.lit(0)).alias("closed_markets"),
        F.coalesce(F.sum("arbitrage"), F.lit(0)).alias("arbitrage"),
        F.array_sort(
            F.collect_list(F.concat_ws("=", "market_type", F.col("sent").cast("string")))
        ).alias("by_type"),
    )
    return (
        beside(one, listed, n_fetched, n_cross)
        .select(
            "sent",
            (F.col("fetched") - F.col("sent")).alias("skipped"),
            "closed_markets",
            (F.col("sent") - F.col("closed_markets")).alias("open_markets"),
            "arbitrage",
            "cross_arbitrage",
            F.size("cities").alias("n_cities"),
            F.concat_ws(",", "cities").alias("cities"),
            F.concat_ws(",", "by_type").alias("by_type"),
        )
    )


def weather_poll_summary(polls: DataFrame) -> DataFrame:
    """``status``: sent, skipped or failed; ``weather_type`` of what was sent."""
    sent = F.col("status") == "sent"
    return polls.agg(
        F.count_if(sent).alias("sent"),
        F.count_if(sent & (F.col("weather_type") == "historical")).alias("historical"),
        F.count_if(sent & (F.col("weather_type") == "current")).alias("current"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def gazetteer_stats(questions: DataFrame, cities: DataFrame) -> DataFrame:
    asked = questions.agg(F.count_distinct("question_key").alias("total_questions"))
    counted = cities.agg(
        F.count(F.lit(1)).alias("total_cities"),
        F.count_if(F.col("verified")).alias("verified_cities"),
        F.count_if(~F.coalesce("verified", F.lit(False))).alias("invalid_cities"),
    )
    return beside(asked, counted)


def labelled_counters(df: DataFrame, metric: str, labels: Sequence[str]) -> DataFrame:
    label = F.concat_ws(",", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c), F.lit("unknown"))) for c in labels])
    return df.groupBy(F.lit(metric).alias("metric"), label.alias("labels")).agg(
        F.count(F.lit(1)).alias("value")
    )


def observe_counters(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, object]:
    """Counters collected while ``df`` runs for another purpose (no second pass)."""
    from pyspark.sql import Observation

    watch = Observation(name)
    counts = [F.count_if(cond).alias(label) for label, cond in conditions.items()]
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *counts), watch


def latency_histogram(correlations: DataFrame, column: str = "correlation_latency") -> DataFrame:
    """Cumulative buckets with sum and count: one pass, then eight rows."""
    value = F.col(column)
    bounds = [(str(b), value <= b) for b in C.LATENCY_BUCKETS] + [("+Inf", value.isNotNull())]
    counts = correlations.agg(
        *[F.count_if(cond).alias(f"b{i}") for i, (_, cond) in enumerate(bounds)],
        F.coalesce(F.sum(value), F.lit(0)).alias("sum_sec"),
        F.count(value).alias("n"),
    )
    rows = F.array(
        *[F.struct(F.lit(le).alias("le"), F.col(f"b{i}").alias("cumulative")) for i, (le, _) in enumerate(bounds)]
    )
    return counts.select(F.inline(rows), "sum_sec", "n")


def prediction_span(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count(F.lit(1)).alias("n"), F.min("poll_ts").alias("first_poll"), F.max("poll_ts").alias("last_poll")
    )


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("resolved_at").isNull()).groupBy("alert_type", "severity").agg(
        F.count(F.lit(1)).alias("n")
    )


def top_recent_aggregates(aggregates: DataFrame, limit: int = 10) -> DataFrame:
    order = [F.col("updated_at").desc(), F.col("location_name"), F.col("market_type"), F.col("window_start")]
    return aggregates.orderBy(*order).limit(limit).select(
        "location_name", "market_type", "accuracy_rate", "bias_score"
    )


def sample_rows(rows: DataFrame, order: Sequence[str], limit: int = 5) -> DataFrame:
    """The first few rows, for a look at them."""
    return rows.orderBy(*order).limit(limit)


def run_report(correlations: DataFrame, predictions: DataFrame) -> DataFrame:
    """Coverage of one run: correlated out of all deduplicated predictions."""
    total = predictions.agg(F.count(F.lit(1)).alias("total"))
    done = correlations.agg(F.count(F.lit(1)).alias("correlated"))
    ratio = F.when(F.col("total") > 0, F.col("correlated") / F.col("total"))
    return beside(total, done).select("total", "correlated", round_to(ratio, 4).alias("coverage"))

"""Alert rules. Each returns rows of the alert schema (missing columns are null
after ``union_alerts``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell import constants as C
from foretell.functions.numeric import FINE, finite, fixed, from_units, percent, round_to, signed_fixed, sum_units, summed, to_units
from foretell.functions.text import base_rate
from foretell.functions.times import instant
from foretell.operators.baseline import newest_judged
from foretell.operators.toprow import first_per_key, first_seen, latest_per_key
from foretell.schemas import ALERT

BATCH_CRITICAL_RATIO = 0.6
STREAM_CRITICAL_RATIO = 0.7


def _subject() -> Column:
    return F.concat_ws(" ", F.col("location_name"), F.col("market_type"))


def _baseline_note(statistical: Column, static: Column) -> Column:
    note = F.when(F.col("baseline_source") == "7day_statistical", statistical).otherwise(static)
    return F.concat(F.lit(" [baseline="), note, F.lit("]"))


def _accuracy_message(style: str) -> Column:
    accuracy, threshold = F.col("accuracy_rate"), F.col("accuracy_threshold")
    if style == "stream":
        source = F.when(F.col("baseline_source") == "7day_statistical", "statistical").otherwise("static")
        return F.concat(
            F.lit("Accuracy drop ["), source, F.lit("]: "), _subject(),
            F.lit(" accuracy="), percent(accuracy, 1), F.lit(" < threshold="), percent(threshold, 1),
        )
    statistical = F.concat(
        F.lit("mean-2σ("), percent(F.col("acc_mean"), 1), F.lit("±"), percent(F.col("acc_std"), 1),
        F.lit(", n="), F.col("baseline_n"), F.lit(")"),
    )
    static = F.concat(F.lit("static("), percent(threshold, 0), F.lit(")"))
    return F.concat(
        F.lit("Accuracy drop: "), _subject(), F.lit(" "), percent(accuracy, 1),
        F.lit(" < threshold "), percent(threshold, 1), _baseline_note(statistical, static),
    )


def _bias_message(style: str) -> Column:
    bias, threshold = F.col("bias_score"), F.col("bias_threshold")
    direction = F.when(bias > 0, "over-predicting").otherwise("under-predicting")
    if style == "stream":
        source = F.when(F.col("baseline_source") == "7day_statistical", "statistical").otherwise("static")
        return F.concat(
            F.lit("Bias ["), source, F.lit("]: "), _subject(), F.lit(" "), direction,
            F.lit(" bias="), signed_fixed(bias, 3), F.lit(" threshold=±"), fixed(threshold, 3),
        )
    statistical = F.concat(
        F.lit("mean+2σ("), fixed(F.col("bias_mean"), 3), F.lit("±"), fixed(F.col("bias_std"), 3),
        F.lit(", n="), F.col("baseline_n"), F.lit(")"),
    )
    static = F.concat(F.lit("static("), fixed(threshold, 2), F.lit(")"))
    return F.concat(
        F.lit("Bias: "), _subject(), F.lit(" "), direction, F.lit(" bias="), signed_fixed(bias, 3),
        F.lit(" > threshold "), fixed(threshold, 3), _baseline_note(statistical, static),
    )


def _shown(threshold: Column, style: str) -> Column:
    """Batch alerts carry a rounded threshold, alerts of a stream the one they were judged by."""
    return threshold if style == "stream" else round_to(threshold, 4)


def _accuracy_rule(at: Column, critical_ratio: float, style: str, min_total: int) -> tuple[Column, list[Column]]:
    accuracy, threshold = F.col("accuracy_rate"), F.col("accuracy_threshold")
    critical = accuracy < threshold * F.lit(critical_ratio)
    return (F.col("total_predictions") >= min_total) & (accuracy < threshold), [
        F.lit("accuracy_drop").alias("alert_type"),
        F.when(critical, "critical").otherwise("high").alias("severity"),
        F.col("location_name"),
        F.col("market_type"),
        _accuracy_message(style).alias("message"),
        accuracy.alias("metric_value"),
        _shown(threshold, style).alias("threshold_value"),
        round_to(threshold - accuracy, 4).alias("deviation"),
        at.alias("detected_at"),
    ]


def _bias_rule(at: Column, style: str, min_total: int) -> tuple[Column, list[Column]]:
    bias, threshold = F.col("bias_score"), F.col("bias_threshold")
    size = F.abs(bias)
    return (F.col("total_predictions") >= min_total) & (size > threshold), [
        F.lit("bias_detected").alias("alert_type"),
        F.when(size > threshold * F.lit(1.5), "high").otherwise("medium").alias("severity"),
        F.col("location_name"),
        F.col("market_type"),
        _bias_message(style).alias("message"),
        bias.alias("metric_value"),
        _shown(threshold, style).alias("threshold_value"),
        round_to(size - threshold, 4).alias("deviation"),
        at.alias("detected_at"),
    ]


def accuracy_drop(
    judged: DataFrame,
    as_of,
    critical_ratio: float = BATCH_CRITICAL_RATIO,
    style: str = "batch",
    min_total: int = C.MIN_PREDICTIONS,
) -> DataFrame:
    """``judged``: aggregates with thresholds from ``baselines``."""
    fired, columns = _accuracy_rule(instant(as_of), critical_ratio, style, min_total)
    return judged.where(fired).select(*columns)


def bias_detected(
    judged: DataFrame, as_of, style: str = "batch", min_total: int = C.MIN_PREDICTIONS
) -> DataFrame:
    fired, columns = _bias_rule(instant(as_of), style, min_total)
    return judged.where(fired).select(*columns)


def aggregate_alerts(
    judged: DataFrame,
    at,
    critical_ratio: float = BATCH_CRITICAL_RATIO,
    style: str = "batch",
    min_total: int = C.MIN_PREDICTIONS,
) -> DataFrame:
    """Both rules in one pass over ``judged``: a row yields zero, one or two alerts."""
    at = instant(at)
    rules = [_accuracy_rule(at, critical_ratio, style, min_total), _bias_rule(at, style, min_total)]
    found = F.array(*[F.when(fired, F.struct(*columns)) for fired, columns in rules])
    return judged.select(F.inline(F.filter(found, lambda a: a.isNotNull())))


# -- mispricing and cross-market arbitrage -------------------------------------


def mispricing(price: Column, market_type: Column, resolved: Column) -> tuple[Column, Column, Column]:
    """(base rate, deviation rounded to 4, flag on the unrounded deviation)."""
    base = base_rate(market_type)
    deviation = F.abs(price - base)
    flag = (deviation > C.MISPRICING_DEVIATION) & ~F.coalesce(resolved, F.lit(False))
    return base, round_to(deviation, 4, signed=False), F.coalesce(flag, F.lit(False))


def mispricing_open(records: DataFrame, as_of) -> DataFrame:
    price = F.coalesce(F.col("price"), F.lit(0.5))
    mtype = F.coalesce(F.col("market_type"), F.lit("WEATHER"))
    base = base_rate(mtype)
    deviation = F.abs(price - base)
    margin = round_to(deviation * 100, 2)
    is_open = ~F.coalesce(F.col("closed"), F.lit(False))
    return records.where(is_open & (deviation > C.MISPRICING_DEVIATION)).select(
        F.lit("arbitrage_opportunity").alias("alert_type"),
        F.when(deviation > C.MISPRICING_CRITICAL, "critical").otherwise("high").alias("severity"),
        "location_name",
        mtype.alias("market_type"),
        F.coalesce(F.col("end_date").cast("string"), F.lit("")).alias("date"),
        F.concat(
            F.lit("Mispricing: "), F.col("location_name"), F.lit(" "), mtype,
            F.lit(" price="), fixed(price, 3), F.lit(" base_rate="), fixed(base, 3),
            F.lit(" deviation="), fixed(margin, 2), F.lit("%"),
        ).alias("message"),
        price.alias("metric_value"),
        margin.alias("arbitrage_margin"),
        F.lit(1).cast("bigint").alias("markets"),
        instant(as_of).alias("detected_at"),
    )


def mispricing_flagged(records: DataFrame, as_of, arrival="arrival") -> DataFrame:
    """First record per market decides; only then is its flag tested."""
    base = F.coalesce(F.col("base_rate"), F.lit(C.DEFAULT_BASE_RATE))
    deviation = F.coalesce(F.col("deviation_from_base"), F.lit(0.0))
    price = F.coalesce(F.col("price"), F.lit(0.5))
    location = F.coalesce(F.col("location_name"), F.lit("unknown"))
    mtype = F.coalesce(F.col("market_type"), F.lit("WEATHER"))
    margin = round_to(deviation * 100, 2)
    flagged = first_seen(records, arrival).where(F.coalesce(F.col("is_arbitrage"), F.lit(False)))
    return flagged.select(
        F.lit("arbitrage_opportunity").alias("alert_type"),
        F.when(deviation > C.MISPRICING_CRITICAL, "critical").otherwise("high").alias("severity"),
        location.alias("location_name"),
        mtype.alias("market_type"),
        F.concat(
            F.lit("Mispricing arbitrage: "), location, F.lit(" "), mtype,
            F.lit(" price="), fixed(price, 3), F.lit(" base="), fixed(base, 3),
            F.lit(" deviation="), fixed(margin, 2), F.lit("%"),
        ).alias("message"),
        price.alias("metric_value"),
        base.alias("threshold_value"),
        round_to(deviation, 4).alias("deviation"),
        price.alias("price_sum"),
        margin.alias("arbitrage_margin"),
        instant(as_of).alias("detected_at"),
    )


def cross_market_sum(records: DataFrame) -> DataFrame:
    """Open markets of one place, type and day whose YES prices sum above 1.01."""
    opened = records.where(~F.coalesce(F.col("closed"), F.lit(False)))
    groups = opened.groupBy(
        "location_name",
        "market_type",
        F.coalesce(F.col("end_date").cast("string"), F.lit("")).alias("date"),
    ).agg(
        F.count(F.lit(1)).alias("markets"),
        *sum_units(to_units(F.coalesce(finite(F.col("price")), F.lit(0.0)), FINE, signed=False), "units"),
    )
    # exact in fine units, so a sum of exactly 1.01 does not fire; rounded only for show
    limit = 10**FINE + round(C.CROSS_MARKET_EXCESS * 10**FINE)
    return groups.where((F.col("markets") >= 2) & (summed("units", "decimal(38,0)") > limit)).select(
        "location_name", "market_type", "date", "markets", round_to(from_units(summed("units"), FINE), 4).alias("price_sum")
    )


def cross_market(records: DataFrame, as_of) -> DataFrame:
    total = F.col("price_sum")
    margin = round_to((total - 1.0) * 100, 2)
    return cross_market_sum(records).select(
        F.lit("arbitrage_opportunity").alias("alert_type"),
        F.when(margin > C.CROSS_MARKET_CRITICAL_MARGIN, "critical").otherwise("high").alias("severity"),
        "location_name",
        "market_type",
        "date",
        F.concat(
            F.lit("Cross-market arbitrage: "), _subject(), F.lit(" "), F.col("date"),
            F.lit(" price_sum="), fixed(total, 3), F.lit(" margin="), fixed(margin, 2), F.lit("%"),
        ).alias("message"),
        total.alias("metric_value"),
        margin.alias("arbitrage_margin"),
        "markets",
        instant(as_of).alias("detected_at"),
    )


# -- feed health and coverage ----------------------------------------------------


def latest_health(health: DataFrame) -> DataFrame:
    ties = [F.xxhash64(*sorted(health.columns))]
    return first_per_key(health, ["component"], [F.col("recorded_at").desc(), *ties])


def never_reported(expected: DataFrame, health: DataFrame) -> DataFrame:
    """Expected components (column ``component``) absent from the health table."""
    return expected.join(health.select("component").distinct(), "component", "left_anti")


def producer_timeout(health: DataFrame, expected: DataFrame, as_of) -> DataFrame:
    now = instant(as_of)
    silent = (F.unix_micros(now) - F.unix_micros(F.col("recorded_at"))) / F.lit(60_000_000.0)
    limit = float(C.SILENCE_MINUTES)
    seen = latest_health(health)
    stale = seen.where(F.col("recorded_at") < now - F.expr(f"interval {C.SILENCE_MINUTES} minutes"))
    common = [
        F.lit("producer_timeout").alias("alert_type"),
        F.col("component").alias("location_name"),
        F.lit("SYSTEM").alias("market_type"),
        F.lit(limit).alias("threshold_value"),
        now.alias("detected_at"),
    ]
    timeouts = stale.select(
        *common,
        F.when(silent > C.SILENCE_CRITICAL_MINUTES, "critical").otherwise("high").alias("severity"),
        F.concat(
            F.lit("Producer silent: "), F.col("component"), F.lit(" has not reported for "),
            fixed(silent, 1), F.lit(f" min (threshold: {C.SILENCE_MINUTES} min). Last seen: "),
            F.date_format("recorded_at", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC | status="),
            F.col("status"), F.lit(" msgs="), F.col("messages_processed"), F.lit(" errors="),
            F.col("error_count"),
        ).alias("message"),
        round_to(silent, 1).alias("metric_value"),
        round_to(silent - limit, 1).alias("deviation"),
    )
    absent = never_reported(expected, seen).select(
        *common,
        F.lit("critical").alias("severity"),
        F.concat(
            F.lit("Producer never reported: "), F.col("component"),
            F.lit(" has no records in pipeline_health"),
        ).alias("message"),
        F.lit(None).cast("double").alias("metric_value"),
        F.lit(None).cast("double").alias("deviation"),
    )
    return timeouts.unionByName(absent)


def join_coverage(correlations: DataFrame) -> DataFrame:
    sums = correlations.agg(
        F.count(F.lit(1)).alias("total"), F.count("actual_outcome").alias("matched")
    )
    coverage = F.col("matched").cast("double") / F.col("total").cast("double")
    return sums.select(
        "total",
        "matched",
        F.when(F.col("total") > 0, coverage).alias("coverage"),
        F.when(F.col("total") > 0, round_to(coverage * 100, 2)).alias("coverage_pct"),
    )


def low_coverage(correlations: DataFrame, as_of, target: float = C.COVERAGE_TARGET) -> DataFrame:
    coverage = F.col("coverage")
    return join_coverage(correlations).where(coverage < target).select(
        F.lit("low_coverage").alias("alert_type"),
        F.when(coverage < C.COVERAGE_CRITICAL, "critical").otherwise("high").alias("severity"),
        F.lit("pipeline").alias("location_name"),
        F.lit("ALL").alias("market_type"),
        F.concat(
            F.lit("Join coverage "), percent(coverage, 1), F.lit(f" below threshold {target * 100:.0f}%: "),
            F.col("matched"), F.lit("/"), F.col("total"),
            F.lit(" predictions matched with weather actuals"),
        ).alias("message"),
        round_to(coverage, 4).alias("metric_value"),
        F.lit(target).alias("threshold_value"),
        round_to(F.lit(target) - coverage, 4).alias("deviation"),
        instant(as_of).alias("detected_at"),
    )


def recently_reported(health: DataFrame, as_of) -> DataFrame:
    """Components whose newest health row is less than ten minutes old."""
    fresh = F.col("recorded_at") > instant(as_of) - F.expr(f"interval {C.SILENCE_MINUTES} minutes")
    return health.where(fresh).select("component").distinct()


def health_semi_join(alerts: DataFrame, health: DataFrame, as_of) -> DataFrame:
    fresh = recently_reported(health, as_of)
    return alerts.join(fresh, alerts["location_name"] == fresh["component"], "left_semi")


def auto_resolve(alerts: DataFrame, health: DataFrame, as_of) -> DataFrame:
    """Close open timeout alerts of components that report again."""
    fresh = recently_reported(health, as_of).withColumn("__fresh", F.lit(True))
    joined = alerts.join(fresh, alerts["location_name"] == fresh["component"], "left")
    closing = (
        (F.col("alert_type") == "producer_timeout")
        & ~F.col("is_resolved")
        & F.coalesce(F.col("__fresh"), F.lit(False))
    )
    return joined.withColumns(
        {
            "is_resolved": F.col("is_resolved") | closing,
            "resolved_at": F.when(closing, instant(as_of)).otherwise(F.col("resolved_at")),
        }
    ).drop("component", "__fresh")


def union_alerts(*frames: DataFrame) -> DataFrame:
    """UNION ALL in the alert table's columns; what a rule lacks is null."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    columns = [
        (F.col(f.name) if f.name in merged.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in ALERT.fields
    ]
    return merged.select(*columns)


def latest_aggregate(aggregates: DataFrame) -> DataFrame:
    """Newest window per place and type, nulls read as 0."""
    return latest_per_key(aggregates, ["location_name", "market_type"], "window_start").withColumns(_no_nulls())


def _no_nulls() -> dict[str, Column]:
    return {
        "accuracy_rate": F.coalesce("accuracy_rate", F.lit(0.0)),
        "bias_score": F.coalesce("bias_score", F.lit(0.0)),
        "total_predictions": F.coalesce("total_predictions", F.lit(0)),
    }


def detect_all(
    aggregates: DataFrame,
    predictions: DataFrame,
    health: DataFrame,
    expected: DataFrame,
    correlations: DataFrame,
    as_of,
    arrival="arrival",
) -> DataFrame:
    """All rules: the newest aggregate per key against the seven days before ``as_of``,
    flagged mispricings, silent feeds and the coverage of the join."""
    judged = newest_judged(aggregates, as_of).withColumns(_no_nulls())
    return union_alerts(
        aggregate_alerts(judged, as_of),
        mispricing_flagged(predictions, as_of, arrival),
        producer_timeout(health, expected, as_of),
        low_coverage(correlations, as_of),
    )

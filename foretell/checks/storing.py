"""Upserts, appends and stored topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from foretell.checks import check
from foretell.checks.sql import NOW, q
from foretell.operators import upsert as U
from foretell.sources import tables, topics
from foretell.sources.bucketed import BucketedTable
from foretell.sources.session import scratch

# -- correlations: stored = even markets, incoming = all, with changed values --------

_STORED = "condition_id, location_name, price, actual_outcome, prediction_error, correlation_method, correlation_latency"


def _stored(f):
    return f.correlations.where(F.col("arrival") % 2 == 0).select(*_STORED.split(", "))


def _incoming(f):
    return f.correlations.select(
        "condition_id",
        F.upper("location_name").alias("location_name"),
        (F.col("price") + 1).alias("price"),
        (1 - F.col("actual_outcome")).alias("actual_outcome"),
        (F.col("prediction_error") / 2).alias("prediction_error"),
        F.lit("winner_known").alias("correlation_method"),
        (F.col("correlation_latency") + 1).alias("correlation_latency"),
    )


@check(
    "upsert_corr_keep_first",
    q("""SELECT condition_id, CASE WHEN old THEN location_name ELSE upper(location_name) END AS location_name,
           CASE WHEN old THEN price ELSE price + 1 END AS price, CASE WHEN old THEN actual_outcome ELSE 1 - actual_outcome END AS actual_outcome,
           CASE WHEN old THEN prediction_error ELSE prediction_error / 2 END AS prediction_error,
           CASE WHEN old THEN correlation_method ELSE 'winner_known' END AS correlation_method,
           CASE WHEN old THEN correlation_latency ELSE correlation_latency + 1 END AS correlation_latency
         FROM (SELECT *, arrival % 2 = 0 AS old FROM correlations)""", "correlations"),
)
def _keep_first(f):
    return U.insert_missing(_stored(f), _incoming(f), ["condition_id"])


@check(
    "upsert_corr_update",
    q("""SELECT condition_id, CASE WHEN old THEN location_name ELSE upper(location_name) END AS location_name,
           CASE WHEN old THEN price ELSE price + 1 END AS price, 1 - actual_outcome AS actual_outcome,
           prediction_error / 2 AS prediction_error, 'winner_known' AS correlation_method, correlation_latency + 1 AS correlation_latency
         FROM (SELECT *, arrival % 2 = 0 AS old FROM correlations)""", "correlations"),
)
def _update(f):
    return U.upsert(_stored(f), _incoming(f), ["condition_id"], U.CORRELATION_UPDATES)


# -- aggregates: stored = first twenty days, incoming = from the tenth day on ----------

_NEW = f"""SELECT location_name, market_type, window_start, window_end + INTERVAL 1 HOUR AS window_end, total_predictions + 5 AS total_predictions,
      correct_predictions + 3 AS correct_predictions, 1 - accuracy_rate AS accuracy_rate, avg_prediction_error / 2 AS avg_prediction_error,
      min_prediction_error / 2 AS min_prediction_error, max_prediction_error / 2 AS max_prediction_error, total_volume + 1 AS total_volume,
      volume_weighted_accuracy / 2 AS volume_weighted_accuracy, -1 * bias_score AS bias_score, over_prediction_count + 1 AS over_prediction_count,
      under_prediction_count + 1 AS under_prediction_count, {NOW} AS updated_at
      FROM aggregates WHERE window_start >= TIMESTAMP '2024-01-10'"""
_AGG_COLUMNS = (
    "location_name", "market_type", "window_start", "window_end", "total_predictions", "correct_predictions", "accuracy_rate",
    "avg_prediction_error", "min_prediction_error", "max_prediction_error", "total_volume", "volume_weighted_accuracy",
    "bias_score", "over_prediction_count", "under_prediction_count", "updated_at",
)


# the conflict rules once more, so that the SQL does not follow the lists it checks
_AGGREGATE_KEYS = ("location_name", "market_type", "window_start")
_AGGREGATE_SET = (
    "total_predictions", "correct_predictions", "accuracy_rate", "avg_prediction_error", "volume_weighted_accuracy",
    "bias_score", "updated_at",
)
_ALERT_KEYS = ("alert_type", "location_name", "market_type")
_ALERT_SET = ("severity", "message", "metric_value", "detected_at")
_CITY_KEYS = ("city_name",)
_CITY_SET = ("lat", "lon", "timezone", "updated_at")


def _merged(keys: tuple[str, ...], updates: tuple[str, ...], columns: tuple[str, ...]) -> str:
    picked = []
    for c in columns:
        if c in keys:
            picked.append(f"coalesce(o.{c}, n.{c}) AS {c}")
        else:
            first, second = ("n", "o") if c in updates else ("o", "n")
            picked.append(f"CASE WHEN {first}.{keys[0]} IS NOT NULL THEN {first}.{c} ELSE {second}.{c} END AS {c}")
    on = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    return f"SELECT {', '.join(picked)} FROM stored o FULL OUTER JOIN incoming n ON {on}"


@check(
    "upsert_aggregate",
    q(_merged(_AGGREGATE_KEYS, _AGGREGATE_SET, _AGG_COLUMNS), "aggregates").replace(
        "\nSELECT coalesce", f", stored AS (SELECT * FROM aggregates WHERE window_start < TIMESTAMP '2024-01-20'), incoming AS ({_NEW})\nSELECT coalesce", 1),
)
def _upsert_aggregate(f):
    c = F.col
    stored = f.aggregates.where(c("window_start") < F.lit("2024-01-20").cast("timestamp")).select(*_AGG_COLUMNS)
    incoming = f.aggregates.where(c("window_start") >= F.lit("2024-01-10").cast("timestamp")).select(
        "location_name",
        "market_type",
        "window_start",
        (c("window_end") + F.expr("interval 1 hour")).alias("window_end"),
        (c("total_predictions") + 5).alias("total_predictions"),
        (c("correct_predictions") + 3).alias("correct_predictions"),
        (1 - c("accuracy_rate")).alias("accuracy_rate"),
        *[(c(n) / 2).alias(n) for n in ("avg_prediction_error", "min_prediction_error", "max_prediction_error")],
        (c("total_volume") + 1).alias("total_volume"),
        (c("volume_weighted_accuracy") / 2).alias("volume_weighted_accuracy"),
        (c("bias_score") * -1).alias("bias_score"),
        (c("over_prediction_count") + 1).alias("over_prediction_count"),
        (c("under_prediction_count") + 1).alias("under_prediction_count"),
        F.lit("2024-01-31").cast("timestamp").alias("updated_at"),
    )
    return U.upsert(stored, incoming, U.AGGREGATE_KEYS, U.AGGREGATE_UPDATES)


# -- alerts: all stored alerts replayed in order onto one table -------------------------

_ALERT_COLUMNS = (
    "alert_type", "location_name", "market_type", "severity", "message", "metric_value", "threshold_value",
    "is_resolved", "resolved_at", "detected_at",
)


def _alert_pair(f):
    """Stored: newest alert per key before the 20th; incoming: newest per key after the 10th."""
    at, border = F.col("detected_at"), lambda d: F.lit(d).cast("timestamp")
    keys = list(U.ALERT_KEYS)
    stored = tables.compacted_view(f.stored_alerts.where(at < border("2024-01-20")), keys, "alert_id")
    incoming = tables.compacted_view(f.stored_alerts.where(at >= border("2024-01-10")), keys, "alert_id")
    return stored.select(*_ALERT_COLUMNS), incoming.select(*_ALERT_COLUMNS)


_NEWEST = "QUALIFY row_number() OVER (PARTITION BY alert_type, location_name, market_type ORDER BY alert_id DESC) = 1"


@check(
    "upsert_alert",
    q(_merged(_ALERT_KEYS, _ALERT_SET, _ALERT_COLUMNS), "stored_alerts").replace(
        "\nSELECT coalesce",
        f", stored AS (SELECT * FROM stored_alerts WHERE detected_at < TIMESTAMP '2024-01-20' {_NEWEST}), "
        f"incoming AS (SELECT * FROM stored_alerts WHERE detected_at >= TIMESTAMP '2024-01-10' {_NEWEST})\nSELECT coalesce", 1),
)
def _upsert_alert(f):
    return U.upsert(*_alert_pair(f), U.ALERT_KEYS, U.ALERT_UPDATES)


@check(
    "fold_changes",
    q("""SELECT alert_type, location_name, market_type, arg_max(severity, alert_id) AS severity, arg_max(message, alert_id) AS message,
           arg_max(metric_value, alert_id) AS metric_value, arg_min(threshold_value, alert_id) AS threshold_value,
           arg_min(is_resolved, alert_id) AS is_resolved, max(detected_at) AS detected_at
         FROM stored_alerts GROUP BY 1, 2, 3""", "stored_alerts"),
)
def _fold(f):
    log = f.stored_alerts.drop("resolved_at")
    return U.fold_changes(log, U.ALERT_KEYS, U.ALERT_UPDATES, "alert_id")


_CITIES = (
    """WITH stored AS (SELECT c_custkey AS k, 'city' || c_custkey AS city_name, c_acctbal AS lat, c_acctbal / 2 AS lon, 'UTC' AS timezone, 'old' AS source,
           TIMESTAMP '2024-01-01' AS updated_at FROM customer WHERE c_custkey % 3 <> 0),
         incoming AS (SELECT 'city' || c_custkey AS city_name, c_acctbal + 1 AS lat, c_acctbal / 2 AS lon, 'Zone/' || c_nationkey AS timezone, 'new' AS source,
           TIMESTAMP '2024-01-31' AS updated_at FROM customer WHERE c_custkey % 2 = 0) """
    + _merged(_CITY_KEYS, _CITY_SET, ("city_name", "lat", "lon", "timezone", "source", "updated_at"))
)


@check(
    "upsert_city",
    _CITIES,
)
def _upsert_city(f):
    return U.upsert(*_city_pair(f), U.CITY_KEYS, U.CITY_UPDATES)


@check("upsert_bucketed", _CITIES)
def _upsert_bucketed(f):
    """The same upsert on a table stored in buckets: written, merged and read again."""
    stored, incoming = _city_pair(f)
    table = BucketedTable(f.spark, scratch(f.spark, "cities"), U.CITY_KEYS, buckets=8)
    table.write(stored)
    table.upsert(incoming, U.CITY_UPDATES)
    return table.read()


def _city_pair(f):
    def cities(source, shift, zone, at, keep):
        key = F.col("c_custkey")
        return f.table("customer").where(keep(key)).select(
            F.concat(F.lit("city"), key.cast("string")).alias("city_name"),
            (F.col("c_acctbal") + shift).alias("lat"),
            (F.col("c_acctbal") / 2).alias("lon"),
            zone.alias("timezone"),
            F.lit(source).alias("source"),
            F.lit(at).cast("timestamp").alias("updated_at"),
        )

    stored = cities("old", 0, F.lit("UTC"), "2024-01-01", lambda k: k % 3 != 0)
    zone = F.concat(F.lit("Zone/"), F.col("c_nationkey").cast("string"))
    incoming = cities("new", 1, zone, "2024-01-31", lambda k: k % 2 == 0)
    return stored, incoming


# -- appends -----------------------------------------------------------------------------


@check("sink_topic", q("SELECT condition_id, location_name, correlation_method, actual_outcome, prediction_error FROM correlations", "correlations"))
def _sink_topic(f):
    rows = f.correlations.select("condition_id", "location_name", "correlation_method", "actual_outcome", "prediction_error")
    path = scratch(f.spark, "topic")
    topics.append_json(rows, path)
    return topics.read_bounded(f.spark, path, rows.schema, format="json")


@check(
    "append_health",
    """SELECT 'feed_' || (user_id % 25) AS component, CAST(ts AS DATE) AS day, count(*) AS polls,
         count(*) FILTER (event_type = 'error') AS degraded FROM events GROUP BY 1, 2""",
)
def _append_health(f):
    """Two appends, one per half of the health rows, read back by day."""
    path = scratch(f.spark, "health")
    rows = f.health.withColumn("day", F.to_date("recorded_at"))
    even = F.col("health_id") % 2 == 0
    tables.append_table(rows.where(even), path, ["day"])
    tables.append_table(rows.where(~even), path, ["day"])
    stored = f.spark.read.parquet(path)
    return stored.groupBy("component", "day").agg(
        F.count(F.lit(1)).alias("polls"), F.count_if(F.col("status") == "degraded").alias("degraded")
    )

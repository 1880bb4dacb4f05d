"""Structured Streaming jobs run to the end of the given tables.

Each has SQL for what the stream must have emitted once its input is read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from foretell.checks import check
from foretell.checks.alerting import _accuracy_sql, _bias_sql
from foretell.checks.ingestion import EVENT_SCHEMA
from foretell.checks.scoring import HOPS
from foretell.checks.sql import judged, q, rolling, stream_metrics
from foretell.operators import upsert as U
from foretell.operators.accuracy import GROUP
from foretell.plans.fixtures import Fixtures
from foretell.sources import tables, topics
from foretell.sources.changelog import ChangeLog
from foretell.sources.session import scratch
from foretell.streaming.counters import CounterListener, count_labels
from foretell.streaming.hopping import stream_hopping
from foretell.streaming.keyed import key_by, windowed_counts
from foretell.streaming.pending_join import stream_pending_join
from foretell.streaming.rolling_alerts import stream_baselines, stream_rolling_alerts
from foretell.streaming.run import drain, drain_complete, drain_each, drain_into, start_append

ORDER_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


def _events(f):
    raw = topics.read_stream(f.spark, f.folder, EVENT_SCHEMA, glob="events.parquet")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _predictions(f):
    orders = topics.read_stream(f.spark, f.folder, ORDER_SCHEMA, glob="orders.parquet")
    return Fixtures.predictions_from(orders, f.table("customer"))


def _stored_stream(f, df, name):
    """A batch result written as a topic and read back as a stream."""
    path = scratch(f.spark, name)
    df.write.parquet(path)
    return topics.read_stream(f.spark, path, df.schema)


@check("src_stream_topic", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def _source(f):
    return drain(_events(f), "source")


@check(
    "key_by",
    q("SELECT coalesce(location_name, 'unknown') AS location_name, count(*) AS n FROM weather GROUP BY 1", "weather"),
)
def _key_by(f):
    return drain_complete(key_by(Fixtures.weather_from(_events(f)), "location_name"), "keyed")


_HOP_KEYS = "location_name, market_type, window_start, window_end"
_CLOSED = f"""SELECT * FROM ({stream_metrics(HOPS, _HOP_KEYS)})
    WHERE window_end <= (SELECT date_trunc('milliseconds', max(poll_ts)) FROM correlations) - INTERVAL 15 MINUTE"""


@check("stream_hopping", q(_CLOSED, "correlations"))
def _hopping(f):
    fields = ("poll_ts", *GROUP, "price", "actual_outcome", "prediction_error", "correlation_method", "volume")
    return drain(stream_hopping(_stored_stream(f, f.correlations.select(*fields), "correlations")), "hopping")


@check(
    "watermark_15m",
    q("""SELECT location_name, w AS window_start, count(*) AS n FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, poll_ts) AS w FROM weather)
         WHERE w + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(poll_ts)) FROM weather) - INTERVAL 15 MINUTE GROUP BY 1, 2""", "weather"),
)
def _watermark(f):
    counted = windowed_counts(Fixtures.weather_from(_events(f)), "poll_ts", ["location_name"])
    return drain(counted.select("location_name", "window_start", "n"), "watermark")


# for every prediction: the place's newest weather at that moment if it settles the
# prediction, else the first later one that does; either within a day
_PAIR_RULE = """
    CASE WHEN p.closed AND p.winner IS NOT NULL THEN true
      WHEN p.market_type IN ('RAIN', 'SNOW', 'WEATHER') THEN true
      WHEN p.market_type IN ('SUNSHINE', 'FOG', 'HAIL', 'CLOUD') THEN w.weather_code IS NOT NULL
      WHEN p.market_type = 'WIND' THEN w.wind_kmh IS NOT NULL
      WHEN p.market_type = 'FROST' THEN w.temp_c IS NOT NULL
      WHEN p.market_type = 'TEMPERATURE' THEN p.th_type IS NOT NULL ELSE false END"""
_PENDING = f"""
  SELECT condition_id, location_name, obs_id, weather_type, correlation_method FROM (
    SELECT p.condition_id, p.location_name, w.obs_id, w.weather_type,
      CASE WHEN p.closed AND p.winner IS NOT NULL THEN 'winner_known' WHEN w.weather_type = 'historical' THEN 'historical_weather'
        ELSE 'current_snapshot' END AS correlation_method,
      row_number() OVER (PARTITION BY p.condition_id ORDER BY w.poll_ts) AS rn
    FROM predictions p JOIN weather w ON w.location_name = p.location_name
      AND w.poll_ts BETWEEN p.poll_ts - INTERVAL 24 HOUR AND p.poll_ts + INTERVAL 24 HOUR
    WHERE {_PAIR_RULE} AND (w.poll_ts > p.poll_ts OR w.poll_ts = (SELECT max(x.poll_ts) FROM weather x
      WHERE x.location_name = p.location_name AND x.poll_ts <= p.poll_ts))) WHERE rn = 1"""


@check(
    "stream_pending_join",
    q("SELECT condition_id, location_name, weather_type, correlation_method, obs_ts AS weather_poll_ts FROM (SELECT p.*, w.poll_ts AS obs_ts "
      "FROM paired p JOIN weather w USING (obs_id))", "predictions", "weather").replace(
        "\nSELECT condition_id", f", paired AS ({_PENDING})\nSELECT condition_id", 1),
)
def _pending(f):
    joined = stream_pending_join(_predictions(f), Fixtures.weather_from(_events(f)))
    return drain(joined, "pending").select(
        "condition_id", "location_name", "weather_type", "correlation_method", "weather_poll_ts"
    )


@check(
    "state_ttl_24h",
    q(f"SELECT weather_type, correlation_method, count(*) AS n FROM ({_PENDING.replace('24 HOUR', '1 HOUR')}) GROUP BY 1, 2", "predictions", "weather"),
)
def _ttl(f):
    """The same join with state that lives one hour."""
    joined = stream_pending_join(
        _predictions(f), Fixtures.weather_from(_events(f)), ttl_hours=1, salts=3, lateness="40 days"
    )
    return drain(joined, "ttl").groupBy("weather_type", "correlation_method").agg(F.count(F.lit(1)).alias("n"))


_STREAM_ALERTS = (
    f"SELECT * FROM ({_accuracy_sql('judged_stream', '0.7', True, 'window_end')}) UNION ALL "
    f"SELECT * FROM ({_bias_sql('judged_stream', True, 'window_end')})"
)


@check("stream_rolling_alerts", q(_STREAM_ALERTS, "judged_stream"))
def _rolling(f):
    return drain(stream_rolling_alerts(_stored_stream(f, f.aggregates, "aggregates")), "alerts")


@check("append_alert", q(f"SELECT alert_type, severity, count(*) AS n FROM ({_STREAM_ALERTS}) GROUP BY 1, 2", "judged_stream"))
def _append_alert(f):
    """Plain inserts through a batch function that appends."""
    path = scratch(f.spark, "alert-table")
    stream = stream_rolling_alerts(_stored_stream(f, f.aggregates, "aggregates"))
    drain_each(stream, "append", lambda batch, _: tables.append_table(batch, path))
    return f.spark.read.parquet(path).groupBy("alert_type", "severity").agg(F.count(F.lit(1)).alias("n"))


@check(
    "idempotent_sink",
    q("""SELECT alert_type, location_name, market_type, arg_max(severity, alert_id) AS severity, arg_max(message, alert_id) AS message,
           arg_max(metric_value, alert_id) AS metric_value, arg_min(threshold_value, alert_id) AS threshold_value,
           arg_min(is_resolved, alert_id) AS is_resolved, max(detected_at) AS detected_at FROM stored_alerts GROUP BY 1, 2, 3""", "stored_alerts"),
)
def _idempotent(f):
    """Every micro-batch is delivered twice, and the topic once more from a new checkpoint, with
    a compaction in between; the table is as if each change came once."""
    changes = f.stored_alerts.drop("resolved_at")
    log = ChangeLog(f.spark, scratch(f.spark, "alert-log"), U.ALERT_KEYS, U.ALERT_UPDATES, "alert_id")
    write = log.sink()

    def twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    topic = _stored_stream(f, changes, "alerts")
    drain_each(topic, "twice", twice)
    log.compact()
    drain_each(topic, "again", twice)
    return log.read()


@check(
    "labelled_counters_live",
    q("""SELECT 'weather_records_produced_total' AS metric, 'weather_type=' || weather_type AS labels, count(*) AS value FROM weather GROUP BY 2 UNION ALL
         SELECT 'predictions_produced_total', 'market_status=' || market_status || ',market_type=' ||
           CASE WHEN market_type IN ('RAIN', 'SNOW', 'WIND') THEN market_type ELSE 'other' END, count(*) FROM predictions GROUP BY 2""",
      "weather", "predictions"),
)
def _live_counters(f):
    """Counters that the two streams tell with their progress while they run into tables."""
    listener = CounterListener()
    f.spark.streams.addListener(listener)
    try:
        observed = count_labels(
            Fixtures.weather_from(_events(f)), "weather_records_produced_total", {"weather_type": ["historical", "current"]}
        )
        polled = count_labels(
            _predictions(f),
            "predictions_produced_total",
            {"market_status": ["open", "closed"], "market_type": ["RAIN", "SNOW", "WIND"]},
        )
        for name, stream in (("observed", observed), ("polled", polled)):
            listener.settle(start_append(stream, scratch(f.spark, f"{name}-out"), scratch(f.spark, f"{name}-state")))
    finally:
        f.spark.streams.removeListener(listener)
    return listener.frame(f.spark)


# -- lateness, retention, restart ---------------------------------------------------------

_LATE = """
  SELECT location_name, w AS window_start, count(*) AS n FROM (
    SELECT *, time_bucket(INTERVAL 1 HOUR, poll_ts) AS w, poll_ts >= TIMESTAMP '2024-01-20' OR obs_id % 10 = 0 AS second FROM weather),
    (SELECT max(poll_ts) FILTER (poll_ts < TIMESTAMP '2024-01-20' AND obs_id % 10 <> 0) AS first_max, max(poll_ts) AS last_max FROM weather)
  WHERE (NOT second OR w + INTERVAL 1 HOUR > date_trunc('milliseconds', first_max) - INTERVAL 15 MINUTE)
    AND w + INTERVAL 1 HOUR <= date_trunc('milliseconds', last_max) - INTERVAL 15 MINUTE GROUP BY 1, 2"""


@check("late_drop", q(_LATE, "weather"))
def _late(f):
    """Every tenth row of the first nineteen days arrives only with the last ten days,
    too late for windows the watermark has closed by then."""
    topic, out, checkpoint = (scratch(f.spark, n) for n in ("late-topic", "late-out", "late-state"))
    rows = f.weather.select("obs_id", "location_name", "poll_ts")
    second = (F.col("poll_ts") >= F.lit("2024-01-20").cast("timestamp")) | (F.col("obs_id") % 10 == 0)
    for part in (~second, second):
        rows.where(part).write.mode("append").parquet(topic)
        counted = windowed_counts(topics.read_stream(f.spark, topic, rows.schema), "poll_ts", ["location_name"])
        result = drain_into(counted.select("location_name", "window_start", "n"), out, checkpoint)
    return result


_TWO_DAYS = judged(rolling("thick", "bias_score", 2))


@check(
    "state_ttl_8d",
    q(f"""SELECT location_name, market_type, window_end, baseline_n, acc_mean, acc_std, bias_mean, bias_std
          FROM ({_TWO_DAYS})""", "thick"),
)
def _retention(f):
    """Rolling history kept for two days, over two runs of the same stream."""
    topic, out, checkpoint = (scratch(f.spark, n) for n in ("kept-topic", "kept-out", "kept-state"))
    border = F.lit("2024-01-15").cast("timestamp")
    for part in (F.col("window_start") < border, F.col("window_start") >= border):
        f.aggregates.where(part).write.mode("append").parquet(topic)
        stream = topics.read_stream(f.spark, topic, f.aggregates.schema)
        bounds = stream_baselines(stream, days=2).select(
            "location_name", "market_type", "window_end", "baseline_n", "acc_mean", "acc_std", "bias_mean", "bias_std"
        )
        result = drain_into(bounds, out, checkpoint)
    return result


@check("checkpoint_60s", "SELECT event_id, event_type, value FROM events")
def _checkpoint(f):
    """A job with one checkpoint a minute, stopped and started again: the second start
    finds its offsets in the checkpoint and emits nothing twice."""
    out, checkpoint = scratch(f.spark, "minute-out"), scratch(f.spark, "minute-state")
    events = _events(f).select("event_id", "event_type", "value")
    for _ in range(2):
        query = topics.stream_to_topic(events, out, checkpoint, every="60 seconds").start()
        while not query.lastProgress and not query.awaitTermination(1):
            pass
        query.stop()
    return f.spark.read.schema(events.schema).parquet(out)

"""Alert rules, arbitrage, coverage, health and the reporting views."""

from __future__ import annotations

from pyspark.sql import functions as F

from foretell.checks import check
from foretell.checks.sql import NOW, base_rate, fix, judged, pct, q, rnd, sfix, units
from foretell.functions.text import base_rate as base_rate_of
from foretell.operators import alerts as L
from foretell.operators.upsert import ALERT_KEYS
from foretell.operators import summaries as M
from foretell.operators.baseline import baselines
from foretell.operators.scoring import with_outcome
from foretell.operators.lookup import attach_weather, weather_snapshot
from foretell.plans.fixtures import AS_OF, POLL_ORDER
from foretell.plans.jobs import anomaly_job
from foretell.sources.tables import compacted_view
from foretell.plans.views import query_view

_SUBJECT = "location_name || ' ' || market_type"
_NULLS = "CAST(NULL AS DOUBLE) AS price_sum, CAST(NULL AS DOUBLE) AS arbitrage_margin"


def _accuracy_sql(source: str, ratio: str, stream: bool = False, at: str = NOW) -> str:
    if stream:
        message = (
            "'Accuracy drop [' || CASE WHEN baseline_source = '7day_statistical' THEN 'statistical' ELSE 'static' END || ']: ' || "
            f"{_SUBJECT} || ' accuracy=' || {pct('accuracy_rate', 1)} || ' < threshold=' || {pct('accuracy_threshold', 1)}"
        )
    else:
        message = (
            f"'Accuracy drop: ' || {_SUBJECT} || ' ' || {pct('accuracy_rate', 1)} || ' < threshold ' || {pct('accuracy_threshold', 1)} || "
            f"' [baseline=' || CASE WHEN baseline_source = '7day_statistical' THEN 'mean-2σ(' || {pct('acc_mean', 1)} || '±' || {pct('acc_std', 1)} "
            f"|| ', n=' || baseline_n || ')' ELSE 'static(' || {pct('accuracy_threshold', 0)} || ')' END || ']'"
        )
    return f"""SELECT 'accuracy_drop' AS alert_type,
      CASE WHEN accuracy_rate < accuracy_threshold * {ratio}::DOUBLE THEN 'critical' ELSE 'high' END AS severity,
      location_name, market_type, {message} AS message, accuracy_rate AS metric_value,
      {'accuracy_threshold' if stream else rnd('accuracy_threshold', 4)} AS threshold_value, {rnd('accuracy_threshold - accuracy_rate', 4)} AS deviation,
      {at} AS detected_at FROM {source} WHERE total_predictions >= 10 AND accuracy_rate < accuracy_threshold"""


def _bias_sql(source: str, stream: bool = False, at: str = NOW) -> str:
    direction = "CASE WHEN bias_score > 0 THEN 'over-predicting' ELSE 'under-predicting' END"
    if stream:
        message = (
            "'Bias [' || CASE WHEN baseline_source = '7day_statistical' THEN 'statistical' ELSE 'static' END || ']: ' || "
            f"{_SUBJECT} || ' ' || {direction} || ' bias=' || {sfix('bias_score', 3)} || ' threshold=±' || {fix('bias_threshold', 3)}"
        )
    else:
        message = (
            f"'Bias: ' || {_SUBJECT} || ' ' || {direction} || ' bias=' || {sfix('bias_score', 3)} || ' > threshold ' || {fix('bias_threshold', 3)} || "
            f"' [baseline=' || CASE WHEN baseline_source = '7day_statistical' THEN 'mean+2σ(' || {fix('bias_mean', 3)} || '±' || {fix('bias_std', 3)} "
            f"|| ', n=' || baseline_n || ')' ELSE 'static(' || {fix('bias_threshold', 2)} || ')' END || ']'"
        )
    return f"""SELECT 'bias_detected' AS alert_type,
      CASE WHEN abs(bias_score) > bias_threshold * 1.5::DOUBLE THEN 'high' ELSE 'medium' END AS severity,
      location_name, market_type, {message} AS message, bias_score AS metric_value,
      {'bias_threshold' if stream else rnd('bias_threshold', 4)} AS threshold_value, {rnd('abs(bias_score) - bias_threshold', 4)} AS deviation,
      {at} AS detected_at FROM {source} WHERE total_predictions >= 10 AND abs(bias_score) > bias_threshold"""


@check("alert_accuracy_drop", q(_accuracy_sql("judged", "0.6"), "judged"))
def _drop(f):
    return L.accuracy_drop(baselines(f.aggregates), AS_OF)


@check("alert_accuracy_drop_stream", q(_accuracy_sql("judged_stream", "0.7", True), "judged_stream"))
def _drop_stream(f):
    judged = baselines(f.aggregates, abs_bias=False, min_total=10)
    return L.accuracy_drop(judged, AS_OF, L.STREAM_CRITICAL_RATIO, "stream")


@check("alert_bias", q(_bias_sql("judged"), "judged"))
def _bias(f):
    return L.bias_detected(baselines(f.aggregates), AS_OF)


@check("alert_bias_stream", q(_bias_sql("judged_stream", True), "judged_stream"))
def _bias_stream(f):
    return L.bias_detected(baselines(f.aggregates, abs_bias=False, min_total=10), AS_OF, "stream")


@check("alert_message", q(f"SELECT message FROM ({_accuracy_sql('judged', '0.6')}) UNION ALL SELECT message FROM ({_bias_sql('judged')})", "judged"))
def _messages(f):
    return L.aggregate_alerts(baselines(f.aggregates), AS_OF).select("message")


# -- arbitrage -------------------------------------------------------------------------


@check("base_rate", q(f"SELECT condition_id, market_type, {base_rate('market_type')} AS base_rate FROM predictions", "predictions"))
def _base_rate(f):
    return f.predictions.select("condition_id", "market_type", base_rate_of(F.col("market_type")).alias("base_rate"))


@check(
    "mispricing_flag",
    q(f"""SELECT condition_id, base_rate, {rnd('abs(price - base_rate)', 4)} AS deviation,
          abs(price - base_rate) > 0.4::DOUBLE AND NOT closed AS flagged
          FROM (SELECT *, {base_rate('market_type')} AS base_rate FROM predictions)""", "predictions"),
)
def _mispricing(f):
    base, deviation, flag = L.mispricing(F.col("price"), F.col("market_type"), F.col("closed"))
    return f.predictions.select("condition_id", base.alias("base_rate"), deviation.alias("deviation"), flag.alias("flagged"))


@check(
    "alert_mispricing_open",
    q(f"""SELECT 'arbitrage_opportunity' AS alert_type, CASE WHEN d > 0.5::DOUBLE THEN 'critical' ELSE 'high' END AS severity,
          location_name, market_type, CAST(end_date AS VARCHAR) AS date,
          'Mispricing: ' || {_SUBJECT} || ' price=' || {fix('price', 3)} || ' base_rate=' || {fix('b', 3)} || ' deviation=' || {fix(rnd('d * 100', 2), 2)} || '%' AS message,
          price AS metric_value, {rnd('d * 100', 2)} AS arbitrage_margin, CAST(1 AS BIGINT) AS markets, {NOW} AS detected_at
          FROM (SELECT *, abs(price - b) AS d FROM (SELECT *, {base_rate('market_type')} AS b FROM predictions))
          WHERE NOT closed AND d > 0.4::DOUBLE""", "predictions"),
)
def _mispricing_open(f):
    return L.mispricing_open(f.predictions, AS_OF)


_FLAGGED = f"""SELECT 'arbitrage_opportunity' AS alert_type, CASE WHEN d > 0.5::DOUBLE THEN 'critical' ELSE 'high' END AS severity,
      location_name, market_type,
      'Mispricing arbitrage: ' || {_SUBJECT} || ' price=' || {fix('price', 3)} || ' base=' || {fix('b', 3)} || ' deviation=' || {fix(rnd('d * 100', 2), 2)} || '%' AS message,
      price AS metric_value, b AS threshold_value, {rnd('d', 4)} AS deviation, price AS price_sum,
      {rnd('d * 100', 2)} AS arbitrage_margin, {NOW} AS detected_at
      FROM (SELECT *, coalesce(base_rate, 0.4) AS b, coalesce(deviation_from_base, 0) AS d FROM polls WHERE condition_id IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY condition_id ORDER BY arrival, part, amount) = 1) WHERE is_arbitrage"""


@check("alert_mispricing_flagged", q(_FLAGGED, "polls"))
def _mispricing_flagged(f):
    return L.mispricing_flagged(f.polls, AS_OF, POLL_ORDER)


_CROSS = """SELECT location_name, market_type, CAST(end_date AS VARCHAR) AS date, count(*) AS markets,
      CAST(sum(CAST(floor(price * 1e4 + 0.5) AS BIGINT)) AS BIGINT) / 1e4 AS price_sum
      FROM predictions WHERE NOT closed GROUP BY 1, 2, 3
      HAVING count(*) >= 2 AND sum(CAST(floor(price * 1e4 + 0.5) AS BIGINT)) > 10100"""


@check("cross_market_sum", q(_CROSS, "predictions"))
def _cross_sum(f):
    return L.cross_market_sum(f.predictions)


@check(
    "alert_cross_market",
    q(f"""SELECT 'arbitrage_opportunity' AS alert_type, CASE WHEN m > 5 THEN 'critical' ELSE 'high' END AS severity,
          location_name, market_type, date,
          'Cross-market arbitrage: ' || {_SUBJECT} || ' ' || date || ' price_sum=' || {fix('price_sum', 3)} || ' margin=' || {fix('m', 2)} || '%' AS message,
          price_sum AS metric_value, m AS arbitrage_margin, markets, {NOW} AS detected_at
          FROM (SELECT *, {rnd('(price_sum - 1.0::DOUBLE) * 100', 2)} AS m FROM ({_CROSS}))""", "predictions"),
)
def _cross(f):
    return L.cross_market(f.predictions, AS_OF)


# -- health and coverage ------------------------------------------------------------------

_SILENT = f"((epoch_us({NOW}) - epoch_us(recorded_at)) / 60000000.0::DOUBLE)"
_TIMEOUT = f"""
    SELECT 'producer_timeout' AS alert_type, component AS location_name, 'SYSTEM' AS market_type, 10.0::DOUBLE AS threshold_value,
      {NOW} AS detected_at, CASE WHEN {_SILENT} > 30 THEN 'critical' ELSE 'high' END AS severity,
      'Producer silent: ' || component || ' has not reported for ' || {fix(_SILENT, 1)} || ' min (threshold: 10 min). Last seen: ' ||
        strftime(recorded_at, '%Y-%m-%d %H:%M:%S') || ' UTC | status=' || status || ' msgs=' || messages_processed || ' errors=' || error_count AS message,
      {rnd(_SILENT, 1)} AS metric_value, {rnd(_SILENT + ' - 10.0::DOUBLE', 1)} AS deviation
    FROM latest_health WHERE recorded_at < {NOW} - INTERVAL 10 MINUTE
    UNION ALL
    SELECT 'producer_timeout', component, 'SYSTEM', 10.0::DOUBLE, {NOW}, 'critical',
      'Producer never reported: ' || component || ' has no records in pipeline_health', NULL, NULL
    FROM expected WHERE component NOT IN (SELECT component FROM health)"""


@check("alert_producer_timeout", q(_TIMEOUT, "latest_health", "expected"))
def _timeout(f):
    return L.producer_timeout(f.health, f.expected, AS_OF)


_LOW = f"""SELECT 'low_coverage' AS alert_type, CASE WHEN c < 0.7::DOUBLE THEN 'critical' ELSE 'high' END AS severity,
      'pipeline' AS location_name, 'ALL' AS market_type,
      'Join coverage ' || {pct('c', 1)} || ' below threshold 95%: ' || m || '/' || n || ' predictions matched with weather actuals' AS message,
      {rnd('c', 4)} AS metric_value, 0.95::DOUBLE AS threshold_value, {rnd('0.95::DOUBLE - c', 4)} AS deviation, {NOW} AS detected_at
      FROM (SELECT count(*) AS n, count(actual_outcome) AS m, count(actual_outcome)::DOUBLE / count(*) AS c FROM outcomes) WHERE c < 0.95::DOUBLE"""


@check("alert_low_coverage", q(_LOW, "outcomes"))
def _low(f):
    rows = with_outcome(attach_weather(f.predictions, *weather_snapshot(f.weather)))
    return L.low_coverage(rows, AS_OF)


@check(
    "auto_resolve",
    q(f"""SELECT alert_id, alert_type, location_name, is_resolved OR hit AS is_resolved, CASE WHEN hit THEN {NOW} ELSE resolved_at END AS resolved_at
          FROM (SELECT *, alert_type = 'producer_timeout' AND NOT is_resolved AND EXISTS (SELECT 1 FROM latest_health l
             WHERE l.component = a.location_name AND l.recorded_at > {NOW} - INTERVAL 10 MINUTE) AS hit FROM stored_alerts a)""",
      "stored_alerts", "latest_health"),
)
def _auto_resolve(f):
    return L.auto_resolve(f.stored_alerts, f.health, AS_OF).select(
        "alert_id", "alert_type", "location_name", "is_resolved", "resolved_at"
    )


_COLUMNS = (
    "alert_type, severity, location_name, market_type, message, metric_value, threshold_value, deviation, "
    "price_sum, arbitrage_margin, detected_at"
)


# two places fall silent: nothing of theirs lies in the seven days before as_of
_SILENT_PLACES = "location_name IN ('London', 'Tokyo') AND window_start >= TIMESTAMP '2024-01-20'"
_NEWEST_JUDGED = ", newest AS (" + judged(f"""
    SELECT n.*, coalesce(r.n_rows, 0) AS n_rows, r.s_acc, r.q_acc, r.s_bias, r.q_bias, 0 AS au, 0 AS bu
    FROM (SELECT * FROM aggregates WHERE NOT ({_SILENT_PLACES}) QUALIFY row_number() OVER
            (PARTITION BY location_name, market_type ORDER BY window_start DESC) = 1) n
    LEFT JOIN (SELECT location_name, market_type, count(*) AS n_rows, CAST(sum(au) AS BIGINT) AS s_acc, CAST(sum(au * au) AS BIGINT) AS q_acc,
        CAST(sum(bu) AS BIGINT) AS s_bias, CAST(sum(bu * bu) AS BIGINT) AS q_bias
      FROM (SELECT *, {units('accuracy_rate', 4)} AS au, {units('abs(bias_score)', 4)} AS bu FROM aggregates
            WHERE NOT ({_SILENT_PLACES}) AND window_end >= {NOW} - INTERVAL 7 DAY) GROUP BY 1, 2) r
    ON r.location_name = n.location_name AND r.market_type = n.market_type""") + ")"
_RUN = f"""SELECT {_COLUMNS}@ FROM (
          SELECT * FROM ({_accuracy_sql('newest', '0.6')}) UNION ALL BY NAME SELECT * FROM ({_bias_sql('newest')})
          UNION ALL BY NAME SELECT * FROM ({_FLAGGED}) UNION ALL BY NAME SELECT * FROM ({_TIMEOUT})
          UNION ALL BY NAME SELECT * FROM ({_LOW}))"""


def _run_sql(final: str, *more: str) -> str:
    text = q("-- run\n" + final, "aggregates", "polls", "latest_health", "expected", "outcomes", *more)
    return text.replace("\n-- run", _NEWEST_JUDGED, 1)


def _run_inputs(f):
    silent = F.col("location_name").isin("London", "Tokyo") & (F.col("window_start") >= F.lit("2024-01-20").cast("timestamp"))
    rows = with_outcome(attach_weather(f.predictions, *weather_snapshot(f.weather)))
    return f.aggregates.where(~silent), f.polls, f.health, f.expected, rows


@check("union_alerts", _run_sql(_RUN.replace("@", "")))
def _union(f):
    return L.detect_all(*_run_inputs(f), AS_OF, POLL_ORDER)


_KEPT = ("alert_id", "threshold_value", "deviation", "price_sum", "arbitrage_margin", "is_resolved", "resolved_at")
_SET = ("severity", "message", "metric_value", "detected_at")
_KEY = ("alert_type", "location_name", "market_type")
_BY_KEY = f"PARTITION BY {', '.join(_KEY)} ORDER BY coalesce(metric_value, '-infinity'::DOUBLE)"
_SAVED = f"""SELECT {", ".join(f"coalesce(o.{c}, n.{c}) AS {c}" for c in _KEY)},
    {", ".join(f"CASE WHEN n.alert_type IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in _SET)},
    {", ".join(f"CASE WHEN o.alert_type IS NOT NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in _KEPT)}
  FROM (SELECT * EXCLUDE (is_resolved, resolved_at, hit), is_resolved OR hit AS is_resolved,
      CASE WHEN hit THEN {NOW} ELSE resolved_at END AS resolved_at,
      NULL::DOUBLE AS deviation, NULL::DOUBLE AS price_sum, NULL::DOUBLE AS arbitrage_margin
    FROM (SELECT *, alert_type = 'producer_timeout' AND NOT is_resolved AND EXISTS (SELECT 1 FROM latest_health l
        WHERE l.component = a.location_name AND l.recorded_at > {NOW} - INTERVAL 10 MINUTE) AS hit
      FROM (SELECT * FROM stored_alerts
        QUALIFY row_number() OVER (PARTITION BY {", ".join(_KEY)} ORDER BY alert_id DESC) = 1) a)) o
  FULL JOIN (SELECT {", ".join(_KEY)}, {", ".join(f"l.{c}" for c in _SET)}, {", ".join(f"f.{c}" for c in _KEPT)}
    FROM (SELECT * FROM fired QUALIFY row_number() OVER ({_BY_KEY}, message) = 1) f
    JOIN (SELECT * FROM fired QUALIFY row_number() OVER ({_BY_KEY} DESC, message DESC) = 1) l USING ({", ".join(_KEY)})) n
  USING ({", ".join(_KEY)})"""
_FIRED = _RUN.replace("@", ", NULL::BIGINT AS alert_id, false AS is_resolved, NULL::TIMESTAMP AS resolved_at")


@check("anomaly_job", _run_sql(f"SELECT * FROM (WITH fired AS ({_FIRED}) {_SAVED})", "stored_alerts"))
def _anomaly_job(f):
    """Over the newest stored alert of each key, as the stored table holds one for each."""
    standing = compacted_view(f.stored_alerts, ALERT_KEYS, "alert_id")
    return anomaly_job(standing, *_run_inputs(f), AS_OF, POLL_ORDER)


@check(
    "alerts_by_severity",
    q("SELECT alert_type, severity, count(*) AS n FROM stored_alerts WHERE resolved_at IS NULL GROUP BY 1, 2", "stored_alerts"),
)
def _by_severity(f):
    return M.alerts_by_severity(f.stored_alerts)


# -- views ------------------------------------------------------------------------------------

# the views' "last 24 hours" and "7 days" end where the daily aggregates are dense
_VIEW_AS_OF = "2024-01-30 12:00:00"
_VNOW = f"TIMESTAMP '{_VIEW_AS_OF}'"
_PCT = "CAST(floor(CAST(sum(CAST(floor(accuracy_rate * 1e4 + 0.5) AS BIGINT)) AS BIGINT) / count(accuracy_rate) + 0.5) AS BIGINT) / 1e2"
_ERR = "CAST(floor(CAST(sum(CAST(floor(avg_prediction_error * 1e4 + 0.5) AS BIGINT)) AS BIGINT) / count(avg_prediction_error) + 0.5) AS BIGINT) / 1e4"


@check(
    "current_accuracy",
    q(f"""SELECT location_name, market_type, {_PCT} AS accuracy_pct, {_ERR} AS avg_error,
          CAST(sum(total_predictions) AS BIGINT) AS total_predictions, max(window_end) AS last_updated
          FROM aggregates WHERE window_start >= {_VNOW} - INTERVAL 24 HOUR GROUP BY 1, 2""", "aggregates"),
)
def _current_accuracy(f):
    return query_view(f.spark, "v_current_accuracy", _VIEW_AS_OF, market_accuracy_aggregates=f.aggregates)


@check(
    "accuracy_trend",
    q(f"""SELECT date_trunc('hour', window_start) AS hour, location_name, market_type, {_PCT} AS accuracy_pct,
          CAST(sum(total_predictions) AS BIGINT) AS predictions
          FROM aggregates WHERE window_start >= {_VNOW} - INTERVAL 7 DAY GROUP BY 1, 2, 3""", "aggregates"),
)
def _trend(f):
    return query_view(f.spark, "v_accuracy_trend", _VIEW_AS_OF, market_accuracy_aggregates=f.aggregates)


@check(
    "recent_correlations",
    q(f"""SELECT location_name, market_type, correlation_method, actual_outcome, prediction_error, price AS yes_price,
          actual_temp_c, actual_precip_mm, poll_ts AS created_at FROM correlations
          WHERE poll_ts >= {_VNOW} - INTERVAL 24 HOUR ORDER BY poll_ts DESC""", "correlations"),
)
def _recent(f):
    stored = f.correlations.withColumnsRenamed({"price": "yes_price", "poll_ts": "created_at"})
    return query_view(f.spark, "v_recent_correlations", _VIEW_AS_OF, market_correlations=stored)


@check(
    "active_alerts",
    q("""SELECT alert_type, severity, location_name, market_type, message, metric_value, threshold_value, detected_at,
         CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3 WHEN 'low' THEN 4 END AS severity_rank
         FROM stored_alerts WHERE NOT is_resolved ORDER BY severity_rank, detected_at DESC""", "stored_alerts"),
)
def _active(f):
    return query_view(f.spark, "v_active_alerts", AS_OF, anomaly_alerts=f.stored_alerts)


@check(
    "top_recent_aggregates",
    q("""SELECT location_name, market_type, accuracy_rate, bias_score FROM aggregates
         ORDER BY updated_at DESC, location_name, market_type, window_start LIMIT 10""", "aggregates"),
)
def _top(f):
    return M.top_recent_aggregates(f.aggregates)


@check(
    "sample_limit",
    q("SELECT condition_id, location_name, correlation_method, prediction_error FROM correlations ORDER BY arrival LIMIT 5", "correlations"),
)
def _sample(f):
    return M.sample_rows(f.correlations, ["arrival"]).select(
        "condition_id", "location_name", "correlation_method", "prediction_error"
    )


@check(
    "time_window_filter",
    q(f"""SELECT health_id, recorded_at, recorded_at > {NOW} - INTERVAL 10 MINUTE AS last_10m,
          recorded_at >= {NOW} - INTERVAL 24 HOUR AS last_24h FROM health WHERE recorded_at >= {NOW} - INTERVAL 7 DAY""", "health"),
)
def _time_filter(f):
    from foretell.functions.times import within

    at = F.col("recorded_at")
    return f.health.where(within(at, AS_OF, "7 days")).select(
        "health_id",
        "recorded_at",
        within(at, AS_OF, "10 minutes", inclusive=False).alias("last_10m"),
        within(at, AS_OF, "24 hours").alias("last_24h"),
    )


@check(
    "labelled_counters",
    q("""SELECT 'correlation_matched_total' AS metric, 'correlation_method=' || correlation_method AS labels, count(*) AS value
         FROM correlations GROUP BY 2 UNION ALL
         SELECT 'weather_records_produced_total', 'weather_type=' || weather_type, count(*) FROM weather GROUP BY 2 UNION ALL
         SELECT 'anomaly_alerts_fired_total', 'alert_type=' || alert_type || ',severity=' || severity, count(*) FROM stored_alerts GROUP BY 2""",
      "correlations", "weather", "stored_alerts"),
)
def _counters(f):
    matched = M.labelled_counters(f.correlations, "correlation_matched_total", ["correlation_method"])
    produced = M.labelled_counters(f.weather, "weather_records_produced_total", ["weather_type"])
    fired = M.labelled_counters(f.stored_alerts, "anomaly_alerts_fired_total", ["alert_type", "severity"])
    return matched.unionByName(produced).unionByName(fired)

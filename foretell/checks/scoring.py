"""Outcomes, correlation, accuracy metrics, windows and baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from foretell.checks import check
from foretell.checks.sql import (
    NOW, batch_metrics, outcome_sql, q, rnd, stream_metrics, threshold_sql, units,
)
from foretell.functions import outcomes as O
from foretell.functions.times import latency_between_polls, latency_signed
from foretell.operators import accuracy as A
from foretell.operators import baseline as B
from foretell.operators import scoring as S
from foretell.operators import summaries as M
from foretell.operators.lookup import attach_weather, weather_snapshot
from foretell.plans import jobs as J
from foretell.plans.fixtures import AS_OF, Fixtures
from foretell.sources.session import scratch


def attached(f: Fixtures):
    return attach_weather(f.predictions, *weather_snapshot(f.weather))


# -- per-row rules -----------------------------------------------------------------


@check("f_to_c", f"SELECT event_id, {rnd('(value - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE', 2)} AS celsius FROM events")
def _f_to_c(f):
    return f.table("events").select("event_id", O.f_to_c(F.col("value")).alias("celsius"))


@check("c_to_f", f"SELECT event_id, {rnd('value * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE', 1)} AS fahrenheit FROM events")
def _c_to_f(f):
    return f.table("events").select("event_id", O.c_to_f(F.col("value")).alias("fahrenheit"))


@check(
    "compare_threshold",
    q(f"SELECT condition_id, {threshold_sql('th_value + (arrival % 23) - 11')} AS outcome, th_type AS kind "
      "FROM predictions", "predictions"),
)
def _compare_threshold(f):
    actual = F.col("threshold.value") + (F.col("arrival") % 23) - 11
    return f.predictions.select(
        "condition_id",
        O.compare_threshold(actual, F.col("threshold")).alias("outcome"),
        F.col("threshold.type").alias("kind"),
    )


@check(
    "weather_outcome",
    q(f"SELECT obs_id, m.market_type, {outcome_sql('m.market_type')} AS outcome FROM weather, "
      "(SELECT unnest(['RAIN','SNOW','TEMPERATURE','SUNSHINE','WIND','FOG','HAIL','CLOUD','FROST','WEATHER','VOLCANO']) AS market_type) m",
      "weather"),
)
def _weather_outcome(f):
    types = F.array(*[F.lit(t) for t in (*O.SETTLED_MARKETS, "VOLCANO")])
    rows = f.weather.withColumn("market_type", F.explode(types))
    return rows.select(
        "obs_id",
        "market_type",
        O.weather_outcome(
            F.col("market_type"), F.col("weather_code"), F.col("precip_mm"), F.col("rain_mm"),
            F.col("wind_kmh"), F.col("temp_c"),
        ).alias("outcome"),
    )


@check(
    "prediction_error",
    q(f"SELECT condition_id, {rnd('abs(price - CAST(winner AS INT))', 4)} AS prediction_error FROM predictions", "predictions"),
)
def _prediction_error(f):
    return f.predictions.select(
        "condition_id", O.prediction_error(F.col("price"), F.col("winner").cast("int")).alias("prediction_error")
    )


@check("latency_job", q(f"SELECT condition_id, CAST(datediff('second', poll_ts, {NOW}) AS BIGINT) AS latency FROM predictions", "predictions"))
def _latency_job(f):
    return f.predictions.select(
        "condition_id", latency_signed(F.col("poll_ts"), F.lit(AS_OF).cast("timestamp")).alias("latency")
    )


@check(
    "latency_polls",
    q("SELECT condition_id, CAST(abs(epoch_us(w_poll_ts) - epoch_us(poll_ts)) // 1000000 AS BIGINT) AS latency FROM attached", "attached"),
)
def _latency_polls(f):
    return attached(f).select(
        "condition_id", latency_between_polls(F.col("poll_ts"), F.col("w.poll_ts")).alias("latency")
    )


# -- the scored fact ------------------------------------------------------------------

_CORR = (
    "condition_id, location_name, market_type, market_status, price, winner, closed, end_date, poll_ts, volume,"
    " actual_outcome, correlation_method, prediction_error, correlation_latency, weather_type, observation_date,"
    " actual_temp_c, actual_temp_f, actual_precip_mm, actual_rain_mm, actual_weather_code, actual_wind_kmh, weather_poll_ts"
)


@check("correlate", q(f"SELECT {_CORR} FROM correlations", "correlations"))
def _correlate(f):
    return f.correlations.select(*[c.strip() for c in _CORR.split(",")])


@check(
    "flatten_weather",
    q("SELECT condition_id, weather_type, observation_date, temp_c AS actual_temp_c, temp_f AS actual_temp_f, "
      "precip_mm AS actual_precip_mm, rain_mm AS actual_rain_mm, weather_code AS actual_weather_code, "
      "wind_kmh AS actual_wind_kmh, w_poll_ts AS weather_poll_ts FROM attached", "attached"),
)
def _flatten_weather(f):
    return S.flatten_weather(attached(f).select("condition_id", "w"))


@check("failed_correlations", q("SELECT condition_id, market_type, weather_type FROM outcomes WHERE obs_id IS NOT NULL AND actual_outcome IS NULL", "outcomes"))
def _failed(f):
    return S.failed_correlations(attached(f)).select("condition_id", "market_type", F.col("w.weather_type").alias("weather_type"))


@check("drop_snapshot", q("SELECT condition_id, correlation_method FROM correlations WHERE correlation_method IS DISTINCT FROM 'current_snapshot'", "correlations"))
def _drop_snapshot(f):
    return A.drop_snapshot(f.correlations).select("condition_id", "correlation_method")


@check(
    "group_location_type",
    q("SELECT coalesce(nullif(location_name, 'London'), 'unknown') AS location_name, coalesce(nullif(market_type, 'RAIN'), 'WEATHER') AS market_type, "
      "count(*) AS n FROM correlations GROUP BY 1, 2", "correlations"),
)
def _group(f):
    holes = f.correlations.withColumns(
        {
            "location_name": F.nullif(F.col("location_name"), F.lit("London")),
            "market_type": F.nullif(F.col("market_type"), F.lit("RAIN")),
        }
    )
    return holes.groupBy(*A.group_keys()).agg(F.count(F.lit(1)).alias("n"))


@check(
    "accuracy_metrics_batch",
    q(batch_metrics("(SELECT * FROM correlations WHERE correlation_method IS DISTINCT FROM 'current_snapshot')", "location_name, market_type"), "correlations"),
)
def accuracy_metrics_batch(f):
    return A.accuracy(A.drop_snapshot(f.correlations), "batch")


@check("accuracy_metrics_batch_all", q(batch_metrics("correlations", "location_name, market_type"), "correlations"))
def _accuracy_all(f):
    return A.accuracy(f.correlations, "batch")


@check("accuracy_metrics_stream", q(stream_metrics("correlations", "location_name, market_type"), "correlations"))
def _accuracy_stream(f):
    return A.accuracy(f.correlations, "stream")


# -- windows ------------------------------------------------------------------------------

HOPS = (
    "(SELECT *, w AS window_start, w + INTERVAL 1 HOUR AS window_end FROM (SELECT *, "
    "unnest([time_bucket(INTERVAL 15 MINUTE, poll_ts) - INTERVAL (15 * k) MINUTE for k in [0, 1, 2, 3]]) AS w FROM correlations))"
)


@check("hopping_accuracy", q(stream_metrics(HOPS, "location_name, market_type, window_start, window_end"), "correlations"))
def _hopping(f):
    return A.hopping(f.correlations)


@check(
    "window_metadata",
    q(f"SELECT location_name, market_type, strftime(window_start, '%Y-%m-%dT%H:%M:%S+00:00') AS window_start, "
      f"strftime(window_end, '%Y-%m-%dT%H:%M:%S+00:00') AS window_end, '2024-01-31T00:00:00+00:00' AS poll_timestamp, total_predictions "
      f"FROM ({stream_metrics(HOPS, 'location_name, market_type, window_start, window_end')})", "correlations"),
)
def _window_metadata(f):
    from foretell.operators.accuracy import window_metadata

    return window_metadata(A.hopping(f.correlations), AS_OF).select(
        "location_name", "market_type", "window_start", "window_end", "poll_timestamp", "total_predictions"
    )


@check(
    "label_window",
    q(f"SELECT location_name, market_type, count(*) AS total_predictions, {NOW} - INTERVAL 1 HOUR AS window_start, {NOW} AS window_end "
      "FROM correlations WHERE correlation_method IS DISTINCT FROM 'current_snapshot' GROUP BY 1, 2", "correlations"),
)
def _label_window(f):
    rows = A.label_window(A.accuracy(A.drop_snapshot(f.correlations)), AS_OF)
    return rows.select("location_name", "market_type", "total_predictions", "window_start", "window_end")


@check(
    "mean_std_pop",
    f"""SELECT event_type, n, {rnd('CAST(s AS DOUBLE) / n / 1e4', 4)} AS mean,
          {rnd('sqrt(CAST(n::HUGEINT * v - s::HUGEINT * s AS DOUBLE)) / n / 1e4', 4)} AS std
        FROM (SELECT event_type, count(*) AS n, CAST(sum({units('value', 4)}) AS BIGINT) AS s,
                CAST(sum({units('value', 4)} * {units('value', 4)}) AS HUGEINT) AS v FROM events GROUP BY 1)""",
)
def _mean_std(f):
    return B.mean_std(f.table("events"), ["event_type"], F.col("value"))


_BASE = (
    "location_name, market_type, window_start, total_predictions, accuracy_rate, bias_score, {t4a} AS accuracy_threshold, "
    "{t4b} AS bias_threshold, acc_mean, acc_std, bias_mean, bias_std, baseline_source, baseline_n"
).format(t4a=rnd("accuracy_threshold", 6), t4b=rnd("bias_threshold", 6))


def _shown(df):
    from foretell.functions.numeric import round_to

    return df.select(
        "location_name", "market_type", "window_start", "total_predictions", "accuracy_rate", "bias_score",
        round_to(F.col("accuracy_threshold"), 6).alias("accuracy_threshold"),
        round_to(F.col("bias_threshold"), 6).alias("bias_threshold"),
        "acc_mean", "acc_std", "bias_mean", "bias_std", "baseline_source", "baseline_n",
    )


@check("baseline_7d", q(f"SELECT {_BASE} FROM judged", "judged"))
def _baseline(f):
    return _shown(B.baselines(f.aggregates))


# the reference's per-key lookup of the same rows is the window frame itself
@check("baseline_lookup", q("""
    SELECT a.location_name, a.market_type, a.window_end, count(*) AS points,
      CAST(sum(b.total_predictions) AS BIGINT) AS predictions
    FROM aggregates a JOIN aggregates b ON b.location_name = a.location_name AND b.market_type = a.market_type
      AND b.window_end BETWEEN a.window_end - INTERVAL 7 DAY AND a.window_end GROUP BY 1, 2, 3""", "aggregates"))
def _baseline_lookup(f):
    return B.history(f.aggregates).select("location_name", "market_type", "window_end", "points", "predictions")


@check("baseline_state", q(f"SELECT {_BASE} FROM judged_stream", "judged_stream"))
def _baseline_state(f):
    return _shown(B.baselines(f.aggregates, abs_bias=False, min_total=10))


# -- run reports ------------------------------------------------------------------------------


_ERROR_SUM = f"CAST(sum({units('prediction_error', 4)}) AS BIGINT)"
_AVG_ERROR = rnd(f"{_ERROR_SUM} / count(prediction_error) / 1e4", 4)


@check(
    "method_breakdown",
    q(f"SELECT correlation_method, count(*) AS n, {_AVG_ERROR} AS avg_error FROM correlations GROUP BY 1", "correlations"),
)
def _methods(f):
    return M.method_breakdown(f.correlations)


@check(
    "latency_histogram",
    q("""SELECT le, CAST(sum(CASE WHEN le = '+Inf' OR latency <= CAST(nullif(le, '+Inf') AS BIGINT) THEN 1 ELSE 0 END) AS BIGINT) AS cumulative,
           CAST(sum(latency) AS BIGINT) AS sum_sec, count(*) AS n
         FROM (SELECT CAST(abs(epoch_us(weather_poll_ts) - epoch_us(poll_ts)) // 1000000 AS BIGINT) AS latency FROM correlations),
           (SELECT unnest(['30','60','120','300','600','1800','3600','+Inf']) AS le) GROUP BY le""", "correlations"),
)
def _histogram(f):
    return M.latency_histogram(S.correlate(attached(f)))


@check("prediction_span", q("SELECT count(*) AS n, min(poll_ts) AS first_poll, max(poll_ts) AS last_poll FROM predictions", "predictions"))
def _span(f):
    return M.prediction_span(f.predictions)


@check(
    "join_coverage",
    q(f"SELECT count(*) AS total, count(actual_outcome) AS matched, count(actual_outcome)::DOUBLE / count(*) AS coverage, "
      f"{rnd('count(actual_outcome)::DOUBLE / count(*) * 100', 2)} AS coverage_pct FROM outcomes", "outcomes"),
)
def _coverage(f):
    from foretell.operators.alerts import join_coverage

    return join_coverage(S.with_outcome(attached(f)))


@check(
    "run_coverage",
    q(f"SELECT (SELECT count(*) FROM predictions) AS total, count(*) AS correlated, "
      f"{rnd('count(*)::DOUBLE / (SELECT count(*) FROM predictions)', 4)} AS coverage FROM correlations", "correlations"),
)
def _run_coverage(f):
    return M.run_report(f.correlations, f.predictions)


# -- jobs ---------------------------------------------------------------------------------------

# every market is polled twice: open at another price first, then as it is
@check(
    "correlation_job",
    q(f"SELECT {_CORR} FROM correlations", "correlations").replace(
        "FROM predictions p LEFT JOIN exact",
        "FROM (SELECT * REPLACE (CASE WHEN closed THEN price ELSE 1 - price END AS price) FROM predictions) p LEFT JOIN exact", 1),
)
def _correlation_job(f):
    open_first = f.predictions.withColumns(
        {
            "price": 1 - F.col("price"),
            "winner": F.lit(None).cast("boolean"),
            "closed": F.lit(False),
            "market_status": F.lit("open"),
            "arrival": F.col("arrival") * 2,
        }
    )
    polls = open_first.unionByName(f.predictions.withColumn("arrival", F.col("arrival") * 2 + 1))
    rows = J.correlation_job(polls, f.weather, AS_OF, store=scratch(f.spark, "resolved"))
    return rows.select(*[c.strip() for c in _CORR.split(",")])


# every third market has an earlier record, which only a decided one replaces
_FIRST = "(arrival % 3 = 0 AND correlation_method IS DISTINCT FROM 'winner_known')"
_RECORDS = f"""(SELECT * REPLACE (CASE WHEN {_FIRST} THEN 'historical_weather' ELSE correlation_method END AS correlation_method,
    CASE WHEN {_FIRST} THEN 1 - price ELSE price END AS price) FROM correlations)"""
_SETTLED = f"(SELECT * FROM {_RECORDS} WHERE correlation_method IS DISTINCT FROM 'current_snapshot')"


def _job_records(f):
    early = f.correlations.where("arrival % 3 = 0").withColumns(
        {"correlation_method": F.lit("historical_weather"), "price": 1 - F.col("price"), "arrival": F.col("arrival") * 2}
    )
    return early.unionByName(f.correlations.withColumn("arrival", F.col("arrival") * 2 + 1))


def _aggregation_job(f):
    stored = f.correlations.where("arrival % 2 = 0")
    return J.aggregation_job(_job_records(f), stored, f.aggregates, AS_OF)


@check(
    "aggregation_job",
    q(f"""SELECT * FROM aggregates UNION ALL BY NAME
          SELECT *, {NOW} - INTERVAL 1 HOUR AS window_start, {NOW} AS window_end, {NOW} AS updated_at
          FROM ({batch_metrics(_SETTLED, 'location_name, market_type')})""", "aggregates"),
)
def _job_aggregates(f):
    return _aggregation_job(f)[1]


@check(
    "aggregation_job_correlations",
    q(f"""SELECT condition_id, price, correlation_method FROM correlations WHERE arrival % 2 = 0
          UNION ALL SELECT condition_id, price, correlation_method FROM {_SETTLED} WHERE arrival % 2 <> 0""", "correlations"),
)
def _job_correlations(f):
    return _aggregation_job(f)[0].select("condition_id", "price", "correlation_method")

"""Lookup joins, semi/anti joins and one-row-per-key operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from foretell.checks import check
from foretell.checks.sql import NOW, q
from foretell.operators import alerts as L
from foretell.operators import toprow as T
from foretell.operators.lookup import attach_weather, unmatched_predictions, weather_snapshot
from foretell.plans.fixtures import AS_OF, POLL_ORDER
from foretell.plans.views import query_view

_OBS = "obs_id, location_name, weather_type, observation_date, poll_ts, weather_code"


@check("weather_snapshot", q(f"SELECT {_OBS} FROM exact UNION ALL SELECT {_OBS} FROM place", "exact", "place"))
def _snapshot(f):
    exact, current = weather_snapshot(f.weather)
    return exact.unionByName(current).select(*_OBS.split(", "))


@check(
    "two_tier_lookup_join",
    q("SELECT condition_id, location_name, end_date, obs_id, weather_type, observation_date FROM attached", "attached"),
)
def _two_tier(f):
    rows = attach_weather(f.predictions, *weather_snapshot(f.weather))
    return rows.select("condition_id", "location_name", "end_date", "w.obs_id", "w.weather_type", "w.observation_date")


# every place has weather in the data, so two places lose theirs here
@check(
    "unmatched_predictions",
    q("""SELECT condition_id, p.location_name, end_date FROM predictions p
         WHERE NOT EXISTS (SELECT 1 FROM weather w WHERE w.location_name = p.location_name
             AND w.location_name NOT IN ('Tokyo', 'Paris')
             AND (w.weather_type <> 'historical' OR w.observation_date = p.end_date))""", "predictions", "weather"),
)
def _unmatched(f):
    weather = f.weather.where(~F.col("location_name").isin("Tokyo", "Paris"))
    return unmatched_predictions(f.predictions, weather).select("condition_id", "location_name", "end_date")


# -- deduplication -----------------------------------------------------------------


@check(
    "dedup_prefer_closed",
    q("""SELECT condition_id, closed, arrival, part, amount FROM polls WHERE condition_id IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY condition_id ORDER BY closed DESC, arrival, part, amount) = 1""", "polls"),
)
def _closed(f):
    return T.prefer_closed(f.polls, POLL_ORDER).select("condition_id", "closed", "arrival", "part", "amount")


@check(
    "dedup_prefer_winner",
    q("""SELECT condition_id, correlation_method, arrival, part, amount FROM (
           SELECT * FROM polls WHERE condition_id IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY condition_id
             ORDER BY correlation_method = 'winner_known' DESC, arrival, part, amount) = 1)
         UNION ALL SELECT condition_id, correlation_method, arrival, part, amount FROM polls WHERE condition_id IS NULL""", "polls"),
)
def _winner(f):
    return T.prefer_winner(f.polls, POLL_ORDER).select("condition_id", "correlation_method", "arrival", "part", "amount")


@check(
    "dedup_first_seen",
    q("""SELECT condition_id, arrival, part, amount FROM (SELECT * FROM polls WHERE condition_id IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY condition_id ORDER BY arrival, part, amount) = 1) WHERE is_arbitrage""", "polls"),
)
def _first_seen(f):
    return T.first_seen(f.polls, POLL_ORDER).where("is_arbitrage").select("condition_id", "arrival", "part", "amount")


@check(
    "latest_aggregate",
    q("""SELECT location_name, market_type, coalesce(accuracy_rate, 0) AS accuracy_rate, coalesce(bias_score, 0) AS bias_score,
           coalesce(total_predictions, 0) AS total_predictions, window_start, window_end FROM aggregates
         QUALIFY row_number() OVER (PARTITION BY location_name, market_type ORDER BY window_start DESC) = 1""", "aggregates"),
)
def _latest_aggregate(f):
    return L.latest_aggregate(f.aggregates).select(
        "location_name", "market_type", "accuracy_rate", "bias_score", "total_predictions", "window_start", "window_end"
    )


@check("latest_health", q("SELECT component, status, recorded_at, messages_processed, error_count FROM latest_health", "latest_health"))
def _latest_health(f):
    return L.latest_health(f.health).select("component", "status", "recorded_at", "messages_processed", "error_count")


@check(
    "latest_health_subquery",
    q("""SELECT component, status, messages_processed, error_count, last_message_at, latency_ms, recorded_at FROM health h
         WHERE recorded_at = (SELECT max(recorded_at) FROM health x WHERE x.component = h.component)""", "health"),
)
def _latest_health_subquery(f):
    # ties stay, as in the correlated form (see pipeline_health_view for that one)
    return T.latest_with_ties(f.health, ["component"], "recorded_at").drop("health_id")


@check(
    "pipeline_health_view",
    q("""SELECT component, status, messages_processed, error_count, last_message_at, latency_ms, recorded_at FROM health h
         WHERE recorded_at = (SELECT max(recorded_at) FROM health x WHERE x.component = h.component) ORDER BY component""", "health"),
)
def _health_view(f):
    return query_view(f.spark, "v_pipeline_health", AS_OF, pipeline_health=f.health)


@check(
    "health_semi_join",
    q(f"""SELECT alert_id, location_name, is_resolved FROM stored_alerts a WHERE EXISTS (
           SELECT 1 FROM latest_health l WHERE l.component = a.location_name AND l.recorded_at > {NOW} - INTERVAL 10 MINUTE)""",
      "stored_alerts", "latest_health"),
)
def _semi(f):
    return L.health_semi_join(f.stored_alerts, f.health, AS_OF).select("alert_id", "location_name", "is_resolved")


@check("never_reported_anti_join", q("SELECT component FROM expected WHERE component NOT IN (SELECT component FROM health)", "expected", "health"))
def _never(f):
    return L.never_reported(f.expected, f.health)


@check(
    "compacted_view",
    q("SELECT location_name, market_type, metric_value, detected_at FROM stored_alerts "
      "QUALIFY row_number() OVER (PARTITION BY alert_type, location_name, market_type ORDER BY alert_id DESC) = 1", "stored_alerts"),
)
def _compacted(f):
    from foretell.sources.tables import compacted_view

    newest = compacted_view(f.stored_alerts, ["alert_type", "location_name", "market_type"], "alert_id")
    return newest.select("location_name", "market_type", "metric_value", "detected_at")

"""The fixture mapping and shared rules as SQL for DuckDB."""

from __future__ import annotations

from foretell.plans.fixtures import AS_OF, CITIES, ODD_PLACES, TYPES

NOW = f"TIMESTAMP '{AS_OF}'"


def lst(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def units(e: str, k: int) -> str:
    s = f"1e{k}"
    return (
        f"(CASE WHEN ({e}) < 0 THEN -CAST(floor(-({e}) * {s} + 0.5) AS BIGINT)"
        f" ELSE CAST(floor(({e}) * {s} + 0.5) AS BIGINT) END)"
    )


def rnd(e: str, k: int) -> str:
    return f"({units(e, k)} / 1e{k})"


def fix(e: str, k: int) -> str:
    return f"printf('%.{k}f', {rnd(e, k)})"


def sfix(e: str, k: int) -> str:
    return f"printf('%+.{k}f', {rnd(e, k)})"


def pct(e: str, k: int) -> str:
    return f"({fix(f'({e}) * 100.0::DOUBLE', k)} || '%')"


RAIN = "(51,53,55,56,57,61,63,65,66,67,80,81,82)"
SNOW = "(71,73,75,77,85,86)"
PRECIP = "(51,53,55,56,57,61,63,65,66,67,80,81,82,71,73,75,77,85,86)"


def outcome_sql(m: str, p: str = "") -> str:
    """Weather rules; ``p`` prefixes the weather columns."""
    wet = f"coalesce({p}precip_mm, 0) > 0.1"
    rain = f"coalesce({p}rain_mm, 0) > 0.1"
    code = f"{p}weather_code"
    return f"""CASE {m}
      WHEN 'RAIN' THEN CASE WHEN {code} IS NOT NULL THEN CAST({code} IN {RAIN} AS INT) ELSE CAST({wet} OR {rain} AS INT) END
      WHEN 'SNOW' THEN CASE WHEN {code} IS NOT NULL THEN CAST({code} IN {SNOW} AS INT) ELSE 0 END
      WHEN 'SUNSHINE' THEN CAST({code} IN (0,1) AS INT)
      WHEN 'WIND' THEN CAST({p}wind_kmh > 30 AS INT)
      WHEN 'FOG' THEN CAST({code} IN (45,48) AS INT)
      WHEN 'HAIL' THEN CAST({code} IN (96,99) AS INT)
      WHEN 'CLOUD' THEN CAST({code} IN (2,3) AS INT)
      WHEN 'FROST' THEN CAST({p}temp_c <= 0 AS INT)
      WHEN 'WEATHER' THEN CASE WHEN {code} IS NOT NULL THEN CAST({code} IN {PRECIP} AS INT) ELSE CAST({wet} AS INT) END
      END"""


def threshold_sql(f: str) -> str:
    a = f"(CASE WHEN th_unit = 'C' THEN {rnd(f'(({f}) - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE', 2)} ELSE ({f}) END)"
    return f"""CASE th_type WHEN 'above' THEN CAST({a} >= th_value AS INT)
      WHEN 'below' THEN CAST({a} <= th_value AS INT)
      WHEN 'between' THEN CASE WHEN th_min IS NOT NULL AND th_max IS NOT NULL
        THEN CAST({a} >= th_min AND {a} <= th_max AS INT) END END"""


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def q(final: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    head = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {head}\n{final}" if head else final


cte("weather", (), f"""
  SELECT event_id AS obs_id, ({lst(CITIES)})[CAST(user_id % 25 AS INT) + 1] AS location_name,
    CASE WHEN event_type IN ('view','purchase','signup') THEN 'historical' ELSE 'current' END AS weather_type,
    CAST(ts AS DATE) AS observation_date, ts AS poll_ts,
    value - 20 AS temp_c, (value - 20) * 9 / 5 + 32 AS temp_f,
    CASE WHEN event_id % 3 = 0 THEN value / 10 ELSE 0.0::DOUBLE END AS precip_mm,
    CASE WHEN event_id % 2 = 0 THEN CASE WHEN event_id % 3 = 0 THEN value / 10 ELSE 0.0::DOUBLE END ELSE 0.0::DOUBLE END AS rain_mm,
    CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INT) END AS weather_code,
    CASE WHEN event_type <> 'signup' THEN value END AS wind_kmh
  FROM events""")

cte("predictions", (), f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS condition_id, 'Question ' || o_orderkey AS question,
    ({lst(CITIES)})[c_nationkey + 1] AS location_name,
    ({lst(TYPES)})[CAST(o_orderkey % 11 AS INT) + 1] AS market_type,
    CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS market_status,
    CAST((o_orderkey * 37) % 101 AS DOUBLE) / 100.0::DOUBLE AS price,
    CASE WHEN o_orderstatus = 'F' AND o_custkey % 10 <> 0 THEN o_custkey % 2 = 0 END AS winner,
    o_orderstatus = 'F' AS closed,
    CAST(DATE '2024-01-01' + CAST(o_orderkey % 40 AS INT) AS DATE) AS end_date,
    TIMESTAMP '2024-01-01' + to_seconds((o_orderkey * 173) % 2592000) AS poll_ts,
    o_totalprice AS volume,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 50 AS DOUBLE) END AS th_value,
    CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 3 = 2 THEN CAST(o_orderkey % 50 AS DOUBLE) END AS th_min,
    CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 3 = 2 THEN CAST(o_orderkey % 50 AS DOUBLE) + 10 END AS th_max,
    CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE 'F' END END AS th_unit,
    CASE WHEN o_orderkey % 7 <> 0 THEN (['above','below','between'])[CAST(o_orderkey % 3 AS INT) + 1] END AS th_type,
    o_orderkey AS arrival
  FROM orders JOIN customer ON o_custkey = c_custkey""")

cte("exact", ("weather",), """
  SELECT * FROM weather WHERE weather_type = 'historical'
  QUALIFY row_number() OVER (PARTITION BY location_name, observation_date ORDER BY poll_ts DESC, obs_id DESC) = 1""")
cte("place", ("weather",), """
  SELECT * FROM weather WHERE weather_type <> 'historical'
  QUALIFY row_number() OVER (PARTITION BY location_name ORDER BY poll_ts DESC, obs_id DESC) = 1""")

_W = ("obs_id", "weather_type", "observation_date", "temp_c", "temp_f", "precip_mm", "rain_mm", "weather_code", "wind_kmh")
_PICK = ", ".join(f"CASE WHEN e.obs_id IS NOT NULL THEN e.{c} ELSE c.{c} END AS {c}" for c in _W)
cte("attached", ("predictions", "exact", "place"), f"""
  SELECT p.*, {_PICK}, CASE WHEN e.obs_id IS NOT NULL THEN e.poll_ts ELSE c.poll_ts END AS w_poll_ts
  FROM predictions p LEFT JOIN exact e ON e.location_name = p.location_name AND e.observation_date = p.end_date
  LEFT JOIN place c ON c.location_name = p.location_name""")
cte("outcomes", ("attached",), f"""
  SELECT *, CASE WHEN obs_id IS NULL THEN NULL
      WHEN closed AND winner IS NOT NULL THEN CAST(winner AS INT)
      WHEN market_type = 'TEMPERATURE' THEN {threshold_sql('temp_f')}
      ELSE {outcome_sql('market_type')} END AS actual_outcome,
    CASE WHEN closed AND winner IS NOT NULL THEN 'winner_known'
      WHEN weather_type = 'historical' THEN 'historical_weather' ELSE 'current_snapshot' END AS method
  FROM attached""")
cte("correlations", ("outcomes",), f"""
  SELECT condition_id, question, location_name, market_type, market_status, price, winner, closed, end_date,
    poll_ts, volume, arrival, actual_outcome, method AS correlation_method,
    {rnd('abs(price - actual_outcome)', 4)} AS prediction_error,
    CAST(datediff('second', poll_ts, {NOW}) AS BIGINT) AS correlation_latency,
    weather_type, observation_date, temp_c AS actual_temp_c, temp_f AS actual_temp_f,
    precip_mm AS actual_precip_mm, rain_mm AS actual_rain_mm, weather_code AS actual_weather_code,
    wind_kmh AS actual_wind_kmh, w_poll_ts AS weather_poll_ts
  FROM outcomes WHERE actual_outcome IS NOT NULL""")

HIT = "coalesce((actual_outcome = 1 AND price >= 0.5) OR (actual_outcome = 0 AND price < 0.5), false)"
REL = "(correlation_method IS DISTINCT FROM 'current_snapshot')"
VOL = "CAST(coalesce(volume, 1) AS DECIMAL(24,6))"
SVOL = "CAST(coalesce(nullif(volume, 0), 1) AS DECIMAL(24,6))"


def batch_metrics(source: str, keys: str, extra: str = "") -> str:
    """``keys``: comma list of output key columns of ``source``."""
    return f"""
  SELECT {keys}{extra}, n AS total_predictions, n_correct AS correct_predictions,
    {rnd('acc', 4)} AS accuracy_rate,
    CASE WHEN n_error > 0 THEN {rnd('CAST(eu AS DOUBLE) / CAST(n_error AS DOUBLE) / 1e4', 4)} ELSE 0 END AS avg_prediction_error,
    coalesce({rnd('mn', 4)}, 0) AS min_prediction_error, coalesce({rnd('mx', 4)}, 0) AS max_prediction_error,
    {rnd('CAST(vol AS DOUBLE)', 2)} AS total_volume,
    {rnd('CASE WHEN vol > 0 THEN CAST(hv AS DOUBLE) / CAST(vol AS DOUBLE) ELSE acc END', 4)} AS volume_weighted_accuracy,
    CASE WHEN n_out > 0 THEN {rnd('CAST(pu AS DOUBLE) / 1e4 / n_out - CAST(os AS DOUBLE) / n_out', 4)} ELSE 0 END AS bias_score,
    n_over AS over_prediction_count, n_under AS under_prediction_count
  FROM (SELECT *, CAST(n_correct AS DOUBLE) / (CASE WHEN n_rel > 0 THEN n_rel ELSE n END) AS acc FROM (
    SELECT {keys}, count(*) AS n, count(*) FILTER ({REL}) AS n_rel,
      count(*) FILTER ({REL} AND {HIT}) AS n_correct, count(prediction_error) AS n_error,
      CAST(sum({units('prediction_error', 4)}) AS BIGINT) AS eu, min(prediction_error) AS mn, max(prediction_error) AS mx,
      sum({VOL}) AS vol, coalesce(sum({VOL}) FILTER ({HIT}), 0) AS hv, count(actual_outcome) AS n_out,
      CAST(coalesce(sum({units('coalesce(price, 0.5)', 4)}) FILTER (actual_outcome IS NOT NULL), 0) AS BIGINT) AS pu,
      CAST(coalesce(sum(actual_outcome), 0) AS BIGINT) AS os,
      count(*) FILTER (coalesce(price, 0) > 0.5 AND actual_outcome = 0) AS n_over,
      count(*) FILTER (coalesce(price, 0) <= 0.5 AND actual_outcome = 1) AS n_under
    FROM {source} GROUP BY {keys}))"""


def stream_metrics(source: str, keys: str) -> str:
    counted = f"({REL} AND actual_outcome IS NOT NULL AND price IS NOT NULL)"
    return f"""
  SELECT {keys}, n AS total_predictions, n_correct AS correct_predictions,
    {rnd('acc', 4)} AS accuracy_rate,
    CASE WHEN n_error > 0 THEN {rnd('CAST(eu AS DOUBLE) / CAST(n_error AS DOUBLE) / 1e4', 4)} ELSE 0 END AS avg_prediction_error,
    {rnd('CASE WHEN vol > 0 THEN CAST(hv AS DOUBLE) / CAST(vol AS DOUBLE) ELSE acc END', 4)} AS volume_weighted_accuracy,
    CASE WHEN nc > 0 THEN {rnd('CAST(pu AS DOUBLE) / 1e4 / nc - CAST(os AS DOUBLE) / nc', 4)} ELSE 0 END AS bias_score,
    n_over AS over_prediction_count, n_under AS under_prediction_count
  FROM (SELECT *, CAST(n_correct AS DOUBLE) / greatest(nc, 1) AS acc FROM (
    SELECT {keys}, count(*) AS n, count(*) FILTER ({counted}) AS nc,
      count(*) FILTER ({counted} AND {HIT}) AS n_correct,
      count(prediction_error) FILTER ({REL}) AS n_error,
      CAST(sum({units('prediction_error', 4)}) FILTER ({REL}) AS BIGINT) AS eu,
      coalesce(sum({SVOL}) FILTER ({counted}), 0) AS vol, coalesce(sum({SVOL}) FILTER ({counted} AND {HIT}), 0) AS hv,
      CAST(coalesce(sum({units('price', 4)}) FILTER ({counted}), 0) AS BIGINT) AS pu,
      CAST(coalesce(sum(actual_outcome) FILTER ({counted}), 0) AS BIGINT) AS os,
      count(*) FILTER ({counted} AND price > 0.5 AND actual_outcome = 0) AS n_over,
      count(*) FILTER ({counted} AND price <= 0.5 AND actual_outcome = 1) AS n_under
    FROM {source} GROUP BY {keys}))"""


cte("daily_rows", ("correlations",), """
  SELECT * REPLACE ('ALL' AS market_type), date_trunc('day', poll_ts) AS window_start
  FROM correlations WHERE correlation_method IS DISTINCT FROM 'current_snapshot'""")
cte("aggregates", ("daily_rows",), f"""
  SELECT *, window_start + INTERVAL 1 DAY AS window_end, window_start + INTERVAL 25 HOUR AS updated_at
  FROM ({batch_metrics('daily_rows', 'location_name, market_type, window_start')})""")


def rolling(source: str, bias: str, days: int = 7) -> str:
    return f"""
  SELECT *, count(*) OVER f AS n_rows, CAST(sum(au) OVER f AS BIGINT) AS s_acc, CAST(sum(au * au) OVER f AS BIGINT) AS q_acc,
    CAST(sum(bu) OVER f AS BIGINT) AS s_bias, CAST(sum(bu * bu) OVER f AS BIGINT) AS q_bias
  FROM (SELECT *, {units('accuracy_rate', 4)} AS au, {units(bias, 4)} AS bu FROM {source})
  WINDOW f AS (PARTITION BY location_name, market_type ORDER BY window_end
               RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND CURRENT ROW)"""


def judged(rolled: str) -> str:
    def mean(s):
        return f"(CAST({s} AS DOUBLE) / CAST(n_rows AS DOUBLE) / 1e4)"

    def std(s, v):
        return f"(sqrt(CAST(CAST(n_rows AS HUGEINT) * {v} - CAST({s} AS HUGEINT) * {s} AS DOUBLE)) / CAST(n_rows AS DOUBLE) / 1e4)"

    am, ad, bm, bd = mean("s_acc"), std("s_acc", "q_acc"), mean("s_bias"), std("s_bias", "q_bias")
    return f"""
  SELECT * EXCLUDE (n_rows, s_acc, q_acc, s_bias, q_bias, au, bu),
    CASE WHEN n_rows >= 3 THEN greatest(0.0::DOUBLE, {am} - 2.0::DOUBLE * {ad}) ELSE 0.8::DOUBLE END AS accuracy_threshold,
    CASE WHEN n_rows >= 3 THEN {bm} + 2.0::DOUBLE * {bd} ELSE 0.3::DOUBLE END AS bias_threshold,
    CASE WHEN n_rows >= 3 THEN {rnd(am, 4)} END AS acc_mean, CASE WHEN n_rows >= 3 THEN {rnd(ad, 4)} END AS acc_std,
    CASE WHEN n_rows >= 3 THEN {rnd(bm, 4)} END AS bias_mean, CASE WHEN n_rows >= 3 THEN {rnd(bd, 4)} END AS bias_std,
    CASE WHEN n_rows >= 3 THEN '7day_statistical' ELSE 'static_fallback' END AS baseline_source,
    n_rows AS baseline_n
  FROM ({rolled})"""


cte("judged", ("aggregates",), judged(rolling("aggregates", "abs(bias_score)")))
cte("thick", ("aggregates",), "SELECT * FROM aggregates WHERE total_predictions >= 10")
cte("judged_stream", ("thick",), judged(rolling("thick", "bias_score")))

cte("polls", (), f"""
  SELECT CASE WHEN l_orderkey % 10 <> 3 THEN CAST(l_orderkey AS VARCHAR) END AS condition_id,
    l_linestatus = 'F' AS closed, l_orderkey * 10 + l_linenumber AS arrival, l_partkey AS part, l_extendedprice AS amount,
    CASE WHEN l_linestatus = 'F' THEN 'winner_known' ELSE 'historical_weather' END AS correlation_method,
    l_returnflag = 'R' AS is_arbitrage,
    ({lst(CITIES)})[CAST(l_suppkey % 25 AS INT) + 1] AS location_name,
    ({lst(TYPES)})[CAST(l_partkey % 11 AS INT) + 1] AS market_type,
    CAST((l_partkey * 37) % 101 AS DOUBLE) / 100.0::DOUBLE AS price,
    CASE WHEN l_orderkey % 4 <> 0 THEN l_discount * 5 + 0.1::DOUBLE END AS base_rate,
    CASE WHEN l_orderkey % 5 <> 0 THEN l_tax * 8 END AS deviation_from_base
  FROM lineitem""")

cte("questions", ("predictions",), f"""
  SELECT 'm' || arrival AS id, CASE arrival % 8
      WHEN 0 THEN 'Will it rain in ' || location_name || ' on ' || CAST(end_date AS VARCHAR) || '?'
      WHEN 1 THEN 'Will the temperature in ' || location_name || ' exceed ' || (arrival % 50) || '°F?'
      WHEN 2 THEN 'Will there be fog in ' || location_name || ' today?'
      WHEN 3 THEN 'Will it snow in  ' || location_name || ' tomorrow?'
      WHEN 4 THEN 'Will it be sunny in ' || location_name || ' at today?'
      WHEN 5 THEN 'Will it be below ' || (arrival % 50) || ' degrees in ' || location_name || ', or not?'
      WHEN 6 THEN 'Will the home team win the 2024 final?'
      ELSE 'A hurricane? Expect wind in ' || ({lst(ODD_PLACES)})[CAST((arrival // 8) % 4 AS INT) + 1] || ' tomorrow, freezing'
    END AS question, arrival, location_name, price, winner, closed, end_date, poll_ts, volume
  FROM predictions""")

cte("gazetteer", (), f"""
  SELECT ({lst(CITIES)})[n_nationkey + 1] AS city_name, n_nationkey % 9 <> 8 AS verified,
    n_nationkey * 1.5::DOUBLE AS lat, n_nationkey * -2.5::DOUBLE AS lon,
    CASE WHEN n_nationkey % 4 <> 0 THEN 'Zone/' || n_nationkey END AS timezone FROM nation""")

cte("markets", ("questions",), """
  SELECT id, question, 'slug-' || arrival AS slug, 'https://example.org/' || arrival AS url,
    CASE WHEN arrival % 11 = 3 THEN 'MULTIPLE_CHOICE' ELSE 'BINARY' END AS outcome_type,
    CASE WHEN winner THEN 'YES' WHEN NOT winner THEN 'NO' WHEN closed THEN 'MKT' END AS resolution,
    CASE WHEN arrival % 19 <> 0 THEN CAST((arrival * 37) % 10007 AS DOUBLE) / 10007.0::DOUBLE END AS probability,
    closed AS is_resolved,
    CASE WHEN arrival % 23 = 0 THEN 0 ELSE epoch_ms(CAST(end_date AS TIMESTAMP)) END AS close_time,
    CASE WHEN arrival % 6 <> 0 THEN volume END AS volume,
    CASE WHEN arrival % 9 <> 0 THEN CAST(arrival % 50 AS INT) END AS bettors, end_date, arrival
  FROM questions""")


def base_rate(m: str) -> str:
    return f"""(CASE {m} WHEN 'RAIN' THEN 0.35::DOUBLE WHEN 'SNOW' THEN 0.15::DOUBLE WHEN 'TEMPERATURE' THEN 0.5::DOUBLE
      WHEN 'SUNSHINE' THEN 0.55::DOUBLE WHEN 'WIND' THEN 0.4::DOUBLE WHEN 'FOG' THEN 0.2::DOUBLE WHEN 'HAIL' THEN 0.1::DOUBLE
      WHEN 'FROST' THEN 0.2::DOUBLE WHEN 'WEATHER' THEN 0.4::DOUBLE ELSE 0.4::DOUBLE END)"""


cte("health", (), """
  SELECT 'feed_' || (user_id % 25) AS component,
    CASE WHEN event_type = 'error' THEN 'degraded' ELSE 'healthy' END AS status,
    CAST(floor(value) AS BIGINT) AS messages_processed,
    CAST(event_type = 'error' AS BIGINT) AS error_count, ts AS last_message_at,
    event_id % 1000 AS latency_ms, ts AS recorded_at, event_id AS health_id
  FROM events""")
cte("latest_health", ("health",), """
  SELECT * FROM health QUALIFY row_number() OVER (PARTITION BY component ORDER BY recorded_at DESC) = 1""")
cte("expected", (), """
  SELECT 'feed_' || n_nationkey AS component FROM nation
  UNION ALL SELECT 'feed_' || (r_regionkey + 25) FROM region WHERE r_regionkey < 2""")

cte("stored_alerts", (), f"""
  SELECT event_id AS alert_id, CASE WHEN event_id % 2 = 0 THEN 'producer_timeout' ELSE 'accuracy_drop' END AS alert_type,
    (['low','medium','high','critical'])[CAST(user_id % 4 AS INT) + 1] AS severity,
    CASE WHEN event_id % 2 = 0 THEN 'feed_' || (user_id % 25) ELSE ({lst(CITIES)})[CAST(user_id % 25 AS INT) + 1] END AS location_name,
    CASE WHEN event_id % 2 = 0 THEN 'SYSTEM' ELSE 'ALL' END AS market_type,
    'alert ' || event_id AS message, value AS metric_value, 10.0::DOUBLE AS threshold_value,
    event_id % 3 = 0 AS is_resolved, CASE WHEN event_id % 3 = 0 THEN ts END AS resolved_at, ts AS detected_at
  FROM events""")

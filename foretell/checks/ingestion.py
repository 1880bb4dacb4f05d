"""Scans, decoding, contracts, parsing and flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from foretell import constants as C
from foretell.checks import check
from foretell.checks.sql import NOW, base_rate, q, rnd
from foretell.checks.texts import CITY_SQL, _TYPE
from foretell.functions import times as D
from foretell.operators import alerts as L
from foretell.operators import ingest as I
from foretell.operators import quality as Q
from foretell.operators import summaries as M
from foretell.plans.fixtures import AS_OF
from foretell.schemas import RAW_CURRENT, RAW_DAILY
from foretell.sources import topics
from foretell.sources.tables import scan_table

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@check("src_bounded_topic", "SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE props IS NOT NULL")
def _bounded(f):
    return topics.read_bounded(f.spark, f"{f.folder}/events.parquet", EVENT_SCHEMA, value="props")


# every seventh record is cut off, every eleventh is not JSON at all
@check(
    "decode_json_or_avro",
    """SELECT event_id, CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INT) END AS k,
         event_id % 7 <> 0 AND event_id % 11 <> 0 AS decoded FROM events""",
)
def _decode(f):
    e = f.table("events")
    raw = (
        F.when(F.col("event_id") % 7 == 0, F.substring("props", 1, 4))
        .when(F.col("event_id") % 11 == 0, F.lit("not json"))
        .otherwise(F.col("props"))
    )
    records = e.select("event_id", raw.cast("binary").alias("value"))
    decoded = topics.decode(f.spark, records, "k int")
    return decoded.select(
        "event_id", F.col("record.k").alias("k"), F.col("record").isNotNull().alias("decoded")
    )


def _contract_rows(f):
    k = F.col("arrival")
    return f.predictions.select(
        F.when(k % 13 != 0, F.col("condition_id")).alias("condition_id"),
        F.when(k % 5 != 0, F.col("question")).alias("question"),
        "location_name",
        "market_type",
        "market_status",
        F.col("price").alias("yes_price"),
        "winner",
        "closed",
        F.col("end_date").cast("string").alias("end_date_iso"),
        F.when(k % 5 != 1, F.col("market_type")).alias("weather_type"),
        (k % 2 == 0).alias("is_arbitrage"),
        "arrival",
    )


@check(
    "encode_contract",
    q("""SELECT json_object('CONDITION_ID', condition_id, 'QUESTION', question, 'LOCATION_NAME', location_name, 'MARKET_TYPE', market_type,
           'MARKET_STATUS', market_status, 'YES_PRICE', price, 'WINNER', winner, 'CLOSED', closed, 'END_DATE_ISO', CAST(end_date AS VARCHAR))::VARCHAR AS value
         FROM predictions""", "predictions"),
)
def _encode(f):
    rows = f.predictions.select(
        "condition_id", "question", "location_name", "market_type", "market_status", F.col("price").alias("yes_price"),
        "winner", "closed", F.col("end_date").cast("string").alias("end_date_iso"), "volume",
    )
    return Q.encode_contract(rows, "prediction")


# the rows carry no poll timestamp, so that message is on every one
@check(
    "validate_required",
    q("""SELECT arrival, concat_ws('; ', CASE WHEN arrival % 13 = 0 THEN 'Missing required field: CONDITION_ID' END,
           CASE WHEN arrival % 5 = 0 THEN 'Missing required field: QUESTION' END,
           CASE WHEN arrival % 5 = 1 THEN 'Missing required field: WEATHER_TYPE' END,
           'Missing required field: POLL_TIMESTAMP') AS errors FROM predictions""", "predictions"),
)
def _validate(f):
    return Q.validate(_contract_rows(f), "prediction").select("arrival", F.array_join("errors", "; ").alias("errors"))


@check(
    "validate_split",
    q("SELECT arrival % 13 = 0 OR arrival % 5 < 2 AS rejected, count(*) AS n FROM predictions GROUP BY 1", "predictions"),
)
def _validate_split(f):
    rows = _contract_rows(f).withColumn("poll_timestamp", F.lit(AS_OF))
    valid, bad = Q.split_valid(rows, "prediction")
    parts = valid.select(F.lit(False).alias("rejected")).unionByName(bad.select(F.lit(True).alias("rejected")))
    return parts.groupBy("rejected").agg(F.count(F.lit(1)).alias("n"))


@check(
    "check_constraints",
    q("""SELECT arrival, violations FROM (SELECT arrival, concat_ws(',', CASE WHEN arrival % 13 = 0 THEN 'valid_outcome' END,
           CASE WHEN prediction_error + (arrival % 17) / 16.0::DOUBLE > 1 THEN 'valid_error' END,
           CASE WHEN arrival % 19 = 0 THEN 'valid_severity' END, CASE WHEN arrival % 23 = 0 THEN 'valid_alert_type' END,
           CASE WHEN arrival % 29 = 0 THEN 'valid_status' END) AS violations FROM correlations) WHERE violations <> ''""", "correlations"),
)
def _constraints(f):
    k = F.col("arrival")
    rows = f.correlations.select(
        "arrival",
        F.when(k % 13 == 0, 2).when(k % 3 == 0, F.lit(None)).otherwise(F.col("actual_outcome")).alias("actual_outcome"),
        (F.col("prediction_error") + (k % 17) / F.lit(16.0)).alias("prediction_error"),
        F.when(k % 19 == 0, "fatal").otherwise("high").alias("severity"),
        F.when(k % 23 == 0, "other").otherwise("bias_detected").alias("alert_type"),
        F.when(k % 29 == 0, "asleep").otherwise("down").alias("status"),
    )
    checked = Q.check_constraints(rows).where(F.size("violations") > 0)
    return checked.select("arrival", F.array_join("violations", ",").alias("violations"))


@check("scan_table", "SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-24' AND value > 50")
def _scan(f):
    where = (F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz")) & (F.col("value") > 50)
    return scan_table(f.spark, f"{f.folder}/events.parquet", ["event_id", "ts", "value"], where)


@check(
    "json_details",
    q("""SELECT health_id, '{"status":"' || status || '","sent":' || messages_processed || ',"errors":' || error_count || '}' AS details,
           messages_processed AS sent FROM health""", "health"),
)
def _details(f):
    rows = Q.with_details(f.health, status="status", sent="messages_processed", errors="error_count")
    return rows.select("health_id", "details", Q.detail("sent", "bigint").alias("sent"))


# -- times ---------------------------------------------------------------------------


@check(
    "ms_to_iso",
    "SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS iso FROM events",
)
def _ms_to_iso(f):
    e = f.table("events")
    ms = F.when(F.col("event_id") % 18 == 0, F.lit(None)).when(F.col("event_id") % 9 == 0, F.lit(0)).otherwise(F.unix_millis("ts"))
    return e.select("event_id", D.ms_to_iso(ms.cast("bigint")).alias("iso"))


@check(
    "event_time",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN ts + INTERVAL 1 HOUR
         ELSE TIMESTAMP '2024-02-01' END AS event_ts FROM events""",
)
def _event_time(f):
    k = F.col("event_id") % 5
    e = f.table("events")
    poll = (
        F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
        .when(k == 3, F.lit("yesterday"))
    )
    end = F.when(k == 2, F.date_format(F.col("ts") + F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    ingest = F.lit("2024-02-01").cast("timestamp")
    return e.select("event_id", D.event_time(poll, ingest, end).alias("event_ts"))


@check(
    "date_key",
    q("""SELECT arrival, CASE WHEN arrival % 6 IN (0, 1) THEN 'current' ELSE CAST(end_date AS VARCHAR) END AS date_key,
           CASE WHEN arrival % 6 IN (0, 1) THEN '' ELSE CAST(end_date AS VARCHAR) END AS plain_key FROM predictions""", "predictions"),
)
def _date_key(f):
    k = F.col("arrival") % 6
    text = F.when(k == 1, "").when(k != 0, F.concat(F.col("end_date").cast("string"), F.lit("T12:00:00Z")))
    return f.predictions.select("arrival", D.date_key(text).alias("date_key"), D.date_key(text, "").alias("plain_key"))


@check(
    "historical_eligible",
    q(f"""SELECT arrival, CASE WHEN arrival % 6 < 4 THEN false ELSE end_date < CAST({NOW} AS DATE) END AS eligible FROM predictions""", "predictions"),
)
def _eligible(f):
    k = F.col("arrival") % 6
    text = F.when(k == 1, "").when(k == 2, "current").when(k == 3, "2024-13-45").when(k != 0, F.col("end_date").cast("string"))
    return f.predictions.select("arrival", D.historical_eligible(text, AS_OF).alias("eligible"))


@check(
    "canonical_fields",
    q("""SELECT condition_id, closed, price, CAST(poll_ts AS VARCHAR) AS poll_timestamp, market_type FROM predictions""", "predictions"),
)
def _canonical(f):
    k = F.col("arrival") % 2 == 0
    stamp = F.date_format("poll_ts", "yyyy-MM-dd HH:mm:ss")
    # one record spells a field one way, the next one the other
    mixed = f.predictions.select(
        F.when(k, F.col("condition_id")).alias("condition_id"),
        F.when(~k, F.col("condition_id")).alias("condition_id_upper"),
        F.when(~k, F.col("price")).alias("price"),
        F.when(k, F.col("price")).alias("yes_price"),
        F.col("closed").alias("CLOSED"),
        stamp.alias("POLL_TIMESTAMP"),
        "market_type",
    )
    renamed = mixed.withColumnRenamed("condition_id_upper", "CONDITION_ID_UPPER")
    return I.canonical_fields(renamed, {"condition_id": ("condition_id", "CONDITION_ID_UPPER")})


# -- markets and weather records -------------------------------------------------------

_PARSED = f"""
    SELECT *, {_TYPE} AS market_type, {CITY_SQL} AS city FROM markets
    WHERE probability IS NOT NULL AND outcome_type = 'BINARY'"""
_PARSED_ROWS = f"""SELECT id AS condition_id, slug AS question_id, question, city AS location_name, market_type,
      CASE WHEN decided THEN 'closed' ELSE 'open' END AS market_status, {rnd('probability', 4)} AS yes_price,
      {rnd('1.0::DOUBLE - probability', 4)} AS no_price, {rnd('probability', 4)} AS price, 1.0::DOUBLE AS price_sum,
      CASE WHEN decided THEN resolution = 'YES' END AS winner, is_resolved AS closed,
      CASE WHEN close_time <> 0 THEN strftime(make_timestamp(close_time * 1000), '%Y-%m-%dT%H:%M:%SZ') END AS end_date_iso,
      market_type AS weather_type, abs(probability - base) > 0.4::DOUBLE AND NOT is_resolved AS is_arbitrage, base AS base_rate,
      {rnd('abs(probability - base)', 4)} AS deviation_from_base, true AS is_valid,
      CASE WHEN decided THEN CAST(resolution = 'YES' AS INT) END AS actual_outcome,
      CASE WHEN decided THEN {rnd("abs(probability - CAST(resolution = 'YES' AS INT))", 4)} END AS prediction_error,
      NOT is_resolved AS needs_weather_check, 'manifold' AS source, url AS market_url, resolution,
      coalesce(bettors, 0) AS unique_bettors, coalesce(volume, 0) AS volume, {NOW} AS poll_timestamp
    FROM (SELECT *, is_resolved AND coalesce(resolution IN ('YES', 'NO'), false) AS decided, {base_rate('market_type')} AS base FROM ({_PARSED}))
    WHERE city IS NOT NULL"""


@check("parse_market", q(_PARSED_ROWS, "markets", "gazetteer"))
def _parse(f):
    return I.parse_market(f.markets, f.gazetteer, AS_OF)


@check(
    "poll_summary",
    q(f"""SELECT sent, fetched - sent AS skipped, closed_markets, sent - closed_markets AS open_markets, arbitrage,
          (SELECT count(*) FROM (SELECT 1 FROM parsed WHERE NOT closed GROUP BY location_name, market_type, end_date_iso
             HAVING count(*) >= 2 AND sum(CAST(floor(price * 1e4 + 0.5) AS BIGINT)) > 10100)) AS cross_arbitrage,
          n_cities, cities, (SELECT string_agg(e, ',' ORDER BY e) FROM (SELECT market_type || '=' || count(*) AS e FROM parsed GROUP BY market_type)) AS by_type
          FROM (SELECT count(*) AS sent, (SELECT count(*) FROM markets) AS fetched, count(*) FILTER (market_status = 'closed') AS closed_markets,
            count(*) FILTER (is_arbitrage) AS arbitrage, CAST(count(DISTINCT location_name) AS INT) AS n_cities,
            string_agg(DISTINCT location_name, ',' ORDER BY location_name) AS cities FROM parsed)""", "markets", "gazetteer").replace(
        "\nSELECT sent", f", parsed AS MATERIALIZED ({_PARSED_ROWS})\nSELECT sent", 1),
)
def _poll_summary(f):
    records = I.parse_market(f.markets, f.gazetteer, AS_OF)
    fetched = f.markets.agg(F.count(F.lit(1)).alias("fetched"))
    crossed = L.cross_market_sum(records.withColumn("end_date", F.substring("end_date_iso", 1, 10)))
    return M.poll_summary(records, fetched, crossed.agg(F.count(F.lit(1)).alias("cross_arbitrage")))


@check(
    "weather_poll_summary",
    """SELECT count(*) FILTER (s = 'sent') AS sent, count(*) FILTER (s = 'sent' AND h) AS historical, count(*) FILTER (s = 'sent' AND NOT h) AS current,
         count(*) FILTER (s = 'skipped') AS skipped, count(*) FILTER (s = 'failed') AS failed
       FROM (SELECT CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 10 = 0 THEN 'skipped' ELSE 'sent' END AS s,
         event_type IN ('view', 'purchase', 'signup') AS h FROM events)""",
)
def _weather_summary(f):
    status = (
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_id") % 10 == 0, "skipped").otherwise("sent")
    )
    kind = F.when(F.col("event_type").isin("view", "purchase", "signup"), "historical").otherwise("current")
    return M.weather_poll_summary(f.table("events").select(status.alias("status"), kind.alias("weather_type")))


@check(
    "flatten_current",
    q(f"""SELECT location_name, 'current' AS weather_type, observation_date, poll_ts, temp_c,
          {rnd('temp_c * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE', 1)} AS temp_f, precip_mm, rain_mm, weather_code, wind_kmh,
          CAST(obs_id % 100 AS INT) AS humidity_pct FROM weather WHERE obs_id % 8 <> 0""", "weather"),
)
def _current(f):
    w = f.weather
    text = F.to_json(
        F.struct(
            F.date_format("poll_ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
            F.col("temp_c").alias("temperature_2m"),
            F.col("precip_mm").alias("precipitation"),
            F.col("rain_mm").alias("rain"),
            "weather_code",
            F.col("wind_kmh").alias("wind_speed_10m"),
            (F.col("obs_id") % 100).alias("relative_humidity_2m"),
        )
    )
    raw = w.select(
        "location_name",
        "poll_ts",
        F.when(F.col("obs_id") % 8 != 0, F.from_json(text, RAW_CURRENT)).alias("current"),
    )
    return I.flatten_current(raw)


# three days per record; the day list of every eighth record is empty
@check(
    "flatten_daily",
    q(f"""SELECT location_name, 'historical' AS weather_type, CAST(observation_date + d AS DATE) AS observation_date, poll_ts,
          temp_c + d AS temp_c, {rnd('(temp_c + d) * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE', 1)} AS temp_f,
          temp_c - d AS temp_min_c, {rnd('(temp_c - d) * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE', 1)} AS temp_min_f,
          precip_mm, rain_mm, weather_code, CAST(NULL AS DOUBLE) AS wind_kmh, CAST(NULL AS INT) AS humidity_pct
          FROM weather, (SELECT unnest([0, 1, 2]) AS d) WHERE obs_id % 8 <> 0""", "weather"),
)
def _daily(f):
    def days(value):
        listed = F.array(*[value(d) for d in range(3)])
        return F.when(F.col("obs_id") % 8 != 0, listed).otherwise(F.slice(listed, 1, 0))

    day = F.col("observation_date")
    text = F.to_json(
        F.struct(
            days(lambda d: F.date_add(day, d).cast("string")).alias("time"),
            days(lambda d: F.col("temp_c") + d).alias("temperature_2m_max"),
            days(lambda d: F.col("temp_c") - d).alias("temperature_2m_min"),
            days(lambda d: F.col("precip_mm")).alias("precipitation_sum"),
            days(lambda d: F.col("rain_mm")).alias("rain_sum"),
            days(lambda d: F.col("weather_code")).alias("weathercode"),
        )
    )
    raw = f.weather.select("location_name", "poll_ts", F.from_json(text, RAW_DAILY).alias("daily"))
    return I.flatten_daily(raw)


@check(
    "distinct_city_dates",
    q("""SELECT location_name AS city, date, arg_min(needs, arrival) AS needs_check FROM (
           SELECT location_name, arrival, CASE WHEN arrival % 6 = 0 THEN 'current' ELSE CAST(end_date AS VARCHAR) END AS date,
             CASE WHEN arrival % 3 = 0 THEN true ELSE NOT closed END AS needs FROM predictions)
         WHERE location_name IN (SELECT city_name FROM gazetteer WHERE verified) GROUP BY 1, 2""", "predictions", "gazetteer"),
)
def _city_dates(f):
    k = F.col("arrival")
    rows = f.predictions.select(
        "location_name",
        "arrival",
        F.when(k % 6 != 0, F.col("end_date")).alias("end_date"),
        F.when(k % 3 != 0, ~F.col("closed")).alias("needs_weather_check"),
    )
    return I.distinct_city_dates(rows, f.gazetteer)


@check(
    "weather_requests",
    q(f"""SELECT DISTINCT location_name AS city, CAST(end_date AS VARCHAR) AS date,
          CASE WHEN end_date < CAST({NOW} AS DATE) THEN 'historical' ELSE 'current' END AS feed
          FROM predictions WHERE location_name IN (SELECT city_name FROM gazetteer WHERE verified
            AND (city_name IN {tuple(c[0] for c in C.CITY_COORDINATES)} OR city_name NOT IN ('Manchester', 'Istanbul')))""", "predictions", "gazetteer"),
)
def _requests(f):
    rows = f.predictions.withColumn("needs_weather_check", ~F.col("closed"))
    lost = F.col("city_name").isin("London", "Manchester", "Istanbul")
    places = f.gazetteer.withColumn("lat", F.when(~lost, F.col("lat")))
    return I.weather_requests(I.distinct_city_dates(rows, f.gazetteer), AS_OF, places).select("city", "date", "feed")

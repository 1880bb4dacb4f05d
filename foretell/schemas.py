"""Explicit schemas at the boundary: records, contracts and stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

THRESHOLD = T.StructType(
    [
        T.StructField("value", T.DoubleType()),
        T.StructField("value_min", T.DoubleType()),
        T.StructField("value_max", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("condition_id", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("market_type", T.StringType()),
        T.StructField("market_status", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("winner", T.BooleanType()),
        T.StructField("closed", T.BooleanType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("poll_ts", T.TimestampType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("threshold", THRESHOLD),
    ]
)

WEATHER = T.StructType(
    [
        T.StructField("obs_id", T.LongType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("weather_type", T.StringType()),
        T.StructField("observation_date", T.DateType()),
        T.StructField("poll_ts", T.TimestampType()),
        T.StructField("temp_c", T.DoubleType()),
        T.StructField("temp_f", T.DoubleType()),
        T.StructField("precip_mm", T.DoubleType()),
        T.StructField("rain_mm", T.DoubleType()),
        T.StructField("weather_code", T.IntegerType()),
        T.StructField("wind_kmh", T.DoubleType()),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("alert_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("market_type", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("threshold_value", T.DoubleType()),
        T.StructField("deviation", T.DoubleType()),
        T.StructField("price_sum", T.DoubleType()),
        T.StructField("arbitrage_margin", T.DoubleType()),
        T.StructField("detected_at", T.TimestampType()),
    ]
)

RAW_CURRENT = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("temperature_2m", T.DoubleType()),
        T.StructField("precipitation", T.DoubleType()),
        T.StructField("rain", T.DoubleType()),
        T.StructField("weather_code", T.IntegerType()),
        T.StructField("wind_speed_10m", T.DoubleType()),
        T.StructField("relative_humidity_2m", T.IntegerType()),
    ]
)

RAW_DAILY = T.StructType(
    [
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m_max", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m_min", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
        T.StructField("rain_sum", T.ArrayType(T.DoubleType())),
        T.StructField("weathercode", T.ArrayType(T.IntegerType())),
    ]
)

# -- fixed values: message contracts, (field, required) in message order -------
CONTRACTS = {
    "prediction": (
        ("CONDITION_ID", True), ("QUESTION", True), ("LOCATION_NAME", True),
        ("MARKET_TYPE", True), ("MARKET_STATUS", True), ("YES_PRICE", True),
        ("NO_PRICE", False), ("WINNER", False), ("CLOSED", True),
        ("END_DATE_ISO", False), ("WEATHER_TYPE", True), ("IS_ARBITRAGE", True),
        ("POLL_TIMESTAMP", True),
    ),
    "weather": (
        ("LOCATION_NAME", True), ("OBSERVATION_DATE", True), ("WEATHER_TYPE", True),
        ("TEMP_C", False), ("TEMP_F", False), ("PRECIP_MM", False),
        ("RAIN_MM", False), ("WEATHER_CODE", False), ("WIND_KMH", False),
        ("SOURCE", True), ("POLL_TIMESTAMP", True),
    ),
    "correlation": (
        ("CONDITION_ID", True), ("QUESTION", True), ("LOCATION_NAME", True),
        ("MARKET_TYPE", True), ("MARKET_STATUS", True), ("YES_PRICE", True),
        ("CLOSED", True), ("END_DATE_ISO", False), ("ACTUAL_TEMP_C", False),
        ("ACTUAL_TEMP_F", False), ("ACTUAL_PRECIP_MM", False),
        ("ACTUAL_WEATHER_CODE", False), ("ACTUAL_OUTCOME", False),
        ("PREDICTION_ERROR", False), ("CORRELATION_METHOD", True),
        ("CORRELATION_LATENCY_SEC", False), ("POLL_TIMESTAMP", True),
    ),
    "aggregate": (
        ("LOCATION_NAME", True), ("MARKET_TYPE", True), ("ACCURACY_RATE", True),
        ("AVG_PREDICTION_ERROR", True), ("TOTAL_PREDICTIONS", True),
        ("CORRECT_PREDICTIONS", True), ("VOLUME_WEIGHTED_ACC", True),
        ("BIAS_SCORE", True), ("WINDOW_START", True), ("WINDOW_END", True),
    ),
    "alert": (
        ("ALERT_TYPE", True), ("SEVERITY", True), ("LOCATION_NAME", True),
        ("MARKET_TYPE", True), ("METRIC_VALUE", False), ("THRESHOLD", False),
        ("DEVIATION", False), ("MESSAGE", True), ("CREATED_AT", True),
    ),
}

"""Per-row rules with literal cases."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foretell.functions import numeric as N
from foretell.functions import outcomes as O
from foretell.functions import text as X
from foretell.functions import times as D
from foretell.schemas import THRESHOLD


@pytest.mark.parametrize(
    ("value", "digits", "expected"),
    [(2.675, 2, 2.68), (1.005, 2, 1.0), (0.5, 0, 1.0), (-0.5, 0, -1.0), (-1.23456, 4, -1.2346), (0.0, 4, 0.0), (None, 2, None)],
)
def test_round_to(one, value, digits, expected):
    assert one(N.round_to(F.lit(value).cast("double"), digits)) == expected


@pytest.mark.parametrize(("f", "c"), [(32, 0.0), (212, 100.0), (98.6, 37.0), (-40, -40.0), (77, 25.0), (None, None)])
def test_f_to_c(one, f, c):
    assert one(O.f_to_c(F.lit(f).cast("double"))) == c


@pytest.mark.parametrize(("c", "f"), [(0, 32.0), (100, 212.0), (25, 77.0), (-40, -40.0)])
def test_c_to_f(one, c, f):
    assert one(O.c_to_f(F.lit(c).cast("double"))) == f


THRESHOLDS = [
    (45.5, (40.0, None, None, "F", "above"), 1),
    (40.0, (40.0, None, None, "F", "above"), 1),
    (39.9, (40.0, None, None, "F", "above"), 0),
    (35.0, (35.0, None, None, "F", "below"), 1),
    (35.1, (35.0, None, None, "F", "below"), 0),
    (40.0, (None, 40.0, 41.0, "F", "between"), 1),
    (41.0, (None, 40.0, 41.0, "F", "between"), 1),
    (41.1, (None, 40.0, 41.0, "F", "between"), 0),
    (77.0, (25.0, None, None, "C", "above"), 1),
    (76.9, (25.0, None, None, "C", "above"), 0),
    (41.1, (None, 45.0, None, "F", "between"), None),
    (41.1, (None, None, None, "F", "above"), None),
    (41.1, (40.0, None, None, "F", "near"), None),
    (50.0, (40.0, None, None, None, "above"), 1),
    (None, (40.0, None, None, "F", "above"), None),
    (41.1, None, None),
]


def test_compare_threshold(spark):
    schema = T.StructType(
        [T.StructField("actual", T.DoubleType()), T.StructField("threshold", THRESHOLD), T.StructField("expected", T.IntegerType())]
    )
    df = spark.createDataFrame(THRESHOLDS, schema)
    got = df.withColumn("got", O.compare_threshold(F.col("actual"), F.col("threshold"))).collect()
    assert [r.got for r in got] == [r.expected for r in got]


# market, code, precip, rain, wind, temp_c, expected
OUTCOMES = [
    ("RAIN", 61, 0.0, 0.0, None, None, 1),
    ("RAIN", 0, 9.0, 9.0, None, None, 0),
    ("RAIN", None, 2.5, None, None, None, 1),
    ("RAIN", None, None, 0.2, None, None, 1),
    ("RAIN", None, 0.0, 0.0, None, None, 0),
    ("RAIN", None, None, None, None, None, 0),
    ("RAIN", None, 0.1, 0.1, None, None, 0),
    ("SNOW", 75, None, None, None, None, 1),
    ("SNOW", None, 5.0, None, None, None, 0),
    ("SUNSHINE", 1, None, None, None, None, 1),
    ("SUNSHINE", None, None, None, None, None, None),
    ("WIND", None, None, None, 30.0, None, 0),
    ("WIND", None, None, None, 30.1, None, 1),
    ("WIND", 61, None, None, None, None, None),
    ("FOG", 45, None, None, None, None, 1),
    ("FOG", None, None, None, None, None, None),
    ("HAIL", 96, None, None, None, None, 1),
    ("HAIL", 95, None, None, None, None, 0),
    ("CLOUD", 3, None, None, None, None, 1),
    ("FROST", None, None, None, None, 0.0, 1),
    ("FROST", None, None, None, None, 0.1, 0),
    ("FROST", 0, None, None, None, None, None),
    ("WEATHER", 71, None, None, None, None, 1),
    ("WEATHER", 3, 9.0, None, None, None, 0),
    ("WEATHER", None, 0.2, None, None, None, 1),
    ("TEMPERATURE", 61, 1.0, 1.0, 1.0, 1.0, None),
    ("VOLCANO", 61, 1.0, 1.0, 1.0, 1.0, None),
]


def test_weather_outcome_and_masks(spark):
    """The rule and its bit-mask form agree on every case."""
    schema = "market string, weather_code int, precip_mm double, rain_mm double, wind_kmh double, temp_c double, expected int"
    df = spark.createDataFrame(OUTCOMES, schema).withColumns(
        {"weather_type": F.lit("current"), "temp_f": F.lit(None).cast("double")}
    )
    rule = O.weather_outcome(
        F.col("market"), F.col("weather_code"), F.col("precip_mm"), F.col("rain_mm"), F.col("wind_kmh"), F.col("temp_c")
    )
    masks = O.settlement(df)
    bit = O.market_bit(F.col("market"))
    by_mask = F.when(masks["answers"].bitwiseAND(bit) != 0, (masks["occurs"].bitwiseAND(bit) != 0).cast("int"))
    for row in df.select("market", "weather_code", "expected", rule.alias("rule"), by_mask.alias("mask")).collect():
        assert (row.rule, row.mask) == (row.expected, row.expected), row


@pytest.mark.parametrize(("p", "o", "e"), [(0.8, 1, 0.2), (0.15, 0, 0.15), (0.5, 1, 0.5), (1.0, 1, 0.0)])
def test_prediction_error(one, p, o, e):
    assert one(O.prediction_error(F.lit(p), F.lit(o))) == e


@pytest.mark.parametrize(
    ("question", "expected"),
    [
        ("Will it rain in London tomorrow?", "RAIN"),
        ("Will it be raining in London?", "WEATHER"),
        ("Will there be sleet?", "RAIN"),
        ("Will it snow in Toronto?", "SNOW"),
        ("Will there be a blizzard in Boston?", "SNOW"),
        ("Will the temperature in NYC exceed 77°F?", "TEMPERATURE"),
        ("Will it be above 30 degrees celsius in Paris?", "TEMPERATURE"),
        ("Will it be sunny in Los Angeles?", "SUNSHINE"),
        ("Will it be windy in Chicago?", "WIND"),
        ("Will there be a storm in Miami?", "WIND"),
        ("Will there be fog in San Francisco?", "FOG"),
        ("Will there be hail in Denver?", "HAIL"),
        ("Will it be cloudy in Seattle?", "CLOUD"),
        ("Will it freeze in Warsaw?", "TEMPERATURE"),
        ("Freezing in Warsaw?", "FROST"),
        ("Some random question", "WEATHER"),
    ],
)
def test_market_type(one, question, expected):
    assert one(X.market_type(F.lit(question))) == expected


@pytest.mark.parametrize(
    ("city", "expected"),
    [
        ("London", True), ("Banská Štiavnica", True), ("New York City", True), ("A", False), ("A" * 50, True),
        ("A" * 51, False), ("london", False), ("Area 51", False), ("A B C D E", True), ("A B C D E F", False), (None, False), ("", False),
    ],
)
def test_plausible_city(one, city, expected):
    assert one(X.plausible_city(F.lit(city).cast("string"))) is expected


@pytest.mark.parametrize(
    ("city", "expected"), [("NYC", "New York City"), ("the Big Apple", "New York City"), ("DC", "Washington"), ("London", "London")]
)
def test_normalize_city(one, city, expected):
    assert one(X.normalize_city(F.lit(city))) == expected


@pytest.mark.parametrize(
    ("city", "expected"), [("London", False), ("A B C D", False), ("A B C D E", True), ("Paris Next Week", True), ("Monday", True)]
)
def test_suspicious_city(one, city, expected):
    assert one(X.suspicious_city(F.lit(city))) is expected


def test_question_key_ignores_dates(one):
    a = one(X.question_key(F.lit("Will it rain in London on 2026-05-20?")))
    b = one(X.question_key(F.lit("Will it rain  in London today?")))
    c = one(X.question_key(F.lit("Will it rain in Paris today?")))
    assert a == b != c
    assert len(a) == 12


def test_terms(one):
    assert one(X.term_match(F.lit("will it RAIN IN Oslo?")))
    assert not one(X.term_match(F.lit("Who wins the cup?")))
    found = one(X.matched_terms(F.lit("Will it rain in Oslo?")))
    assert [(r.term_no, r.term) for r in found] == [(0, "Will it rain in"), (2, "rain in")]


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2024-01-30", True), ("2024-01-31", False), ("2024-02-01", False), ("current", False), ("", False), (None, False), ("junk", False), ("2024-13-45", False)],
)
def test_historical_eligible(one, text, expected):
    assert one(D.historical_eligible(F.lit(text).cast("string"), "2024-01-31 10:00:00")) is expected


@pytest.mark.parametrize(("ms", "expected"), [(1700000000000, "2023-11-14T22:13:20Z"), (0, None), (None, None)])
def test_ms_to_iso(one, ms, expected):
    assert one(D.ms_to_iso(F.lit(ms).cast("bigint"))) == expected


def test_latency(one):
    early, late = F.lit("2024-01-01 00:00:00.9").cast("timestamp"), F.lit("2024-01-01 00:00:02").cast("timestamp")
    assert one(D.latency_signed(early, late)) == 1
    assert one(D.latency_signed(late, early)) == -1
    assert one(D.latency_between_polls(late, early)) == 1
    assert one(D.latency_signed(F.lit(None).cast("timestamp"), late)) is None


@pytest.mark.parametrize(
    "text", ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00+00:00", "2024-01-01T10:00:00.000000+00:00", "2024-01-01T12:00:00+02:00"]
)
def test_event_time_spellings(one, text):
    fallback = F.lit("2000-01-01").cast("timestamp")
    assert one(F.date_format(D.event_time(F.lit(text), fallback), "yyyy-MM-dd HH:mm")) == "2024-01-01 10:00"


def test_event_time_falls_back(one):
    fallback = F.lit("2000-01-01").cast("timestamp")
    none = F.lit(None).cast("string")
    assert one(D.event_time(F.lit("soon"), fallback)).year == 2000
    assert one(D.event_time(none, fallback, F.lit("2024-05-01T00:00:00Z"))) == datetime(2024, 5, 1)


@pytest.mark.parametrize(("text", "expected"), [("2026-05-20T00:00:00Z", "2026-05-20"), ("", "current"), (None, "current")])
def test_date_key(one, text, expected):
    assert one(D.date_key(F.lit(text).cast("string"))) == expected

"""Operators on small frames."""

from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from foretell import accuracy, baselines, insert_missing, score, upsert
from foretell.operators import alerts as L
from foretell.operators import gazetteer as G
from foretell.operators import ingest as I
from foretell.operators import quality as Q
from foretell.operators import summaries as M
from foretell.operators import toprow as T
from foretell.operators.lookup import attach_weather, unmatched_predictions, weather_snapshot
from foretell.operators.scoring import failed_correlations
from foretell.operators.upsert import fold_changes
from foretell.sources.topics import decode

AS_OF = "2026-05-21 00:00:00"


def lookup(predictions, weather):
    return attach_weather(predictions, *weather_snapshot(weather))


# -- lookup ---------------------------------------------------------------------------


def test_exact_day_beats_current(predictions, weather):
    w = weather({"obs_id": 1}, {"obs_id": 2, "weather_type": "historical"})
    assert lookup(predictions({}), w).first()["w"]["obs_id"] == 2


@pytest.mark.parametrize("end", [date(2026, 6, 1), None])
def test_fallback_to_current(predictions, weather, end):
    w = weather({"obs_id": 1}, {"obs_id": 2, "weather_type": "historical"})
    assert lookup(predictions({"end_date": end}), w).first()["w"]["obs_id"] == 1


def test_unknown_place_stays_unmatched(predictions, weather):
    p = predictions({"location_name": "Oslo"}, {"condition_id": "m2"}, {"condition_id": "m3", "location_name": None})
    rows = {r.condition_id: r.w for r in lookup(p, weather({})).collect()}
    assert rows["m1"] is None and rows["m3"] is None and rows["m2"] is not None
    assert {r.condition_id for r in unmatched_predictions(p, weather({})).collect()} == {"m1", "m3"}


def test_last_current_row_wins_and_bad_rows_drop(weather):
    w = weather(
        {"obs_id": 1, "poll_ts": datetime(2026, 5, 20, 9)},
        {"obs_id": 2, "poll_ts": datetime(2026, 5, 20, 10)},
        {"obs_id": 3, "location_name": None},
        {"obs_id": 4, "weather_type": "historical", "observation_date": None},
        {"obs_id": 5, "weather_type": None, "poll_ts": datetime(2026, 5, 20, 8)},
    )
    exact, current = weather_snapshot(w)
    assert exact.count() == 0
    assert [r.obs_id for r in current.collect()] == [2]


# -- scoring ---------------------------------------------------------------------------

HIST = {"weather_type": "historical"}
ABOVE_40 = (40.0, None, None, "F", "above")
SCORES = [
    ({"closed": True, "winner": True, "price": 0.8}, HIST, (1, 0.2, "winner_known")),
    ({"closed": True, "winner": False, "price": 0.15}, {}, (0, 0.15, "winner_known")),
    ({"closed": True, "winner": True, "market_type": "VOLCANO"}, {}, (1, 0.35, "winner_known")),
    ({}, HIST, (1, 0.35, "historical_weather")),
    ({}, {}, (1, 0.35, "current_snapshot")),
    ({}, {"weather_type": None}, (1, 0.35, "current_snapshot")),
    ({"market_type": None}, {}, (1, 0.35, "current_snapshot")),
    ({"price": None}, {}, (1, 0.5, "current_snapshot")),
    ({"winner": True}, {"weather_code": 0}, (0, 0.65, "current_snapshot")),
    ({"market_type": "TEMPERATURE", "threshold": ABOVE_40}, {**HIST, "temp_f": 45.5}, (1, 0.35, "historical_weather")),
    ({"market_type": "TEMPERATURE"}, HIST, None),
    ({"market_type": "TEMPERATURE", "threshold": ABOVE_40}, {"temp_f": None}, None),
    ({"market_type": "TEMPERATURE", "threshold": (None, None, None, "F", "above")}, {}, None),
    ({"market_type": "VOLCANO"}, {}, None),
    ({"market_type": "WIND"}, {"wind_kmh": None}, None),
    ({"market_type": "FOG"}, {"weather_code": None}, None),
    ({"market_type": "RAIN"}, {"weather_code": None}, (1, 0.35, "current_snapshot")),
]


def test_scoring(predictions, weather):
    """Every case in its own place, so one run scores them all."""
    p = predictions(*[{"condition_id": str(i), "location_name": f"P{i}", **c[0]} for i, c in enumerate(SCORES)])
    w = weather(*[{"obs_id": i, "location_name": f"P{i}", **c[1]} for i, c in enumerate(SCORES)])
    got = {
        int(r.condition_id): (r.actual_outcome, r.prediction_error, r.correlation_method)
        for r in score(p, w, AS_OF).collect()
    }
    assert got == {i: c[2] for i, c in enumerate(SCORES) if c[2]}
    failed = {int(r.condition_id) for r in failed_correlations(lookup(p, w)).collect()}
    assert failed == {i for i, c in enumerate(SCORES) if c[2] is None}


def test_other_weather_type_never_scores_but_winner_does(predictions, weather):
    w = weather({"weather_type": "forecast"})
    assert score(predictions({}), w, AS_OF).count() == 0
    assert score(predictions({"closed": True, "winner": True}), w, AS_OF).count() == 1


def test_empty_inputs(predictions, weather):
    none = predictions({}).limit(0)
    assert score(none, weather({}), AS_OF).count() == 0
    assert score(predictions({}), weather({}).limit(0), AS_OF).count() == 0
    assert accuracy(score(none, weather({}), AS_OF)).count() == 0


# -- metrics ---------------------------------------------------------------------------

CORR = "location_name string, market_type string, price double, actual_outcome int, prediction_error double, correlation_method string, volume double"


def corr(spark, *rows):
    return spark.createDataFrame([("London", "RAIN", *r) for r in rows], CORR)


def test_volume_weights(spark):
    m = accuracy(corr(spark, (0.9, 1, 0.1, "winner_known", 900.0), (0.9, 0, 0.9, "winner_known", 100.0))).first()
    assert (m.total_predictions, m.correct_predictions, m.accuracy_rate) == (2, 1, 0.5)
    assert (m.volume_weighted_accuracy, m.total_volume, m.bias_score) == (0.9, 1000.0, 0.4)
    assert (m.min_prediction_error, m.max_prediction_error, m.avg_prediction_error) == (0.1, 0.9, 0.5)


def test_null_outcome_counts_in_total_only(spark):
    m = accuracy(corr(spark, (0.9, 1, 0.1, "winner_known", None), (0.9, None, None, "winner_known", None))).first()
    assert (m.total_predictions, m.correct_predictions, m.avg_prediction_error, m.total_volume) == (2, 1, 0.1, 2.0)


def test_all_outcomes_null(spark):
    m = accuracy(corr(spark, (0.9, None, None, "winner_known", 0.0))).first()
    assert (m.accuracy_rate, m.avg_prediction_error, m.bias_score, m.volume_weighted_accuracy) == (0, 0, 0, 0)
    s = accuracy(corr(spark, (0.9, None, None, "winner_known", 0.0)), "stream").first()
    assert (s.accuracy_rate, s.bias_score, s.total_predictions) == (0, 0, 1)


def test_half_is_a_hit_and_under(spark):
    m = accuracy(corr(spark, (0.5, 1, 0.5, "winner_known", 1.0))).first()
    assert (m.correct_predictions, m.under_prediction_count, m.over_prediction_count) == (1, 1, 0)


def test_variants_differ_on_snapshots(spark):
    rows = corr(spark, (0.9, 1, 0.1, "winner_known", 1.0), (0.9, 0, 0.9, "current_snapshot", 1.0))
    batch, stream = accuracy(rows).first(), accuracy(rows, "stream").first()
    assert (batch.total_predictions, batch.accuracy_rate, batch.avg_prediction_error) == (2, 1.0, 0.5)
    assert (stream.total_predictions, stream.accuracy_rate, stream.avg_prediction_error) == (2, 1.0, 0.1)
    assert (batch.over_prediction_count, stream.over_prediction_count) == (1, 0)


def test_only_snapshots_fall_back_to_total(spark):
    m = accuracy(corr(spark, (0.9, 1, 0.1, "current_snapshot", 1.0))).first()
    assert (m.correct_predictions, m.accuracy_rate) == (0, 0.0)


# -- baselines and alerts ------------------------------------------------------------------


def aggregates(spark, *rows, key=("London", "RAIN")):
    """(accuracy, bias, total), one per day."""
    start = datetime(2026, 5, 1)
    data = [(*key, start + timedelta(days=i), start + timedelta(days=i + 1), *r) for i, r in enumerate(rows)]
    schema = "location_name string, market_type string, window_start timestamp, window_end timestamp, accuracy_rate double, bias_score double, total_predictions bigint"
    return spark.createDataFrame(data, schema)


def last(df):
    return df.orderBy(F.desc("window_start")).first()


def test_static_until_three_points(spark):
    two, three = (aggregates(spark, *[(0.9, 0.1, 20)] * n) for n in (2, 3))
    assert (last(baselines(two)).baseline_source, last(baselines(two)).accuracy_threshold) == ("static_fallback", 0.8)
    row = last(baselines(three))
    assert (row.baseline_source, row.accuracy_threshold, row.bias_threshold) == ("7day_statistical", 0.9, 0.1)


def test_std_and_floor(spark):
    row = last(baselines(aggregates(spark, (0.6, 0.0, 20), (0.8, 0.0, 20), (1.0, 0.0, 20))))
    assert (row.acc_mean, row.acc_std) == (0.8, 0.1633)
    row = last(baselines(aggregates(spark, (0.0, 0.0, 20), (1.0, 0.0, 20), (0.0, 0.0, 20))))
    assert row.accuracy_threshold == 0.0


def test_signed_and_absolute_bias(spark):
    rows = aggregates(spark, (0.9, -0.2, 20), (0.9, 0.2, 20), (0.9, 0.0, 5), (0.9, 0.2, 20))
    assert last(baselines(rows)).bias_mean == 0.15
    signed = last(baselines(rows, abs_bias=False, min_total=10))
    assert (signed.bias_mean, signed.baseline_n) == (0.0667, 3)


def test_chunked_history_equals_brute_force(spark):
    """Random timelines, one key with most rows, window edges hit exactly."""
    rng = random.Random(7)
    base = datetime(2026, 1, 1)
    rows = []
    for i in range(600):
        key = ("Hot", "RAIN") if i % 3 else (f"P{i % 5}", "SNOW")
        at = base + timedelta(days=rng.randrange(0, 60), hours=rng.choice([0, 0, 5, 23]))
        rows.append((*key, at, rng.randrange(0, 10001) / 1e4, rng.randrange(-5000, 5001) / 1e4, 20))
    schema = "location_name string, market_type string, window_end timestamp, accuracy_rate double, bias_score double, total_predictions bigint"
    got = baselines(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    for r in got:
        past = [
            (round(x[3] * 1e4), abs(round(x[4] * 1e4)))
            for x in rows
            if x[:2] == (r.location_name, r.market_type) and timedelta() <= r.window_end - x[2] <= timedelta(days=7)
        ]
        n = len(past)
        assert r.baseline_n == n
        if n >= 3:
            mean = sum(p[0] for p in past) / n / 1e4
            std = math.sqrt(n * sum(p[0] ** 2 for p in past) - sum(p[0] for p in past) ** 2) / n / 1e4
            assert r.accuracy_threshold == pytest.approx(max(0.0, mean - 2 * std), abs=1e-9)


def judged(spark, acc, bias, total, acc_thr=0.8, bias_thr=0.3):
    data = [("London", "RAIN", acc, bias, total, acc_thr, bias_thr, None, None, None, None, "static_fallback", 1)]
    schema = "location_name string, market_type string, accuracy_rate double, bias_score double, total_predictions bigint, accuracy_threshold double, bias_threshold double, acc_mean double, acc_std double, bias_mean double, bias_std double, baseline_source string, baseline_n bigint"
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize(
    ("acc", "bias", "total", "expected"),
    [
        (0.80, 0.30, 20, []),
        (0.10, 0.90, 5, []),
        (0.45, 0.0, 20, [("accuracy_drop", "critical", 0.35)]),
        (0.65, 0.0, 20, [("accuracy_drop", "high", 0.15)]),
        (0.48, 0.0, 20, [("accuracy_drop", "high", 0.32)]),
        (0.90, 0.60, 20, [("bias_detected", "high", 0.3)]),
        (0.90, -0.35, 20, [("bias_detected", "medium", 0.05)]),
        (0.65, 0.60, 20, [("accuracy_drop", "high", 0.15), ("bias_detected", "high", 0.3)]),
    ],
)
def test_aggregate_alerts(spark, acc, bias, total, expected):
    frame = judged(spark, acc, bias, total)
    rows = L.aggregate_alerts(frame, AS_OF).collect()
    assert [(r.alert_type, r.severity, r.deviation) for r in rows] == expected
    apart = L.accuracy_drop(frame, AS_OF).unionByName(L.bias_detected(frame, AS_OF)).collect()
    assert apart == rows


def test_messages(spark):
    rows = L.aggregate_alerts(judged(spark, 0.65, -0.6, 20), AS_OF).collect()
    assert rows[0].message == "Accuracy drop: London RAIN 65.0% < threshold 80.0% [baseline=static(80%)]"
    assert rows[1].message == "Bias: London RAIN under-predicting bias=-0.600 > threshold 0.300 [baseline=static(0.30)]"
    stream = L.aggregate_alerts(judged(spark, 0.5, 0.0, 20), AS_OF, L.STREAM_CRITICAL_RATIO, "stream").first()
    assert stream.severity == "critical"
    assert stream.message == "Accuracy drop [static]: London RAIN accuracy=50.0% < threshold=80.0%"


FLAG = "condition_id string, location_name string, market_type string, price double, is_arbitrage boolean, base_rate double, deviation_from_base double, arrival bigint"


def test_mispricing_flagged(spark):
    rows = [
        ("a", "London", "RAIN", 0.95, True, 0.35, 0.6, 1),
        ("a", "London", "RAIN", 0.95, True, 0.35, 0.6, 2),
        ("b", None, None, 0.85, True, None, 0.5, 3),
        ("c", "Paris", "RAIN", 0.9, False, 0.35, 0.55, 4),
        ("c", "Paris", "RAIN", 0.9, True, 0.35, 0.55, 5),
        (None, "Rome", "RAIN", 0.9, True, 0.35, 0.55, 6),
        ("d", "Oslo", "SNOW", 0.45, True, 0.15, 0.3, 7),
    ]
    got = {r.location_name: r for r in L.mispricing_flagged(spark.createDataFrame(rows, FLAG), AS_OF).collect()}
    assert set(got) == {"London", "unknown", "Oslo"}
    assert (got["London"].severity, got["Oslo"].severity, got["unknown"].severity) == ("critical", "high", "high")
    assert (got["unknown"].arbitrage_margin, got["unknown"].market_type, got["unknown"].threshold_value) == (50.0, "WEATHER", 0.4)


def test_cross_market_needs_two_and_more_than_one_percent(predictions):
    def market(i, place, price, closed=False):
        return {"condition_id": str(i), "location_name": place, "price": price, "closed": closed}

    p = predictions(
        market(1, "A", 0.5), market(2, "A", 0.51), market(3, "B", 0.6), market(4, "B", 0.42), market(5, "C", 0.99),
        market(6, "D", 0.9), market(7, "D", 0.9, True), market(8, "E", 0.8), market(9, "E", 0.9),
    )
    got = {r.location_name: (r.metric_value, r.arbitrage_margin, r.severity, r.markets) for r in L.cross_market(p, AS_OF).collect()}
    assert got == {"B": (1.02, 2.0, "high", 2), "E": (1.7, 70.0, "critical", 2)}


HEALTH = "component string, status string, messages_processed bigint, error_count bigint, recorded_at timestamp"


def health(spark, **minutes):
    now = datetime(2026, 5, 21)
    return spark.createDataFrame([(k, "healthy", 5, 0, now - timedelta(minutes=m)) for k, m in minutes.items()], HEALTH)


def test_timeouts_and_auto_resolve(spark):
    h = health(spark, fresh=5, edge=10, late=20, dead=45)
    expected = spark.createDataFrame([("fresh",), ("ghost",)], "component string")
    got = {r.location_name: (r.severity, r.metric_value) for r in L.producer_timeout(h, expected, AS_OF).collect()}
    assert got == {"late": ("high", 20.0), "dead": ("critical", 45.0), "ghost": ("critical", None)}
    alerts = spark.createDataFrame(
        [("producer_timeout", c, False, None) for c in ("fresh", "edge", "late")] + [("accuracy_drop", "fresh", False, None)],
        "alert_type string, location_name string, is_resolved boolean, resolved_at timestamp",
    )
    closed = {(r.alert_type, r.location_name) for r in L.auto_resolve(alerts, h, AS_OF).where("is_resolved").collect()}
    assert closed == {("producer_timeout", "fresh")}


@pytest.mark.parametrize(("hits", "misses", "severity"), [(95, 5, None), (94, 6, "high"), (70, 30, "high"), (69, 31, "critical"), (0, 0, None)])
def test_low_coverage(spark, hits, misses, severity):
    rows = [(1,)] * hits + [(None,)] * misses
    got = L.low_coverage(spark.createDataFrame(rows, "actual_outcome int"), AS_OF).collect()
    assert [r.severity for r in got] == ([severity] if severity else [])


def test_union_fills_missing_columns(spark):
    rows = L.union_alerts(L.low_coverage(spark.createDataFrame([(None,)], "actual_outcome int"), AS_OF)).collect()
    assert rows[0].price_sum is None and rows[0].alert_type == "low_coverage"


# -- one row per key -------------------------------------------------------------------------


def test_dedups(spark):
    schema = "condition_id string, closed boolean, correlation_method string, arrival bigint"
    rows = [
        ("a", False, "historical_weather", 1), ("a", True, "winner_known", 2), ("a", True, "winner_known", 3),
        ("b", None, None, 4), ("b", False, "current_snapshot", 5), (None, True, "winner_known", 6), (None, False, "x", 7), ("", True, "x", 8),
    ]
    df = spark.createDataFrame(rows, schema)

    def order(frame):
        return sorted(r.arrival for r in frame.collect())

    assert order(T.prefer_closed(df, "arrival")) == [2, 4]
    assert order(T.prefer_winner(df, "arrival")) == [2, 4, 6, 7, 8]
    assert order(T.first_seen(df, "arrival")) == [1, 4]


def test_latest_with_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3)], "k string, ts int, v int")
    assert sorted(r.v for r in T.latest_with_ties(df, ["k"], "ts").collect()) == [2, 3]


# -- upserts -----------------------------------------------------------------------------------


def test_upserts(spark):
    schema = "k string, a int, b int"
    old = spark.createDataFrame([("x", 1, 1), ("y", 2, 2), (None, 3, 3)], schema)
    new = spark.createDataFrame([("x", 10, 10), ("z", 30, None), (None, 40, 40)], schema)

    def got(df):
        return sorted(map(tuple, df.collect()), key=str)

    kept = [("x", 1, 1), ("y", 2, 2), ("z", 30, None), (None, 3, 3), (None, 40, 40)]
    assert got(insert_missing(old, new, ["k"])) == sorted(kept, key=str)
    merged = [("x", 1, 10), ("y", 2, 2), ("z", 30, None), (None, 3, 3), (None, 40, 40)]
    assert got(upsert(old, new, ["k"], ["b"])) == sorted(merged, key=str)


def test_update_to_null_is_kept(spark):
    old = spark.createDataFrame([("x", 1)], "k string, a int")
    new = spark.createDataFrame([("x", None)], "k string, a int")
    assert upsert(old, new, ["k"], ["a"]).first().a is None


def test_fold_equals_repeated_upserts(spark):
    rng = random.Random(3)
    log = [(rng.choice("abc"), rng.randrange(100), rng.randrange(100), i) for i in range(60)]
    state: dict = {}
    for k, a, b, _ in log:
        state[k] = (state[k][0] if k in state else a, b)
    folded = fold_changes(spark.createDataFrame(log, "k string, a int, b int, seq int"), ["k"], ["b"], "seq")
    assert {r.k: (r.a, r.b) for r in folded.collect()} == state


# -- text and ingestion ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def gazetteer(spark):
    names = ["London", "Thunder Bay", "Amsterdam", "New York City", "Paris", "Chicago", "Dublin", "Bratislava", "Bibinje", "Banská Štiavnica"]
    return spark.createDataFrame([(n, True) for n in names] + [("Pokemon Go", False)], "city_name string, verified boolean")


CITIES = {
    "Will it rain in London tomorrow?": "London",
    "Will it snow in Thunder Bay on 2023-11-26?": "Thunder Bay",
    "Will it rain in New York City on 2023-12-01?": "New York City",
    "Will the temperature in London exceed 77°F?": "London",
    "Will it be sunny in Paris today?": "Paris",
    "Will it be windy in Chicago tomorrow?": "Chicago",
    "Will there be fog in Dublin tonight?": "Dublin",
    "Will it rain in Banská Štiavnica on 2026-04-13?": "Banská Štiavnica",
    "Will it be below 12 degrees in Paris, maybe?": "Paris",
    "Will it rain in Thunder   Bay ?": "Thunder Bay",
    "Will it rain in  Paris?": None,
    "Will Sanji have a nose bleed?": None,
    "Will it rain tomorrow?": None,
    "Will it rain in Pokemon Go on 19 August?": None,
    "Will there be rain in the Kingdom of Heaven?": None,
}


def test_extract_city(spark, gazetteer):
    df = spark.createDataFrame([(q,) for q in CITIES] * 2 + [(None,)], "question string")
    rows = G.extract_city(df, gazetteer).collect()
    assert len(rows) == 2 * len(CITIES) + 1
    assert {r.question: r.city for r in rows} == {**CITIES, None: None}


def test_resolve_city(spark):
    cases = {
        "Will it snow in NYC on 3 May?": ("New York City", False),
        "Will it rain in London tomorrow?": ("London", False),
        "Will it rain in Next Weekend?": (None, True),
        "Nothing here": (None, True),
    }
    rows = G.resolve_city(spark.createDataFrame([(q,) for q in cases], "question string")).collect()
    assert {r.question: (r.city, r.needs_review) for r in rows} == cases


MARKET = "id string, question string, slug string, url string, outcomeType string, resolution string, probability double, isResolved boolean, closeTime bigint, volume double, uniqueBettorCount int"


def market(**change):
    base = {
        "id": "m", "question": "Will it rain in London tomorrow?", "slug": "s", "url": "u", "outcomeType": "BINARY", "resolution": None,
        "probability": 0.65, "isResolved": False, "closeTime": 1700000000000, "volume": None, "uniqueBettorCount": None,
    }
    return tuple({**base, **change}.values())


def test_parse_market(spark, gazetteer):
    rows = [
        market(id="open"),
        market(id="yes", isResolved=True, resolution="YES", probability=0.8),
        market(id="no", isResolved=True, resolution="NO", probability=0.8),
        market(id="mkt", isResolved=True, resolution="MKT", probability=0.99),
        market(id="arb", probability=0.9),
        market(id="edge", probability=0.75),
        market(id="null", probability=None),
        market(id="multi", outcomeType="MULTIPLE_CHOICE"),
        market(id="nocity", question="Will it rain?"),
    ]
    got = {r.condition_id: r for r in I.parse_market(spark.createDataFrame(rows, MARKET), gazetteer, AS_OF).collect()}
    assert set(got) == {"open", "yes", "no", "mkt", "arb", "edge"}
    assert (got["yes"].actual_outcome, got["yes"].prediction_error, got["yes"].market_status) == (1, 0.2, "closed")
    assert (got["no"].winner, got["no"].prediction_error) == (False, 0.8)
    assert (got["mkt"].market_status, got["mkt"].closed, got["mkt"].winner, got["mkt"].is_arbitrage) == ("open", True, None, False)
    assert (got["arb"].is_arbitrage, got["arb"].deviation_from_base, got["arb"].base_rate) == (True, 0.55, 0.35)
    assert (got["edge"].is_arbitrage, got["open"].no_price, got["open"].price_sum) == (0.75 - 0.35 > 0.4, 0.35, 1.0)
    assert (got["open"].volume, got["open"].unique_bettors, got["open"].end_date_iso) == (0.0, 0, "2023-11-14T22:13:20Z")


def test_dedup_across_terms(spark):
    results = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (1, 1, "b"), (1, 2, "c"), (1, 3, None)], "term_no int, rank int, id string")
    assert {(r.id, r.term_no) for r in I.dedup_across_terms(results).collect()} == {("a", 0), ("b", 0), ("c", 1)}
    assert {(r.term_no, r.total, r.new_markets) for r in I.term_report(results).collect()} == {(0, 2, 2), (1, 3, 1)}


def test_contract(spark):
    df = spark.createDataFrame([("x", None)], "location_name string, market_type string")
    errors = Q.validate(df, "alert").first().errors
    assert "Missing required field: MARKET_TYPE" in errors and "Missing required field: SEVERITY" in errors
    assert not any("METRIC_VALUE" in e or "LOCATION_NAME" in e for e in errors)
    assert Q.validate(df, "no such topic").first().errors == []


def test_constraints_pass_nulls(spark):
    rows = [(0, 0.5), (None, None), (2, 0.5), (1, 1.5), (3, -0.1)]
    got = Q.check_constraints(spark.createDataFrame(rows, "actual_outcome int, prediction_error double")).collect()
    assert [r.violations for r in got] == [[], [], ["valid_outcome"], ["valid_error"], ["valid_outcome", "valid_error"]]


def test_decode(spark):
    rows = [(b'{"a": 1}',), (b'{"a": ',), (b"\x00\x00\x00\x00\x01abc",), (b"[1]",), (None,)]
    got = decode(spark, spark.createDataFrame(rows, "value binary"), "a int").collect()
    assert [r.record and r.record.a for r in got] == [1, None, None, None, None]


def test_canonical_fields(spark):
    df = spark.createDataFrame([("a", 0.0, True)], "CONDITION_ID string, yes_price double, other boolean")
    assert I.canonical_fields(df).first().asDict() == {"condition_id": "a", "price": 0.0, "other": True}


def test_latency_histogram(spark):
    df = spark.createDataFrame([(30,), (31,), (5000,), (None,)], "correlation_latency bigint")
    rows = {r.le: r.cumulative for r in M.latency_histogram(df).collect()}
    assert (rows["30"], rows["60"], rows["3600"], rows["+Inf"]) == (1, 2, 2, 3)


def test_observed_counters_need_no_second_pass(spark):
    df, watch = M.observe_counters(spark.range(10), "run", even=F.col("id") % 2 == 0)
    df.write.format("noop").mode("overwrite").save()
    assert watch.get == {"rows": 10, "even": 5}


@pytest.mark.parametrize("variant", ["batch", "stream"])
def test_panes_equal_windows(spark, variant):
    """Summing panes first gives what windowing every row gives."""
    from foretell import hopping
    from foretell.operators import accuracy as A

    rng = random.Random(2)
    base = datetime(2026, 5, 1)
    methods = ["winner_known", "current_snapshot", "historical_weather"]
    rows = [
        (rng.choice("AB"), "RAIN", rng.randrange(101) / 100, rng.choice([0, 1, None]), rng.choice([0.25, None]), rng.choice(methods),
         rng.choice([1.5, 0.0, None]), base + timedelta(minutes=rng.randrange(300)))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, CORR + ", poll_ts timestamp")
    totals, metrics = (A.batch_totals, A.batch_metrics) if variant == "batch" else (A.stream_totals, A.stream_metrics)
    direct = df.groupBy(F.window("poll_ts", "1 hour", "15 minutes").alias("w"), *A.group_keys()).agg(*totals())
    direct = metrics(direct, [*A.GROUP, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")])
    assert sorted(map(str, hopping(df, variant=variant).collect())) == sorted(map(str, direct.collect()))

"""Cases outside the oracle data: chunks, digits, repeated keys, malformed records."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from foretell.functions.numeric import LIMB, sum_units, summed, to_units
from foretell.operators.accuracy import accuracy
from foretell.operators.alerts import cross_market_sum
from foretell.operators.baseline import DAY_MICROS, mean_std
from foretell.operators.upsert import insert_missing, upsert
from foretell.plans.jobs import save_alerts
from foretell.sources import topics
from tests import test_pending_pages, test_rolling_state


@pytest.mark.parametrize("size", [1, 3, 10_000])
def test_pairs_do_not_depend_on_chunks(size):
    hour = 3_600_000_000
    rows = [
        (1, "a", 5 * hour, 1),
        (0, None, 6 * hour, 1),
        (1, "b", 1 * hour, 2),
        (0, None, 2 * hour, 2),
        (1, "c", 2 * hour, 1),
        (1, "c", 3 * hour, 0),
        (0, None, 4 * hour, 1),
    ]
    # c was replaced by a poll that nothing settles before the weather of hour 4 came
    assert test_pending_pages.run(test_pending_pages.processor()[0], [rows], size) == [
        ("a", 5 * hour, 4 * hour),
        ("b", 1 * hour, 2 * hour),
    ]


@pytest.mark.parametrize("size", [1, 2, 10_000])
def test_history_does_not_depend_on_chunks(size):
    rows = [(day * DAY_MICROS, 1, 0) for day in (3, 4, 1, 2)]
    assert [row[1] for row in test_rolling_state.run([rows], size)[0]] == [1, 2, 3, 4]


def test_prices_are_not_cut_before_the_threshold(spark):
    row = ("London", "RAIN", False, None, 0.50504)
    df = spark.createDataFrame([row, row], "location_name string, market_type string, closed boolean, end_date date, price double")
    assert [r.price_sum for r in cross_market_sum(df).collect()] == [1.0101]


def test_mean_of_fine_values(spark):
    df = spark.createDataFrame([("a", 0.00004), ("a", 0.00004), ("a", 0.00008)], "k string, v double")
    got = mean_std(df, ["k"], F.col("v") * 1000).first()
    assert (got["mean"], got["std"]) == (0.0533, 0.0189)


def test_insert_keeps_one_of_repeated_keys_and_all_without(spark):
    schema = "k int, v string"
    old = spark.createDataFrame([(1, "old")], schema)
    new = spark.createDataFrame([(2, "b"), (2, "a"), (1, "x"), (None, "p"), (None, "q")], schema)
    got = sorted(((r.k or 0), r.v) for r in insert_missing(old, new, ["k"], ["v"]).collect())
    assert got == [(0, "p"), (0, "q"), (1, "old"), (2, "a")]


def test_upsert_lets_null_keys_by(spark):
    schema = "k int, v string"
    old = spark.createDataFrame([(1, "old"), (None, "n")], schema)
    new = spark.createDataFrame([(1, "new"), (None, "m")], schema)
    got = sorted(((r.k or 0), r.v) for r in upsert(old, new, ["k"], ["v"]).collect())
    assert got == [(0, "m"), (0, "n"), (1, "new")]


def test_alerts_saved_twice_stand_once(spark):
    schema = "alert_id bigint, alert_type string, location_name string, market_type string, severity string, message string, "
    schema += "metric_value double, threshold_value double, is_resolved boolean, resolved_at timestamp, detected_at timestamp"
    day = datetime(2026, 5, 1)
    stored = spark.createDataFrame(
        [(1, "drop", "Oslo", "RAIN", "low", "old", 0.1, 0.6, True, day, day), (2, "drop", "Rome", "RAIN", "low", "r", 0.2, 0.6, False, None, day)],
        schema,
    )
    fired = [
        ("drop", "Oslo", "RAIN", "high", "worse", 0.5, 0.7),
        ("drop", "Oslo", "RAIN", "mid", "bad", 0.4, 0.8),
        ("new", "Oslo", "RAIN", "mid", "b", 2.0, 0.2),
        ("new", "Oslo", "RAIN", "mid", "a", None, 0.1),
        ("loose", None, "RAIN", "mid", "n", 1.0, 0.1),
    ]
    names = "alert_type string, location_name string, market_type string, severity string, message string, metric_value double, threshold_value double"
    fresh = spark.createDataFrame(fired, names).selectExpr(
        "*", "9.5D as deviation", "false as is_resolved", "timestamp'2026-05-02' as detected_at"
    )
    once = save_alerts(stored, fresh)
    got = {(r.alert_type, r.location_name): r for r in once.collect()}
    assert len(got) == 4 and once.columns == [*stored.columns, "deviation"]
    oslo, new = got["drop", "Oslo"], got["new", "Oslo"]
    # the last in order of value gives what is updated; a standing alert keeps the rest
    assert (oslo.alert_id, oslo.severity, oslo.message, oslo.threshold_value, oslo.is_resolved) == (1, "high", "worse", 0.6, True)
    assert (new.message, new.metric_value, new.threshold_value, new.deviation) == ("b", 2.0, 0.1, 9.5)
    assert got["drop", "Rome"].message == "r" and got["loose", None].alert_id is None
    keyed = fresh.where("location_name is not null")
    first = save_alerts(stored, keyed)
    assert sorted(map(str, save_alerts(first, keyed).collect())) == sorted(map(str, first.collect()))


def test_malformed_json_is_null(spark):
    df = spark.createDataFrame([(s,) for s in ('{"k": 1}', '{"k": 1,,}', "{bad}", "{k: }", "[1]", "", None)], "value string")
    got = [r.record for r in topics.decode(spark, df, "k int").collect()]
    assert [g and g.k for g in got] == [1] + [None] * 6 and got[1:] == [None] * 6


def test_a_view_leaves_other_views_alone(spark):
    from foretell.plans.views import query_view

    spark.range(3).createOrReplaceTempView("pipeline_health")
    schema = "component string, status string, messages_processed bigint, error_count bigint, last_message_at timestamp, latency_ms bigint, recorded_at timestamp"
    one, two = (spark.sql("SELECT 1").select(F.lit(n).alias("component"), *[F.lit(None).cast(c.split()[1]).alias(c.split()[0])
                for c in schema.split(", ")[1:-1]], F.current_timestamp().alias("recorded_at")) for n in ("a", "b"))
    first = query_view(spark, "v_pipeline_health", "2024-01-31 00:00:00", pipeline_health=one)
    second = query_view(spark, "v_pipeline_health", "2024-01-31 00:00:00", pipeline_health=two)
    assert [r.component for r in first.collect()] == ["a"] and [r.component for r in second.collect()] == ["b"]
    assert spark.table("pipeline_health").count() == 3
    spark.catalog.dropTempView("pipeline_health")


def test_a_silent_key_has_no_baseline(spark):
    from foretell.operators.baseline import newest_judged

    rows = [("old", "RAIN", f"2024-01-0{d} 00:00:00", 0.9) for d in range(1, 6)]
    rows += [("new", "RAIN", f"2024-01-2{d} 00:00:00", 0.9) for d in range(5, 9)] + [("new", "RAIN", "2024-01-01 00:00:00", 0.1)]
    frame = spark.createDataFrame(rows, "location_name string, market_type string, at string, accuracy_rate double").select(
        "location_name", "market_type", "accuracy_rate", F.lit(0.0).alias("bias_score"), F.lit(20).cast("bigint").alias("total_predictions"),
        F.col("at").cast("timestamp").alias("window_start"), F.col("at").cast("timestamp").alias("window_end"))
    got = {r.location_name: r for r in newest_judged(frame, "2024-01-31 00:00:00").collect()}
    assert (got["old"].baseline_source, got["old"].baseline_n, got["old"].accuracy_threshold) == ("static_fallback", 0, 0.8)
    assert (got["new"].baseline_source, got["new"].baseline_n, got["new"].acc_mean) == ("7day_statistical", 4, 0.9)


def test_numbers_that_are_none_are_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", float("inf")), ("a", 3.0)], "k string, v double")
    got = mean_std(df, ["k"], F.col("v")).first()
    assert (got["n"], got["mean"], got["std"]) == (2, 2.0, 1.0)
    large = spark.createDataFrame([("a", 1e10), ("a", 3e10), ("b", 0.1), ("b", 0.1)], "k string, v double")
    got = {r.k: (r.n, r["mean"], r["std"]) for r in mean_std(large, ["k"], F.col("v")).collect()}
    assert got == {"a": (2, 2e10, 1e10), "b": (2, 0.1, 0.0)}
    one = spark.range(1).select(to_units(F.lit(float("nan")), 9).alias("a"), to_units(F.lit(1e30), 9).alias("b")).first()
    assert tuple(one) == (None, None)


def test_a_bad_price_does_not_end_the_job(spark):
    row = ("Oslo", "RAIN", 1, "historical_weather")
    rows = [(*row, 0.75, 0.25, 10.0), (*row, float("nan"), float("nan"), float("inf")), (*row, 1e30, 1e30, 1e40)]
    names = "location_name string, market_type string, actual_outcome int, correlation_method string, price double, prediction_error double, volume double"
    for variant in ("batch", "stream"):
        got = accuracy(spark.createDataFrame(rows, names), variant).first()
        assert got["total_predictions"] == 3 and got["location_name"] == "Oslo"
    alone = accuracy(spark.createDataFrame(rows[:2], names), "stream").first()
    assert (alone["accuracy_rate"], alone["avg_prediction_error"], alone["bias_score"]) == (1.0, 0.25, -0.25)


def test_sums_of_many_rows_stay_exact(spark):
    """10^10 and more rows of 1.0, each row here standing for many: both limbs merge by addition."""
    units = (F.lit(1_000_000_007).cast("bigint"), 4 * 10**9)
    part = spark.range(25).select(
        (units[0].bitwiseAND((1 << LIMB) - 1) * units[1]).alias("u"), (F.shiftright(units[0], LIMB) * units[1]).alias("u_high")
    )
    merged = part.agg(F.sum("u").alias("u"), F.sum("u_high").alias("u_high"))
    exact = merged.select(summed("u", "decimal(38,0)").alias("x"), summed("u").alias("y")).first()
    assert int(exact.x) == 25 * units[1] * 1_000_000_007 and exact.y == float(25 * units[1] * 1_000_000_007)
    signed = spark.createDataFrame([(-5,), (7_000_000_000,), (-3_000_000,)], "u bigint").agg(*sum_units(F.col("u"), "u"))
    assert int(signed.select(summed("u", "decimal(38,0)").alias("x")).first().x) == 7_000_000_000 - 5 - 3_000_000

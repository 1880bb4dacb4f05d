"""Streaming jobs over several micro-batches against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from foretell import baselines, stream_pending_join
from foretell.sources import topics
from foretell.sources.session import scratch, scratch_root
from foretell.streaming.rolling_alerts import stream_baselines
from foretell.streaming.run import drain, drain_into
from tests.test_operators import aggregates

T0 = datetime(2026, 5, 20)


def topic(spark, frame, path=None):
    path = path or scratch(spark, "topic")
    frame.write.mode("append").parquet(path)
    return path


def run_rounds(spark, predictions, weather, rounds, **options):
    """Each round appends its predictions and weather, then drains the join."""
    p_path, w_path, out, state = (scratch(spark, n) for n in ("p", "w", "out", "state"))
    for p_rows, w_rows in rounds:
        p, w = predictions(*p_rows), weather(*w_rows)
        topic(spark, p if p_rows else p.limit(0), p_path)
        topic(spark, w if w_rows else w.limit(0), w_path)
        joined = stream_pending_join(
            topics.read_stream(spark, p_path, p.schema), topics.read_stream(spark, w_path, w.schema), **options
        )
        result = drain_into(joined, out, state)
    return sorted((r.condition_id, r.actual_outcome, r.correlation_method) for r in result.collect())


def pred(i, hours, **change):
    return {"condition_id": i, "poll_ts": T0 + timedelta(hours=hours), **change}


def obs(i, hours, **change):
    return {"obs_id": i, "poll_ts": T0 + timedelta(hours=hours), **change}


def test_prediction_waits_for_later_weather(spark, predictions, weather):
    rounds = [([pred("a", 0)], [obs(0, 0, location_name="Oslo")]), ([pred("z", 1, location_name="Rome")], [obs(1, 2)])]
    assert run_rounds(spark, predictions, weather, rounds) == [("a", 1, "current_snapshot")]


def test_newest_weather_answers_at_once_and_repolls_repeat(spark, predictions, weather):
    rounds = [([pred("z", 0, location_name="Rome")], [obs(1, 0), obs(2, 1, weather_code=0)]), ([pred("a", 2)], []), ([pred("a", 3)], [])]
    got = run_rounds(spark, predictions, weather, rounds)
    assert got == [("a", 0, "current_snapshot")] * 2


def test_unanswerable_weather_leaves_prediction_waiting(spark, predictions, weather):
    wind = {"market_type": "WIND"}
    rounds = [
        ([pred("a", 1, **wind)], [obs(1, 0, wind_kmh=None)]),
        ([pred("z", 2, location_name="Rome")], [obs(2, 2, wind_kmh=None)]),
        ([pred("z", 3, location_name="Rome")], [obs(3, 3, wind_kmh=31.0)]),
        ([pred("z", 4, location_name="Rome")], [obs(4, 4, wind_kmh=1.0)]),
    ]
    assert run_rounds(spark, predictions, weather, rounds) == [("a", 1, "current_snapshot")]


def test_state_expires(spark, predictions, weather):
    rounds = [([pred("old", 0), pred("young", 5)], [obs(0, 0, location_name="Oslo")]), ([pred("z", 25, location_name="Rome")], [obs(1, 25)])]
    assert run_rounds(spark, predictions, weather, rounds) == [("young", 1, "current_snapshot")]


@pytest.mark.parametrize("salts", [1, 5])
def test_pairs_do_not_depend_on_salts(spark, predictions, weather, salts):
    rng = random.Random(11)
    kinds = ["RAIN", "WIND", "FOG", "FROST", "VOLCANO"]
    p = [pred(f"m{i}", rng.uniform(0, 20), market_type=rng.choice(kinds)) for i in range(60)]
    w = [
        obs(i, rng.uniform(0, 20), weather_code=rng.choice([None, 45, 61]), wind_kmh=rng.choice([None, 40.0]), temp_c=rng.choice([None, -1.0]))
        for i in range(30)
    ]
    got = run_rounds(spark, predictions, weather, [(p, w)], salts=salts)
    assert got == brute_force(p, w)


def brute_force(p, w):
    """Replay both streams in event order."""
    needs = {
        "RAIN": lambda o: True,
        "WIND": lambda o: o["wind_kmh"] is not None,
        "FOG": lambda o: o["weather_code"] is not None,
        "FROST": lambda o: o["temp_c"] is not None,
        "VOLCANO": lambda o: False,
    }
    truth = {
        "RAIN": lambda o: int(o["weather_code"] == 61 if o["weather_code"] is not None else True),
        "WIND": lambda o: 1,
        "FOG": lambda o: int(o["weather_code"] == 45),
        "FROST": lambda o: 1,
    }
    latest, waiting, out = None, [], []

    def emit(x):
        out.append((x["condition_id"], truth[x["market_type"]](latest), "current_snapshot"))

    for x in sorted(p + w, key=lambda x: (x["poll_ts"], "condition_id" in x)):
        if "condition_id" in x:
            if latest and needs[x["market_type"]](latest):
                emit(x)
            else:
                waiting.append(x)
        else:
            latest = x
            for y in [y for y in waiting if needs[y["market_type"]](x)]:
                emit(y)
                waiting.remove(y)
    return sorted(out)


def test_rolling_stream_equals_batch_over_many_batches(spark):
    rng = random.Random(5)
    rows = aggregates(spark, *[(rng.randrange(10001) / 1e4, rng.randrange(-9999, 9999) / 1e4, rng.choice([5, 20])) for _ in range(25)])
    path, out, state = (scratch(spark, n) for n in ("agg", "out", "state"))
    for low, high in ((0, 9), (9, 10), (10, 31)):
        part = F.dayofmonth("window_start").between(low + 1, high)
        topic(spark, rows.where(part), path)
        result = drain_into(stream_baselines(topics.read_stream(spark, path, rows.schema)), out, state)
    columns = ["window_end", "baseline_n", "accuracy_threshold", "bias_threshold", "baseline_source"]
    batch = baselines(rows, abs_bias=False, min_total=10)
    assert sorted(map(tuple, result.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))


class Conf:
    """Stands in for a session of some cluster."""

    def __init__(self, master, folder):
        self.sparkContext = self
        self.conf, self.master, self.folder = self, master, folder

    def get(self, key, default):
        return self.folder if key == "spark.checkpoint.dir" else default


def test_scratch_folder():
    assert scratch_root(Conf("spark://host:7077", "/shared/place/")) == "/shared/place"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Conf("spark://host:7077", None))


def test_drained_source_keeps_every_row(spark):
    rows = spark.range(100).withColumn("v", F.col("id") * 2)
    stream = topics.read_stream(spark, topic(spark, rows), rows.schema)
    assert sorted(map(tuple, drain(stream, "all").collect())) == sorted(map(tuple, rows.collect()))

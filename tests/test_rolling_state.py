"""Rolling sums: the batch form against numpy, the stream's state with a stand-in store."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foretell.operators import baseline
from foretell.streaming import rolling_alerts as R
from tests.test_pending_pages import Clock, Handle

DAY = baseline.DAY_MICROS
HOUR = DAY // 24


def window_sums(at, value, span):
    """Sums over [t - span, t] for every t, ties included."""
    order = np.argsort(at, kind="stable")
    times, running = at[order], np.concatenate([[0], np.cumsum(value[order])])
    return running[np.searchsorted(times, at, "right")] - running[np.searchsorted(times, at - span, "left")]


def test_batch_sums_equal_numpy_on_a_dense_key(spark):
    """A million rows of one key in a week and a bit, ties and nulls among them."""
    n = 1_000_000
    rows = spark.range(n).select(
        F.lit("Oslo").alias("location_name"),
        F.lit("RAIN").alias("market_type"),
        F.timestamp_micros((F.col("id") * 7919 % n) * 800_000 - F.col("id") % 3 * 800_000).alias("ts"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 97).alias("v"),
        F.col("id").alias("chunk"),
    )
    out = baseline.over_history(rows, "ts", 7, {"total": F.col("v"), "n": F.col("v").isNotNull().cast("bigint")})
    assert out.columns == [*rows.columns, "total", "n"]
    got = out.select(F.unix_micros("ts").alias("at"), "v", "chunk", "total", "n").toPandas().sort_values("chunk")
    at, v = got["at"].to_numpy(), got["v"].fillna(0).to_numpy(dtype=np.int64)
    assert (got["total"].to_numpy() == window_sums(at, v, 7 * DAY)).all()
    assert (got["n"].to_numpy() == window_sums(at, got["v"].notna().to_numpy(dtype=np.int64), 7 * DAY)).all()


def test_batch_sums_have_no_sliding_frame(spark, capsys):
    rows = spark.createDataFrame([], "location_name string, market_type string, ts timestamp, accuracy_rate double, bias_score double")
    baseline.rolling_sums(rows, "ts", 7, True).explain("extended")
    plan = capsys.readouterr().out
    assert "RangeFrame, unboundedpreceding$(), currentrow$()" in plan and "RangeFrame, -" not in plan
    assert baseline.rolling_sums(rows, "ts", 7, True).count() == 0


def frame(rows):
    at, acc, bias = (np.array(c, dtype=np.int64) for c in zip(*rows))
    return pd.DataFrame({"at": at, "acc": acc, "bias": bias, "total_predictions": 10, "accuracy_rate": acc / 1e4, "bias_score": bias / 1e4})


def run(batches, size, days=7):
    processor, handle = R.RollingHistory(days), Handle()
    processor.init(handle)
    out = []
    for rows in batches:
        whole = frame(rows)
        chunks = (whole.iloc[i : i + size] for i in range(0, len(whole), size))
        for found in processor.handleInputRows(("Oslo", "RAIN"), chunks, None):
            out += zip(*(found[c].tolist() for c in ("at", "n_rows", "s_acc", "q_acc", "s_bias", "q_bias")))
    return sorted(out), processor, handle


def expected(batches, days=7):
    out, history = [], []
    for rows in batches:
        history += rows
        for at, _, _ in rows:
            inside = [r for r in history if at - days * DAY <= r[0] <= at]
            acc, bias = [r[1] for r in inside], [r[2] for r in inside]
            out.append((at, len(inside), sum(acc), sum(a * a for a in acc), sum(bias), sum(b * b for b in bias)))
    return sorted(out)


@pytest.mark.parametrize("size", [1, 7, 10_000])
@pytest.mark.parametrize("held", [4, 50_000])
def test_stream_sums_equal_a_scan_for_any_chunk_and_order(monkeypatch, size, held):
    monkeypatch.setattr(R, "HELD", held)
    pick = random.Random(2)
    batches = []
    for part in range(6):
        # each batch reaches some hours back into the one before
        times = [part * 2 * DAY + pick.randrange(-20, 48) * HOUR for _ in range(40)]
        batches.append([(t, pick.randrange(10_001), pick.randrange(-9_999, 9_999)) for t in times])
    got = run(batches, size)[0]
    assert got == expected(batches)
    mixed = [pick.sample(rows, len(rows)) for rows in batches]
    assert run(mixed, 3)[0] == got


def test_state_grows_with_instants_of_the_last_days_only():
    # forty days of hourly rows, a hundred at each hour, a batch a day
    batches = [[(day * DAY + hour * HOUR, 9_000, 5) for hour in range(24) for _ in range(100)] for day in range(40)]
    out, processor, handle = run(batches, 1000)
    panes = handle.states["panes"]
    assert len(panes.values) <= 7 + 2 + R.SLACK_DAYS and not handle.states["rows"].values
    assert sum(len(pane[0]) for pane in panes.values.values()) <= 24 * len(panes.values)
    assert out[-1][1] == 100 * (7 * 24 + 1)
    # a batch reads the day its windows begin on and the day after it, and writes its own day
    panes.reads = panes.writes = 0
    list(processor.handleInputRows(("Oslo", "RAIN"), iter([frame([(40 * DAY + HOUR, 1, 1)])]), None))
    assert panes.reads <= 2 and panes.writes == 1
    list(processor.handleExpiredTimer(("Oslo", "RAIN"), Clock(60 * DAY), None))
    assert not panes.values and handle.states["head"].get() is None

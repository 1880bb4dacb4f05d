"""The change log: replays, restarts, crashes and compaction."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foretell.sources import topics
from foretell.sources.changelog import ChangeLog
from foretell.sources.session import scratch

SCHEMA = "k string, kept int, v int, n bigint"


@pytest.fixture
def log(spark):
    return ChangeLog(spark, scratch(spark, "log"), ["k"], ["v"], "n")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def state(log):
    return {r.k: (r.kept, r.v) for r in log.read().collect()}


def test_replays_change_nothing_and_order_is_that_of_commits(spark, log):
    first, second = batch(spark, ("x", 1, 1, 5)), batch(spark, ("x", 9, 2, 0), ("y", 5, 5, 1))
    assert log.append(first, "s", 0) and log.append(second, "s", 1)
    assert not log.append(second, "s", 1) and not log.append(first, "s", 0)
    assert state(log) == {"x": (1, 2), "y": (5, 5)}
    # another stream starts at batch 0 again and goes on behind
    assert log.append(batch(spark, ("x", 7, 3, 0)), "t", 0)
    assert state(log)["x"] == (1, 3)
    # rows of one batch by their own order
    assert log.append(batch(spark, ("x", 7, 6, 2), ("x", 7, 4, 1)), "t", 1) and state(log)["x"] == (1, 6)


def test_crash_before_the_commit_leaves_no_trace(spark, log, monkeypatch):
    log.append(batch(spark, ("x", 1, 1, 0)), "s", 0)

    def crash(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(log, "_commit", crash)
        with pytest.raises(OSError):
            log.append(batch(spark, ("x", 1, 99, 0)), "s", 1)
        assert state(log) == {"x": (1, 1)}
        with pytest.raises(OSError):
            log.compact()
    assert state(log) == {"x": (1, 1)}
    assert log.append(batch(spark, ("x", 1, 2, 0)), "s", 1) and state(log) == {"x": (1, 2)}


def test_the_clock_has_no_part(spark, log, monkeypatch):
    import time

    log.append(batch(spark, ("x", 1, 1, 0)), "s", 0)
    monkeypatch.setattr(time, "time", lambda: 0.0)
    monkeypatch.setattr(time, "time_ns", lambda: 0)
    log.append(batch(spark, ("x", 1, 2, 0)), "a stream with an earlier name", 0)
    assert state(log) == {"x": (1, 2)}


def test_compaction_bounds_what_is_read_and_kept(spark, log):
    for n in range(6):
        log.append(batch(spark, (f"k{n % 3}", n, n, 0)), "s", n)
        if n % 2:
            before = state(log)
            log.compact()
            assert state(log) == before
            assert len(log.commits()) == 1 and len(log.read().inputFiles()) <= 3
    assert state(log) == {"k0": (0, 3), "k1": (1, 4), "k2": (2, 5)}
    # a batch committed before the snapshot is known as such
    assert not log.append(batch(spark, ("k0", 0, 77, 0)), "s", 5)
    assert log.append(batch(spark, ("k0", 0, 78, 0)), "s", 6) and state(log)["k0"] == (0, 78)
    log.compact()
    # this generation and the one before; of older ones an empty file
    folders = sorted(Path(log.path.removeprefix("file://"), "data").iterdir())
    full = [f for f in folders if any(p.is_dir() for p in f.iterdir())]
    assert len(full) == 2 and len(folders) == 5
    manifests = list(Path(log.path.removeprefix("file://"), "commits").rglob("seq=*"))
    assert len(manifests) == 3  # the snapshot, and the snapshot and delta before
    # nothing new, nothing done
    gen = log.commits()[0].gen
    log.compact()
    assert log.commits()[0].gen == gen


def test_restart_and_new_checkpoint(spark, log):
    """The same checkpoint goes on where it ended; a new one applies the topic again, to the same table."""
    topic, checkpoint = scratch(spark, "topic"), scratch(spark, "state")
    runs = []

    def drain(state_folder):
        stream = topics.read_stream(spark, topic, batch(spark).schema)
        write = log.sink(compact_every=3)

        def twice(rows, batch_id):
            write(rows, batch_id)
            write(rows, batch_id)
            runs.append(batch_id)

        query = (
            stream.writeStream.foreachBatch(twice).option("checkpointLocation", state_folder).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    for n in range(4):
        batch(spark, ("x", n, n, n), (f"y{n}", n, n, n)).write.mode("append").parquet(topic)
        drain(checkpoint)
    want = {"x": (0, 3), **{f"y{n}": (n, n) for n in range(4)}}
    assert state(log) == want and len(runs) == 4
    drain(checkpoint)
    assert state(log) == want and len(runs) == 4
    drain(scratch(spark, "new-state"))
    assert state(log) == want and len(runs) == 5
    assert log.read().where(F.col("k") == "x").count() == 1


def test_empty_log_and_empty_batch(spark, log):
    with pytest.raises(ValueError, match="nothing has been committed"):
        log.read()
    log.compact()
    assert log.append(batch(spark), "s", 0) and log.read().count() == 0

"""Live counters: listed labels, other values, batches told twice."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Row
from pyspark.sql import functions as F

from foretell.sources import topics
from foretell.sources.session import scratch
from foretell.streaming.counters import CounterListener, count_labels
from foretell.streaming.run import start_append


def progress(query, batch, **metrics):
    return SimpleNamespace(progress=SimpleNamespace(id=query, batchId=batch, observedMetrics=metrics))


def test_a_batch_counts_once():
    listener = CounterListener()
    for batch in (0, 1, 1, 0, 2):
        listener.onQueryProgress(progress("q", batch, seen=Row(**{"k=a": 3, "k=other": 0})))
    listener.onQueryProgress(progress("q", 3))
    listener.onQueryProgress(progress("p", 0, seen=Row(**{"k=a": 1})))
    assert listener.values == {("seen", "k=a"): 10, ("seen", "k=other"): 0}


def test_counters_of_a_restarted_stream(spark):
    rows = spark.range(100).select(
        F.when(F.col("id") % 10 != 0, F.concat(F.lit("t"), F.col("id") % 4)).alias("kind"), (F.col("id") % 3 == 0).cast("string").alias("ok")
    )
    path, out, state = (scratch(spark, n) for n in ("topic", "out", "state"))
    listener = CounterListener()
    spark.streams.addListener(listener)
    try:
        for _ in range(2):
            rows.write.mode("append").parquet(path)
            stream = count_labels(topics.read_stream(spark, path, rows.schema), "n", {"kind": ["t0", "t1"], "ok": ["true"]})
            listener.settle(start_append(stream, out, state))
    finally:
        spark.streams.removeListener(listener)
    known = F.when(F.col("kind").isin("t0", "t1"), F.col("kind")).otherwise("other")
    labels = F.concat(F.lit("kind="), known, F.lit(",ok="), F.when(F.col("ok") == "true", "true").otherwise("other"))
    want = {r[0]: 2 * r[1] for r in rows.groupBy(labels).count().collect()}
    assert {r.labels: r.value for r in listener.frame(spark).collect()} == want
    assert spark.read.parquet(out).count() == 200

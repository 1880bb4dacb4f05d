"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from functools import cache

import pytest

import __spark_entry__ as registered

SF = "/root/testdata/sf0.001"
# whole-stage methods above this size are never compiled by the JIT
JIT_LIMIT = 8000


@cache
def plan(spark, name):
    return registered.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["weather_snapshot", "dedup_prefer_closed", "dedup_prefer_winner", "dedup_first_seen", "latest_aggregate", "latest_health", "compacted_view"],
)
def test_one_row_per_key_is_cut_before_the_exchange(spark, name):
    text = plan(spark, name)
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit", text), text


@pytest.mark.parametrize(
    "name", ["accuracy_metrics_batch", "hopping_accuracy", "cross_market_sum", "join_coverage", "fold_changes", "term_report"]
)
def test_groups_combine_before_the_exchange(spark, name):
    assert re.search(r"partial_|Exchange.*\n.*(Hash|Sort)Aggregate", plan(spark, name))


def test_scan_reads_only_what_it_needs(spark):
    text = plan(spark, "scan_table")
    assert "GreaterThanOrEqual(ts" in text and "GreaterThan(value,50.0)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in text


def test_health_filter_reaches_the_scan(spark):
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\w*\(ts", plan(spark, "health_semi_join"))


def test_flagship_columns(spark):
    text = plan(spark, "accuracy_metrics_batch")
    assert "c_name" not in text and "o_orderdate" not in text and "o_orderpriority" not in text


@pytest.mark.parametrize("name", ["accuracy_metrics_batch", "accuracy_metrics_stream", "correlate", "hopping_accuracy"])
def test_generated_methods_fit_the_jit(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = registered.queries()[name](spark, SF)
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution, "debug"), "package$")
        code = getattr(debug, "MODULE$").codegenString(frame._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)) < JIT_LIMIT


def test_alert_run_reads_stored_inputs_once_and_exchanges_little(spark):
    from foretell.checks.alerting import _run_inputs
    from foretell.operators.alerts import detect_all
    from foretell.plans.fixtures import AS_OF, POLL_ORDER, Fixtures
    from foretell.sources.session import scratch

    stored = []
    for name, frame in zip(("aggregates", "polls", "health", "expected", "scored"), _run_inputs(Fixtures(spark, SF))):
        path = scratch(spark, f"run-{name}")
        frame.write.parquet(path)
        stored.append(spark.read.parquet(path))
    text = detect_all(*stored, AS_OF, POLL_ORDER)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 6
    scans = {name: len(re.findall(rf"FileScan parquet.*run-{name}", text)) for name in ("aggregates", "polls", "expected", "scored")}
    assert set(scans.values()) == {1}, scans

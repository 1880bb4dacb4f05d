"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from foretell import checks
from tests.compare import DATA, compare, database

FOLDER = DATA / "sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


# empty at this size: its predictions span three days of January, no aggregate has ten
# of them, and no feed reported in the last ten minutes
MAY_BE_EMPTY = {
    "alert_accuracy_drop", "alert_accuracy_drop_stream", "alert_bias", "alert_bias_stream", "alert_message",
    "append_alert", "baseline_state", "state_ttl_8d", "stream_rolling_alerts", "alert_low_coverage",
    "accuracy_trend", "current_accuracy", "recent_correlations", "health_semi_join",
}


# queries of the training-data operators have tests of their own
@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_matches_sql(spark, con, name):
    df = checks.QUERIES[name](spark, str(FOLDER))
    problem = compare(df, con, checks.ORACLES[name])
    assert problem == "" or (problem == "EMPTY" and name in MAY_BE_EMPTY)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan


def test_entry(spark):
    assert registered.entry(spark).count() > 0

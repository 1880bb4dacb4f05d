"""Bucketed tables: plans, layout over versions, crashes, other sessions."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foretell.operators.upsert import upsert
from foretell.sources.bucketed import BucketedTable
from foretell.sources.session import scratch

BUCKETS = 5


def rows(spark, low, high, add):
    return spark.range(low, high).select(
        F.concat(F.lit("k"), "id").alias("k"),
        (F.col("id") % 7).alias("part"),
        (F.col("id") + add).alias("v"),
        F.lit(add).alias("kept"),
    )


@pytest.fixture
def table(spark):
    table = BucketedTable(spark, scratch(spark, "bucketed"), ["k", "part"], BUCKETS)
    table.write(rows(spark, 0, 500, 0))
    return table


def state(df):
    return sorted(map(tuple, df.collect()))


def test_only_incoming_rows_are_exchanged(spark, table):
    plan = table.merged(rows(spark, 400, 600, 1000), ["v"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Bucketed: true" in plan
    # more partitions by default than buckets, and fewer
    for n in (2, 50):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            plan = table.merged(rows(spark, 400, 600, 1000), ["v"])._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_upserts_keep_rows_and_layout(spark, table):
    want = rows(spark, 0, 500, 0)
    for n in range(1, 4):
        incoming = rows(spark, 100 * n, 100 * n + 450, 1000 * n)
        table.upsert(incoming, ["v"])
        want = upsert(want, incoming, ["k", "part"], ["v"])
        assert state(table.read()) == state(want)
        # one file for each bucket, whatever the number of versions
        assert len(table.read().inputFiles()) <= BUCKETS
    assert table.read().where("k = 'k120'").first().kept == 0


def test_a_crash_before_the_manifest_changes_nothing(spark, table, monkeypatch):
    before = state(table.read())

    def crash(version):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(table, "_manifest", crash)
        with pytest.raises(OSError):
            table.upsert(rows(spark, 0, 900, 5), ["v"])
    assert state(table.read()) == before
    table.upsert(rows(spark, 0, 1, 77), ["v"])
    assert [r for r in state(table.read()) if r[0] == "k0"] == [("k0", 0, 77, 0)]


def test_a_new_session_finds_the_layout(spark, table):
    other = BucketedTable(spark.newSession(), table.path, ["k", "part"], BUCKETS)
    name = other._name(other._newest().version)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    assert state(other.read()) == state(rows(spark, 0, 500, 0)) and Path(other._newest().folder.removeprefix("file:")).exists()
    plan = other.merged(rows(other.spark, 0, 9, 1), ["v"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_null_keys_and_empty_tables(spark):
    table = BucketedTable(spark, scratch(spark, "bucketed"), ["k"], 3)
    with pytest.raises(ValueError, match="nothing has been written"):
        table.read()
    table.write(spark.createDataFrame([], "k string, v int"))
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([("a", 1), (None, 2)], "k string, v int"), ["v"])
    assert state(table.read()) == [("a", 1)]

"""Stored tables: scans, appends and compacted topics. ``changelog`` holds tables that take upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def scan_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
    format: str = "parquet",
    **options,
) -> DataFrame:
    """Pruned and filtered scan; ``format="jdbc"`` reads a database where a driver is present."""
    frame = spark.read.format(format).options(**options).load(path)
    if where is not None:
        frame = frame.where(where)
    return frame.select(*columns) if columns else frame


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def compacted_view(log: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Latest record per key of an append-only topic, as log compaction would leave it."""
    from foretell.operators.toprow import latest_per_key

    return latest_per_key(log, keys, seq)

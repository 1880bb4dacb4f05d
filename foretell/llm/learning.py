"""Labelled rows for fitting: a bounded, repeatable sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int) -> DataFrame:
    """doc_id, text, label (0 or 1) of at most ``bound`` labelled documents for which ``learn`` holds.

    The documents are those with the smallest hashes of their id, so any run takes the same ones,
    and each gives one row: of repeated ids the text with the smallest hash. An id that many rows
    share is cut to one row inside each task before anything is shuffled.
    ``docs`` comes from ``texts_of``; its table is read once and joined to at most ``bound`` ids.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(learn & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    # at most ``bound`` rows of two numbers
    found = docs.join(F.broadcast(chosen), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return found.groupBy("doc_id", "label").agg(least).select("doc_id", "least.text", "label")

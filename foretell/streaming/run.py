"""Drive a streaming DataFrame over what its source holds now."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from foretell.sources.session import scratch


def drain(df: DataFrame, name: str) -> DataFrame:
    """Run to the end of the available input, append to parquet, read it back."""
    spark: SparkSession = df.sparkSession
    return drain_into(df, scratch(spark, f"{name}-out"), scratch(spark, f"{name}-state"))


def start_append(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Starts appending what the source holds now to parquet."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain_into(df: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Same with given folders, so that a later run takes up where this one ended."""
    start_append(df, out, checkpoint).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def drain_each(df: DataFrame, name: str, sink) -> None:
    """Same, through a ``foreachBatch`` sink."""
    checkpoint = scratch(df.sparkSession, f"{name}-state")
    query = (
        df.writeStream.foreachBatch(sink)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_complete(df: DataFrame, name: str) -> DataFrame:
    """For aggregates without watermark: the final table is the last batch's output."""
    spark = df.sparkSession
    out = scratch(spark, f"{name}-out")
    query = (
        df.writeStream.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
        .outputMode("complete")
        .option("checkpointLocation", scratch(spark, f"{name}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)

"""Topics: bounded and streaming scans, decoding, appends.

A topic is a folder of parquet or JSON files, or a Kafka topic where the Kafka
connector is on the class path; ``format`` picks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_bounded(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    format: str = "parquet",
    value: str | None = None,
    **options,
) -> DataFrame:
    """Whole topic, earliest to latest; records whose ``value`` column is null drop."""
    reader = spark.read.format(format).options(**options)
    if format == "kafka":
        reader = reader.options(subscribe=path, startingOffsets="earliest", endingOffsets="latest")
        frame = reader.load().select("value", F.col("timestamp").alias("ingest_ts"))
        return frame.where(F.col("value").isNotNull())
    if schema is not None:
        reader = reader.schema(schema)
    frame = reader.load(path)
    return frame.where(F.col(value).isNotNull()) if value else frame


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = "parquet",
    glob: str | None = None,
    **options,
) -> DataFrame:
    """Unbounded topic from its start. The checkpoint plays the consumer group."""
    reader = spark.readStream.format(format).options(**options)
    if format == "kafka":
        return reader.options(subscribe=path, startingOffsets="earliest").load()
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.schema(schema).load(path)


def has_avro(spark: SparkSession) -> bool:
    """Is spark-avro on the class path?"""
    loader = spark._jvm.Thread.currentThread().getContextClassLoader()
    return loader.getResource("org/apache/spark/sql/avro/AvroFileFormat.class") is not None


def decode(
    spark: SparkSession,
    df: DataFrame,
    schema: T.StructType | str,
    value: str = "value",
    avro_schemas: tuple[str, ...] = (),
    into: str = "record",
) -> DataFrame:
    """UTF-8 JSON first, then Avro behind a five-byte header, else null."""
    options = {"mode": "PERMISSIVE"}
    text = F.col(value)
    if dict(df.dtypes)[value] == "binary":
        text = F.decode(text, "UTF-8")
    # from_json() makes a struct of nulls of a malformed record, and of one that is no object
    whole = F.try_parse_json(text).isNotNull() & F.ltrim(text).startswith("{")
    candidates: list[Column] = [F.when(whole, F.from_json(text, schema, options))]
    if avro_schemas and has_avro(spark):
        from pyspark.sql.avro.functions import from_avro

        body = F.substring(F.col(value), 6, 2**31 - 1)
        candidates += [from_avro(body, a, options) for a in avro_schemas]
    return df.withColumn(into, F.coalesce(*candidates))


def append_json(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append records to a topic folder; messages carry no key."""
    writer = df.write.mode("append").option("ignoreNullFields", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def stream_to_topic(df: DataFrame, path: str, checkpoint: str, every: str = "60 seconds", format: str = "parquet"):
    """Append stream with one checkpoint per trigger."""
    return (
        df.writeStream.format(format)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
    )

"""What several operators share: table reading, text batches, written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.sources.session import scratch


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names; a null text is the empty one.

    Whatever else the frame holds, under any name, is not read.
    """
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


#: Bytes of text turned into Python strings at a time, or one text if it is longer.
SLICE = 1 << 22


def slices(batch: pa.RecordBatch, column: int, limit: int = 0) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``limit`` bytes (``SLICE``) in that text or binary column; a longer row is a part alone."""
    limit = limit or SLICE
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_rows(
    df: DataFrame, make: Callable[[], Callable[..., tuple]], schema: str, done: Callable[[], None] | None = None
) -> DataFrame:
    """One result tuple for each (id, text), in Arrow batches; ``make`` runs once for each task,
    and ``done`` when it ends.

    ``df`` comes from ``texts_of``; ``schema`` lists the columns after doc_id.
    """
    kind = dict(df.dtypes)["doc_id"]
    out = df.sparkSession.createDataFrame([], f"doc_id {kind}, {schema}").schema
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        try:
            for batch in batches:
                for part in slices(batch, 1):
                    found = list(map(work, part.column(0).to_pylist(), part.column(1).to_pylist()))
                    columns = zip(map(list, zip(*found)), list(arrow)[1:])
                    arrays = [part.column(0)] + [pa.array(c, f.type) for c, f in columns]
                    yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)
        finally:
            if done is not None:
                done()

    return df.mapInArrow(run, out)


def map_texts(
    df: DataFrame, make: Callable[[], Callable[[str], tuple]], schema: str, done: Callable[[], None] | None = None
) -> DataFrame:
    """Same for work that needs no id."""

    def without_id():
        work = make()
        return lambda _, text: work(text)

    return map_rows(df, without_id, schema, done)


def filter_texts(df: DataFrame, make: Callable[[], Callable[[list[str]], list[bool]]], text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is judged to stay; a null text counts as empty."""
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = make()
        for batch in batches:
            for part in slices(batch, place):
                stays = judge([text or "" for text in part.column(place).to_pylist()])
                yield part.filter(pa.array(stays, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: later steps neither
    repeat the work nor depend on the executors that did it, and Spark knows its size."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo a divisor: the split into learning and held-out rows."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor

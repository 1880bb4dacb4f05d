"""A stored table laid out by its keys, so that upserts shuffle only what comes in.

Rows lie in a fixed number of buckets by the hash of their keys, one file for a bucket. An upsert joins
the incoming rows to them bucket by bucket: the stored side is neither exchanged nor sorted
across tasks, and every task of the join holds whole buckets, so what it writes keeps the
layout. Each write is a version of its own, in a folder beside the one that is read; a version
counts once a one-row manifest, made visible by one rename, names it. One writer at a time.

Spark keeps bucketing in its catalog only; a table is registered there by its folder whenever
a session first reads it, under a name made from the path and the version.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.operators.upsert import upsert

_MANIFEST = "version bigint, folder string, ddl string"


class BucketedTable:
    """``keys`` are never null: rows without a key conflict with nothing and belong in another table."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 32) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        spark.createDataFrame([], _MANIFEST).write.mode("ignore").parquet(self._manifest(0))

    def _manifest(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}"

    def _newest(self):
        files = self.spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).parquet(f"{self.path}/versions")
        return files.orderBy(F.desc("version")).first()

    def _name(self, version: int) -> str:
        return f"bucketed_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}_{version}"

    def write(self, rows: DataFrame) -> None:
        """Replaces the table by ``rows``, of which no two share a key.

        Rows that come by bucket, as those of an upsert do, are written without an exchange.
        """
        self._store(rows.where(self._keyed()).repartition(self.buckets, *self.keys))

    def _keyed(self):
        keyed = F.lit(True)
        for key in self.keys:
            keyed = keyed & F.col(key).isNotNull()
        return keyed

    def _store(self, rows: DataFrame) -> None:
        last = self._newest()
        version = last.version + 1 if last else 1
        folder = f"{self.path}/data/{version:012d}-{hashlib.sha256(repr(last).encode()).hexdigest()[:8]}"
        name = self._name(version)
        # left over from a write that was never committed
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        writer = rows.write.format("parquet").mode("overwrite").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        writer.option("path", folder).saveAsTable(name)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        manifest = self.spark.createDataFrame([(version, folder, ddl)], _MANIFEST)
        manifest.coalesce(1).write.parquet(self._manifest(version))

    def read(self) -> DataFrame:
        """The newest version, which Spark knows to be bucketed."""
        last = self._newest()
        if last is None:
            raise ValueError(f"nothing has been written to {self.path}")
        name = self._name(last.version)
        if not self.spark.catalog.tableExists(name):
            by = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({last.ddl}) USING parquet "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{last.folder}'"
            )
        return self.spark.table(name)

    def merged(self, incoming: DataFrame, updates: Sequence[str]) -> DataFrame:
        """The table after the upserts: only ``incoming`` is exchanged."""
        return upsert(self.read(), incoming.where(self._keyed()), self.keys, updates, keyed=True)

    def upsert(self, incoming: DataFrame, updates: Sequence[str]) -> None:
        """Stores the merged table as the next version. Keys of ``incoming`` are unique."""
        self._store(self.merged(incoming, updates))

"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Settings results and speed depend on; safe to set on a running session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # HotSpot never compiles a method above 8000 bytes; a stage that would need one
    # runs three times faster operator by operator
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def local_session(cpus: int | str = "*", app: str = "foretell") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # call-site capture costs some milliseconds per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    return configure(builder.getOrCreate())


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="foretell-")


def scratch_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without that setting gets a temporary folder of its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_root(spark.sparkContext.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for one run's output, table or stream state."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"

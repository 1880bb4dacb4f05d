"""A table kept as a log of upserts: committed deltas over a snapshot, read by folding.

A batch is written to a folder of its own and then committed by a manifest of one row in one
file, which a rename makes visible as a whole: what a crash leaves between the two is named by
no manifest and never read. Commits are numbered one after the other; no clock has a part in
their order. A stream's batches are known by the id that its checkpoint keeps and by their
number, so a batch that is delivered again, in the same run or after a restart, is left out,
while a new checkpoint is a new stream and goes on behind what is there.

``compact`` folds everything into a snapshot and begins a new *generation* with it. Readers
take the newest generation that has been committed; the one before is kept for readers under
way, older ones are emptied. So a reader opens one snapshot and the deltas since, however long
the table has lived. One writer at a time; any number of readers.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from foretell.operators.upsert import fold_changes

_MANIFEST = "gen bigint, seq bigint, kind string, stream string, batch_id bigint, folder string, done map<string, bigint>"
_SEQ, _ORDER = "__seq", "__order"
#: Set by Spark for the function of a foreachBatch sink; the same as long as the checkpoint is.
_QUERY_ID = "sql.streaming.queryId"


class ChangeLog:
    """Upserts by ``keys``: ``updates`` take a key's last value, other columns its first one.

    ``order`` ranks the rows of one batch; it is a column of the table only if it is updated.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], updates: Sequence[str], order: str
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.updates, self.order = list(keys), list(updates), order
        # an empty first generation; does nothing if there is one
        spark.createDataFrame([], _MANIFEST).write.mode("ignore").parquet(self._manifest(0, 0))

    def _manifest(self, gen: int, seq: int) -> str:
        return f"{self.path}/commits/gen={gen:06d}/seq={seq:012d}"

    def commits(self) -> list[Row]:
        """Manifests of the newest generation in order: its snapshot, if any, and the deltas since."""
        files = self.spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).parquet(f"{self.path}/commits")
        rows = files.where("gen is not null").collect()
        newest = max((r.gen for r in rows), default=0)
        return sorted((r for r in rows if r.gen == newest), key=lambda r: r.seq)

    @staticmethod
    def _done(commits: list[Row]) -> dict[str, int]:
        """The last batch of every stream that has been committed."""
        done: dict[str, int] = {}
        for row in commits:
            for stream, batch_id in (row.done or {row.stream: row.batch_id}).items():
                done[stream] = max(batch_id, done.get(stream, -1))
        return done

    def _commit(self, gen: int, seq: int, kind: str, folder: str, stream=None, batch_id=None, done=None) -> None:
        row = (gen, seq, kind, stream, batch_id, folder, done)
        self.spark.createDataFrame([row], _MANIFEST).coalesce(1).write.parquet(self._manifest(gen, seq))

    def _write(self, rows: DataFrame, gen: int, seq: int) -> str:
        folder = f"data/gen={gen:06d}/{seq:012d}-{uuid.uuid4().hex}"
        rows.withColumn(_SEQ, F.lit(seq).cast("bigint")).write.parquet(f"{self.path}/{folder}")
        return folder

    def append(self, batch: DataFrame, stream: str, batch_id: int) -> bool:
        """Commits a batch; False if it has been committed before."""
        commits = self.commits()
        if batch_id <= self._done(commits).get(stream, -1):
            return False
        last = commits[-1] if commits else None
        gen, seq = (last.gen, last.seq + 1) if last else (0, 1)
        self._commit(gen, seq, "delta", self._write(batch, gen, seq), stream, batch_id)
        return True

    def sink(self, stream: str | None = None, compact_every: int = 0) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function; ``compact_every`` deltas begin a new generation."""

        def write(batch: DataFrame, batch_id: int) -> None:
            name = stream or batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
            if self.append(batch, name, batch_id) and compact_every:
                if sum(row.kind == "delta" for row in self.commits()) >= compact_every:
                    self.compact()

        return write

    def _log(self, commits: list[Row]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{row.folder}" for row in commits])

    def read(self) -> DataFrame:
        """The table as of the last commit. A log without any commit cannot be read."""
        commits = self.commits()
        if not commits:
            raise ValueError(f"nothing has been committed to {self.path}")
        return self._folded(commits)

    def _folded(self, commits: list[Row]) -> DataFrame:
        log = self._log(commits)
        ordered = log.withColumn(_ORDER, F.struct(_SEQ, self.order)).drop(_SEQ)
        if self.order not in self.updates:
            ordered = ordered.drop(self.order)
        return fold_changes(ordered, self.keys, self.updates, _ORDER)

    def compact(self) -> None:
        """The table so far as one snapshot that begins a new generation."""
        commits = self.commits()
        if not any(row.kind == "delta" for row in commits):
            return
        last = commits[-1]
        gen, seq = last.gen + 1, last.seq + 1
        rows = self._folded(commits)
        if self.order not in rows.columns:
            rows = rows.withColumn(self.order, F.lit(None).cast(dict(self._log(commits).dtypes)[self.order]))
        self._commit(gen, seq, "snapshot", self._write(rows, gen, seq), done=self._done(commits))
        self._empty(gen - 2)

    def _empty(self, gen: int) -> None:
        """Takes the files of a generation that no reader uses any more; both folders stay, with an empty file."""
        if gen < 0:
            return
        nothing = self.spark.createDataFrame([], _MANIFEST)
        for part in ("commits", "data"):
            nothing.write.mode("overwrite").parquet(f"{self.path}/{part}/gen={gen:06d}")

"""Labelled counters of running streams, told by their progress: no second pass over the data."""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

OTHER = "other"


def count_labels(stream: DataFrame, metric: str, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """The stream itself, with a counter of ``metric`` for each combination of the labels' values.

    Values are listed, as a counter is one number that every task adds to; rows with another
    value, or none, count under ``other``.
    """
    combinations: list[tuple[str, Column]] = [("", F.lit(True))]
    for name, values in labels.items():
        given = F.coalesce(F.col(name), F.lit(OTHER))
        cases = [(v, given == v) for v in values] + [(OTHER, ~given.isin(*values))]
        combinations = [
            (f"{said},{name}={v}" if said else f"{name}={v}", before & case)
            for said, before in combinations
            for v, case in cases
        ]
    return stream.observe(metric, *[F.count_if(case).alias(said) for said, case in combinations])


class CounterListener(StreamingQueryListener):
    """Sums the counters of every query it hears of; a batch that is reported again counts once."""

    def __init__(self) -> None:
        self.values: dict[tuple[str, str], int] = {}
        self._last: dict[str, int] = {}
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            query = str(progress.id)
            if not progress.observedMetrics or progress.batchId <= self._last.get(query, -1):
                return
            self._last[query] = progress.batchId
            for metric, row in progress.observedMetrics.items():
                for labels, count in row.asDict().items():
                    self.values[metric, labels] = self.values.get((metric, labels), 0) + count

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def settle(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Waits until the end of a query has been heard; events come in order, but later than it ends."""
        query.awaitTermination()
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"nothing heard of the end of {query.runId}")

    def frame(self, spark: SparkSession) -> DataFrame:
        """metric, labels, value of every counter that has counted something."""
        with self._lock:
            rows = [(*name, value) for name, value in sorted(self.values.items()) if value]
        return spark.createDataFrame(rows, "metric string, labels string, value bigint")

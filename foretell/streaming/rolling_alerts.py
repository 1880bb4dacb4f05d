"""Alerts on an aggregate stream against each key's own rolling history.

The history is a ring of days, each with its sums and the sums of every instant in it; a
window is whole days between two exact edges. State grows with the instants of the last days,
not with rows, and a row costs two searches. Rows older than the kept days see what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from foretell import constants as C
from foretell.functions.numeric import finite, to_units
from foretell.operators import alerts
from foretell.operators.baseline import DAY_MICROS, thresholds

_OUT = (
    "location_name string, market_type string, at bigint, total_predictions bigint,"
    " accuracy_rate double, bias_score double, n_rows bigint, n_acc bigint, s_acc bigint,"
    " q_acc bigint, n_bias bigint, s_bias bigint, q_bias bigint"
)


#: Sums kept for a pane and for every instant in it.
_SUMS = ("n", "s_acc", "q_acc", "s_bias", "q_bias")
_PANE = ("at", *_SUMS)
_ROW = ("at", "acc", "bias", "total_predictions", "accuracy_rate", "bias_score")
#: Rows of a key that are held before they go to the state until the batch is read.
HELD = 50_000
#: Late rows reach back further than a window does.
SLACK_DAYS = 1
_DAY_MS = DAY_MICROS // 1000


def _arrays(names, kind: str = "bigint") -> str:
    return ", ".join(f"{n} array<{kind}>" for n in names)


class Ring:
    """A key's history: for each day its sums, and the sums of every instant in it.

    Days are read when rows fall on them or a window ends on them; days inside a window count
    by their totals. So a batch reads and writes about two days for each day it touches, and
    an instant takes the same room however many rows share it.
    """

    def __init__(self, totals, panes) -> None:
        self.panes = panes
        self.totals: dict[int, np.ndarray] = {}
        if totals is not None:
            days, *sums = totals
            self.totals = dict(zip(days, np.array(sums, dtype=np.int64).T))
        self.read: dict[int, np.ndarray] = {}
        self.written: set[int] = set()

    def pane(self, day: int) -> np.ndarray:
        """Columns ``_PANE``, a row for each instant in order."""
        if day not in self.read:
            stored = self.panes.getValue((day,)) if day in self.totals else [[] for _ in _PANE]
            self.read[day] = np.array([list(c) for c in stored], dtype=np.int64).T.reshape(-1, len(_PANE))
        return self.read[day]

    def add(self, at: np.ndarray, acc: np.ndarray, bias: np.ndarray) -> None:
        columns = (np.ones_like(at), acc, acc * acc, bias, bias * bias)
        for day in np.unique(at // DAY_MICROS).tolist():
            mine = at // DAY_MICROS == day
            both = np.vstack([self.pane(day), np.column_stack([at, *columns])[mine]])
            instants, group = np.unique(both[:, 0], return_inverse=True)
            sums = np.zeros((len(instants), len(_SUMS)), dtype=np.int64)
            np.add.at(sums, group, both[:, 1:])
            self.read[day] = np.column_stack([instants, sums])
            self.totals[day] = sums.sum(axis=0)
            self.written.add(day)

    def before(self, at: np.ndarray, side: str) -> np.ndarray:
        """Sums of all history before each time (``left``), or up to and with it (``right``)."""
        days = np.array(sorted(self.totals), dtype=np.int64)
        running = np.cumsum([np.zeros(len(_SUMS), dtype=np.int64), *(self.totals[d] for d in days.tolist())], axis=0)
        home = at // DAY_MICROS
        out = running[np.searchsorted(days, home)]
        for day in np.unique(home).tolist():
            if day in self.totals:
                pane = self.pane(day)
                inside = np.vstack([np.zeros((1, len(_SUMS)), dtype=np.int64), np.cumsum(pane[:, 1:], axis=0)])
                mine = home == day
                out[mine] += inside[np.searchsorted(pane[:, 0], at[mine], side=side)]
        return out

    def drop_before(self, day: int) -> None:
        for old in [d for d in self.totals if d < day]:
            del self.totals[old]
            self.read.pop(old, None)
            if old not in self.written or self.panes.containsKey((old,)):
                self.panes.removeKey((old,))
            self.written.discard(old)

    def store(self) -> tuple:
        """Writes the days that changed; returns the totals."""
        for day in sorted(self.written):
            self.panes.updateValue((day,), tuple(self.read[day].T.tolist()))
        days = sorted(self.totals)
        return (days, *(np.array([self.totals[d] for d in days], dtype=np.int64).T.tolist() or [[]] * len(_SUMS)))


class RollingHistory(StatefulProcessor):
    """For each row the integer sums over its trailing window, the row included.

    All rows of a batch count before the first is judged, so results do not depend on how the
    batch is cut or ordered.
    """

    def __init__(self, days: int) -> None:
        self.span = days * DAY_MICROS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", f"timer bigint, {_arrays(('day', *_SUMS))}")
        self.panes = handle.getMapState("panes", "day bigint", _arrays(_PANE))
        self.rows = handle.getMapState("rows", "n bigint", f"{_arrays(_ROW[:4])}, {_arrays(_ROW[4:], 'double')}")

    def _ring(self) -> tuple[int, Ring]:
        head = self.head.get()
        return (head[0], Ring(list(head)[1:], self.panes)) if head is not None else (0, Ring(None, self.panes))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        timer, ring = self._ring()
        held: list[pd.DataFrame] = []
        stored = 0
        for chunk in rows:
            chunk = chunk[list(_ROW)]
            ring.add(*(chunk[c].to_numpy(dtype=np.int64) for c in _ROW[:3]))
            held.append(chunk)
            if sum(map(len, held)) > HELD:
                whole = pd.concat(held)
                self.rows.updateValue((stored,), tuple(whole[c].tolist() for c in _ROW))
                held, stored = [], stored + 1
        for n in range(stored):
            whole = pd.DataFrame(dict(zip(_ROW, map(list, self.rows.getValue((n,))))))
            self.rows.removeKey((n,))
            yield self._judged(key, whole, ring)
        if held:
            yield self._judged(key, pd.concat(held), ring)
        newest = max(ring.totals) * DAY_MICROS
        ring.drop_before((newest - self.span) // DAY_MICROS - SLACK_DAYS)
        due = (newest + self.span) // 1000 + (1 + SLACK_DAYS) * _DAY_MS
        if due != timer:
            self.handle.registerTimer(due)
        self.head.update((due, *ring.store()))

    def _judged(self, key, rows: pd.DataFrame, ring: Ring) -> pd.DataFrame:
        at = rows["at"].to_numpy(dtype=np.int64)
        sums = dict(zip(_SUMS, (ring.before(at, "right") - ring.before(at - self.span, "left")).T))
        return pd.DataFrame(
            {
                "location_name": key[0],
                "market_type": key[1],
                "at": at,
                "total_predictions": rows["total_predictions"].to_numpy(),
                "accuracy_rate": rows["accuracy_rate"].to_numpy(),
                "bias_score": rows["bias_score"].to_numpy(),
                "n_rows": sums["n"],
                "n_acc": sums["n"],
                "s_acc": sums["s_acc"],
                "q_acc": sums["q_acc"],
                "n_bias": sums["n"],
                "s_bias": sums["s_bias"],
                "q_bias": sums["q_bias"],
            }
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        timer, ring = self._ring()
        ring.drop_before((timerValues.getCurrentWatermarkInMs() * 1000 - self.span) // DAY_MICROS)
        if ring.totals:
            self.head.update((timer, *ring.store()))
        else:
            self.head.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_baselines(
    aggregates: DataFrame, ts: str = "window_end", days: int = C.BASELINE_DAYS, lateness: str = "24 hours"
) -> DataFrame:
    """Aggregates of at least ten predictions, with thresholds from signed bias."""
    rows = (
        aggregates.withWatermark(ts, lateness)
        .where(F.coalesce(F.col("total_predictions"), F.lit(0)) >= C.MIN_PREDICTIONS)
        .where(F.col(ts).isNotNull())
        .select(
            F.coalesce("location_name", F.lit("unknown")).alias("location_name"),
            F.coalesce("market_type", F.lit("WEATHER")).alias("market_type"),
            F.unix_micros(F.col(ts)).alias("at"),
            F.col("total_predictions").cast("bigint").alias("total_predictions"),
            F.coalesce(finite(F.col("accuracy_rate")), F.lit(0.0)).alias("accuracy_rate"),
            F.coalesce(finite(F.col("bias_score")), F.lit(0.0)).alias("bias_score"),
            ts,
        )
        .withColumns({"acc": to_units(F.col("accuracy_rate"), 4), "bias": to_units(F.col("bias_score"), 4)})
    )
    sums = rows.groupBy("location_name", "market_type").transformWithStateInPandas(
        statefulProcessor=RollingHistory(days),
        outputStructType=_OUT,
        outputMode="append",
        timeMode="eventTime",
    )
    return thresholds(sums).withColumn(ts, F.timestamp_micros("at")).drop("at")


def stream_rolling_alerts(aggregates: DataFrame, ts: str = "window_end", **options) -> DataFrame:
    """Both rules per aggregate; an alert is stamped with its aggregate's time."""
    judged = stream_baselines(aggregates, ts, **options)
    return alerts.aggregate_alerts(judged, F.col(ts), alerts.STREAM_CRITICAL_RATIO, "stream")

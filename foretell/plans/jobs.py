"""The three batch jobs as calls on frames: what a run reads in, what it stores out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.functions.times import instant
from foretell.operators.accuracy import accuracy, drop_snapshot, label_window
from foretell.operators.alerts import auto_resolve, detect_all
from foretell.operators.scoring import score
from foretell.operators.toprow import prefer_closed, prefer_winner
from foretell.operators.upsert import (
    AGGREGATE_KEYS,
    AGGREGATE_UPDATES,
    ALERT_KEYS,
    ALERT_UPDATES,
    fold_changes,
    insert_missing,
    upsert,
)


def correlation_job(
    polls: DataFrame, weather: DataFrame, as_of, arrival: str | Sequence[str] = "arrival", store: str | None = None
) -> DataFrame:
    """Polls, several for a market, to one scored row for each market that weather settles.

    The polls themselves say which (place, day) pairs are asked for, so these are found
    before the polls are ranked. ``store`` as in ``attach_weather``.
    """
    return score(prefer_closed(polls, arrival), weather, as_of, asked=polls, store=store)


def aggregation_job(
    records: DataFrame,
    correlations: DataFrame,
    aggregates: DataFrame,
    as_of,
    arrival: str | Sequence[str] = "arrival",
    hours: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """(correlations, aggregates) after a run over the topic ``records``.

    One record for each market, no current snapshots: new ones are inserted into
    ``correlations``, and all of them are summed per place and type, under a window label
    that ends at ``as_of``, into ``aggregates``.
    """
    settled = drop_snapshot(prefer_winner(records, arrival))
    summed = label_window(accuracy(settled, "batch"), as_of, hours).withColumn("updated_at", instant(as_of))
    stored = insert_missing(correlations, settled, ["condition_id"])
    return stored, upsert(aggregates, summed, AGGREGATE_KEYS, AGGREGATE_UPDATES)


def anomaly_job(
    alerts: DataFrame,
    aggregates: DataFrame,
    predictions: DataFrame,
    health: DataFrame,
    expected: DataFrame,
    correlations: DataFrame,
    as_of,
    arrival: str | Sequence[str] = "arrival",
) -> DataFrame:
    """The stored ``alerts`` after a run: those of feeds that report again closed, the run's own saved.

    Running it again with the same inputs changes nothing more.
    """
    fired = detect_all(aggregates, predictions, health, expected, correlations, as_of, arrival)
    fresh = fired.withColumns({"is_resolved": F.lit(False), "resolved_at": F.lit(None).cast("timestamp")})
    return save_alerts(auto_resolve(alerts, health, as_of), fresh)


def save_alerts(alerts: DataFrame, fired: DataFrame) -> DataFrame:
    """Stored alerts after the upserts of ``fired``: one alert for each type, place and market type.

    A standing alert takes the new severity, message, value and time and keeps the rest. Of a
    run's alerts with one key the first gives what is kept and the last what is updated, in
    order of value and message. Alerts without one of the keys never conflict.
    """
    def filled(df: DataFrame, other: DataFrame) -> DataFrame:
        missing = [f for f in other.schema if f.name not in df.columns]
        return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})

    alerts, rows = filled(alerts, fired), filled(fired, alerts)
    rows = rows.select(*alerts.columns)
    keyed = F.lit(True)
    for key in ALERT_KEYS:
        keyed = keyed & F.col(key).isNotNull()
    value = F.coalesce(F.col("metric_value"), F.lit(float("-inf")))
    log = rows.where(keyed).withColumn("__seq", F.struct(value.alias("value"), "message"))
    folded = fold_changes(log, ALERT_KEYS, ALERT_UPDATES, "__seq").select(*alerts.columns)
    return upsert(alerts, folded.unionByName(rows.where(~keyed)), ALERT_KEYS, ALERT_UPDATES)

"""Two-tier weather lookup: the settling day's row, else the place's current row.

Every distinct (place, day) that predictions ask for is resolved once, on tables
whose size is the number of keys; the wide prediction rows then take part in a
single equi-join. ``distinct`` combines map-side, so a (place, day) that holds a
third of all predictions is one key row.

With ``store`` the resolved keys are written before the join. Spark then plans it
from the table's true size: broadcast below ``spark.sql.autoBroadcastJoinThreshold``,
and the predictions are not shuffled at all, else a sort-merge join whose hot keys
lie on the streamed side of a left join, where AQE splits them. Nothing is hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.functions.outcomes import settlement
from foretell.operators.toprow import latest_per_key

HISTORICAL = "historical"


def weather_snapshot(weather: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(exact, current): newest row per (place, day) and newest row per place."""
    placed = weather.where(F.col("location_name").isNotNull() & (F.col("location_name") != ""))
    historical = F.coalesce(F.col("weather_type"), F.lit("current")) == HISTORICAL
    exact = latest_per_key(
        placed.where(historical & F.col("observation_date").isNotNull()),
        ["location_name", "observation_date"],
        "poll_ts",
        "obs_id",
    )
    current = latest_per_key(placed.where(~historical), ["location_name"], "poll_ts", "obs_id")
    return exact, current


def _packed(weather: DataFrame, name: str) -> F.Column:
    return F.struct(*[F.col(c) for c in weather.columns]).alias(name)


def resolve_keys(asked: DataFrame, exact: DataFrame, current: DataFrame) -> DataFrame:
    """(location_name, end_date) -> struct ``w``; unmatched keys are left out.

    The weather rules run here, once per key, not once per prediction.
    """
    keys = asked.select("location_name", "end_date").where("location_name is not null").distinct()
    by_day = exact.select(
        "location_name", F.col("observation_date").alias("end_date"), _packed(exact, "day_row")
    )
    by_place = current.select("location_name", _packed(current, "place_row"))
    found = (
        keys.join(by_day, ["location_name", "end_date"], "left")
        .join(by_place, "location_name", "left")
        .select("location_name", "end_date", F.coalesce("day_row", "place_row").alias("w"))
        .where(F.col("w").isNotNull())
    )
    fields = [F.col(f"w.{c}") for c in exact.columns]
    rules = [rule.alias(name) for name, rule in settlement(F.col("w")).items()]
    return found.select("location_name", "end_date", F.struct(*fields, *rules).alias("w"))


def attach_weather(
    predictions: DataFrame,
    exact: DataFrame,
    current: DataFrame,
    asked: DataFrame | None = None,
    store: str | None = None,
) -> DataFrame:
    """Predictions plus struct ``w`` (null where nothing matches).

    ``asked`` may be any cheaper frame whose (location_name, end_date) pairs cover
    those of ``predictions``, such as the raw polls before deduplication. ``store``
    is a new folder all executors reach.
    """
    resolved = resolve_keys(predictions if asked is None else asked, exact, current)
    if store:
        resolved.write.parquet(store)
        resolved = predictions.sparkSession.read.schema(resolved.schema).parquet(store)
    resolved = resolved.select(
        F.col("location_name").alias("r_location"), F.col("end_date").alias("r_end_date"), "w"
    )
    match = (F.col("location_name") == F.col("r_location")) & F.col("end_date").eqNullSafe(
        F.col("r_end_date")
    )
    return predictions.join(resolved, match, "left").drop("r_location", "r_end_date")


def unmatched(attached: DataFrame) -> DataFrame:
    return attached.where(F.col("w").isNull()).drop("w")


def unmatched_predictions(predictions: DataFrame, weather: DataFrame) -> DataFrame:
    """Predictions whose place has neither a row for the day nor a current row."""
    exact, current = weather_snapshot(weather)
    resolved = resolve_keys(predictions, exact, current).drop("w")
    same = (predictions["location_name"] == resolved["location_name"]) & predictions[
        "end_date"
    ].eqNullSafe(resolved["end_date"])
    return predictions.join(resolved, same, "left_anti")

"""Score predictions against the weather row attached to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.functions import outcomes as O
from foretell.functions.times import instant, latency_between_polls, latency_signed
from foretell.operators.lookup import attach_weather, weather_snapshot


def _ready(attached: DataFrame) -> DataFrame:
    """Weather structs that do not come from ``attach_weather`` get their masks here."""
    fields = attached.schema["w"].dataType.names
    if set(fields) >= set(O.SETTLEMENT):
        return attached
    w = F.col("w")
    rules = [rule.alias(name) for name, rule in O.settlement(w).items()]
    scored = F.when(w.isNotNull(), F.struct(*[w[f] for f in fields], *rules))
    return attached.withColumn("w", scored)


def _market() -> Column:
    return F.coalesce(F.col("market_type"), F.lit("WEATHER"))


def _decided() -> Column:
    return F.coalesce(F.col("closed"), F.lit(False)) & F.col("winner").isNotNull()


def _scorable() -> Column:
    """True exactly where ``_outcome`` has an answer, and much shorter: Spark copies a
    filter below the select it belongs to, so this runs in place of the full rules."""
    need = O.needs_mask(_market(), F.col("closed"), F.col("winner"), F.col("threshold"))
    same_place = F.col("location_name").eqNullSafe(F.col("w.location_name"))
    return (F.col("w.answers").bitwiseAND(need) != 0) & same_place


def _outcome() -> Column:
    """Outcome of a scorable row: a known winner settles any market type, then
    thresholds (TEMPERATURE) or weather rules for the nine other types."""
    w = F.col("w")
    by_temperature = O.compare_threshold(w["temp_f"], F.col("threshold"), w["temp_f_in_c"])
    by_code = (w["occurs"].bitwiseAND(O.market_bit(_market())) != 0).cast("int")
    return (
        F.when(_decided(), F.col("winner").cast("int"))
        .when(_market() == "TEMPERATURE", by_temperature)
        .otherwise(by_code)
    )


def _method() -> Column:
    return (
        F.when(_decided(), O.WINNER_KNOWN)
        .when(F.col("w.weather_type") == "historical", O.HISTORICAL)
        .otherwise(O.SNAPSHOT)
    )


def with_outcome(attached: DataFrame) -> DataFrame:
    """Adds outcome and method to rows with a weather struct ``w``. Rows that cannot
    be scored have a null outcome, and their method has no meaning."""
    return _ready(attached).withColumns(
        {"actual_outcome": F.when(_scorable(), _outcome()), "correlation_method": _method()}
    )


def flatten_weather(df: DataFrame, struct: str = "w") -> DataFrame:
    """The weather struct as the ``actual_*`` columns of the correlations table."""
    w = F.col(struct)
    return df.withColumns(
        {
            "weather_type": w["weather_type"],
            "observation_date": w["observation_date"],
            "actual_temp_c": w["temp_c"],
            "actual_temp_f": w["temp_f"],
            "actual_precip_mm": w["precip_mm"],
            "actual_rain_mm": w["rain_mm"],
            "actual_weather_code": w["weather_code"],
            "actual_wind_kmh": w["wind_kmh"],
            "weather_poll_ts": w["poll_ts"],
        }
    ).drop(struct)


def correlate(attached: DataFrame, as_of=None) -> DataFrame:
    """Scored rows only. Latency is poll to ``as_of``, or poll to weather poll."""
    scored = _ready(attached).where(_scorable())
    scored = scored.withColumns({"actual_outcome": _outcome(), "correlation_method": _method()})
    price = F.coalesce(F.col("price"), F.lit(0.5))
    if as_of is None:
        latency = latency_between_polls(F.col("poll_ts"), F.col("w.poll_ts"))
    else:
        latency = latency_signed(F.col("poll_ts"), instant(as_of))
    return flatten_weather(
        scored.withColumn("prediction_error", O.prediction_error(price, F.col("actual_outcome")))
        .withColumn("correlation_latency", latency)
    )


def failed_correlations(attached: DataFrame) -> DataFrame:
    """Matched to weather but not scorable."""
    return _ready(attached.where(F.col("w").isNotNull())).where(
        ~F.coalesce(_scorable(), F.lit(False))
    )


def score(
    predictions: DataFrame,
    weather: DataFrame,
    as_of=None,
    asked: DataFrame | None = None,
    store: str | None = None,
) -> DataFrame:
    """Predictions and weather -> correlations. See ``attach_weather`` for the options."""
    exact, current = weather_snapshot(weather)
    return correlate(attach_weather(predictions, exact, current, asked, store), as_of)

"""Per-row scoring rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foretell import constants as C
from foretell.functions.numeric import round_to

SNAPSHOT = "current_snapshot"
WINNER_KNOWN = "winner_known"
HISTORICAL = "historical_weather"

WEATHER_MARKETS = (
    "RAIN", "SNOW", "SUNSHINE", "WIND", "FOG", "HAIL", "CLOUD", "FROST", "WEATHER",
)


def f_to_c(f: Column) -> Column:
    return round_to((f - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0), 2)


def c_to_f(c: Column) -> Column:
    return round_to(c * F.lit(9.0) / F.lit(5.0) + F.lit(32.0), 1)


def _bit(condition: Column) -> Column:
    """1/0 of a condition; an unknown condition stays null."""
    return condition.cast("int")


def compare_threshold(actual_f: Column, threshold: Column, actual_f_in_c: Column | None = None) -> Column:
    """``actual_f_in_c`` spares the conversion where the caller has it already."""
    in_c = f_to_c(actual_f) if actual_f_in_c is None else actual_f_in_c
    actual = F.when(threshold["unit"].eqNullSafe(F.lit("C")), in_c).otherwise(actual_f)
    kind, value = threshold["type"], threshold["value"]
    least, most = threshold["value_min"], threshold["value_max"]
    # every kind is an interval; a missing bound leaves an end null, and so the answer
    endless = F.lit(float("inf"))
    low = F.when(kind == "above", value).when(kind == "below", -endless)
    low = low.when((kind == "between") & most.isNotNull(), least)
    high = F.when(kind == "above", endless).when(kind == "below", value)
    high = high.when((kind == "between") & least.isNotNull(), most)
    return _bit((actual >= low) & (actual <= high))


def weather_rules(
    code: Column, precip_mm: Column, rain_mm: Column, wind_kmh: Column, temp_c: Column
) -> dict[str, Column]:
    """market type -> 1, 0 or null (cannot tell)."""
    precip = F.coalesce(precip_mm, F.lit(0.0)) > 0.1
    rain = F.coalesce(rain_mm, F.lit(0.0)) > 0.1
    return {
        "RAIN": F.coalesce(_bit(code.isin(*C.RAIN_CODES)), _bit(precip | rain)),
        "SNOW": F.coalesce(_bit(code.isin(*C.SNOW_CODES)), F.lit(0)),
        "SUNSHINE": _bit(code.isin(*C.CLEAR_CODES)),
        "WIND": _bit(wind_kmh > 30),
        "FOG": _bit(code.isin(*C.FOG_CODES)),
        "HAIL": _bit(code.isin(*C.HAIL_CODES)),
        "CLOUD": _bit(code.isin(*C.CLOUDY_CODES)),
        "FROST": _bit(temp_c <= 0),
        "WEATHER": F.coalesce(_bit(code.isin(*C.RAIN_CODES, *C.SNOW_CODES)), _bit(precip)),
    }


def weather_outcome(
    market_type: Column,
    code: Column,
    precip_mm: Column,
    rain_mm: Column,
    wind_kmh: Column,
    temp_c: Column,
) -> Column:
    rules = weather_rules(code, precip_mm, rain_mm, wind_kmh, temp_c)
    return F.coalesce(*[F.when(market_type == name, rule) for name, rule in rules.items()])


def prediction_error(probability: Column, outcome: Column) -> Column:
    return round_to(F.abs(probability - outcome), 4, signed=False)


def hit(price: Column, outcome: Column) -> Column:
    """The forecast leaned the way the outcome went; false when either is unknown."""
    right = ((outcome == 1) & (price >= 0.5)) | ((outcome == 0) & (price < 0.5))
    return F.coalesce(right, F.lit(False))


# -- settling by bit masks ------------------------------------------------------
# Bit i stands for market i of SETTLED_MARKETS. A weather row carries which markets
# it can answer and which of them occurred, worked out once per weather row; a
# prediction needs one bit. "Does this row settle it, and how" is then two ANDs.
SETTLED_MARKETS = WEATHER_MARKETS + ("TEMPERATURE",)
ANY_WEATHER_BIT = 1 << len(SETTLED_MARKETS)
SETTLEMENT = ("answers", "occurs", "temp_f_in_c")


def _sum_bits(conditions: dict[str, Column]) -> Column:
    total = F.lit(0)
    for name, condition in conditions.items():
        total = total + F.when(condition, 1 << SETTLED_MARKETS.index(name)).otherwise(0)
    return total


def settlement(weather) -> dict[str, Column]:
    """Columns for ``weather[field]``: a DataFrame, a struct column or ``F`` by name."""
    rules = weather_rules(
        weather["weather_code"], weather["precip_mm"], weather["rain_mm"], weather["wind_kmh"], weather["temp_c"]
    )
    answered = {name: rule.isNotNull() for name, rule in rules.items()}
    answered["TEMPERATURE"] = weather["temp_f"].isNotNull()
    known = F.coalesce(weather["weather_type"], F.lit("current")).isin("historical", "current")
    return {
        "answers": F.when(known, _sum_bits(answered)).otherwise(0) + F.lit(ANY_WEATHER_BIT),
        "occurs": _sum_bits({name: rule == 1 for name, rule in rules.items()}),
        "temp_f_in_c": f_to_c(weather["temp_f"]),
    }


def market_bit(market_type: Column) -> Column:
    """The bit of a market type, 0 for an unknown one."""
    bits = ", ".join(f"'{name}', {1 << i}" for i, name in enumerate(SETTLED_MARKETS))
    return F.coalesce(F.try_element_at(F.expr(f"map({bits})"), market_type), F.lit(0))


def needs_mask(market_type: Column, closed: Column, winner: Column, threshold: Column) -> Column:
    """The one bit a prediction needs: a known winner takes any weather row."""
    bounded = threshold["value_min"].isNotNull() & threshold["value_max"].isNotNull()
    usable = (threshold["type"].isin("above", "below") & threshold["value"].isNotNull()) | (
        (threshold["type"] == "between") & bounded
    )
    hopeless = (market_type == "TEMPERATURE") & ~F.coalesce(usable, F.lit(False))
    return (
        F.when(closed & winner.isNotNull(), ANY_WEATHER_BIT)
        .when(hopeless, 0)
        .otherwise(market_bit(market_type))
    )

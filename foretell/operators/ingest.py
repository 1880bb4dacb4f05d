"""Landed records to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.functions import text as X
from foretell.functions.numeric import round_to
from foretell.functions.outcomes import c_to_f, prediction_error
from foretell.functions.times import historical_eligible, instant, ms_to_iso
from foretell.operators.alerts import mispricing
from foretell.operators.gazetteer import coords_lookup, extract_city, verified_names
from foretell.operators.toprow import first_per_key


def parse_market(markets: DataFrame, gazetteer: DataFrame, as_of) -> DataFrame:
    """Raw markets to prediction records. Rows without probability, of another
    outcome type or without a valid city are dropped."""
    usable = markets.where(F.col("probability").isNotNull() & (F.col("outcomeType") == "BINARY"))
    placed = extract_city(usable, gazetteer).where(F.col("city").isNotNull())
    resolved = F.coalesce(F.col("isResolved"), F.lit(False))
    decided = resolved & F.coalesce(F.col("resolution").isin("YES", "NO"), F.lit(False))
    # worked out in a select of its own: the record names each of these several times
    typed = placed.select(
        *markets.columns,
        "city",
        X.market_type(F.col("question")).alias("mtype"),
        resolved.alias("resolved"),
        F.when(decided, F.col("resolution") == "YES").alias("won"),
    )
    p, won, mtype = F.col("probability"), F.col("won"), F.col("mtype")
    base, deviation, flag = mispricing(p, mtype, F.col("resolved"))
    price = round_to(p, 4, signed=False)
    return typed.select(
        F.col("id").alias("condition_id"),
        F.col("slug").alias("question_id"),
        "question",
        F.col("city").alias("location_name"),
        mtype.alias("market_type"),
        F.when(won.isNotNull(), "closed").otherwise("open").alias("market_status"),
        price.alias("yes_price"),
        round_to(F.lit(1.0) - p, 4, signed=False).alias("no_price"),
        price.alias("price"),
        F.lit(1.0).alias("price_sum"),
        won.alias("winner"),
        F.col("resolved").alias("closed"),
        ms_to_iso(F.col("closeTime")).alias("end_date_iso"),
        mtype.alias("weather_type"),
        flag.alias("is_arbitrage"),
        base.alias("base_rate"),
        deviation.alias("deviation_from_base"),
        F.lit(True).alias("is_valid"),
        won.cast("int").alias("actual_outcome"),
        prediction_error(p, won.cast("int")).alias("prediction_error"),
        (~F.col("resolved")).alias("needs_weather_check"),
        F.lit("manifold").alias("source"),
        F.col("url").alias("market_url"),
        "resolution",
        F.coalesce("uniqueBettorCount", F.lit(0)).alias("unique_bettors"),
        F.coalesce("volume", F.lit(0.0)).alias("volume"),
        instant(as_of).alias("poll_timestamp"),
    )


# -- fixed values: accepted spellings of a field, first non-null wins ------------
SPELLINGS = {
    "condition_id": ("condition_id", "CONDITION_ID"),
    "closed": ("closed", "CLOSED"),
    "price": ("price", "yes_price", "YES_PRICE"),
    "poll_timestamp": ("poll_timestamp", "POLL_TIMESTAMP"),
}


def canonical_fields(df: DataFrame, spellings: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One lower-case column per field, whichever spelling a record uses.

    Names are matched exactly. A frame that carries two spellings differing only in
    case needs ``spark.sql.caseSensitive``; JSON read with a schema can name them apart.
    """
    table = {**SPELLINGS, **(spellings or {})}
    names = set(df.columns)
    spent = {name for options in table.values() for name in options}
    merged = {
        field: [F.col(name) for name in options if name in names] for field, options in table.items()
    }
    return df.select(
        *[F.coalesce(*found).alias(field) for field, found in merged.items() if found],
        *[F.col(c) for c in df.columns if c not in spent],
    )


def flatten_current(raw: DataFrame) -> DataFrame:
    """``current`` object (struct) to one row; rows without it are dropped."""
    c = F.col("current")
    return raw.where(c.isNotNull()).select(
        "location_name",
        F.lit("current").alias("weather_type"),
        F.to_date("poll_ts").alias("observation_date"),
        "poll_ts",
        c["temperature_2m"].alias("temp_c"),
        c_to_f(c["temperature_2m"]).alias("temp_f"),
        c["precipitation"].alias("precip_mm"),
        c["rain"].alias("rain_mm"),
        c["weather_code"].alias("weather_code"),
        c["wind_speed_10m"].alias("wind_kmh"),
        c["relative_humidity_2m"].alias("humidity_pct"),
    )


def flatten_daily(raw: DataFrame) -> DataFrame:
    """Daily arrays to one row per day; the temperature is the day's maximum."""
    d = F.col("daily")
    days = F.arrays_zip(
        d["time"].alias("day"),
        d["temperature_2m_max"].alias("t_max"),
        d["temperature_2m_min"].alias("t_min"),
        d["precipitation_sum"].alias("precip"),
        d["rain_sum"].alias("rain"),
        d["weathercode"].alias("code"),
    )
    filled = raw.where(d.isNotNull() & (F.size(d["temperature_2m_max"]) > 0))
    return filled.select("location_name", "poll_ts", F.explode(days).alias("x")).select(
        "location_name",
        F.lit("historical").alias("weather_type"),
        F.try_to_date("x.day", "yyyy-MM-dd").alias("observation_date"),
        "poll_ts",
        F.col("x.t_max").alias("temp_c"),
        c_to_f(F.col("x.t_max")).alias("temp_f"),
        F.col("x.t_min").alias("temp_min_c"),
        c_to_f(F.col("x.t_min")).alias("temp_min_f"),
        F.col("x.precip").alias("precip_mm"),
        F.col("x.rain").alias("rain_mm"),
        F.col("x.code").alias("weather_code"),
        F.lit(None).cast("double").alias("wind_kmh"),
        F.lit(None).cast("int").alias("humidity_pct"),
    )


def dedup_across_terms(results: DataFrame) -> DataFrame:
    """First-seen market over (term_no, rank) of overlapping search results."""
    return first_per_key(
        results.where(F.col("id").isNotNull() & (F.col("id") != "")),
        ["id"],
        [F.col("term_no"), F.col("rank")],
    )


def term_report(results: DataFrame) -> DataFrame:
    """Per term: results and how many of them no earlier term had returned.

    The first term of a market is a minimum, so markets shrink map-side and no
    row of the search results is ranked.
    """
    total = results.groupBy("term_no").agg(F.count(F.lit(1)).alias("total"))
    fresh = (
        results.where(F.col("id").isNotNull() & (F.col("id") != ""))
        .groupBy("id")
        .agg(F.min("term_no").alias("term_no"))
        .groupBy("term_no")
        .agg(F.count(F.lit(1)).alias("fresh"))
    )
    return total.join(fresh, "term_no", "left").select(
        "term_no", "total", F.coalesce("fresh", F.lit(0)).alias("new_markets")
    )


def term_hits(markets: DataFrame, question: str = "question") -> DataFrame:
    """(term_no, term, id) for every search term a market's text contains."""
    wanted = markets.where(X.term_match(F.col(question)))
    return wanted.select("id", F.inline(X.matched_terms(F.col(question))))


def distinct_city_dates(predictions: DataFrame, gazetteer: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Distinct valid (city, date) with the first record's ``needs_check``."""
    names = verified_names(gazetteer)
    shaped = predictions.where(X.plausible_city(F.col("location_name"))).select(
        F.col("location_name").alias("city"),
        F.coalesce(F.col("end_date").cast("string"), F.lit("current")).alias("date"),
        F.coalesce("needs_weather_check", F.lit(True)).alias("needs_check"),
        arrival,
    )
    grouped = shaped.groupBy("city", "date").agg(F.min_by("needs_check", arrival).alias("needs_check"))
    return grouped.join(names, grouped["city"] == names["city_name"], "left_semi")


def weather_requests(city_dates: DataFrame, as_of, places: DataFrame | None = None) -> DataFrame:
    """Which feed answers a (city, date): the archive for past days, else current.

    With ``places`` (city_name, lat, lon, timezone) requests carry coordinates, and cities
    that have none there or in the fixed table are skipped.
    """
    if places is not None:
        city_dates = coords_lookup(city_dates, places)
    past = historical_eligible(F.col("date"), as_of)
    return city_dates.withColumn("feed", F.when(past, "historical").otherwise("current"))

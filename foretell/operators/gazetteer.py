"""City names against a gazetteer table (city_name, verified, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell import constants as C
from foretell.functions import text as X


def accepted_places(responses: DataFrame) -> DataFrame:
    """Geocoder rows whose class is a settlement and whose type is not a venue."""
    return responses.where(
        F.col("place_class").isin(*C.PLACE_CLASSES) & ~F.col("place_type").isin(*C.REFUSED_PLACE_TYPES)
    )


def verified_names(gazetteer: DataFrame) -> DataFrame:
    return gazetteer.where(F.col("verified")).select("city_name").distinct()


def valid_cities(df: DataFrame, gazetteer: DataFrame, city: str = "city") -> DataFrame:
    names = verified_names(gazetteer)
    return df.where(X.plausible_city(F.col(city))).join(
        names, F.col(city) == names["city_name"], "left_semi"
    )


def question_cities(questions: DataFrame, gazetteer: DataFrame, question: str = "question") -> DataFrame:
    """(question, city) for every distinct question whose cascade finds a valid city.

    Markets are polled over and over with the same text, so the patterns run once
    per distinct question. Candidates keep their cascade position; the first one
    in the gazetteer wins. ``distinct`` and the final grouping share the exchange
    on the question when the gazetteer is small enough for Spark to broadcast.
    """
    names = verified_names(gazetteer)
    candidates = (
        questions.where(F.col(question).isNotNull())
        .select(question)
        .distinct()
        .withColumn("__asked", X.strip(F.col(question)))
        .select(question, F.posexplode(X.city_captures(F.col("__asked"))).alias("place", "__capture"))
        .where(F.col("__capture") != "")
        .select(question, "place", X.clean_city(F.col("__capture")).alias("city"))
        .where(X.plausible_city(F.col("city")))
    )
    known = candidates.join(names, candidates["city"] == names["city_name"], "left_semi")
    return known.groupBy(question).agg(F.min_by("city", "place").alias("city"))


def extract_city(df: DataFrame, gazetteer: DataFrame, question: str = "question") -> DataFrame:
    """Adds ``city`` (null where the cascade finds none)."""
    found = question_cities(df, gazetteer, question).withColumnRenamed(question, "__question")
    return df.join(found, F.col(question) == F.col("__question"), "left").drop("__question")


def resolve_city(df: DataFrame, question: str = "question") -> DataFrame:
    """Adds ``city`` and ``needs_review``.

    A nickname is accepted at once; a suspicious or missing capture goes to review.
    """
    raw = X.extract_city_basic(F.col(question))
    marked = df.withColumn("__raw", raw)
    nick = X.nickname_target(F.col("__raw"))
    known_nick = nick.isNotNull() & (nick != F.col("__raw"))
    doubtful = F.col("__raw").isNull() | (~F.coalesce(known_nick, F.lit(False)) & X.suspicious_city(F.col("__raw")))
    return (
        marked.withColumn("needs_review", F.coalesce(doubtful, F.lit(True)))
        .withColumn("city", F.when(~F.col("needs_review"), X.normalize_city(F.col("__raw"))))
        .drop("__raw")
    )


def split_review(df: DataFrame, question: str = "question") -> tuple[DataFrame, DataFrame]:
    resolved = resolve_city(df, question)
    settled = resolved.where(~F.col("needs_review")).drop("needs_review")
    return settled, resolved.where(F.col("needs_review")).drop("needs_review", "city")


def timezone_lookup(df: DataFrame, gazetteer: DataFrame, city: str = "city") -> DataFrame:
    """Known city's zone, else the gazetteer's, else UTC."""
    zones = gazetteer.select(F.col("city_name").alias("__city"), F.col("timezone").alias("__tz"))
    known = X.choose(F.col(city), C.CITY_TIMEZONES)
    return (
        df.join(zones, F.col(city) == F.col("__city"), "left")
        .withColumn("timezone", F.coalesce(known, "__tz", F.lit("UTC")))
        .drop("__city", "__tz")
    )


def known_coordinates(spark) -> DataFrame:
    return spark.createDataFrame(
        list(C.CITY_COORDINATES), "city_name string, lat double, lon double, timezone string"
    )


def coords_lookup(df: DataFrame, cache: DataFrame, city: str = "city") -> DataFrame:
    """Adds lat/lon/timezone; the fixed table wins over ``cache`` (city_name, lat,
    lon, timezone). Places without coordinates, cached as missing or not, drop."""
    known = known_coordinates(df.sparkSession).select(
        F.col("city_name").alias("k_city"), F.struct("lat", "lon", "timezone").alias("k")
    )
    cached = cache.where(F.col("lat").isNotNull()).select(
        F.col("city_name").alias("c_city"),
        F.struct("lat", "lon", F.coalesce("timezone", F.lit("UTC")).alias("timezone")).alias("c"),
    )
    return (
        df.join(known, F.col(city) == F.col("k_city"), "left")
        .join(cached, F.col(city) == F.col("c_city"), "left")
        .withColumn("at", F.coalesce("k", "c"))
        .where(F.col("at").isNotNull())
        .select(*df.columns, "at.lat", "at.lon", "at.timezone")
    )

"""The domain's inputs derived from the TPC-H-like tables of a data folder.

Column expressions only: every frame scales with the tables behind it. The same
mapping in SQL is in ``checks/sql.py``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.operators.accuracy import accuracy, drop_snapshot
from foretell.operators.scoring import score
from foretell.sources.session import configure, scratch

AS_OF = "2024-01-31 00:00:00"

CITIES = (
    "London", "New York City", "Tokyo", "Seattle", "Paris", "Berlin", "Sydney",
    "Toronto", "Miami", "Warsaw", "Amsterdam", "Dublin", "Chicago", "Los Angeles",
    "San Francisco", "Boston", "Denver", "Atlanta", "Vancouver", "Montreal",
    "Calgary", "Ottawa", "Manchester", "Birmingham", "Istanbul",
)
TYPES = (
    "RAIN", "SNOW", "TEMPERATURE", "SUNSHINE", "WIND", "FOG", "HAIL", "CLOUD",
    "FROST", "WEATHER", "VOLCANO",
)
# two lines of an order may share a number, so arrival needs more than that
POLL_ORDER = ("arrival", "part", "amount")
ODD_PLACES = ("NYC", "Frisco", "Atlantis", "Monday Next Week")


def pick(names: tuple[str, ...], index: Column) -> Column:
    listed = ", ".join(f"'{n}'" for n in names)
    return F.element_at(F.expr(f"array({listed})"), index.cast("int") + 1)


class Fixtures:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        """A table with its zone-less timestamps read as UTC."""
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        naive = {c: F.col(c).cast("timestamp") for c, t in frame.dtypes if t == "timestamp_ntz"}
        return frame.withColumns(naive) if naive else frame

    # -- weather <- events -------------------------------------------------------
    @staticmethod
    def weather_from(events: DataFrame) -> DataFrame:
        kind, value = F.col("event_type"), F.col("value")
        precip = F.when(F.col("event_id") % 3 == 0, value / 10).otherwise(F.lit(0.0))
        return events.select(
            F.col("event_id").alias("obs_id"),
            pick(CITIES, F.col("user_id") % 25).alias("location_name"),
            F.when(kind.isin("view", "purchase", "signup"), "historical").otherwise("current").alias("weather_type"),
            F.to_date("ts").alias("observation_date"),
            F.col("ts").alias("poll_ts"),
            (value - 20).alias("temp_c"),
            ((value - 20) * 9 / 5 + 32).alias("temp_f"),
            precip.alias("precip_mm"),
            F.when(F.col("event_id") % 2 == 0, precip).otherwise(F.lit(0.0)).alias("rain_mm"),
            F.when(kind != "error", F.get_json_object("props", "$.k").cast("int")).alias("weather_code"),
            F.when(kind != "signup", value).alias("wind_kmh"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        return self.weather_from(self.table("events"))

    # -- predictions <- orders x customer ---------------------------------------
    @staticmethod
    def predictions_from(orders: DataFrame, customers: DataFrame) -> DataFrame:
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        closed = F.col("o_orderstatus") == "F"
        value = (key % 50).cast("double")
        threshold = F.struct(
            value.alias("value"),
            F.when(key % 3 == 2, value).alias("value_min"),
            F.when(key % 3 == 2, value + 10).alias("value_max"),
            F.when(key % 2 == 0, "C").otherwise("F").alias("unit"),
            pick(("above", "below", "between"), key % 3).alias("type"),
        )
        joined = orders.join(
            customers.select("c_custkey", "c_nationkey"), cust == F.col("c_custkey")
        )
        return joined.select(
            key.cast("string").alias("condition_id"),
            F.concat(F.lit("Question "), key.cast("string")).alias("question"),
            pick(CITIES, F.col("c_nationkey")).alias("location_name"),
            pick(TYPES, key % 11).alias("market_type"),
            F.when(closed, "closed").otherwise("open").alias("market_status"),
            (((key * 37) % 101).cast("double") / F.lit(100.0)).alias("price"),
            F.when(closed & (cust % 10 != 0), cust % 2 == 0).alias("winner"),
            closed.alias("closed"),
            F.date_add(F.lit("2024-01-01").cast("date"), (key % 40).cast("int")).alias("end_date"),
            F.timestamp_seconds(F.lit(1704067200) + (key * 173) % 2592000).alias("poll_ts"),
            F.col("o_totalprice").alias("volume"),
            F.when(key % 7 != 0, threshold).alias("threshold"),
            key.alias("arrival"),
        )

    @cached_property
    def predictions(self) -> DataFrame:
        return self.predictions_from(self.table("orders"), self.table("customer"))

    @cached_property
    def correlations(self) -> DataFrame:
        return score(self.predictions, self.weather, AS_OF, store=scratch(self.spark, "resolved"))

    # -- polls <- lineitem: several records per market ---------------------------
    @cached_property
    def polls(self) -> DataFrame:
        key = F.col("l_orderkey")
        method = F.when(F.col("l_linestatus") == "F", "winner_known").otherwise("historical_weather")
        return self.table("lineitem").select(
            F.when(key % 10 != 3, key.cast("string")).alias("condition_id"),
            (F.col("l_linestatus") == "F").alias("closed"),
            (key * 10 + F.col("l_linenumber")).alias("arrival"),
            F.col("l_partkey").alias("part"),
            F.col("l_extendedprice").alias("amount"),
            method.alias("correlation_method"),
            (F.col("l_returnflag") == "R").alias("is_arbitrage"),
            pick(CITIES, F.col("l_suppkey") % 25).alias("location_name"),
            pick(TYPES, F.col("l_partkey") % 11).alias("market_type"),
            (((F.col("l_partkey") * 37) % 101).cast("double") / F.lit(100.0)).alias("price"),
            F.when(key % 4 != 0, F.col("l_discount") * 5 + 0.1).alias("base_rate"),
            F.when(key % 5 != 0, F.col("l_tax") * 8).alias("deviation_from_base"),
        )

    # -- questions and raw markets <- orders x customer --------------------------
    @cached_property
    def questions(self) -> DataFrame:
        k = F.col("arrival")
        city, odd = F.col("location_name"), pick(ODD_PLACES, F.floor(k / 8) % 4)
        n = (k % 50).cast("string")
        texts = [
            F.concat(F.lit("Will it rain in "), city, F.lit(" on "), F.col("end_date").cast("string"), F.lit("?")),
            F.concat(F.lit("Will the temperature in "), city, F.lit(" exceed "), n, F.lit("°F?")),
            F.concat(F.lit("Will there be fog in "), city, F.lit(" today?")),
            F.concat(F.lit("Will it snow in  "), city, F.lit(" tomorrow?")),
            F.concat(F.lit("Will it be sunny in "), city, F.lit(" at today?")),
            F.concat(F.lit("Will it be below "), n, F.lit(" degrees in "), city, F.lit(", or not?")),
            F.lit("Will the home team win the 2024 final?"),
            F.concat(F.lit("A hurricane? Expect wind in "), odd, F.lit(" tomorrow, freezing")),
        ]
        asked = F.coalesce(*[F.when(k % 8 == i, text) for i, text in enumerate(texts)])
        return self.predictions.select(
            F.concat(F.lit("m"), k.cast("string")).alias("id"),
            asked.alias("question"),
            "arrival",
            "location_name",
            "price",
            "winner",
            "closed",
            "end_date",
            "poll_ts",
            "volume",
        )

    @cached_property
    def markets(self) -> DataFrame:
        k = F.col("arrival")
        millis = F.unix_millis(F.col("end_date").cast("timestamp"))
        resolution = F.when(F.col("winner"), "YES").when(~F.col("winner"), "NO").when(F.col("closed"), "MKT")
        return self.questions.select(
            "id",
            "question",
            F.concat(F.lit("slug-"), k.cast("string")).alias("slug"),
            F.concat(F.lit("https://example.org/"), k.cast("string")).alias("url"),
            F.when(k % 11 == 3, "MULTIPLE_CHOICE").otherwise("BINARY").alias("outcomeType"),
            resolution.alias("resolution"),
            F.when(k % 19 != 0, ((k * 37) % 10007).cast("double") / F.lit(10007.0)).alias("probability"),
            F.col("closed").alias("isResolved"),
            F.when(k % 23 == 0, F.lit(0)).otherwise(millis).cast("bigint").alias("closeTime"),
            F.when(k % 6 != 0, F.col("volume")).alias("volume"),
            F.when(k % 9 != 0, (k % 50).cast("int")).alias("uniqueBettorCount"),
        )

    # -- gazetteer <- nation; geocoder responses <- customer ---------------------
    @cached_property
    def gazetteer(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.table("nation").select(
            pick(CITIES, n).alias("city_name"),
            (n % 9 != 8).alias("verified"),
            (n * 1.5).alias("lat"),
            (n * -2.5).alias("lon"),
            F.when(n % 4 != 0, F.concat(F.lit("Zone/"), n.cast("string"))).alias("timezone"),
        )

    # -- health <- events ----------------------------------------------------------
    @cached_property
    def health(self) -> DataFrame:
        bad = F.col("event_type") == "error"
        return self.table("events").select(
            F.concat(F.lit("feed_"), (F.col("user_id") % 25).cast("string")).alias("component"),
            F.when(bad, "degraded").otherwise("healthy").alias("status"),
            F.floor("value").alias("messages_processed"),
            F.when(bad, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("error_count"),
            F.col("ts").alias("last_message_at"),
            (F.col("event_id") % 1000).alias("latency_ms"),
            F.col("ts").alias("recorded_at"),
            F.col("event_id").alias("health_id"),
        )

    @cached_property
    def expected(self) -> DataFrame:
        """Twenty-seven expected components, two of which never report: one per
        nation, two more from the regions."""
        feed = F.lit("feed_")
        first = self.table("nation").select(F.concat(feed, F.col("n_nationkey").cast("string")).alias("component"))
        more = self.table("region").where(F.col("r_regionkey") < 2)
        return first.unionByName(
            more.select(F.concat(feed, (F.col("r_regionkey") + 25).cast("string")).alias("component"))
        )

    # -- stored aggregates: correlations by place and day of poll -----------------
    @cached_property
    def aggregates(self) -> DataFrame:
        rows = drop_snapshot(self.correlations).withColumn("market_type", F.lit("ALL"))
        day = F.date_trunc("day", F.col("poll_ts")).alias("window_start")
        daily = accuracy(rows, "batch", [day])
        return daily.withColumns(
            {
                "window_end": F.col("window_start") + F.expr("interval 1 day"),
                "updated_at": F.col("window_start") + F.expr("interval 25 hours"),
            }
        )

    # -- stored alerts: flagged mispricings, some already closed -------------------
    @cached_property
    def stored_alerts(self) -> DataFrame:
        """One open or closed alert per event: timeouts of feeds and drops of places."""
        e = self.table("events")
        eid = F.col("event_id")
        timeout = eid % 2 == 0
        return e.select(
            eid.alias("alert_id"),
            F.when(timeout, "producer_timeout").otherwise("accuracy_drop").alias("alert_type"),
            pick(("low", "medium", "high", "critical"), F.col("user_id") % 4).alias("severity"),
            F.when(timeout, F.concat(F.lit("feed_"), (F.col("user_id") % 25).cast("string")))
            .otherwise(pick(CITIES, F.col("user_id") % 25))
            .alias("location_name"),
            F.when(timeout, "SYSTEM").otherwise("ALL").alias("market_type"),
            F.concat(F.lit("alert "), eid.cast("string")).alias("message"),
            F.col("value").alias("metric_value"),
            F.lit(10.0).alias("threshold_value"),
            (eid % 3 == 0).alias("is_resolved"),
            F.when(eid % 3 == 0, F.col("ts")).alias("resolved_at"),
            F.col("ts").alias("detected_at"),
        )

"""Question text: market types, cities, keys, terms; gazetteer lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from foretell import constants as C
from foretell.checks import check
from foretell.checks.sql import lst, q
from foretell.functions import text as X
from foretell.operators import gazetteer as G
from foretell.operators import ingest as I
from foretell.operators import summaries as M
from foretell.plans.fixtures import pick


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip_sql(e: str) -> str:
    return rf"regexp_replace({e}, '^\s+|\s+$', '', 'g')"


def _candidate_sql(question: str, pattern: str, stop: str) -> str:
    found = f"regexp_extract({_strip_sql(question)}, {_quoted(pattern)}, 1)"
    spaced = rf"regexp_replace({_strip_sql(found)}, '\s+', ' ', 'g')"
    return _strip_sql(rf"regexp_replace({spaced}, '(?i)\s+({stop})$', '')")


def _plausible_sql(c: str) -> str:
    return (
        rf"(length({c}) BETWEEN 2 AND 50 AND regexp_matches({c}, '^\p{{Lu}}') AND NOT regexp_matches({c}, '\d') "
        rf"AND len(list_filter(string_split_regex({c}, '\s+'), lambda w: w <> '')) <= 5)"
    )


_TYPE = "CASE " + " ".join(
    rf"WHEN regexp_matches(lower(question), '\b({words})\b') THEN '{name}'" for name, words in C.MARKET_TYPE_WORDS
) + " ELSE 'WEATHER' END"
_CANDIDATES = "[" + ", ".join(_candidate_sql("question", p, C.CITY_STOP_WORDS) for p in C.CITY_PATTERNS) + "]"
_BASIC = "coalesce(" + ", ".join(
    "CASE WHEN length({0}) >= 2 THEN {0} END".format(_candidate_sql("question", p, C.CITY_STOP_WORDS_BASIC))
    for i, p in enumerate(C.CITY_PATTERNS) if i != 5
) + ")"
CITY_SQL = f"""(SELECT first(c ORDER BY pos) FROM (SELECT unnest({_CANDIDATES}) AS c, generate_subscripts({_CANDIDATES}, 1) AS pos)
      WHERE {_plausible_sql('c')} AND c IN (SELECT city_name FROM gazetteer WHERE verified))"""
_NICK = "CASE lower({0}) " + " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in C.CITY_NICKNAMES.items()) + " END"


def _suspicious_sql(c: str) -> str:
    words = rf"list_filter(string_split_regex({c}, '\s+'), lambda w: w <> '')"
    return f"(len({words}) > 4 OR list_has_any(list_transform({words}, lambda w: lower(w)), {lst(C.TIME_WORDS)}))"


@check("market_type", q(f"SELECT id, {_TYPE} AS market_type FROM questions", "questions"))
def _market_type(f):
    return f.questions.select("id", X.market_type(F.col("question")).alias("market_type"))


@check("extract_city", q(f"SELECT id, {CITY_SQL} AS city FROM questions", "questions", "gazetteer"))
def _extract_city(f):
    return G.extract_city(f.questions, f.gazetteer).select("id", "city")


@check("extract_city_basic", q(f"SELECT id, {_BASIC} AS city FROM questions", "questions"))
def _basic(f):
    return f.questions.select("id", X.extract_city_basic(F.col("question")).alias("city"))


_ANY_CITY = f"""(['NYC', 'Frisco', 'The Big Apple', 'London', 'chi-town', 'Paris Next Weekend', 'A B C D E', 'DC', 'new york',
      'Banská Štiavnica', 'x', 'lower', 'Area 51', 'Tokyo'])[CAST(o_orderkey % 14 AS INT) + 1]"""
_ANY = (
    "NYC", "Frisco", "The Big Apple", "London", "chi-town", "Paris Next Weekend", "A B C D E", "DC", "new york",
    "Banská Štiavnica", "x", "lower", "Area 51", "Tokyo",
)


def _named(f):
    return f.table("orders").select("o_orderkey", pick(_ANY, F.col("o_orderkey") % 14).alias("city"))


@check("normalize_city", f"SELECT o_orderkey, coalesce({_NICK.format('city')}, city) AS city FROM (SELECT o_orderkey, {_ANY_CITY} AS city FROM orders)")
def _normalize(f):
    return _named(f).select("o_orderkey", X.normalize_city(F.col("city")).alias("city"))


@check("suspicious_city", f"SELECT o_orderkey, {_suspicious_sql('city')} AS suspicious FROM (SELECT o_orderkey, {_ANY_CITY} AS city FROM orders)")
def _suspicious(f):
    return _named(f).select("o_orderkey", X.suspicious_city(F.col("city")).alias("suspicious"))


@check(
    "valid_city",
    q(f"""SELECT o_orderkey, city FROM (SELECT o_orderkey, {_ANY_CITY} AS city FROM orders)
          WHERE {_plausible_sql('city')} AND city IN (SELECT city_name FROM gazetteer WHERE verified)""", "gazetteer"),
)
def _valid(f):
    return G.valid_cities(_named(f), f.gazetteer)


@check(
    "plausible_city",
    f"SELECT o_orderkey, {_plausible_sql('city')} AS plausible FROM (SELECT o_orderkey, {_ANY_CITY} AS city FROM orders)",
)
def _plausible(f):
    return _named(f).select("o_orderkey", X.plausible_city(F.col("city")).alias("plausible"))


@check(
    "resolve_city",
    q(f"""SELECT id, CASE WHEN NOT review THEN coalesce(nick, raw) END AS city, review AS needs_review FROM (
          SELECT *, raw IS NULL OR (NOT coalesce(nick <> raw, false) AND {_suspicious_sql('raw')}) AS review
          FROM (SELECT *, {_NICK.format('raw')} AS nick FROM (SELECT id, {_BASIC} AS raw FROM questions)))""", "questions"),
)
def _resolve(f):
    return G.resolve_city(f.questions).select("id", "city", "needs_review")


_CLASSES = ("place", "boundary", "administrative", "amenity", "railway")
_KINDS = ("city", "town", "shop", "park", "village", "hotel", "station")


@check(
    "place_class_filter",
    f"""SELECT c_custkey, place_class, place_type FROM (SELECT c_custkey, ({lst(_CLASSES)})[CAST(c_custkey % 5 AS INT) + 1] AS place_class,
          ({lst(_KINDS)})[CAST(c_custkey % 7 AS INT) + 1] AS place_type FROM customer)
        WHERE place_class IN ('place', 'boundary', 'administrative') AND place_type NOT IN ({', '.join(map(_quoted, C.REFUSED_PLACE_TYPES))})""",
)
def _places(f):
    responses = f.table("customer").select(
        "c_custkey",
        pick(_CLASSES, F.col("c_custkey") % 5).alias("place_class"),
        pick(_KINDS, F.col("c_custkey") % 7).alias("place_type"),
    )
    return G.accepted_places(responses)


_ZONES = "CASE city " + " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in C.CITY_TIMEZONES.items()) + " END"
_PLACES = ("Calgary", "Ottawa", "Boston", "London", "Atlantis", "Denver", "Manchester", "Montreal", "Bibinje", "Springfield", "Zürich")


def _asked(f):
    return f.table("customer").select("c_custkey", pick(_PLACES, F.col("c_custkey") % 11).alias("city"))


_ASKED = f"(SELECT c_custkey, ({lst(_PLACES)})[CAST(c_custkey % 11 AS INT) + 1] AS city FROM customer)"


@check(
    "timezone_lookup",
    q(f"SELECT c_custkey, city, coalesce({_ZONES}, g.timezone, 'UTC') AS timezone FROM {_ASKED} LEFT JOIN gazetteer g ON city = g.city_name", "gazetteer"),
)
def _zone(f):
    return G.timezone_lookup(_asked(f), f.gazetteer)


_KNOWN = ", ".join(f"({_quoted(c)}, {lat}::DOUBLE, {lon}::DOUBLE, {_quoted(tz)})" for c, lat, lon, tz in C.CITY_COORDINATES)


@check(
    "coords_lookup",
    f"""SELECT c_custkey, city, coalesce(k.lat, s.lat) AS lat, coalesce(k.lon, s.lon) AS lon,
          CASE WHEN k.lat IS NOT NULL THEN k.tz ELSE coalesce(s.tz, 'UTC') END AS timezone FROM {_ASKED}
        LEFT JOIN (VALUES {_KNOWN}) k(name, lat, lon, tz) ON k.name = city
        LEFT JOIN (VALUES ('Springfield', 1.5::DOUBLE, 2.5::DOUBLE, NULL), ('London', 0::DOUBLE, 0::DOUBLE, 'X'), ('Atlantis', NULL, NULL, NULL)) s(name, lat, lon, tz)
          ON s.name = city WHERE coalesce(k.lat, s.lat) IS NOT NULL""",
)
def _coords(f):
    cache = f.spark.createDataFrame(
        [("Springfield", 1.5, 2.5, None), ("London", 0.0, 0.0, "X"), ("Atlantis", None, None, None)],
        "city_name string, lat double, lon double, timezone string",
    )
    return G.coords_lookup(_asked(f), cache)


_QUIET = f"regexp_replace(lower(question), {_quoted(C.QUESTION_NOISE)}, '', 'g')"
_SPACED = rf"regexp_replace({_QUIET}, '\s+', ' ', 'g')"
_KEY = f"substr(md5({_strip_sql(_SPACED)}), 1, 12)"


@check("question_key", q(f"SELECT id, {_KEY} AS question_key FROM questions", "questions"))
def _key(f):
    return f.questions.select("id", X.question_key(F.col("question")).alias("question_key"))


_TERMS = "[" + ", ".join(_quoted(t) for t in C.SEARCH_TERMS) + "]"
_HITS = f"""(SELECT id, term_no, term, row_number() OVER (PARTITION BY term_no ORDER BY arrival) AS rank FROM (
      SELECT id, arrival, unnest({_TERMS}) AS term, generate_subscripts({_TERMS}, 1) - 1 AS term_no, question FROM questions)
      WHERE contains(lower(question), lower(term)))"""


@check("term_match", q(f"SELECT id, question FROM questions WHERE len(list_filter({_TERMS}, lambda t: contains(lower(question), lower(t)))) > 0", "questions"))
def _term_match(f):
    return f.questions.where(X.term_match(F.col("question"))).select("id", "question")


def _results(f):
    hits = I.term_hits(f.questions)
    return hits.withColumn("rank", F.substring("id", 2, 20).cast("bigint"))


@check(
    "dedup_across_terms",
    q(f"SELECT id, CAST(term_no AS INT) AS term_no, term FROM {_HITS} QUALIFY row_number() OVER (PARTITION BY id ORDER BY term_no, rank) = 1", "questions"),
)
def _across(f):
    return I.dedup_across_terms(_results(f)).select("id", "term_no", "term")


@check(
    "term_report",
    q(f"""SELECT CAST(term_no AS INT) AS term_no, count(*) AS total, count(*) FILTER (term_no = first_no) AS new_markets
          FROM (SELECT *, min(term_no) OVER (PARTITION BY id) AS first_no FROM {_HITS}) GROUP BY 1""", "questions"),
)
def _report(f):
    return I.term_report(_results(f))


@check(
    "gazetteer_stats",
    q(f"""SELECT (SELECT count(DISTINCT {_KEY}) FROM questions) AS total_questions, count(*) AS total_cities,
          count(*) FILTER (verified) AS verified_cities, count(*) FILTER (NOT verified) AS invalid_cities FROM gazetteer""", "questions", "gazetteer"),
)
def _stats(f):
    keyed = f.questions.select(X.question_key(F.col("question")).alias("question_key"))
    return M.gazetteer_stats(keyed, f.gazetteer)

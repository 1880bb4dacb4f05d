"""Question text to market type, city and cache key.

All patterns run as JVM regular expressions. ``(?U)`` makes ``\\s``, ``\\d`` and
``\\b`` Unicode-aware, as the published rules expect.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foretell import constants as C

UNICODE = "(?U)"


def choose(col: Column, mapping: dict) -> Column:
    """Value a small fixed mapping gives for ``col``; null where it has none."""
    (key, value), *rest = mapping.items()
    chain = F.when(col == key, F.lit(value))
    for key, value in rest:
        chain = chain.when(col == key, F.lit(value))
    return chain


def strip(col: Column) -> Column:
    return F.regexp_replace(col, UNICODE + r"^\s+|\s+$", "")


def market_type(question: Column) -> Column:
    lowered = F.lower(question)
    (first_type, first_words), *rest = C.MARKET_TYPE_WORDS
    chain = F.when(lowered.rlike(rf"{UNICODE}\b({first_words})\b"), first_type)
    for name, words in rest:
        chain = chain.when(lowered.rlike(rf"{UNICODE}\b({words})\b"), name)
    return chain.otherwise(C.DEFAULT_MARKET_TYPE)


def base_rate(type_col: Column) -> Column:
    rates = ", ".join(f"'{name}', {rate}D" for name, rate in C.BASE_RATES.items())
    return F.coalesce(
        F.try_element_at(F.expr(f"map({rates})"), type_col), F.lit(C.DEFAULT_BASE_RATE)
    )


def city_captures(question: Column) -> Column:
    """First capture of every pattern in cascade order; '' where one does not match."""
    return F.array(*[F.regexp_extract(question, UNICODE + p, 1) for p in C.CITY_PATTERNS])


def clean_city(capture: Column, stop_words: str = C.CITY_STOP_WORDS) -> Column:
    """Single spaces, no trailing stop word."""
    spaced = F.regexp_replace(strip(capture), UNICODE + r"\s+", " ")
    return strip(F.regexp_replace(spaced, rf"(?iU)\s+({stop_words})$", ""))


def extract_city_basic(question: Column) -> Column:
    """First capture of at least two characters, without gazetteer check."""
    asked = strip(question)
    captures = [
        F.regexp_extract(asked, UNICODE + p, 1)
        for i, p in enumerate(C.CITY_PATTERNS)
        if i != C.DEGREES_PATTERN
    ]
    cleaned = F.transform(F.array(*captures), lambda c: clean_city(c, C.CITY_STOP_WORDS_BASIC))
    return F.get(F.filter(cleaned, lambda c: F.length(c) >= 2), F.lit(0))


def nickname_target(city: Column) -> Column:
    return choose(F.lower(city), C.CITY_NICKNAMES)


def normalize_city(city: Column) -> Column:
    return F.coalesce(nickname_target(city), city)


def _words(city: Column) -> Column:
    return F.filter(F.split(city, UNICODE + r"\s+"), lambda w: w != "")


def suspicious_city(city: Column) -> Column:
    lowered = F.transform(_words(city), F.lower)
    time_words = F.array(*[F.lit(w) for w in C.TIME_WORDS])
    return (F.size(lowered) > 4) | F.arrays_overlap(lowered, time_words)


def plausible_city(city: Column) -> Column:
    """Shape rules a city name must pass before any gazetteer lookup."""
    shape = (
        F.length(city).between(2, 50)
        & city.rlike(r"^\p{Lu}")
        & ~city.rlike(r"\p{Nd}")
        & (F.size(_words(city)) <= 5)
    )
    return F.coalesce(shape, F.lit(False))


def question_key(question: Column) -> Column:
    quiet = F.regexp_replace(F.lower(question), UNICODE + C.QUESTION_NOISE, "")
    return F.substring(F.md5(strip(F.regexp_replace(quiet, UNICODE + r"\s+", " "))), 1, 12)


def matched_terms(text: Column) -> Column:
    """[(term_no, term)] contained in the text, case-insensitively, in query order.

    The term list is one constant and the text appears once, so the expression
    stays small however many terms there are.
    """
    listed = ", ".join(
        f"named_struct('term_no', {i}, 'term', '{t}', 'needle', '{t.lower()}')"
        for i, t in enumerate(C.SEARCH_TERMS)
    )
    hits = F.filter(F.expr(f"array({listed})"), lambda h: F.contains(F.lower(text), h["needle"]))
    return F.transform(hits, lambda h: F.struct(h["term_no"].alias("term_no"), h["term"].alias("term")))


def term_match(text: Column) -> Column:
    """Any search term: one alternation, one scan of the text."""
    return F.lower(text).rlike("|".join(rf"\Q{t.lower()}\E" for t in C.SEARCH_TERMS))

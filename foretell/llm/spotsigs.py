"""Document fingerprints from spot signatures.

A spot is a common word (the anchor) with the content words that follow it, at most
``CHAIN`` and up to the next anchor; the beginning of a text is an anchor too. What is left
up to the next anchor gives spots as well: it is cut before every word whose hash divides by
``CUT``, and each piece is a spot with all its words. So every word is in a spot, also in
texts of other languages, and a change moves only the spots it touches. Letters of scripts
that put no blanks between words count as words. A text's fingerprint is the sorted set of its spots' 32-bit hashes, written as hexadecimal numbers.
The likeness of two fingerprints is the Jaccard similarity of their sets; two empty ones
are equal, likeness 1. ``search`` compares only sets of near lengths: it partitions by
length, and joins on the first hashes of a set, of which similar sets must share one.

Cases: a null text is the empty text; a text without words has the empty fingerprint;
equal texts have equal fingerprints; repeated ids are ordered by their texts, null ids come
first; the only row of a table is followed by itself. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foretell.llm.common import stored, texts_of

CHAIN, CUT = 3, 4
# fixed values: common words of four languages
ANCHORS = (
    "the of and to in is that for it as was with be by on are from this at or an not "
    "der die das und ist von mit den ein eine zu auf für im sich des dem nicht als auch "
    "le la les de des et un une est que pour dans par sur avec au en du qui ne pas "
    "el los las y que del por con para se al lo como más su una no es"
)
_UNSPACED = "".join(rf"\p{{Is{name}}}" for name in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
_MARK = "\u0001"
#: Documents in a bucket of neighbours, about; coarse buckets.
BUCKET, COARSE = 20_000, 64


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def spots(text: Column) -> Column:
    """The sorted distinct spot hashes of a text."""
    anchors = "|".join(sorted(set(ANCHORS.split()), key=lambda w: (-len(w), w)))
    short = lambda piece: F.substring_index(F.rtrim(piece), " ", CHAIN + 1)

    def chains(stretch):
        # an anchor right before another one, or at the end, has no chain
        head = short(stretch)
        rest = F.split(F.substring(stretch, F.length(head) + 2, F.length(stretch)), " ")
        cut = F.transform(rest, lambda w: F.when(F.pmod(F.hash(w), F.lit(CUT)) == 0, F.concat(F.lit(_MARK), w)).otherwise(w))
        pieces = F.transform(F.split(F.array_join(cut, " "), _MARK), F.trim)
        return F.concat(F.filter(F.array(head), lambda c: F.instr(c, " ") > 0), F.filter(pieces, lambda c: c != ""))

    def of_words(words):
        marked = F.regexp_replace(words, f"(?<![^ ])(?:{anchors})(?![^ ])", f"{_MARK}$0")
        stretches = F.transform(F.split(marked, _MARK), F.rtrim)
        # the beginning always has a chain
        begun = F.filter(F.array(short(words)), lambda c: c != "")
        found = F.concat(begun, F.flatten(F.transform(stretches, chains)))
        return F.array_sort(F.array_distinct(F.transform(found, lambda c: F.hash(c))))

    apart = F.regexp_replace(F.lower(text), f"[{_UNSPACED}]", " $0 ")
    return _let(F.trim(F.regexp_replace(apart, r"[^\p{L}\p{N}]+", " ")), of_words)


def fingerprint(found: Column) -> Column:
    """The set of spots as a string."""
    return F.array_join(F.transform(found, lambda x: F.lower(F.hex(x.cast("bigint") + (1 << 31)))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; disjoint ranges or an empty side need no intersection."""
    apart = (F.element_at(a, -1) < F.get(b, F.lit(0))) | (F.element_at(b, -1) < F.get(a, F.lit(0)))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .when(apart, 0.0)
        .otherwise(_let(F.size(F.array_intersect(a, b)), lambda both: both / (F.size(a) + F.size(b) - both)))
    )


def search(queries: DataFrame, rows: DataFrame, least: float = 0.8) -> DataFrame:
    """query_id, doc_id, likeness of all pairs that reach ``least``; both sides have doc_id and spots.

    Sets are partitioned by length in steps of 1 / least, so partners are one step apart at
    most. Of sets that similar, the first n - ceil(least * n) + 1 hashes share one.
    """
    if not 0 < least <= 1:
        raise ValueError("least is a likeness above 0")
    step = F.floor(F.log(F.size("spots")) / -math.log(least)) if least < 1 else F.size("spots")
    size = F.size("spots")
    prefix = F.slice("spots", 1, (size - F.ceil(size * least - 1e-9) + 1).cast("int"))
    keyed = lambda df: df.where(size > 0).select("doc_id", "spots", step.cast("int").alias("part"), F.explode(prefix).alias("spot"))
    mine = keyed(queries).select(
        F.col("doc_id").alias("query_id"), F.col("spots").alias("own"), F.explode(F.array(F.col("part") - 1, "part", F.col("part") + 1)).alias("part"), "spot"
    )
    pairs = mine.join(keyed(rows), ["part", "spot"])
    pruned = pairs.where(F.least(F.size("own"), size) >= least * F.greatest(F.size("own"), size))
    scored = pruned.select("query_id", "doc_id", likeness(F.col("own"), F.col("spots")).alias("likeness"))
    return scored.where(F.col("likeness") >= least).distinct()


def next_texts(texts: DataFrame, carried: Column) -> DataFrame:
    """doc_id, text, own, next_text, next_own: each row beside the next one by doc_id (after the last, the first).

    ``carried`` is worked out once for each row, before rows are dealt out. Ids are cut into
    buckets of neighbours by quantiles; every bucket also gets a copy of the first row behind
    it, so neighbours are found inside the bucket and only one shuffle moves the texts.
    """
    ids = texts.select("doc_id")
    rows = ids.count()
    cuts = sorted(set(ids.dropna().approxQuantile("doc_id", [i / COARSE for i in range(1, COARSE)], 0.002))) if rows else []
    fine = max(1, rows // (COARSE * BUCKET))
    lows, highs = F.array(*map(F.lit, [*cuts[:1], *cuts])), F.array(*map(F.lit, [*cuts, *cuts[-1:]]))
    if cuts:
        coarse = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("doc_id")))
        low, high = F.get(lows, coarse), F.get(highs, coarse)
        inside = F.when(high > low, (F.col("doc_id") - low) / (high - low)).otherwise(0.0)
        place = F.least(F.greatest(F.floor(inside * fine), F.lit(0)), F.lit(fine - 1))
        bucket = F.coalesce(coarse * fine + place, F.lit(-1)).cast("bigint")
    else:
        bucket = F.lit(0).cast("bigint")
    heads = ids.groupBy(bucket.alias("bucket")).agg(F.min("doc_id").alias("head"))
    # a row for each bucket
    all_heads = Window.orderBy("bucket")
    before = F.lag("bucket").over(all_heads)
    # written, so that Spark knows how small it is and sends it to the texts, not the texts to it
    heads = stored(
        heads.select("head", F.coalesce(before, F.max("bucket").over(Window.partitionBy())).alias("before")), "heads"
    )
    placed = texts.select("doc_id", "text", carried.alias("own"), bucket.alias("bucket"), F.lit(False).alias("copy"))
    copies = (
        texts.join(heads, F.col("doc_id").eqNullSafe(F.col("head")))
        .select("doc_id", "text", carried.alias("own"), F.col("before").alias("bucket"), F.lit(True).alias("copy"))
    )
    order = Window.partitionBy("bucket").orderBy("copy", F.asc_nulls_first("doc_id"), "text")
    return (
        placed.unionByName(copies)
        .withColumns({"next_text": F.lead("text").over(order), "next_own": F.lead("own").over(order)})
        .where("not copy")
        .drop("bucket", "copy")
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row.

    The edited text has its last half replaced by the beginning of the next document's text.
    """
    texts = texts_of(docs, id_col, text_col)
    beside = next_texts(texts, spots(F.col("text")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    return (
        beside.select("doc_id", n.cast("bigint").alias("n_chars"), "own", "next_own", edited.alias("edited"))
        .withColumn("edited_own", spots(F.col("edited")))
        .select(
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            fingerprint(F.col("own")).alias("fingerprint"),
            fingerprint(F.col("edited_own")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
            likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        )
    )

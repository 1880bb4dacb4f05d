"""Benchmark passages in documents, also with other numbers, names or units.

Words become templates: a number, a unit after a number, and a capitalised word inside a
sentence give typed placeholders; all else is the bare lower-case word. As copies may
change case, there are two readings: with names as placeholders, and with names as words.
Windows of ``WINDOW`` template words with at least ``LITERALS`` bare words are hashed and
joined with the windows of the benchmark; a benchmark text shorter than a window is one
window of its own length. A third reading is literal: the words themselves, numbers and
units too, without the condition on bare words, so a verbatim passage is found however
dense in numbers it is. A document's windows first pass a bitmap of the benchmark's
hashes, which has a fixed size and lets every match through, so only likely matches leave
the scan.

**Slots.** Within an occurrence of an item in a document, each value in the item must stand
for one value in the document; windows that contradict the most frequent reading of a slot
do not count. A re-parameterised question keeps its repeated values equal, a chance match
does not. As a document may hold several variants of an item, the matched windows are read
as occurrences in three ways, each judged for itself: those of one offset between document
and item, runs in which both places go up (a copy with words put in or left out, up to
``2 * WINDOW`` at a time), and all of the document. A pair counts as found if an occurrence
has ``least`` different consistent windows of the item, or all of them if the item has
fewer; templates alone suffice if they are ``least`` or all of the item's templates.

Result: one row for each found pair of document and item: doc_id, item_id, n_windows (the
item's matched windows in the best occurrence), n_item_windows, exact (all slots of an
occurrence have the item's values).

Cases: null and empty texts match nothing, nor do items without words; of repeated items
each is reported; repeated rows of a document give one pair; rows with a null id cannot be
reported and are left out. An empty table on either side gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foretell.llm.common import stored, texts_of
from foretell.llm.minhash import _M1, _mix, _rows_hash
from foretell.llm.vocabulary import Memo

WINDOW, LITERALS, BITS = 8, 5, 1 << 24
#: Bytes of words that a task remembers (twice), matched windows that it passes on at a time.
REMEMBERED, PASSED = 40 << 20, 10_000
# fixed values: unit words and signs
UNITS = frozenset(
    "km m cm mm mi mile miles ft foot feet inch inches kg g mg lb lbs pound pounds ton tons l ml liter liters litre litres "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years percent degree degrees "
    "dollar dollars cent cents euro euros usd eur mph kmh watt watts volt volts joule joules".split()
)
_BARE = re.compile(r"[\W_]+")
_CAPITAL, _NUMBER, _UNIT, _ENDS = 1, 2, 4, 8
_FLAGS = np.uint64(15)
_NUMBER_SLOT, _NAME_SLOT, _UNIT_SLOT = (np.uint64(xxhash.xxh64_intdigest(x) & ~15) for x in ("<number>", "<name>", "<unit>"))
#: Number of the literal reading.
LITERAL = 2
HITS = "doc_id bigint, reading int, place int, hash bigint, slots array<bigint>"


def _code(run: str) -> int:
    """A run between blanks as a hash with flags in its low bits; 0 if it holds no word."""
    # most runs are a word, or a word and a sign behind it, which needs no pattern
    if run.isalnum():
        bare = run
    elif run[:-1].isalnum() and not run[-1].isalnum():
        bare = run[:-1]
    else:
        bare = _BARE.sub("", run)
        if not bare:
            return 0
    word = bare.lower()
    flags = _CAPITAL * bare[0].isupper() | _ENDS * (run[-1] in ".!?:")
    flags |= _NUMBER if not bare.isalpha() and any(map(str.isdigit, bare)) else _UNIT * (word in UNITS)
    return xxhash.xxh64_intdigest(word) & ~15 | flags


def template(text: str, codes) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The words' own hashes, and for each reading its number, the template, which words are
    slots, and which words a window must have one of to say more than the first reading."""
    lines = [line.split() for line in text.split("\n")]
    sizes = list(map(len, lines))
    code = np.fromiter(map(codes, chain.from_iterable(lines)), np.uint64, sum(sizes))
    words = np.flatnonzero(code)
    if not len(words):
        return np.empty(0, np.uint64), []
    line = np.repeat(np.arange(len(lines)), sizes)[words]
    code = code[words]
    code[np.append(line[1:] != line[:-1], True)] |= np.uint64(_ENDS)  # a line's end ends a sentence
    flags, own = (code & _FLAGS).astype(np.uint8), code & ~_FLAGS
    number = (flags & _NUMBER) > 0
    unit = np.concatenate(([False], number[:-1])) & ((flags & _UNIT) > 0)
    first = np.concatenate(([True], (flags[:-1] & _ENDS) > 0))
    name = ((flags & _CAPITAL) > 0) & ~first & ~number & ~unit
    plain = own
    if number.any():
        plain = np.where(number, _NUMBER_SLOT, np.where(unit, _UNIT_SLOT, own))
    slot = number | unit
    readings = [(0, plain, slot, np.ones(len(own), bool))]
    if name.any():
        readings.append((1, np.where(name, _NAME_SLOT, plain), slot | name, name))
    if slot.any():
        readings.append((LITERAL, own, np.zeros(len(own), bool), slot))
    return own, readings


def windows(text: str, codes, width: int = WINDOW, least: int = LITERALS) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(reading, places, hashes, slot values by place) of the windows: templates with enough bare words, and literal ones."""
    own, readings = template(text, codes)
    out = []
    for reading, words, slots, telling in readings:
        size = min(width, len(words))
        if reading:
            inside = np.concatenate(([0], np.cumsum(telling)))
            wanted = (inside[size:] - inside[:-size]) > 0
        else:
            wanted = np.ones(len(words) - size + 1, bool)
        if reading != LITERAL:
            bare = np.concatenate(([0], np.cumsum(~slots)))
            wanted &= (bare[size:] - bare[:-size]) >= min(least, size)
        places = np.flatnonzero(wanted)
        hashes = _rows_hash(words, size)[places] if not reading else _hashes_at(words, places, size)
        out.append((reading, places, hashes, np.where(slots, own, np.uint64(0))))
    return out


def _hashes_at(words: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """``_rows_hash`` of the windows that begin at some places."""
    if 2 * len(places) > len(words):
        return _rows_hash(words, width)[places]
    out = np.full(len(places), width, np.uint64)
    for i in range(width):
        out = _mix(out * _M1 + words[places + i])
    return out


def _mapper(bitmap: np.ndarray | None, narrow: int):
    """Windows of a batch of texts; with a bitmap only those that may be in the benchmark.

    ``narrow``: window lengths below ``WINDOW`` that short items need.
    """
    schema_names = [c.split()[0] for c in HITS.split(", ")]
    widths = [WINDOW] + [w for w in range(1, WINDOW) if narrow >> w & 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Memo(_code, REMEMBERED).__getitem__

        def passed(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[] for _ in schema_names]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=schema_names)

        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if bitmap is None:
                    found = [(WINDOW, x) for x in windows(text, codes)]
                else:
                    found = [(w, x) for w in widths for x in windows(text, codes, w)]
                for width, (reading, places, hashes, slots) in found:
                    if bitmap is not None:
                        bit = hashes & np.uint64(BITS - 1)
                        likely = (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
                        places, hashes = places[likely], hashes[likely]
                    for place, value in zip(places.tolist(), hashes.view(np.int64).tolist()):
                        rows.append((doc, reading, place, value, slots[place : place + width].view(np.int64).tolist()))
                if len(rows) > PASSED:
                    yield passed(rows)
                    rows = []
            yield passed(rows)

    return run


def _bitmap(marked: DataFrame) -> np.ndarray:
    """A bit for each hash modulo ``BITS``: 2 MB whatever the number of windows."""
    words = (
        marked.select((F.col("hash").bitwiseAND(BITS - 1)).alias("bit"))
        .groupBy(F.expr("bit div 8").alias("byte"))
        .agg(F.expr("bit_or(shiftleft(1, cast(bit % 8 as int)))").alias("bits"))
    )
    out = np.zeros(BITS // 8, np.uint8)
    for byte, bits in words.toLocalIterator():
        out[byte] = bits
    return out


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The found pairs of documents and benchmark items."""
    items = texts_of(benchmark, item_col, item_text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    items = items.where("doc_id is not null")
    known = stored(
        items.mapInArrow(_mapper(None, 0), HITS).select(
            F.col("doc_id").alias("item_id"), "reading", F.col("place").alias("item_place"), "hash", F.col("slots").alias("item_slots")
        ),
        "windows",
    )
    bitmap = _bitmap(known)
    # lengths of windows shorter than WINDOW that occur, as bits
    narrow = known.where(F.size("item_slots") < WINDOW).agg(
        F.expr("coalesce(bit_or(shiftleft(1, size(item_slots))), 0)")
    ).first()[0]
    texts = texts_of(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint")).where("doc_id is not null")
    hits = texts.mapInArrow(_mapper(bitmap, narrow), HITS)
    # each reading of a document meets all readings of an item: a placeholder may stand for a plain word's window only
    # by hash, so equal hashes are all that is asked
    met = hits.withColumnRenamed("reading", "doc_reading").join(known, "hash").select(
        "doc_id", "item_id", "doc_reading", "reading", "place", "item_place", "slots", "item_slots"
    ).where(F.size("slots") == F.size("item_slots"))
    met = _occurrences(stored(met.distinct(), "met"))
    pair = ["doc_id", "item_id"]
    here = [*pair, "kind", "occurrence"]
    # what each value of the item stands for in the occurrence, in most of the windows
    pairs = (
        met.select(*here, "item_place", "slots", F.explode(F.arrays_zip("item_slots", "slots")).alias("z"))
        .select(*here, "item_place", "slots", F.col("z.item_slots").alias("value"), F.col("z.slots").alias("stands"))
        .where("value <> 0")
    )
    votes = pairs.groupBy(*here, "value", "stands").agg(F.count("*").alias("n"))
    chosen = (
        votes.groupBy(*here, "value")
        .agg(F.max_by("stands", F.struct("n", "stands")).alias("chosen"))
    )
    against = (
        pairs.join(chosen, [*here, "value"])
        .groupBy(*here, "item_place", "slots")
        .agg(
            F.max((F.col("stands") != F.col("chosen")).cast("int")).alias("bad"),
            F.max((F.col("stands") != F.col("value")).cast("int")).alias("other"),
        )
    )
    as_template = F.when(F.col("reading") != LITERAL, F.col("item_place"))
    # a window without slots has nothing that could contradict
    good = (
        met.join(against, [*here, "item_place", "slots"], "left")
        .where("coalesce(bad, 0) = 0")
        .groupBy(*here)
        .agg(
            F.count_distinct("item_place").alias("n_windows"),
            F.count_distinct(as_template).alias("n_templates"),
            (F.max(F.coalesce("other", F.lit(0))) == 0).alias("exact"),
        )
    )
    wanted = known.groupBy("item_id").agg(
        F.count_distinct("item_place").alias("n_item_windows"), F.count_distinct(as_template).alias("n_item_templates")
    )
    enough = (F.col("n_windows") >= F.least(F.lit(least), "n_item_windows")) | (
        (F.col("n_templates") > 0) & (F.col("n_templates") >= F.least(F.lit(least), "n_item_templates"))
    )
    return (
        good.join(wanted, "item_id")
        .where(enough)
        .groupBy(*pair)
        .agg(F.max("n_windows").alias("n_windows"), F.first("n_item_windows").alias("n_item_windows"), F.bool_or("exact").alias("exact"))
    )


def _occurrences(met: DataFrame) -> DataFrame:
    """Each matched window with its occurrences (kind, occurrence): of its offset, of its run, and the whole document."""
    by_place = Window.partitionBy("doc_id", "item_id").orderBy("place", "item_place")
    ahead, item_ahead = F.col("place") - F.lag("place").over(by_place), F.col("item_place") - F.lag("item_place").over(by_place)
    breaks = (item_ahead < 0) | ((item_ahead == 0) & (ahead > 0)) | (ahead > item_ahead + 2 * WINDOW)
    run = F.sum("breaks").over(by_place.rowsBetween(Window.unboundedPreceding, 0))
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("occurrence")),
        F.struct(F.lit(1).alias("kind"), F.col("run").alias("occurrence")),
        F.struct(F.lit(2).alias("kind"), (F.col("place") - F.col("item_place")).cast("bigint").alias("occurrence")),
    )
    return (
        met.withColumn("breaks", F.coalesce(breaks.cast("int"), F.lit(0)))
        .withColumn("run", run)
        .withColumn("kinds", F.explode(kinds))
        .select(*met.columns, "kinds.kind", "kinds.occurrence")
    )

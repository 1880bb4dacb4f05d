"""Predictions wait, per place, for weather that can settle them.

Two tagged streams meet in one keyed state: the place's newest weather and the predictions
it could not settle. The scoring rules stay out of Python: both sides arrive with a bit mask
computed by Spark (``functions.outcomes``), the processor pairs rows whose masks overlap, and
the pairs are scored by the batch expressions.

State is typed and kept in *pages*: waiting predictions of a key are dealt to 2^k pages by the
hash of their market, a page being one map entry of column arrays. The key's head, one value,
holds its newest weather and an index: for each page how many rows wait, the OR of what
they need and the span of their times. Weather reads only pages that hold something it answers; expiry drops whole pages by the index. The number
of pages doubles as a key's waiting rows do.

A batch's rows of a key come in chunks of any size and order. Weather (a row for each poll of
a place) is collected; predictions are kept up to ``HELD`` rows, then written to spill pages
of the state. When the last chunk is read, one page after the other meets the sorted weather,
so a task holds one page, its spilled part and the batch's weather of one place. Results do
not depend on chunks, order, pages or salts.

Spark hands rows to a stateful Python operator cell by cell, and so its state. Rows therefore
travel in *packs*: before the exchange a task puts its rows of a key, up to ``PACKED`` bytes
at a time, into one row with an Arrow batch; pages are Arrow batches as well. Of a place's
polls at one instant only the last and the first of each mask can settle anything, so no
others are sent. A pack goes under its newest time; rows in it that the watermark at the
batch's start has passed are late and dropped.

A busy place is spread over ``salts`` keys: predictions hash to one of them, weather goes to
all. Rows without poll time or market id have no part in the join; NaN counts as null.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from foretell.functions.outcomes import needs_mask, settlement
from foretell.operators.scoring import correlate
from foretell.schemas import PREDICTION, WEATHER

TTL_HOURS = 24
SALTS = 4
#: Predictions of a key, and their bytes, that are held before they go to spill pages; rows a page is meant for.
HELD, HELD_BYTES = 100_000, 32 << 20
PAGE = 5_000
SPILL_PAGES = 64
#: Bytes of rows that a task packs at a time.
PACKED = 8 << 20
_HOUR_MS = 3_600_000
_NEVER = np.iinfo(np.int64).max

# weather rows travel with what they settle, worked out once per row
SETTLED_WEATHER = T.StructType(
    [
        *WEATHER.fields,
        T.StructField("answers", T.IntegerType()),
        T.StructField("occurs", T.IntegerType()),
        T.StructField("temp_f_in_c", T.DoubleType()),
    ]
)


def _carrier(kind: T.DataType) -> str:
    """Python gets strings and doubles only: pandas has no other nullable plain columns.

    Doubles hold dates, booleans and 32-bit integers exactly; 64-bit integers go as text."""
    return "string" if isinstance(kind, (T.StringType, T.LongType)) else "double"


def _slots(schema: T.StructType) -> dict[str, str]:
    """Field (nested ones as ``outer.inner``) -> the column that carries it: s0, s1, ... and d0, d1, ...

    Both kinds of rows use the same columns. The place, the times, the market's id and the mask
    have columns of their own.
    """
    out: dict[str, str] = {}
    own = ("location_name", "poll_ts", "condition_id", "answers")

    def add(fields, prefix=""):
        for field in fields:
            if isinstance(field.dataType, T.StructType):
                add(field.dataType.fields, f"{field.name}.")
            elif field.name not in own:
                letter = _carrier(field.dataType)[0]
                out[prefix + field.name] = letter + str(sum(slot[0] == letter for slot in out.values()))

    add(schema.fields)
    return out


P_SLOTS, W_SLOTS = _slots(PREDICTION), _slots(SETTLED_WEATHER)
_P, _W = list(P_SLOTS.values()), list(W_SLOTS.values())
_SLOTS = sorted({*_P, *_W})
_KIND = {"s": "string", "d": "double"}


def _packed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif isinstance(kind, T.BooleanType):
        value = value.cast("int")
    return value.cast(_carrier(kind))


def _unpacked(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(value.cast("int"))
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("boolean")
    return value.cast(kind)


_WAITING = ["id", "h", "at", "mask", *_P]
_PAGE_TYPES = {"id": "string", "h": "bigint", "at": "bigint", "mask": "bigint"} | {c: _KIND[c[0]] for c in _P}
_OFFER = ["at", "mask", *_W]
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}
_POLLS = pa.schema([(c, _ARROW[kind]) for c, kind in _PAGE_TYPES.items()])
_OFFERS = pa.schema([("at", pa.int64()), ("mask", pa.int64()), *((c, _ARROW[_KIND[c[0]]]) for c in _W)])
#: A page: the times, and the other columns of its rows as an Arrow batch.
_PAGE_SCHEMA = "at array<bigint>, rows binary"
_PAGE = pa.schema([field for field in _POLLS if field.name != "at"])
_PACK = "location_name string, salt int, kind int, newest bigint, rows binary"
_OUT = ", ".join(
    ["location_name string", "id string", "p_at bigint", "w_at bigint", "w_mask bigint"]
    + [f"p_{c} {_KIND[c[0]]}" for c in _P]
    + [f"w_{c} {_KIND[c[0]]}" for c in _W]
)
#: A key's newest weather, the timer set last, and the index over its pages.
_HEAD_SCHEMA = ", ".join(
    ["at bigint", "mask bigint", *(f"{c} {_KIND[c[0]]}" for c in _W), "timer bigint"]
    + [f"{c} array<bigint>" for c in ("n", "wanted", "oldest", "newest")]
)


class Pages:
    """Waiting predictions of a key: pages by market hash, and the index over them."""

    def __init__(self, index, states) -> None:
        self.states = states
        empty = [0], [0], [_NEVER], [0]
        self.count, self.wanted, self.oldest, self.newest = map(list, index if index else empty)

    def __len__(self) -> int:
        return len(self.count)

    def read(self, page: int) -> pd.DataFrame:
        return _frame(self.states.getValue((0, page))) if self.count[page] else _frame()

    def write(self, page: int, rows: pd.DataFrame) -> None:
        had = bool(self.count[page])
        self.count[page] = len(rows)
        if len(rows):
            self.states.updateValue((0, page), _row(pa.Table.from_pandas(rows[_WAITING], _POLLS, preserve_index=False)))
            self.wanted[page] = int(np.bitwise_or.reduce(rows["mask"].to_numpy()))
            self.oldest[page], self.newest[page] = int(rows["at"].min()), int(rows["at"].max())
        else:
            self.wanted[page], self.oldest[page], self.newest[page] = 0, _NEVER, 0
            if had:
                self.states.removeKey((0, page))

    def grow(self, size: int) -> None:
        """More pages; page p's rows then belong to p, p + old size, p + 2 * old size, ..."""
        more = size - len(self)
        self.count += [0] * more
        self.wanted += [0] * more
        self.oldest += [_NEVER] * more
        self.newest += [0] * more

    def index(self) -> tuple:
        return self.count, self.wanted, self.oldest, self.newest

    def expire(self, horizon: int) -> None:
        for page, rows in enumerate(self.count):
            if rows and self.newest[page] < horizon:
                self.write(page, _frame())
            elif rows and self.oldest[page] < horizon:
                kept = self.read(page)
                self.write(page, kept[kept["at"] >= horizon])


def _bytes(rows: pa.Table) -> bytes:
    return rows.combine_chunks().to_batches()[0].serialize().to_pybytes()


def _table(packed: bytes, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(packed), schema)])


def _frame(*pages) -> pd.DataFrame:
    """The rows of some pages; an absent page has none."""
    pages = [page for page in pages if page is not None]
    rows = pa.concat_tables([_PAGE.empty_table(), *(_table(page[1], _PAGE) for page in pages)])
    times = [np.asarray(page[0], np.int64) for page in pages]
    out = _plain(rows)
    out["at"] = np.concatenate(times) if times else np.empty(0, np.int64)
    return out[_WAITING]


def _plain(rows: pa.Table) -> pd.DataFrame:
    """Strings as objects, whatever this version of pandas would make of them."""
    return pd.DataFrame({c: pd.Series(rows[c].to_numpy(), dtype=_NUMPY[rows.schema.field(c).type]) for c in rows.column_names})


_NUMPY = {pa.string(): object, pa.int64(): np.int64, pa.float64(): np.float64}


def _row(rows: pa.Table) -> tuple:
    return array("l", rows["at"].to_numpy().tobytes()), _bytes(rows.select(_PAGE.names))


def _telling(weather: pa.Table) -> pa.Table:
    """In order of time; of the polls of one instant the last one and the first of each mask."""
    weather = weather.sort_by([("at", "ascending"), (W_SLOTS["obs_id"], "ascending")])
    rows = pd.DataFrame({c: weather[c].to_numpy() for c in ("at", "mask")})
    last = rows["at"].ne(rows["at"].shift(-1))
    return weather.filter(pa.array((last | ~rows.duplicated()).to_numpy()))


def _packs(rows: pa.Table, kind: int) -> Iterator[pa.RecordBatch]:
    """A pack for each key of the rows."""
    place, salt = rows["location_name"].combine_chunks().dictionary_encode(), rows["salt"].to_numpy().astype(np.int64)
    key = place.indices.to_numpy() * (salt.max() + 1) + salt
    order = np.argsort(key, kind="stable")
    rows, key = rows.take(order), key[order]
    cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
    out = []
    for start, stop in zip(cuts, cuts[1:]):
        part = rows.slice(start, stop - start)
        own = part.select(_POLLS.names) if kind else _telling(part.select(_OFFERS.names))
        packed = _bytes(own)
        newest = int(own["at"].to_numpy().max())
        out.append((part["location_name"][0].as_py(), part["salt"][0].as_py(), kind, newest, packed))
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    names = [c.split()[0] for c in _PACK.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _packed_rows(df: DataFrame, kind: int, lateness: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size > PACKED:
                yield from _packs(pa.Table.from_batches(held), kind)
                held, size = [], 0
        if held:
            yield from _packs(pa.Table.from_batches(held), kind)

    packs = df.mapInArrow(run, _PACK)
    return packs.withColumn("poll_ts", F.timestamp_micros("newest")).withWatermark("poll_ts", lateness)


def _in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """By time and market; polls of a market at one instant by what they say, so that chunks do not matter."""
    keys = ["at", "id"]
    return rows.sort_values([*keys, *_P] if rows.duplicated(keys).any() else keys, kind="stable")


def settle(stored: pd.DataFrame, fresh: pd.DataFrame, weather: pd.DataFrame, latest: tuple | None, ttl: int):
    """Pairs (rows, places in ``weather``; -1 for ``latest``) and the rows that go on waiting.

    ``weather`` is sorted by time, ``latest`` is (mask, at) of the newest one before it.
    ``stored`` rows wait since an earlier batch. A fresh row first meets the newest weather
    at its own time, else it waits: the first later weather that answers it settles it, unless
    a newer poll of its market has taken its place by then.
    """
    rows = pd.concat([stored, _in_order(fresh)], ignore_index=True)
    at, mask = rows["at"].to_numpy(), rows["mask"].to_numpy()
    when, answers = weather["at"].to_numpy(), weather["mask"].to_numpy()
    seen = np.searchsorted(when, at, side="right") - 1
    seen[: len(stored)] = -1
    before = latest if latest is not None else (0, 0)
    now_mask = np.where(seen >= 0, answers[seen] if len(weather) else 0, before[0])
    now_at = np.where(seen >= 0, when[seen] if len(weather) else 0, before[1])
    at_once = (now_mask & mask != 0) & (now_at >= at - ttl)
    at_once[: len(stored)] = False
    # first later weather by the one bit that a row needs
    later = np.full(len(rows), len(weather), dtype=np.int64)
    for bit in np.unique(mask[~at_once]).tolist() if len(weather) else ():
        hits = np.append(np.flatnonzero(answers & bit), len(weather))
        mine = mask == bit
        later[mine] = hits[np.searchsorted(hits[:-1], seen[mine] + 1)]
    found = later < len(weather)
    found[found] = when[later[found]] <= at[found] + ttl
    later[~found] = len(weather)
    waits = np.flatnonzero(~at_once)
    # a market's newer waiting poll replaces the older one, unless that was settled before
    order = waits[np.argsort(pd.factorize(rows["id"].to_numpy()[waits])[0], kind="stable")]
    same = rows["id"].to_numpy()[order[:-1]] == rows["id"].to_numpy()[order[1:]]
    replaced = np.zeros(len(rows), dtype=bool)
    replaced[order[:-1][same & (later[order[:-1]] > seen[order[1:]])]] = True
    paired = at_once | (found & ~replaced)
    place = np.where(at_once, seen, later)[paired]
    newest = when[-1] if len(weather) else before[1]
    # what nothing can settle has only taken the place of its market's older poll
    kept = ~paired & ~replaced & (mask != 0) & (at >= newest - ttl)
    return rows[paired], place, rows[kept]


class PendingJoin(StatefulProcessor):
    """State per (place, salt); waiting rows expire ``ttl_hours`` of event time after their poll."""

    def __init__(self, ttl_hours: int) -> None:
        self.ttl = ttl_hours * _HOUR_MS * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", _HEAD_SCHEMA)
        # kind 0: waiting, 1: spilled rows of the batch at hand
        self.pages = handle.getMapState("pages", "kind int, page bigint", _PAGE_SCHEMA)

    def _read(self) -> tuple[tuple | None, int, Pages]:
        """Newest weather, timer and pages, in one call to the state store."""
        head = self.head.get()
        if head is None:
            return None, 0, Pages(None, self.pages)
        head = tuple(head)
        size = len(_OFFER)
        return (head[:size] if head[0] is not None else None), head[size], Pages(head[size + 1 :], self.pages)

    def _write(self, latest: tuple | None, timer: int, pages: Pages) -> None:
        if latest is None and not any(pages.count):
            self.head.clear()
        else:
            self.head.update((*(latest or (None,) * len(_OFFER)), timer, *pages.index()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        latest, timer, pages = self._read()
        spills = max(SPILL_PAGES, 2 * len(pages))
        held, offers, parts, total, newest = [], [], {}, 0, 0
        for kind, chunk in self._sides(rows, timerValues):
            if not len(chunk):
                continue
            newest = max(newest, int(chunk["at"].to_numpy().max()))
            if not kind:
                offers.append(chunk)
                continue
            held.append(chunk)
            total += len(chunk)
            if sum(map(len, held)) > HELD or sum(part.nbytes for part in held) > HELD_BYTES:
                self._spill(held, spills, parts)
                held = []
        if not (offers or total):
            return
        if parts and held:
            self._spill(held, spills, parts)
            held = []
        fresh = pa.concat_tables([_POLLS.empty_table(), *held]).combine_chunks()
        observed = _telling(pa.concat_tables([_OFFERS.empty_table(), *offers]))
        weather = pd.DataFrame({c: observed[c].to_numpy() for c in ("at", "mask")})
        for survivors, stored, new in self._parts(pages, fresh, parts, spills, total, weather):
            paired, place, kept = settle(stored, new, weather, latest and (latest[1], latest[0]), self.ttl)
            survivors.append(kept)
            if len(paired):
                yield self._pairs(key[0], paired, place, observed, latest)
        if len(weather):
            last = observed.slice(len(weather) - 1).to_pylist()[0]
            latest = tuple(None if pd.isna(last[c]) else last[c] for c in _OFFER)
        # whole hours, so that repeated batches share one timer
        due = ((newest + self.ttl) // 1000 // _HOUR_MS + 1) * _HOUR_MS
        if due != timer:
            self.handle.registerTimer(due)
        self._write(latest, due, pages)

    def _sides(self, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[tuple[int, pa.Table]]:
        """Rows of one kind: weather (0) or predictions (1)."""
        for chunk in rows:
            asks = chunk["kind"].to_numpy() == 1
            yield 0, pa.Table.from_pandas(chunk.loc[~asks, _OFFER], _OFFERS, preserve_index=False)
            yield 1, pa.Table.from_pandas(chunk.loc[asks, _WAITING], _POLLS, preserve_index=False)

    def _spill(self, held: list[pd.DataFrame], spills: int, parts: dict[int, list[int]]) -> None:
        """Rows to spill pages by hash; ``parts`` lists the entries of each page."""
        rows = pa.concat_tables(held).combine_chunks()
        page = rows["h"].to_numpy() % spills
        order = np.argsort(page, kind="stable")
        rows, page = rows.take(order), page[order]
        cuts = [0, *(np.flatnonzero(np.diff(page)) + 1).tolist(), len(page)]
        for start, stop in zip(cuts, cuts[1:]):
            entries = parts.setdefault(int(page[start]), [])
            entries.append(int(page[start]) + spills * len(entries))
            self.pages.updateValue((1, entries[-1]), _row(rows.slice(start, stop - start)))

    def _unspill(self, entries: list[int]) -> pd.DataFrame:
        found = []
        for entry in entries:
            found.append(self.pages.getValue((1, entry)))
            self.pages.removeKey((1, entry))
        return _frame(*found)

    def _parts(self, pages: Pages, fresh, parts, spills, total, weather):
        """(list for survivors, waiting rows, new rows) for all that this batch touches; writes pages."""
        answers = int(np.bitwise_or.reduce(weather["mask"].to_numpy())) if len(weather) else 0
        old = len(pages)
        size = old
        while size < spills and size * PAGE < sum(pages.count) + total:
            size *= 2
        pages.grow(size)
        spilled = bool(parts)
        mine = fresh["h"].to_numpy() % size if not spilled else None
        for page in range(old):
            touched = [p for p in range(page, size, old)]
            has_new = any(map(len, (parts.get(s, ()) for s in range(page, spills, old)))) if spilled else bool(
                np.isin(mine, touched).any()
            )
            if not has_new and not (pages.wanted[page] & answers) and size == old:
                continue
            waiting = pages.read(page)
            for target in touched:
                survivors: list[pd.DataFrame] = []
                # each of these holds a page's spilled rows of one hash, which no other one has
                units = range(target, spills, size) if spilled else (target,)
                modulus = spills if spilled else size
                for unit in units:
                    own = waiting[waiting["h"].to_numpy() % modulus == unit]
                    new = self._unspill(parts.get(unit, [])) if spilled else _plain(fresh.filter(pa.array(mine == target)))
                    if len(own) or len(new):
                        yield survivors, own, new
                rows = [s for s in survivors if len(s)]
                pages.write(target, pd.concat(rows, ignore_index=True) if rows else _frame())

    @staticmethod
    def _pairs(place_name, paired, place, weather, latest) -> pd.DataFrame:
        out = {"location_name": place_name, "id": paired["id"].to_numpy(), "p_at": paired["at"].to_numpy()}
        old = place < 0
        offers = {}
        for n, column in enumerate(_OFFER):
            kind = _NUMPY[_OFFERS.field(column).type]
            # the newest weather of earlier batches is not in this batch's table
            values = np.full(len(place), latest[n] if old.any() else None, object if kind is object else np.float64)
            if column in ("at", "mask"):
                values = np.full(len(place), latest[n] if old.any() else 0, np.int64)
            if not old.all():
                values[~old] = weather[column].take(pa.array(place[~old])).to_numpy()
            offers[column] = values
        out |= {"w_at": offers["at"], "w_mask": offers["mask"]}
        out |= {f"p_{c}": paired[c].to_numpy() for c in _P}
        out |= {f"w_{c}": offers[c] for c in _W}
        return pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        horizon = timerValues.getCurrentWatermarkInMs() * 1000 - self.ttl
        latest, timer, pages = self._read()
        pages.expire(horizon)
        if latest is not None and not any(pages.count) and latest[0] < horizon:
            latest = None
        self._write(latest, timer, pages)
        return iter(())

    def close(self) -> None:
        pass


class PackedJoin(PendingJoin):
    """The same over packs."""

    def _sides(self, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[tuple[int, pa.Table]]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for chunk in rows:
            for kind, packed in zip(chunk["kind"], chunk["rows"]):
                table = _table(packed, _POLLS if kind else _OFFERS)
                at = table["at"].to_numpy()
                if at.min() <= passed:
                    table = table.filter(pa.array(at > passed))
                yield kind, table


def _kinds(schema: T.StructType, prefix: str = "") -> dict[str, T.DataType]:
    out: dict[str, T.DataType] = {}
    for field in schema.fields:
        inner = field.dataType
        out |= _kinds(inner, f"{field.name}.") if isinstance(inner, T.StructType) else {prefix + field.name: inner}
    return out


def _tagged(df: DataFrame, id_col: Column, mask: Column, slots: dict[str, str], schema: T.StructType, names: list[str], salt) -> DataFrame:
    kinds = _kinds(schema)
    carried = {slot: _packed(F.col(field), kinds[field]) for field, slot in slots.items()}
    tagged = df.where("poll_ts is not null").select(
        F.coalesce("location_name", F.lit("unknown")).alias("location_name"),
        id_col.alias("id"),
        F.abs(F.xxhash64(id_col) % F.lit(1 << 40)).alias("h"),
        F.coalesce(mask, F.lit(0)).cast("bigint").alias("mask"),
        F.unix_micros(F.col("poll_ts")).alias("at"),
        *(column.alias(slot) for slot, column in carried.items()),
    )
    return tagged.select("location_name", F.coalesce(salt.cast("int"), F.lit(0)).alias("salt"), *names)


def _record(schema: T.StructType, prefix: str, slots: dict[str, str], outer: str = "") -> list[Column]:
    """The columns of a record from what the processor passed on."""
    own = {"location_name": "location_name", "condition_id": "id", "answers": "w_mask"}
    out = []
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            value = F.struct(*_record(field.dataType, prefix, slots, f"{field.name}."))
        elif field.name == "poll_ts":
            value = F.timestamp_micros(f"{prefix}at")
        else:
            column = own.get(field.name) or prefix + slots[outer + field.name]
            value = _unpacked(F.col(column), field.dataType)
        out.append(value.alias(field.name))
    return out


def stream_pending_join(
    predictions: DataFrame,
    weather: DataFrame,
    ttl_hours: int = TTL_HOURS,
    salts: int | Column = SALTS,
    lateness: str | None = None,
) -> DataFrame:
    """Correlation stream. Rows later than ``lateness`` (default: the state's life
    time) are dropped; a keyed join has no use for them, its state has expired.

    ``salts`` may be a column over ``location_name``: many for busy places, one for others.
    """
    lateness = lateness or f"{ttl_hours} hours"
    spread = F.lit(salts) if isinstance(salts, int) else salts
    asks = _tagged(
        predictions.where("condition_id is not null"),
        F.col("condition_id").cast("string"),
        needs_mask(F.col("market_type"), F.col("closed"), F.col("winner"), F.col("threshold")),
        P_SLOTS,
        PREDICTION,
        _POLLS.names,
        # the low bits of the hash deal rows to pages
        F.pmod(F.shiftright("h", 24), spread),
    )
    ruled = weather.withColumns(settlement(weather))
    none = F.lit(None).cast("string")
    offers = _tagged(ruled, none, F.col("answers"), W_SLOTS, SETTLED_WEATHER, _OFFERS.names, F.lit(0))
    # a place's packs go to all its salts
    copies = F.explode(F.sequence(F.lit(0), spread.cast("int") - 1))
    pairs = (
        _packed_rows(asks, 1, lateness)
        .unionByName(_packed_rows(offers, 0, lateness).withColumn("salt", copies))
        .groupBy("location_name", "salt")
        .transformWithStateInPandas(
            statefulProcessor=PackedJoin(ttl_hours),
            outputStructType=_OUT,
            outputMode="append",
            timeMode="eventTime",
        )
    )
    settled = F.struct(*_record(SETTLED_WEATHER, "w_", W_SLOTS)).alias("w")
    return correlate(pairs.select(*_record(PREDICTION, "p_", P_SLOTS), settled))

"""The pending join's processor against a replay in event order, with a stand-in for the state store."""

from __future__ import annotations

import pickle
import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from foretell.streaming import pending_join as J

HOUR = 3_600_000_000


class State:
    """Value and map state in memory; counts what goes through it."""

    def __init__(self):
        self.values, self.reads, self.writes = {}, 0, 0

    def get(self):
        return self.values.get(None)

    def update(self, value):
        self.values[None] = value

    def clear(self):
        self.values.clear()

    def getValue(self, key):
        self.reads += 1
        return self.values[key]

    def updateValue(self, key, value):
        self.writes += 1
        self.values[key] = value

    def containsKey(self, key):
        return key in self.values

    def removeKey(self, key):
        del self.values[key]


class Files(State):
    """Map state outside the process."""

    def __init__(self, folder):
        super().__init__()
        self.folder = folder

    def getValue(self, key):
        return pickle.loads(self.values[key].read_bytes())

    def updateValue(self, key, value):
        self.values[key] = self.folder / "-".join(map(str, key))
        self.values[key].write_bytes(pickle.dumps(value))


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, schema):
        return self.states.setdefault(name, State())

    def getMapState(self, name, key_schema, schema):
        return self.getValueState(name, schema)

    def registerTimer(self, at):
        self.timers.add(at)


class Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at // 1000


def processor(ttl=24):
    join, handle = J.PendingJoin(ttl), Handle()
    join.init(handle)
    return join, handle


def frame(rows):
    """Rows of (kind, id, at, mask); the poll's own number travels in a payload column."""
    out = pd.DataFrame(rows, columns=["kind", "id", "at", "mask"])
    out["h"] = [zlib.crc32(str(i).encode()) for i in out["id"]]
    for column in J._SLOTS:
        out[column] = pd.Series([None] * len(out), dtype=object if column[0] == "s" else np.float64)
    polls = out["kind"] == 1
    out[J.P_SLOTS["price"]] = out["at"].astype(float).where(polls)
    out[J.W_SLOTS["obs_id"]] = out["at"].astype(str).where(~polls, None)
    return out


def replay(batches, ttl):
    """Pairs (market, weather time), batch by batch in event order."""
    latest, waiting, out = None, {}, []
    for rows in batches:
        for kind, id_, at, mask in sorted(rows, key=lambda r: (r[2], r[0], r[1] or "")):
            if kind == 1:
                if latest and latest[0] & mask and latest[1] >= at - ttl:
                    out.append((id_, at, latest[1]))
                else:
                    waiting[id_] = (at, mask)
            else:
                latest = (mask, at)
                for i, (polled, need) in list(waiting.items()):
                    if polled >= at - ttl and need & mask:
                        out.append((i, polled, at))
                        del waiting[i]
        newest = latest[1] if latest else 0
        waiting = {i: e for i, e in waiting.items() if e[0] >= newest - ttl and e[1]}
    return sorted(out)


def waiting(handle):
    """Waiting rows by page."""
    return handle.states["head"].get()[len(J._OFFER) + 1]


def run(join, batches, size):
    out = []
    for rows in batches:
        whole = frame(rows)
        chunks = (whole.iloc[i : i + size] for i in range(0, len(whole), size))
        for found in join.handleInputRows(("Oslo",), chunks, None):
            out += zip(found["id"], found["p_at"], found["w_at"])
            assert (found["w_" + J.W_SLOTS["obs_id"]] == found["w_at"].astype(str)).all()
            assert (found["p_" + J.P_SLOTS["price"]] == found["p_at"]).all() and (found["location_name"] == "Oslo").all()
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_join_equals_a_replay_for_any_chunk_and_page(monkeypatch, seed, size):
    rng = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(J, "HELD", 5)
        monkeypatch.setattr(J, "PAGE", 2)
        monkeypatch.setattr(J, "SPILL_PAGES", 8)
    batches = []
    for day in range(5):
        times = rng.sample(range(day * 30 * 3600, (day + 2) * 30 * 3600), 40)
        rows = []
        for n, at in enumerate(times):
            if n % 4:
                rows.append((1, f"m{rng.randrange(12)}", at * 1_000_000, rng.choice([0, 1, 2, 4])))
            else:
                rows.append((0, None, at * 1_000_000, rng.choice([0, 1, 2, 3, 8])))
        batches.append(rows)
    join, _ = processor()
    assert run(join, batches, size) == replay(batches, 24 * HOUR)


def test_weather_reads_only_pages_it_answers(monkeypatch):
    monkeypatch.setattr(J, "PAGE", 10)
    join, handle = processor()
    run(join, [[(1, f"m{i}", HOUR + i, 2) for i in range(200)]], 50)
    pages = handle.states["pages"]
    counts = waiting(handle)
    assert len(counts) > 10 and sum(counts) == 200
    pages.reads = 0
    assert run(join, [[(0, None, 2 * HOUR, 1)]], 50) == [] and pages.reads == 0
    assert len(run(join, [[(0, None, 3 * HOUR, 2)]], 50)) == 200
    assert not pages.values and not any(waiting(handle))


def test_expiry_drops_whole_pages_by_the_index():
    join, handle = processor(ttl=1)
    run(join, [[(1, "old", HOUR, 1), (1, "young", 5 * HOUR, 1)], [(0, None, HOUR // 2, 8)]], 10)
    assert min(handle.timers) % 3_600_000 == 0
    list(join.handleExpiredTimer(("Oslo",), Clock(6 * HOUR), None))
    assert waiting(handle) == [1] and handle.states["head"].get()[0] == HOUR // 2
    reads = handle.states["pages"].reads
    list(join.handleExpiredTimer(("Oslo",), Clock(7 * HOUR), None))
    assert not handle.states["pages"].values and handle.states["head"].get() is None
    assert handle.states["pages"].reads == reads


def test_a_place_with_many_rows_stays_within_its_memory(tmp_path):
    """200 000 polls of one place in a batch: a task holds the rows of a page, not of the place."""
    join, handle = processor()
    join.pages = handle.states["pages"] = Files(tmp_path)

    def chunks():
        for start in range(0, 200_000, 10_000):
            yield frame([(1, f"market-{i}", HOUR + i * 1000, 1 + i % 2) for i in range(start, start + 10_000)])
        yield frame([(0, None, 2 * HOUR, 1), (0, None, HOUR // 2, 4)])

    tracemalloc.start()
    found = sum(map(len, join.handleInputRows(("Oslo",), chunks(), None)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    left = [len(join.pages.getValue(key)[0]) for key in join.pages.values]
    assert (found, sum(left)) == (100_000, 100_000) and max(left) <= 2 * J.PAGE
    # all rows at once take more than 200 MB here
    assert peak < 90e6


class Now:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark // 1000


def packed(rows, kind, places=("Oslo",)):
    """Packs of the rows as a task sends them, for each place."""
    names = J._POLLS.names if kind else J._OFFERS.names
    whole = frame(rows)[names]
    tables = []
    for place in places:
        one = pa.Table.from_pandas(whole, J._POLLS if kind else J._OFFERS, preserve_index=False)
        tables.append(one.append_column("location_name", pa.array([place] * len(rows))).append_column("salt", pa.array([0] * len(rows), pa.int32())))
    batches = list(J._packs(pa.concat_tables(tables), kind))
    return pa.Table.from_batches(batches).to_pandas()


def test_packs_carry_a_keys_rows_in_one_and_join_like_rows():
    rng = random.Random(3)
    polls = [(1, f"m{rng.randrange(900)}", rng.randrange(1, 30) * HOUR + n, rng.choice([1, 2, 4])) for n in range(2000)]
    weather = [(0, None, rng.randrange(1, 30) * HOUR, rng.choice([1, 3, 8])) for _ in range(40)]
    sent = packed(polls, 1, ("Oslo", "Rome"))
    assert list(sent["location_name"]) == ["Oslo", "Rome"] and sent["newest"][0] == max(p[2] for p in polls)
    join, handle = J.PackedJoin(24), Handle()
    join.init(handle)
    chunk = pd.concat([sent[:1], packed(weather, 0)])
    out = [pair for found in join.handleInputRows(("Oslo",), iter([chunk]), Now(0)) for pair in zip(found["id"], found["p_at"], found["w_at"])]
    plain, _ = processor()
    assert sorted(out) == run(plain, [polls + weather], 100)


def test_of_one_instant_the_last_poll_and_the_first_of_each_mask_are_sent():
    # 300 polls of one instant: all of them went to every salt before
    weather = [(0, None, HOUR, 1 + n % 2) for n in range(300)] + [(0, None, 2 * HOUR, 4)]
    sent = packed(weather, 0)
    kept = J._table(sent["rows"][0], J._OFFERS)
    assert len(sent) == 1 and kept["mask"].to_pylist() == [1, 2, 2, 4]


def test_rows_the_watermark_has_passed_are_dropped_from_their_pack():
    join, handle = J.PackedJoin(24), Handle()
    join.init(handle)
    chunk = pd.concat([packed([(1, "late", 5 * HOUR, 1), (1, "due", 6 * HOUR, 1)], 1), packed([(0, None, 7 * HOUR, 1)], 0)])
    assert [list(found["id"]) for found in join.handleInputRows(("Oslo",), iter([chunk]), Now(5 * HOUR))] == [["due"]]
    assert list(join.handleInputRows(("Oslo",), iter([packed([(1, "late", HOUR, 1)], 1)]), Now(5 * HOUR))) == []


def test_a_pages_cells_do_not_pass_through_the_state_one_by_one():
    join, handle = processor()
    run(join, [[(1, f"m{i}", HOUR + i, 2) for i in range(200)]], 50)
    ((times, rows),) = handle.states["pages"].values.values()
    assert len(times) == 200 and isinstance(rows, bytes)

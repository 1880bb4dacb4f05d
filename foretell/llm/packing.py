"""Training rows of equal length, packed by best-fit decreasing.

A task encodes the documents of its part of the table and packs them window by window
(``window`` tokens, so memory is bounded whatever a part holds); no document is shuffled.
The words of a slice of texts are cut out of its bytes, each distinct one is looked up once,
and the library sees only those not remembered.
In a window the pieces go from the longest to the shortest, each into the open row with
the least room that still holds it. A segment tree over the room left finds that row.
A document longer than a row is cut into full rows and a rest, without loss: piece ``k``
of a document says at which of its tokens it starts.

Result, one row for each packed row: ``shard`` (part of the table) and ``row`` in it,
``n_tokens``, ``ids`` (binary: ``row_length`` little-endian unsigned integers of
``id_bytes`` bytes, filled up with ``pad``), ``cu_seqlens`` (0 and the end of each segment),
``position_resets`` (where positions start at 0 again), ``doc_ids`` and ``starts`` (for each
segment its document and the number of its first token there). Stacked, the rows of a shard
are its id matrix.

Cases: with ``eos`` every document, the empty and the null one too, has at least that token;
without it, a document without tokens has no segment. Repeated rows are packed each time; a
null id stays null in doc_ids. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from foretell.llm.common import slices, texts_of
from foretell.llm.vocabulary import LONG, SPLIT, Memo

#: Bytes of words whose ids a Python worker remembers.
REMEMBERED = 80 << 20
#: Bytes of text encoded at a time, or one text if it is longer; about as many characters go to the library at a time.
SLICE, CHARACTERS = 1 << 23, 1 << 14
# what a byte may be: blank, part of a letter, digit, other sign, or part of what only the library cuts.
# Of the letters above ASCII those from À to ſ are cut here: NFC leaves them as they are, and lower()
# makes one of one. (× and ÷ are none, and İ becomes two.)
_BLANK, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[9, 10, 11, 12, 13, 32]] = _BLANK
_KIND[48:58] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]*")
SCHEMA = (
    "shard int, row bigint, n_tokens int, id_bytes int, ids binary, cu_seqlens array<int>, "
    "position_resets array<int>, doc_ids array<bigint>, starts array<bigint>"
)


class RoomTree:
    """Open rows by the room they have left; finds the least room that is enough."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.filled = bytearray(2 * self.size)  # a node: whether an open row lies below it
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.size + room
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) with the least room of at least ``least``; the row is taken out."""
        node = self.size + least
        if not self.filled[node]:
            # up to the first subtree on the right that has a row, then down on its left
            while node > 1 and not (node % 2 == 0 and self.filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.filled[2 * node] else 2 * node + 1
        room = node - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.filled[node] = 0
            node >>= 1
            while node and not (self.filled[2 * node] or self.filled[2 * node + 1]):
                self.filled[node] = 0
                node >>= 1
        return room, row


def best_fit(lengths: list[int], row_length: int) -> list[list[int]]:
    """Rows of piece numbers; every piece is in one row and no row is longer than allowed."""
    tree, rows = RoomTree(row_length), []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[piece]
        found = tree.take(size)
        if found:
            room, row = found
            rows[row].append(piece)
        else:
            room, row = row_length, len(rows)
            rows.append([piece])
        if room > size:
            tree.put(room - size, row)
    return rows


class LibraryEncoder:
    """Ids of whole texts by the library, which sees each word once while remembered.

    Nothing in the vocabulary reaches over an ASCII blank. Runs between blanks are cut into
    words by the vocabulary's own pattern, spelled for bytes, if they have only ASCII signs and
    the letters from À to ſ; new words go to the library many at a time, and the tokens that
    end a word tell them apart. Other runs, those with a special string, and all of a vocabulary
    with other rules stay whole: the library cuts them, and the place of a token tells its run.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.id_bytes = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.id_bytes}")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix, names = spec["model"].get("end_of_word_suffix"), self.library.get_vocab()
        self.by_words = bool(suffix) and _splits_as_here(spec)
        self.is_end = np.zeros(max(names.values()) + 1, dtype=bool)
        if suffix:
            self.is_end[[i for name, i in names.items() if name.endswith(suffix)]] = True
        special = "|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)"
        self.special, self.special_bytes = re.compile(special), re.compile(special.encode())
        self.known = Memo(self._one, REMEMBERED)

    def _one(self, run: str) -> bytes:
        return np.array(self.library.encode(run, add_special_tokens=False).ids, self.dtype).tobytes()

    def _by_place(self, runs: list[str]) -> list[bytes]:
        found = self.library.encode(" ".join(runs), add_special_tokens=False)
        ids = np.array(found.ids, self.dtype)
        places = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids))
        starts = np.cumsum([0] + [len(run) + 1 for run in runs])
        cuts = (np.searchsorted(places, starts) * self.id_bytes).tolist()
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip(cuts, cuts[1:])]

    def _by_end(self, words: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(found.ids, self.dtype)
        cuts = ((np.flatnonzero(self.is_end[ids]) + 1) * self.id_bytes).tolist()
        if len(cuts) != len(words):  # the vocabulary lacks a word's last symbol
            return list(map(self._one, words))
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip([0] + cuts, cuts)]

    def _is_word(self, text: str) -> bool:
        return self.by_words and bool(_PLAIN.fullmatch(text)) and not self.special.search(text)

    def _learn(self, units: list[str]) -> list[bytes]:
        """Ids of words and runs not seen before."""
        out = []
        parts = np.cumsum([len(unit) + 1 for unit in units]) // CHARACTERS
        cuts = [0, *(np.flatnonzero(parts[1:] > parts[:-1]) + 1).tolist(), len(units)]
        for a, b in zip(cuts, cuts[1:]):
            some = units[a:b]
            if self._is_word("".join(some)):
                out += self._by_end(some)
                continue
            found = {unit: self._one(unit) if len(unit) >= LONG else None for unit in some}
            words = [unit for unit in some if found[unit] is None and self._is_word(unit)]
            found.update(zip(words, self._by_end(words)))
            runs = [unit for unit in some if found[unit] is None]
            found.update(zip(runs, self._by_place(runs)))
            out += found.values()
        return out

    def units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words and uncut runs of all texts, and how many there are before each text, at last of all.

        In words A-Z are lower-case; whatever else the library does to a text it does to its units.
        """
        texts = texts.cast(pa.large_binary())
        _, ends, body = texts.buffers()
        ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        body = np.frombuffer(body or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        data = np.insert(body, ends, 32)  # a blank before each text and after the last
        kind = _KIND[data]
        solid = kind != _BLANK
        runs = np.flatnonzero(solid[1:] > solid[:-1]) + 1
        if self.by_words:
            data, first = self._words(data, kind, runs, np.flatnonzero(solid[:-1] > solid[1:]) + 1)
        else:
            first = np.zeros(len(data), bool)
            first[runs] = True
        starts = np.append(np.flatnonzero(first[solid]), np.count_nonzero(solid))
        units = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data[solid]))
        return units, np.searchsorted(np.flatnonzero(first), ends + np.arange(len(ends)))

    def _words(
        self, data: np.ndarray, kind: np.ndarray, runs: np.ndarray, run_ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The bytes with A-Z lower-case, and which of them begin a word or an uncut run."""
        low = _LOWER[data]
        first = np.zeros(len(data), bool)
        first[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & (kind[1:] != _BLANK)
        # 's, 't, 'm, 'd, 're, 've, 'll where no sign goes before: signs take the mark along
        marks = np.flatnonzero(data == ord("'"))
        marks = marks[kind[marks - 1] != _SIGN]
        one, two = low[marks + 1], low[np.minimum(marks + 2, len(low) - 1)]
        short = np.isin(one, list(b"stmd"))
        long = (np.isin(one, list(b"rv")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        first[marks[short | long] + 1] = False
        after = np.concatenate((marks[short] + 2, marks[long] + 3))
        first[after] = kind[after] != _BLANK
        odd = kind == _ODD
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        odd[1:] |= (data[:-1] == 0xC4) & (data[1:] == 0xB0)
        odd[[m.start() for m in self.special_bytes.finditer(data)]] = True
        if odd.any():
            uncut = np.flatnonzero(np.logical_or.reduceat(odd, runs))
            step = np.zeros(len(data), np.int8)
            step[runs[uncut]] = 1
            step[run_ends[uncut]] = -1
            inside = np.cumsum(step, dtype=np.int8).astype(bool)
            first[inside] = False
            first[runs[uncut]] = True
            low[inside] = data[inside]
        return low, first

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin, at last where they end."""
        units, cuts = self.units(texts)
        coded = units.dictionary_encode()
        known = self.known.all(coded.dictionary.to_pylist(), self._learn)
        found = pa.array(known, pa.large_binary()).take(coded.indices)
        if not len(found):
            return np.zeros(0, self.dtype), cuts
        _, ends, ids = found.buffers()
        ends = np.frombuffer(ends, np.int64)[: len(found) + 1] // self.id_bytes
        return np.frombuffer(ids, self.dtype, int(ends[-1])), ends[cuts]


def _splits_as_here(spec: dict) -> bool:
    """Whether a vocabulary has the rules by which words are cut here."""
    steps = (spec["normalizer"] or {}).get("normalizers", []), (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        [[step["type"] for step in some] for some in steps] == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]
        and steps[0][1]["pattern"] == {"Regex": r"\s+"}
        and steps[1][0]["pattern"] == {"Regex": SPLIT}
        and not (steps[1][1]["add_prefix_space"] or steps[1][1]["use_regex"])
        and not any(t["normalized"] or t["single_word"] for t in spec["added_tokens"])
    )


@lru_cache(2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def pack_window(pieces: list[tuple], row_length: int, pad: int, dtype: np.dtype) -> list[tuple]:
    """Packed rows of (document, start, ids) pieces."""
    out = []
    for members in best_fit([len(ids) for _, _, ids in pieces], row_length):
        row = np.full(row_length, pad, dtype)
        ends = [0]
        for piece in members:
            ids = pieces[piece][2]
            row[ends[-1] : ends[-1] + len(ids)] = ids
            ends.append(ends[-1] + len(ids))
        out.append(
            (ends[-1], row.tobytes(), ends, ends[:-1], [pieces[i][0] for i in members], [pieces[i][1] for i in members])
        )
    return out


def pack(
    df: DataFrame,
    path: str,
    row_length: int = 2048,
    eos: int | None = None,
    pad: int = 0,
    window: int = 1 << 21,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The packed rows of all documents; ``path`` names a tokenizer file of the library."""
    if row_length < 1 or window < row_length:
        raise ValueError("a row needs a token, and a window a row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library_encoder(path)
        context = TaskContext.get()
        shard = context.partitionId() if context else 0
        end = np.array([] if eos is None else [eos], own.dtype)
        written = held = 0
        pieces: list[tuple] = []

        def emit():
            nonlocal written, held, pieces
            rows = pack_window(pieces, row_length, pad, own.dtype)
            for i in range(0, len(rows), 256):
                some = rows[i : i + 256]
                n, ids, ends, resets, docs, starts = map(list, zip(*some))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(some), pa.int32()),
                        pa.array(range(written, written + len(some)), pa.int64()),
                        pa.array(n, pa.int32()),
                        pa.array([own.id_bytes] * len(some), pa.int32()),
                        pa.array(ids, pa.binary()),
                        pa.array(ends, pa.list_(pa.int32())),
                        pa.array(resets, pa.list_(pa.int32())),
                        pa.array(docs, pa.list_(pa.int64())),
                        pa.array(starts, pa.list_(pa.int64())),
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )
                written += len(some)
            held, pieces = 0, []

        for part in chain.from_iterable(slices(batch, 1, SLICE) for batch in batches):
            found, cuts = own.encode(part.column(1))
            cuts = cuts.tolist()
            for doc, a, b in zip(part.column(0).to_pylist(), cuts, cuts[1:]):
                ids = np.concatenate((found[a:b], end))
                for start in range(0, len(ids), row_length):
                    piece = ids[start : start + row_length]
                    pieces.append((doc, start, piece))
                    held += len(piece)
                    if held >= window:
                        yield from emit()
        yield from emit()

    source = texts_of(df, id_col, text_col)
    return source.mapInArrow(run, SCHEMA)


def read_rows(row_length: int, row) -> list[tuple]:
    """The segments of a packed row: (document, start, ids)."""
    ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}")
    assert len(ids) == row_length
    ends = row["cu_seqlens"]
    return [(d, s, ids[a:b]) for d, s, a, b in zip(row["doc_ids"], row["starts"], ends, ends[1:])]


def position_ids(row_length: int, row) -> np.ndarray:
    """Positions of a packed row: from 0 at every reset; 0 on the filling."""
    out = np.zeros(row_length, np.int64)
    ends = row["cu_seqlens"]
    for a, b in zip(ends, ends[1:]):
        out[a:b] = np.arange(b - a)
    return out

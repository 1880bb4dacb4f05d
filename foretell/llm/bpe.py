"""Exact byte-pair encoding by backtracking, and decoding through an offset table.

Aho-Corasick finds the longest token at every position of a word. The encoder goes from
left to right, takes the longest token there, and keeps it if it can stand after the
token before (``Vocabulary.fits``); else it tries the next shorter one, and where none is
left it steps back and marks the place as dead. As a prefix has only one valid encoding,
a dead place stays dead, and each is visited a bounded number of times: linear time.

Cases: a null or empty text has no tokens and decodes to the empty text; special strings
in a text become their special ids, as the library does by default; equal texts, repeated
rows and null ids keep their rows; other columns of the frame are not read.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from foretell.llm.common import map_texts, texts_of
from foretell.llm.vocabulary import Memo, by_run, key_of, run_words, vocabulary

#: Bytes of words, and of runs of words, whose encoding a task remembers (twice, see ``Memo``).
REMEMBERED = 32 << 20


class Encoder:
    """Token ids of texts; exact for any text, whatever is remembered."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.length = [len(k) for k in self.vocab.keys]
        self.automaton = ahocorasick.Automaton()
        for key, i in self.vocab.tokens.items():
            self.automaton.add_word(key, i)
        self.automaton.make_automaton()
        self.shorter = [-1] * len(self.length)
        for key, i in self.vocab.tokens.items():
            for n in range(len(key) - 1, 0, -1):
                if (part := self.vocab.tokens.get(key[:n])) is not None:
                    self.shorter[i] = part
                    break
        self.packed = Memo(self._packed, REMEMBERED)
        self.packed_run = Memo(self._packed_run, REMEMBERED)

    def forget(self) -> None:
        """At a task's end: the worker may go on with other work."""
        self.packed.forget()
        self.packed_run.forget()

    def word(self, key: str) -> list[int]:
        """Ids of one word, given as its key."""
        length, fits, shorter = self.length, self.vocab.fits, self.shorter
        whole = self.vocab.tokens.get(key)
        if whole is not None:
            return [whole]
        size = len(key)
        longest = [0] * size
        for end, token in self.automaton.iter(key):
            longest[end - length[token] + 1] = token  # longer ones end later
        out: list[int] = []
        dead: set[int] = set()
        at, token = 0, longest[0]
        while at < size:
            after = at + length[token]
            if after not in dead and (not out or fits(out[-1], token)):
                out.append(token)
                at = after
                token = longest[at] if at < size else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead.add(at)
                token = out.pop()
                at -= length[token]
        return out

    def _packed(self, word: str) -> bytes:
        ids = self.word(key_of(word))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _packed_run(self, run: str) -> bytes:
        return b"".join(map(self.packed.__getitem__, run_words(run)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out = []
        for n, piece in enumerate(self.vocab.pieces(text)):
            if n % 2:
                out.append(struct.pack("<I", self.vocab.special[piece]))
            else:
                out += by_run(piece, self.packed.__getitem__, self.packed_run.__getitem__)
        return b"".join(out)


class _Slices(dict):
    """Token strings by id, cut when first asked for; at most one for each id."""

    def __init__(self, block: bytes, offsets: list[int]):
        super().__init__()
        self.block, self.offsets = block, offsets

    def __missing__(self, token: int) -> bytes:
        found = self[token] = self.block[self.offsets[token] : self.offsets[token + 1]]
        return found


class Decoder:
    """All token strings in one block of bytes, with the offset of each; a token is one slice.

    The vocabulary names no decoder, so tokens are joined by blanks, as the library does.
    """

    def __init__(self, path: str):
        names = [name.encode() for name in vocabulary(path).names]
        self.offsets = [0]
        for name in names:
            self.offsets.append(self.offsets[-1] + len(name))
        self.block = b"".join(names)
        self._slices = _Slices(self.block, self.offsets)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the text that ``ids`` (little-endian unsigned 32-bit) stand for."""
        return b" ".join(map(self._slices.__getitem__, memoryview(ids).cast("I")))


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit) for each row."""

    def make():
        own = encoder(path)

        def work(text):
            ids = own.encode(text)
            return len(ids) // 4, ids

        return work

    return map_texts(texts_of(df, id_col, text_col), make, "n_tokens bigint, ids binary", lambda: encoder(path).forget())


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the decoded text for each row of ids."""
    from pyspark.sql import functions as F

    kept = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))

    def make():
        own = decoder(path)
        return lambda ids: (own.decode(ids).decode(),)

    return map_texts(kept, make, "text string")


def round_trip(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """doc_id, n_tokens and SHA-256 (lower-case hex) of the ids and of the text decoded from them.

    Decoded texts stay inside the task; ids leave it only if asked for.
    """

    def make():
        to_ids, to_text = encoder(path), decoder(path)

        def work(text):
            ids = to_ids.encode(text)
            decoded = to_text.decode(ids)
            found = len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()
            return (*found, ids) if with_ids else found

        return work

    more = ", ids binary" if with_ids else ""
    schema = f"n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}"
    return map_texts(texts_of(df, id_col, text_col), make, schema, lambda: encoder(path).forget())

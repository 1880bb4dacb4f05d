"""A byte-pair vocabulary with word ends, and the text rules that go before its merges.

The library's order is: cut out added special tokens, bring the rest to NFC and lower
case, split into words, write each word as byte symbols whose last one carries the word
end, then merge. A word here is a *key*: one character for each byte symbol, the last
moved up by ``END``, so that plain string tools see word ends as symbols of their own.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import regex

END = 0x1000
#: Pairs of tokens remembered, of two numbers each.
PAIRS = 200_000
# fixed values: the splitting pattern of the vocabulary, as the library has it and in two spellings
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_USUAL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_EXACT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


@lru_cache(1)
def _unusual() -> np.ndarray:
    """By code point, whether the two spellings may treat it differently: numbers that are
    no digits, and separators that only one of them takes for white space."""
    marked = np.zeros(sys.maxunicode + 1, dtype=bool)
    marked[[c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("No", "Nl")]] = True
    marked[0x1C:0x20] = True
    return marked


def _usual(text: str) -> bool:
    if text.isascii():
        return not any(c in text for c in "\x1c\x1d\x1e\x1f")
    step = 1 << 20
    parts = (text[i : i + step].encode("utf-32-le", "surrogatepass") for i in range(0, len(text), step))
    return not any(_unusual()[np.frombuffer(part, np.uint32)].any() for part in parts)


def prepared(text: str) -> str:
    """Text without special tokens, normalised."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() would look at the word's end
    return text.lower()


def run_words(run: str) -> list[str]:
    """Words of a run without blanks, taken from a usual text."""
    return [run] if run.isascii() and run.isalpha() else _USUAL.findall(run)


def by_run(text: str, word, run) -> list:
    """``word(w)`` for all words of a text, or ``run(r)`` for all its runs between blanks.

    A run is worth as much as its words, but split() finds runs much faster than a pattern
    finds words, and most runs have been seen before.
    """
    text = prepared(text)
    if _usual(text):
        return list(map(run, text.split()))
    return list(map(word, _EXACT.findall(text)))


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it can be seen, else the next free one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(free)) for b in range(256)]


_LETTERS = {b: c for b, c in enumerate(_byte_letters())}


def key_of(word: str) -> str:
    """A word as byte symbols; the last one is a symbol with word end."""
    key = word if word.isascii() else word.encode().decode("latin-1")
    key = key.translate(_LETTERS)
    return key[:-1] + chr(ord(key[-1]) + END)


class Vocabulary:
    """Tokens by id: keys, lengths, parts and the rank of the merge that makes them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        size = max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.names = [""] * size
        for name, i in ids.items():
            self.names[i] = name
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for name, i in self.special.items():
            self.names[i] = name
        self.left, self.right, self.rank = [-1] * size, [-1] * size, [-1] * size
        self.merges: dict[tuple[int, int], int] = {}
        keys = [""] * size
        made = {a + b for a, b in model["merges"]}
        for name, i in ids.items():
            if name not in made and name not in self.special:
                keys[i] = chr(ord(name[0]) + END) if name.endswith(suffix) and len(name) > 1 else name
        for rank, (a, b) in enumerate(model["merges"]):
            i, x, y = ids[a + b], ids[a], ids[b]
            self.left[i], self.right[i], self.rank[i] = x, y, rank
            self.merges[x, y] = rank
            keys[i] = keys[x] + keys[y]
        self.keys = keys
        self.tokens = {k: i for i, k in enumerate(keys) if k}
        self._pairs: dict[int, bool] = {}
        pattern = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self._special = re.compile(f"({pattern})") if pattern else None

    def pieces(self, text: str) -> list[str]:
        """Text and special tokens by turns: every second item is a special token."""
        return self._special.split(text) if self._special and self._special.search(text) else [text]

    def fits(self, a: int, b: int) -> bool:
        """Whether merging leaves the token ``a`` before the token ``b`` as they are.

        The symbols at the seam grow by the merges inside either token, in order of rank.
        If a merge across the seam ever comes first, the pair does not occur. At equal rank
        the merge further left comes first.
        """
        pair = a * len(self.keys) + b
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) > PAIRS:
                self._pairs.clear()
            known = self._pairs[pair] = self._seam(a, b)
        return known

    def _seam(self, a: int, b: int) -> bool:
        never = len(self.merges)
        xs, ys = [a], [b]
        while self.right[xs[-1]] >= 0:
            xs.append(self.right[xs[-1]])
        while self.left[ys[-1]] >= 0:
            ys.append(self.left[ys[-1]])
        while True:
            inside_a = self.rank[xs[-2]] if len(xs) > 1 else never
            inside_b = self.rank[ys[-2]] if len(ys) > 1 else never
            across = self.merges.get((xs[-1], ys[-1]), never)
            if across < inside_a and across <= inside_b:
                return False
            if inside_a == inside_b == never:
                return True
            (xs if inside_a <= inside_b else ys).pop()


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    """Read once for each Python worker."""
    return Vocabulary(path)


#: Words from this length on are worked out each time.
LONG = 10_000


class Memo(dict):
    """Results by word for the words seen lately, in at most twice ``bound`` bytes.

    Long words, of which few would fill it, are not remembered.
    """

    #: Of an entry besides its word and result: two objects and their place in a table.
    ENTRY = 160

    def __init__(self, work, bound: int):
        super().__init__()
        self.work, self.bound, self.before, self.used = work, bound, {}, 0

    def forget(self) -> None:
        self.clear()
        self.before, self.used = {}, 0

    def __missing__(self, word):
        result = self.before.get(word)
        if result is None:
            result = self.work(word)
        if len(word) < LONG:
            self.learn(word, result)
        return result

    def all(self, words: list, work) -> list:
        """Results of many words; ``work`` finds those of all unknown ones at once."""
        out = list(map(self.get, words))
        lacking = [i for i, result in enumerate(out) if result is None]
        for i in lacking:
            out[i] = self.before.get(words[i])
        unknown = [i for i in lacking if out[i] is None]
        for i, result in zip(unknown, work([words[i] for i in unknown])):
            out[i] = result
        for i in lacking:
            if len(words[i]) < LONG:
                self.learn(words[i], out[i])
        return out

    def learn(self, word, result) -> None:
        self.used += Memo.ENTRY + len(word) + (len(result) if isinstance(result, (bytes, str)) else 0)
        if self.used > self.bound:
            self.before, self.used = dict(self), 0
            self.clear()
        self[word] = result

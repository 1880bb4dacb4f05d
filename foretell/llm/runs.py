"""Periodic runs of words, found online by catching squares.

A run is a stretch of words with smallest period q that is at least two periods (and
``LEAST`` words) long and that no neighbouring word extends. A square is one half of a length
q written twice; every window of 2q words in a run of period q is one.

*Catchers.* Words are appended one by one. Whenever an aligned block of m = 1, 2, 4, ... words
is complete, its catcher looks for the block at a distance q of 2m-1 to 4m-2: a half of such a
length contains an aligned block of m words, and the ranges of all m together hold every q
once. A hit starts a *comparison* at distance q, extended backwards once and advanced over the
appended words when they would make it a square, that is when q words agree. From then on
every further word advances it, and its squares merge into one run, given out when it ends.
*Multiples.* A catcher does not look inside a run under way whose period p is at most m: it
could only find multiples of p there, which are no smallest periods and end where the run
ends. Equal stretches keep the smallest period.

Work: n / m searches over 3m words for each m, so n log n word comparisons in C, and a step
for each word and run under way (at most log n at a word). Nothing is held beyond one text.

A text without words has no run. A null text is empty, rows without id or with a repeated id
give a row each, and other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame

from foretell.llm.common import map_rows, map_texts, texts_of

LEAST = 12
#: Letters to write words with: code points that are no surrogates.
LETTERS = 0x110000 - 0x800
_OUT = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def words_of(text: str) -> list[bytes]:
    """Maximal stretches without ASCII white space; bytes.split() knows just these separators."""
    return text.encode().split()


def _letter(number: int) -> str:
    return chr(number if number < 0xD800 else number + 0x800)


def spelled(words: list, letters: int = LETTERS) -> tuple[str, int]:
    """The words as one string and the letters for a word: one, or two where one is too few.

    First and second letters differ, so words are found at their own places only.
    """
    numbers: dict = {}
    for word in words:
        numbers.setdefault(word, len(numbers))
    if len(numbers) <= letters:
        names = {word: _letter(n) for word, n in numbers.items()}
        return "".join(map(names.__getitem__, words)), 1
    half = letters // 2
    if len(numbers) > half * half:
        raise ValueError("more different words than pairs of letters")
    names = {word: _letter(n // half) + _letter(half + n % half) for word, n in numbers.items()}
    return "".join(map(names.__getitem__, words)), 2


class Catcher:
    """Comparisons under way over a growing text, and the runs that have ended."""

    def __init__(self, least: int = LEAST):
        self.least = least
        #: by distance: first word that agrees with the one that far before it, and words compared so far
        self.begun: dict[int, tuple[int, int]] = {}
        #: comparisons by the number of words at which they become squares
        self.due: dict[int, list[int]] = {}
        #: by distance: the same first word where a square has been appended; followed word by word
        self.squares: dict[int, int] = {}
        self.runs: dict[tuple[int, int], int] = {}

    def end(self, distance: int, stop: int) -> None:
        start = self.squares.pop(distance) - distance
        if stop - start >= self.least:
            known = self.runs.get((start, stop))
            if known is None or distance < known:
                self.runs[start, stop] = distance

    def scan(self, text: str, width: int) -> None:
        """Appends every word of a text spelled with ``width`` letters a word."""
        n = len(text) // width
        squares, due = self.squares, self.due
        seen: dict[str, int] = {}  # a word's last place
        for done in range(1, n + 1):
            at = (done - 1) * width
            word = text[at : at + width]
            if squares:
                for distance in [q for q in squares if not text.startswith(word, at - q * width)]:
                    self.end(distance, done - 1)
            if done in due:
                self.advance(text, width, done)
            last = seen.get(word)
            seen[word] = done
            if last is None:
                continue  # no block that ends here has been written before
            # every size of which a block has just been completed, if its range goes back to ``last``
            size, most, gap = 1, done & -done, done - last + 2
            while size <= most:
                if 4 * size >= gap:
                    first = done - size
                    if first < 2 * size - 1:
                        break
                    self.catch(text, width, first, size)
                size *= 2
        for distance in list(squares):
            self.end(distance, n)

    def advance(self, text: str, width: int, done: int) -> None:
        """Comparisons that would be squares by now: those that agree so far are."""
        for distance in self.due.pop(done):
            first, compared = self.begun.get(distance, (-1, 0))
            if first + distance == done:
                del self.begun[distance]
                step = 1
                while compared < done:
                    stop = min(compared + step, done)
                    if not text.startswith(text[compared * width : stop * width], (compared - distance) * width):
                        break
                    compared, step = stop, 2 * step
                else:
                    self.squares[distance] = first

    def catch(self, text: str, width: int, first: int, size: int) -> None:
        """Comparisons for the copies of the block at ``first`` within its range of distances."""
        low, high = max(0, first - 4 * size + 2), first - 2 * size + 1
        for period, begun in self.squares.items():
            if period <= size:
                high = min(high, begun - period - 1)
        if high < low:
            return
        block = text[first * width : (first + size) * width]
        stop = (high + size) * width
        found = text.find(block, low * width, stop)
        while found >= 0:
            self.compare(text, width, first, size, first - found // width)
            found = text.find(block, found + width, stop)

    def compare(self, text: str, width: int, first: int, size: int, distance: int) -> None:
        if distance in self.squares:
            return
        begun, done = self.back(text, width, first, distance), first + size
        if begun + distance <= done:
            self.begun.pop(distance, None)
            self.squares[distance] = begun
        elif self.begun.get(distance, (-1, 0))[0] != begun:
            # one from an earlier stretch at this distance has ended unseen
            self.begun[distance] = begun, done
            self.due.setdefault(begun + distance, []).append(distance)

    def back(self, text: str, width: int, first: int, distance: int) -> int:
        """First word of the stretch that agrees at a distance and holds ``first``."""
        begun, step = first, 1
        # strides double while they agree, then halve
        while step:
            at = begun - step
            if at >= distance and text.startswith(text[at * width : begun * width], (at - distance) * width):
                begun, step = at, 2 * step
            else:
                step //= 2
        return begun


def find_runs(words: list, least: int = LEAST, letters: int = LETTERS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    catcher = Catcher(least)
    catcher.scan(*spelled(words, letters))
    return sorted((start, stop - start, period) for (start, stop), period in catcher.runs.items())


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words that no run contains behind its first period."""
    kept, at = [], 0
    for first, stop in sorted((start + period, start + length) for start, length, period in runs):
        if stop > at:
            kept += words[at : max(at, first)]
            at = stop
    return kept + words[at:]


def digest(words: list, least: int = LEAST) -> tuple:
    runs = find_runs(words, least)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    start, length, period = best
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        len(runs), start, length, period, 1000 * length // period if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept_words(words, runs))).hexdigest(),
    )


def run_digests(df: DataFrame, repeat: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text: number of runs, its longest one, digests of all runs and of the text
    without repetition. ``repeat`` first makes a tenth of the texts periodic, by crc32 of the id."""

    def work(doc_id, text):
        words = words_of(text)
        return digest(repeated(words, doc_id) if repeat else words)

    return map_rows(texts_of(df, id_col, text_col), lambda: work, _OUT)


def collapse(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the runs and the text without repeated periods (its words joined by blanks).

    A text without runs stays as it is.
    """

    def work(text):
        words = words_of(text)
        runs = find_runs(words)
        named = [{"start": s, "length": n, "period": q} for s, n, q in runs]
        return named, b" ".join(kept_words(words, runs)).decode() if runs else text

    schema = "runs array<struct<start: bigint, length: bigint, period: bigint>>, text string"
    return map_texts(texts_of(df, id_col, text_col), lambda: work, schema)


def repeated(words: list, doc_id) -> list:
    """The words of a document, periodic from some word on for a tenth of all ids; a null id counts as no text."""
    key = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), key // 10
    if key % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    times = -(-(n - a) // p)
    return words[:a] + (period * times)[: n - a]

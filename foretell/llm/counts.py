"""Token counts from a compiled finite-state transducer, without making the tokens.

Reading a word symbol by symbol, a state of the transducer holds the places from which a
token can still reach further: for each, the trie node reached since then, the last token
of the only valid encoding up to there, and its count against now. A step moves the nodes
on; of the tokens that end here just one fits the token before it, and the change of the
count is the transition's output. States are numbered as they are met and transitions kept,
so the transducer is deterministic and compiled as far as the texts need it.

A text is cut into chunks. White space resets everything, so the state map of a chunk is
(words before its first blank, tokens between its first and last blank, rest after it),
and a chunk without blank is only text. Such maps compose associatively; ``compose`` joins
neighbours in a tree, as a prefix scan does, and counts only the word on the seam anew.

Cases: a null or empty text has 0 bytes and 0 tokens; special strings count as one token;
repeated rows and null ids keep their rows; other columns of the frame are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame

from foretell.llm.common import map_texts, texts_of
from foretell.llm.vocabulary import Memo, by_run, key_of, run_words, vocabulary

#: Code points in a chunk; words whose count, and states whose transitions, a worker keeps.
CHUNK, REMEMBERED, STATES = 1 << 16, 48 << 20, 200_000
#: Blanks that reset the transducer and are blanks by every rule.
_BLANK = re.compile(r"[ \t\n\r]")
_START = ((0, -1, 0),)


class Transducer:
    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        # the trie: a node is named by its number, its edges by node and symbol
        self.edges: dict[tuple[int, str], int] = {}
        self.token = [-1]
        self.inner = [True]
        for key, i in self.vocab.tokens.items():
            node = 0
            for symbol in key:
                after = self.edges.get((node, symbol))
                if after is None:
                    after = self.edges[node, symbol] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                self.inner[node] = True
                node = after
            self.token[node] = i
        self.count = Memo(self._count, REMEMBERED)
        self.run_count = Memo(lambda run: sum(map(self.count.__getitem__, run_words(run))), REMEMBERED)
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[tuple, int] = {_START: 0}
        self.states: list[tuple] = [_START]
        self.steps: list[dict[str, tuple[int, int]]] = [{}]

    def step(self, state: int, symbol: str) -> tuple[int, int]:
        """The transition: next state, tokens emitted (which may be negative for a while)."""
        known = self.steps[state].get(symbol)
        if known is None:
            moved = []
            emitted = last = None
            for node, before, count in self.states[state]:
                node = self.edges.get((node, symbol))
                if node is None:
                    continue
                token = self.token[node]
                if token >= 0 and emitted is None and (before < 0 or self.vocab.fits(before, token)):
                    emitted, last = count + 1, token
                if self.inner[node]:
                    moved.append((node, before, count))
            kept = tuple((node, before, count - emitted) for node, before, count in moved) + ((0, last, 0),)
            number = self.numbers.get(kept)
            if number is None:
                number = self.numbers[kept] = len(self.states)
                self.states.append(kept)
                self.steps.append({})
            known = self.steps[state][symbol] = (number, emitted)
        return known

    def _count(self, word: str) -> int:
        if len(self.states) > STATES:
            self._reset()
        state = total = 0
        for symbol in key_of(word):
            state, emitted = self.step(state, symbol)
            total += emitted
        return total

    def tokens(self, text: str) -> int:
        """Tokens of a text that starts and ends at a reset."""
        pieces = self.vocab.pieces(text)
        return len(pieces) // 2 + sum(
            sum(by_run(p, self.count.__getitem__, self.run_count.__getitem__)) for p in pieces[::2]
        )

    def chunk(self, text: str) -> tuple:
        """The state map of a chunk: (head, tokens within, rest), or (text,) if nothing resets in it."""
        first = _BLANK.search(text)
        if not first:
            return (text,)
        last = max(text.rfind(blank) for blank in " \t\n\r")
        return text[: first.start()], self.tokens(text[first.start() : last]), text[last + 1 :]

    def joined(self, a: tuple, b: tuple) -> tuple:
        """The state map of two neighbours."""
        if len(a) == 1:
            return (a[0] + b[0], *b[1:])
        if len(b) == 1:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.tokens(a[2] + b[0]) + b[1], b[2]

    def compose(self, maps: list[tuple]) -> tuple:
        """The map of all chunks in order, joined pairwise until one is left."""
        while len(maps) > 1:
            maps = [self.joined(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0] if maps else ("",)

    def total(self, text: str) -> int:
        if len(text) <= CHUNK:
            return self.tokens(text)
        ends = self.compose([self.chunk(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)])
        return self.tokens(ends[0]) + (ends[1] + self.tokens(ends[2]) if len(ends) > 1 else 0)


@lru_cache(2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def token_counts(
    df: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens) for each row."""

    def make():
        own = transducer(path)

        def work(text):
            n = own.total(text)
            return len(text.encode()), n, n > limit

        return work

    return map_texts(
        texts_of(df, id_col, text_col), make, "n_bytes bigint, n_tokens bigint, over_limit boolean"
    )

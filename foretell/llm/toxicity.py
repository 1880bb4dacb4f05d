"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer turns the words of a clause into symbols: insult and threat words,
with weights, target words, negations, words of reported speech, clause ends; all else is
one plain symbol. Three small transducers read these symbols: one remembers a target, one
the reach of a negation, one that the clause reports speech. Their composition is one
deterministic machine (``MACHINE``), and each insult or threat it meets is scored by the
mode the machine is in: reported, negated, aimed at a target, or plain. So a clause counts,
not the word alone.

Weights of insult words and of word beginnings (for languages that inflect or compound)
are smoothed log odds from labelled rows; how much each mode counts is fitted by logistic
regression. Both take at most ``bound`` labelled rows; scoring covers every row.

Cases: an empty or null text has no matched clause and the lowest score of all; without
usable labels every score is 0; repeated rows get equal scores; null ids keep their rows.
Other columns of the frame are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import filter_texts, map_texts, stored, texts_of
from foretell.llm.learning import labelled_sample
from foretell.llm.vocabulary import Memo

# fixed values: closed word classes
TARGETS = frozenset(
    "you your yours yourself they them their he him she her du dich dir ihr euch sie tu toi te vous ils elle "
    "tú ti usted ustedes ellos ella".split()
)
NEGATIONS = frozenset("not no never neither nor without cannot nicht kein keine nie pas jamais sans nunca jamás sin".split())
REPORTS = frozenset(
    "said says say saying told tells called calls claimed quoted wrote reported according sagte sagt laut dit disait "
    "selon dijo dice según".split()
)
THREATS = frozenset(
    "kill killing murder hurt destroy burn stab shoot beat umbringen töten verletzen tuer frapper détruire matar "
    "destruir herir".split()
)
THREAT_WEIGHT = 1.0
PLAIN, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
MODES = ("plain", "aimed", "negated", "reported")
#: Words that a negation reaches, letters of a word beginning, lexicon entries at most.
REACH, BEGINNING, ENTRIES = 3, 4, 20_000
#: Bytes of words that a task remembers, twice.
REMEMBERED = 36 << 20
_WORD = re.compile(r"[^\W\d_]+")
_ENDS = frozenset(".!?;:")


def _targets(state: int, symbol: int) -> int:
    return 0 if symbol == END else 1 if symbol == TARGET else state


def _negations(state: int, symbol: int) -> int:
    return 0 if symbol == END else REACH if symbol == NEGATION else max(state - 1, 0)


def _reports(state: int, symbol: int) -> int:
    return 0 if symbol == END else 1 if symbol == REPORT else state


def compose() -> tuple[list[list[int]], list[int]]:
    """The composed machine: next state by state and symbol, and the mode of each state."""
    states = list(product(range(2), range(REACH + 1), range(2)))
    number = {s: i for i, s in enumerate(states)}
    moves = [
        [number[_targets(t, x), _negations(n, x), _reports(r, x)] for x in range(7)] for t, n, r in states
    ]
    modes = [3 if r else 2 if n else 1 if t else 0 for t, n, r in states]
    return moves, modes


MACHINE, MODE_OF = compose()


@dataclass
class Grammar:
    """The lexical transducer's weights and what a matched clause of each mode counts."""

    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    bias: float = -50.0
    factors: tuple[float, ...] = (0.0,) * (len(MODES) + 1)

    def run_symbols(self, run: str) -> tuple[tuple[int, float], ...]:
        """Symbols of a run between blanks; () for plain words inside a clause."""
        out = []
        for word in _WORD.findall(run.lower()):
            weight = max(self.words.get(word, 0.0), self.beginnings.get(word[:BEGINNING], 0.0) if len(word) > BEGINNING else 0.0)
            if weight:
                out.append((INSULT, weight))
            elif word in THREATS:
                out.append((THREAT, THREAT_WEIGHT))
            elif word in TARGETS:
                out.append((TARGET, 0.0))
            elif word in NEGATIONS:
                out.append((NEGATION, 0.0))
            elif word in REPORTS:
                out.append((REPORT, 0.0))
            else:
                out.append((PLAIN, 0.0))
        if run[-1] in _ENDS:
            out.append((END, 0.0))
        return tuple(out) if any(s != PLAIN for s, _ in out) else ()

    def clauses(self, text: str, symbols) -> tuple[list[float], int, float]:
        """By mode the weight of matched clauses; words; the number of matches."""
        modes, words, matches = [0.0] * len(MODES), 0, 0
        for line in text.split("\n"):
            runs = list(map(symbols, line.split()))
            words += len(runs)
            if not any(x and any(s in (INSULT, THREAT) for s, _ in x) for x in set(runs)):
                continue
            state, best = 0, [0.0] * len(MODES)
            for x in runs:
                for symbol, weight in x or ((PLAIN, 0.0),):
                    if symbol in (INSULT, THREAT):
                        best[MODE_OF[state]] += weight
                        matches += symbol == INSULT
                    elif symbol == END:
                        modes = [a + b for a, b in zip(modes, best)]
                        best = [0.0] * len(MODES)
                    state = MACHINE[state][symbol]
            modes = [a + b for a, b in zip(modes, best)]
        return modes, words, matches

    def features(self, text: str, symbols) -> list[float]:
        modes, words, matches = self.clauses(text, symbols)
        return [*np.log1p(modes).tolist(), 20.0 * matches / (words + 10.0)]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + x @ np.array(self.factors), -60, 60)))


def _lexicon(sample: DataFrame, toxic: int, clean: int, ratio: float) -> tuple[dict, dict]:
    """Words and beginnings that toxic rows have far more often than clean ones, with their weights."""
    tagged = sample.select(F.struct("doc_id", "label").alias("doc_id"), "text")

    def make():
        def work(text):
            words = set(_WORD.findall(text.lower()))
            return (sorted(words | {w[:BEGINNING] + "*" for w in words if len(w) > BEGINNING}),)

        return work

    support = max(3.0, 0.01 * toxic)
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    rows = (
        map_texts(tagged, make, "items array<string>")
        .select(F.col("doc_id.label").alias("label"), F.explode("items").alias("item"))
        .groupBy("item")
        .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
        .where(F.col("t") >= support)
        .withColumn("weight", odds)
        .where(F.col("weight") >= float(np.log(ratio)))
        .orderBy(F.desc("weight"), "item")
        .limit(ENTRIES)
        .collect()
    )
    found = {r["item"]: float(r["weight"]) for r in rows}
    return {w: v for w, v in found.items() if w[-1] != "*"}, {w[:-1]: v for w, v in found.items() if w[-1] == "*"}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, steps: int = 40) -> tuple[float, tuple[float, ...]]:
    """Factors that are not negative, as a matched clause never speaks against toxicity."""
    free = list(range(x.shape[1]))
    while True:
        z = np.column_stack([np.ones(len(x)), x[:, free]])
        w = np.zeros(z.shape[1])
        penalty = np.diag([1e-6] + [ridge] * len(free))
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hessian = (z * (p * (1 - p))[:, None]).T @ z + penalty * max(len(x), 1) / 100
            step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), z.T @ (y - p) - penalty @ w * max(len(x), 1) / 100)
            w += np.clip(step, -5, 5)
        if (w[1:] >= 0).all() or not free:
            break
        free = [f for f, v in zip(free, w[1:]) if v >= 0]
    factors = np.zeros(x.shape[1])
    factors[free] = w[1:]
    return float(w[0]), tuple(factors.tolist())


def fit(sample: DataFrame, ratio: float = 60.0) -> Grammar:
    """Lexicon and factors from a bounded sample (doc_id, text, label)."""
    sample = stored(sample, "sample")
    sizes = Counter({r["label"]: r["count"] for r in sample.groupBy("label").count().collect()})
    if not sizes[0] or not sizes[1]:
        return Grammar()
    grammar = Grammar(*_lexicon(sample, sizes[1], sizes[0], ratio))
    tagged = sample.select(F.struct("doc_id", "label").alias("doc_id"), "text")

    def make():
        symbols = Memo(grammar.run_symbols, REMEMBERED).__getitem__
        return lambda text: (grammar.features(text, symbols),)

    rows = map_texts(tagged, make, "x array<double>").select("doc_id.doc_id", "doc_id.label", "x").collect()
    found = sorted(tuple(r) for r in rows)
    grammar.bias, grammar.factors = _logistic(np.array([r[2] for r in found]), np.array([r[1] for r in found], float))
    return grammar


def score(texts: DataFrame, grammar: Grammar, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted for rows of ``texts_of``."""
    from foretell.llm.common import arrow_schema

    out = texts.sparkSession.createDataFrame([], f"doc_id {dict(texts.dtypes)['doc_id']}, score double, predicted int")
    names = arrow_schema(out.schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Memo(grammar.run_symbols, REMEMBERED).__getitem__
        for batch in batches:
            x = np.array([grammar.features(t.as_py(), symbols) for t in batch.column(1)]).reshape(batch.num_rows, len(MODES) + 1)
            s = grammar.score(x) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())],
                names=names,
            )

    return texts.mapInArrow(run, out.schema)


def keep_clean(docs: DataFrame, grammar: Grammar, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that are not rejected."""

    def make():
        symbols = Memo(grammar.run_symbols, REMEMBERED).__getitem__

        def judge(texts):
            x = np.array([grammar.features(t, symbols) for t in texts]).reshape(len(texts), len(MODES) + 1)
            return (grammar.score(x) < threshold).tolist()

        return judge

    return filter_texts(docs, make, text_col)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    label: str = "toxic",
    threshold: float = 0.7,
    bound: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    train: DataFrame | None = None,
) -> DataFrame:
    """doc_id, score (0 to 1), predicted for each row; the grammar is fitted on ``train`` (else ``docs``)."""
    texts = texts_of(docs, id_col, text_col)
    source = texts if train is None else texts_of(train, id_col, text_col)
    return score(texts, fit(labelled_sample(source, labels, label, learn, bound)), threshold)

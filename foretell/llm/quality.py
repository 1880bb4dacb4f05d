"""Document quality by histogram gradient-boosted trees over text statistics.

The statistics (``FEATURES``) come from the whole text alone. Trees are grown level by
level on binned values, and kept as flat arrays over all trees, so a batch of documents
goes down all trees at once by array indexing. Fitting takes at most ``bound`` labelled
rows (see ``labelled_sample``); scoring covers every row.

Cases: an empty or null text has statistics of 0 and gets a score like any other; without
usable labels every score is 0.5; repeated rows get equal scores; null ids keep their
rows. Other columns of the frame are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from foretell.llm.common import filter_texts, map_texts, texts_of
from foretell.llm.learning import labelled_sample

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "distinct_words", "top_word", "distinct_pairs", "lines", "distinct_lines",
    "upper", "digits", "blanks", "stops", "commas", "marks", "currency", "pipes", "hashes", "ampersands", "stars",
    "percents", "brackets", "wide", "lone", "long_words", "capital_words", "marked_words",
)
_UPPER, _DIGIT = np.zeros(256), np.zeros(256)
_UPPER[65:91] = 1
_DIGIT[48:58] = 1


def _of(text: bytes) -> np.ndarray:
    weights = np.zeros(256)
    weights[list(text)] = 1
    return weights


_CLASSES = np.stack(
    [_UPPER, _DIGIT, *map(_of, (b" \t\n\r", b".", b",;:", b"!?", b"$", b"|", b"#", b"&", b"*", b"%", b"<>[]{}"))]
)
_WIDE = np.zeros(256)
_WIDE[128:] = 1


def statistics(text: str) -> list[float]:
    """The values of ``FEATURES``."""
    raw = text.encode("utf-8", "surrogatepass")
    size = len(raw)
    if not size:
        return [0.0] * len(FEATURES)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = (_CLASSES @ bytes_ / size).tolist()
    words = raw.split()
    n = max(len(words), 1)
    times = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    # every word counts; each distinct one is looked at once
    upper = sum(c for w, c in times.items() if w[:1].isupper()) / n
    marked = sum(c for w, c in times.items() if not w[-1:].isalnum() and w[-1] < 128) / n
    return [
        np.log1p(size),
        np.log1p(len(words)),
        float(sizes.mean()) if len(words) else 0.0,
        len(times) / n,
        max(times.values(), default=0) / n,
        len(set(zip(words, words[1:]))) / max(n - 1, 1),
        len(lines) / n,
        len(set(lines)) / max(len(lines), 1),
        *shares,
        float(_WIDE @ bytes_ / size),
        float((sizes == 1).mean()) if len(words) else 0.0,
        float((sizes > 15).mean()) if len(words) else 0.0,
        upper,
        marked,
    ]


@dataclass
class Trees:
    """All trees in flat arrays: at node i, go left if x[feature] <= threshold; leaves point to themselves."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    least: float = 5.0,
    ridge: float = 1.0,
) -> Trees:
    """Boosted logistic trees; gradients are summed in histograms of binned values."""
    n, features = x.shape
    positive = (y.sum() + 1) / (n + 2)
    base = float(np.log(positive / (1 - positive)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1) if n else np.zeros((0, features), int)
    cells = binned + np.arange(features) * bins
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

    def new() -> int:
        at = len(nodes["value"])
        for k, v in (("feature", 0), ("threshold", np.inf), ("left", at), ("right", at), ("value", 0.0)):
            nodes[k].append(v)
        return at

    margin, roots = np.full(n, base), []
    for _ in range(rounds if 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        root = new()
        roots.append(root)
        level = [(root, np.arange(n))]
        for step in range(depth + 1):
            following = []
            for at, rows in level:
                g, h = gradient[rows].sum(), weight[rows].sum()
                best = (1e-6, 0, 0)
                if step < depth and len(rows) >= 2 * least:
                    flat = cells[rows].ravel()
                    gs = np.bincount(flat, np.repeat(gradient[rows], features), features * bins).reshape(features, bins)
                    hs = np.bincount(flat, np.repeat(weight[rows], features), features * bins).reshape(features, bins)
                    cs = np.bincount(flat, minlength=features * bins).reshape(features, bins)
                    gl, hl, cl = gs.cumsum(1), hs.cumsum(1), cs.cumsum(1)
                    gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                    gain[(cl < least) | (len(rows) - cl < least)] = -1
                    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[f, b] > best[0] and b < len(edges[f]):
                        best = (float(gain[f, b]), int(f), int(b))
                if best[0] <= 1e-6:
                    nodes["value"][at] = float(-rate * g / (h + ridge))
                    margin[rows] += nodes["value"][at]
                    continue
                _, f, b = best
                nodes["feature"][at], nodes["threshold"][at] = f, float(edges[f][b])
                nodes["left"][at], nodes["right"][at] = new(), new()
                goes_left = binned[rows, f] <= b
                following += [(nodes["left"][at], rows[goes_left]), (nodes["right"][at], rows[~goes_left])]
            level = following
    if not roots:
        roots = [new()]
    kinds = {"feature": np.int64, "threshold": np.float64, "left": np.int64, "right": np.int64, "value": np.float64}
    if not 0 < y.sum() < n:
        base = 0.0
    return Trees(np.array(roots), *(np.array(nodes[k], t) for k, t in kinds.items()), depth, base)


def fit(sample: DataFrame) -> Trees:
    """Trees from a bounded sample (doc_id, text, label), whose statistics come to the driver."""
    from pyspark.sql import functions as F

    # the label rides along with the id
    tagged = sample.select(F.struct("doc_id", "label").alias("doc_id"), "text")
    rows = map_texts(tagged, lambda: lambda text: (statistics(text),), "x array<double>").select(
        "doc_id.doc_id", "doc_id.label", "x"
    )
    found = sorted(tuple(r) for r in rows.collect())
    x = np.array([r[2] for r in found]).reshape(len(found), len(FEATURES))
    return fit_trees(x, np.array([r[1] for r in found], float))


def score(texts: DataFrame, trees: Trees, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted for rows of ``texts_of``."""
    from foretell.llm.common import arrow_schema

    out = texts.sparkSession.createDataFrame([], f"doc_id {dict(texts.dtypes)['doc_id']}, score double, predicted int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(1)]).reshape(batch.num_rows, len(FEATURES))
            s = trees.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())],
                names=names,
            )

    names = arrow_schema(out.schema).names
    return texts.mapInArrow(run, out.schema)


def keep_good(docs: DataFrame, trees: Trees, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that are not rejected."""

    def make():
        def judge(texts):
            x = np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES))
            return (trees.score(x) >= threshold).tolist()

        return judge

    return filter_texts(docs, make, text_col)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    label: str = "quality",
    threshold: float = 0.3,
    bound: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    train: DataFrame | None = None,
) -> DataFrame:
    """doc_id, score (0 to 1), predicted for each row; trees are fitted on ``train`` (else ``docs``)."""
    texts = texts_of(docs, id_col, text_col)
    source = texts if train is None else texts_of(train, id_col, text_col)
    return score(texts, fit(labelled_sample(source, labels, label, learn, bound)), threshold)

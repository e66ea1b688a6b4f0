"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over its bins, grown by boosting shallow trees on one feature at a time, cycle
after cycle; then tables over pairs of features, chosen by what they still explain. A score adds up table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import in_small_batches, private
from chunklake.llm.labelled import SAMPLE_PER_CLASS, held_out, training_texts

FEATURES = (
    "length", "words", "word_length", "upper", "digits", "marks", "symbols", "not_ascii", "distinct", "repeats",
    "pairs", "lines", "line_words", "distinct_lines", "top_mark", "short_words",
)
BINS, CYCLES, RATE, PAIRS, PAIR_BINS, PAIR_CYCLES = 32, 150, 0.15, 8, 8, 60
#: Below this score a document is rejected.
THRESHOLD = 0.3

_KINDS = np.full(256, 7, np.uint8)  # other control bytes
for _kind, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~", bytes(range(128, 256)), b" \t\n\r\x0b\x0c", b"abcdefghijklmnopqrstuvwxyz")):
    _KINDS[list(_bytes)] = _kind


def features(text: str) -> list[float]:
    """The numbers of ``FEATURES`` for a whole text; an empty text has zeros."""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=8)
    size = len(raw)
    words = text.split()
    n = len(words)
    lines = text.split("\n")
    marks = [raw.count(b) for b in (b"!", b"|", b"#", b"$", b"%", b"&", b"*")]
    most = max(n, 1)
    return [
        np.log1p(size), np.log1p(n), sum(map(len, words)) / most, kinds[0] / size, kinds[1] / size, kinds[2] / size, kinds[3] / size,
        kinds[4] / size, len(set(words)) / np.sqrt(most), sum(map(eq, words, words[1:])) / most,
        len(set(zip(words, words[1:], strict=False))) / max(n - 1, 1), np.log1p(len(lines)), n / len(lines), len(set(lines)) / len(lines),
        max(marks) / most, sum(len(w) <= 2 for w in words) / most,
    ]


@dataclass
class Model:
    """Bin edges and tables. ``tables[f][bin]``; ``pairs``: (f, g, table over coarse bins of both)."""

    edges: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of features."""
        total = np.full(len(x), self.base)
        bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]
        for b, values in zip(bins, self.tables, strict=True):
            total += values[b]
        for f, g, values in self.pairs:
            total += values[self.coarse[f][bins[f]], self.coarse[g][bins[g]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int = 3, ridge: float = 1.0) -> np.ndarray:
    """The values per bin of a tree on one feature, grown leaf by leaf at the cut of the largest gain."""

    def best(lo: int, hi: int) -> tuple[float, int]:
        g, h = np.cumsum(grad[lo:hi]), np.cumsum(hess[lo:hi])
        if hi - lo < 2:
            return 0.0, lo
        gain = g[:-1] ** 2 / (h[:-1] + ridge) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge) - g[-1] ** 2 / (h[-1] + ridge)
        k = int(np.argmax(gain))
        return float(gain[k]), lo + k + 1

    parts = [(0, len(grad))]
    for _ in range(leaves - 1):
        gains = [(*best(lo, hi), lo, hi) for lo, hi in parts]
        gain, at, lo, hi = max(gains)
        if gain <= 1e-9:
            break
        parts.remove((lo, hi))
        parts += [(lo, at), (at, hi)]
    values = np.zeros(len(grad))
    for lo, hi in parts:
        values[lo:hi] = grad[lo:hi].sum() / (hess[lo:hi].sum() + ridge)
    return values


def _pair_tree(grad: np.ndarray, hess: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """A tree of depth two on a grid: one cut of the first feature, then one of the second on either side."""

    def worth(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g**2 / (h + ridge)

    g, h = grad.cumsum(0), hess.cumsum(0)
    best_gain, best_values = 0.0, np.zeros_like(grad)
    for cut in range(1, len(grad)):
        gain, values = 0.0, np.zeros_like(grad)
        for rows, sg, sh in ((slice(0, cut), g[cut - 1], h[cut - 1]), (slice(cut, None), g[-1] - g[cut - 1], h[-1] - h[cut - 1])):
            cg, ch = sg.cumsum(), sh.cumsum()
            both = worth(cg[:-1], ch[:-1]) + worth(cg[-1] - cg[:-1], ch[-1] - ch[:-1])
            k = int(np.argmax(both)) + 1
            gain += float(both[k - 1])
            values[rows, :k] = cg[k - 1] / (ch[k - 1] + ridge)
            values[rows, k:] = (cg[-1] - cg[k - 1]) / (ch[-1] - ch[k - 1] + ridge)
        gain -= float(worth(grad.sum(), hess.sum()))
        if gain > best_gain:
            best_gain, best_values = gain, values
    return best_gain, best_values


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """Boosts the tables. With one class or no rows the model is the smoothed share of label 1."""
    share = float((weight @ y + 1) / (weight.sum() + 2)) if len(y) else 0.5
    model = Model(base=float(np.log(share / (1 - share))))
    if len(y) < 2 or y.min() == y.max():
        return model
    for f in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])))
        model.tables.append(np.zeros(len(model.edges[f]) + 1))
        model.coarse.append(np.arange(len(model.edges[f]) + 1) * PAIR_BINS // (len(model.edges[f]) + 1))
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(CYCLES):
        for f, b in enumerate(bins):
            grad, hess = slopes()
            n = len(model.tables[f])
            step = RATE * _tree(np.bincount(b, grad, n), np.bincount(b, hess, n))
            model.tables[f] += step
            total += step[b]
    places = [c[b] for c, b in zip(model.coarse, bins, strict=True)]

    def grid(f: int, g: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(places[f] * PAIR_BINS + places[g], values, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)

    grad, hess = slopes()
    ranked = sorted(((_pair_tree(grid(f, g, grad), grid(f, g, hess))[0], f, g) for f in range(len(bins)) for g in range(f)), reverse=True)
    model.pairs = [(f, g, np.zeros((PAIR_BINS, PAIR_BINS))) for _, f, g in ranked[:PAIRS]]
    for _ in range(PAIR_CYCLES):
        for f, g, values in model.pairs:
            grad, hess = slopes()
            step = RATE * _pair_tree(grid(f, g, grad), grid(f, g, hess))[1]
            values += step
            total += step[places[f], places[g]]
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fits on at most ``per_class`` labelled documents of each class, none of them held out.

    The texts become numbers in the tasks; only those of the bounded sample reach the driver.
    """
    in_small_batches(docs.sparkSession)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([features(t or "") for t in batch["text"].to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], x, batch["label"], batch["weight"]], ["doc_id", "x", "label", "weight"])

    texts = training_texts(docs, labels, label, per_class)
    rows = texts.mapInArrow(measured, "doc_id long, x array<double>, label int, weight double").groupBy("doc_id")
    sample = sorted(rows.agg(F.min("x"), F.first("label"), F.first("weight")).collect(), key=lambda r: r[0])
    x = np.array([r[1] for r in sample]).reshape(len(sample), len(FEATURES))
    return fit(x, np.array([r[2] for r in sample], float), np.array([r[3] for r in sample], float))


def score_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All rows with ``held_out``, ``score`` (0 to 1) and ``predicted``. One pass, no shuffle, whole texts.

    A null or empty text has features of zero and is scored like others; repeated rows are scored each; an empty table gives
    no rows; columns of the input named like the new ones are replaced.
    """
    in_small_batches(docs.sparkSession)
    docs = docs.select(*(c for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")))
    (name,) = private(docs, "score")
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t or "") for t in batch["text"].to_pylist()], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x), pa.float64())], [*batch.schema.names, name])

    rows = docs.mapInArrow(scored, schema).withColumnRenamed(name, "score")
    return rows.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= threshold).cast("int")})

"""Toxicity: a linear-chain conditional random field over the words of a sentence tags toxic spans.

Labels are of documents, so words are labelled first: a word of a toxic document is toxic if it, or its beginning, occurs far
more often in toxic documents than in others. The field learns from sentences with such labels; forward-backward marginals of
all words of a text are summed up to a score of the document, and words more likely toxic than not are the offending spans.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import in_small_batches, kept, private
from chunklake.llm.labelled import SAMPLE_PER_CLASS, held_out, training_texts

THRESHOLD = 0.5
#: A unit (a word or its beginning) is evidence if the odds of toxic documents are so many times higher where it occurs,
#: and so many toxic documents have it. The best ones, up to a bound on the model, are kept.
ODDS, SUPPORT, MOST_UNITS = 4.0, 3, 20000
#: Sentences the field learns from, at most, and their length in words.
MOST_SENTENCES, MOST_WORDS = 20000, 200
#: Of sentences without evidence one in so many is kept for learning, with that weight.
EVERY = 20
STEPS, RATE, RIDGE = 200, 0.8, 0.001
#: A fit has settled where the slope of its likelihood is no longer than this.
SETTLED = 1e-6
#: A unit map of a task is written out once it has so many entries.
FLUSH = 400_000

_TOKEN = re.compile(r"\w+|[.!?\n]")
_BREAKS = frozenset(".!?\n")


def units(word: str) -> list[str]:
    """The word itself and its beginnings of four to eight letters."""
    return [word, *(word[:k] + "^" for k in range(4, min(8, len(word) - 1) + 1))]


def _exp(x: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(x, -30, 30))


@dataclass
class Field:
    """Weights for toxic against clean: of units of the word itself, the word before and the word after; ``moves[a, b]``."""

    bias: float = -6.0
    own: dict[str, float] = field(default_factory=dict)
    before: dict[str, float] = field(default_factory=dict)
    after: dict[str, float] = field(default_factory=dict)
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: Of the document: weights of 1, the highest marginal, the log of their sum, and their share of the words.
    document: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.0, 0.0, 0.0]))


def marginals(emission: np.ndarray, begin: np.ndarray, length: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over sentences of two states, all sentences a word at a time.

    Gives for each word the probability of the toxic state, and the forward and backward odds.
    """
    m = np.exp(moves)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    e = _exp(emission)
    forward, backward = np.empty_like(e), np.ones_like(e)
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), side="left")  # sentences longer than t words
    for t in range(longest):
        at = begin[: active[t]] + t
        if t == 0:
            forward[at] = e[at]
        else:
            r = forward[at - 1]
            forward[at] = np.clip(e[at] * (r * m[1, 1] + m[0, 1]) / (r * m[1, 0] + m[0, 0]), 1e-30, 1e30)
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        r = e[at + 1] * backward[at + 1]
        backward[at] = np.clip((r * m[1, 1] + m[1, 0]) / (r * m[0, 1] + m[0, 0]), 1e-30, 1e30)
    odds = forward * backward
    return odds / (1 + odds), forward, backward


class Reader:
    """Turns texts into emissions, remembering the words it met."""

    def __init__(self, model: Field, most_words: int = 1_000_000):
        self.model, self.most_words = model, most_words
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.weights = np.zeros((0, 3))
        self.breaks = np.zeros(0, bool)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words' emissions, the sentences' begins and lengths among them, and where each text begins."""
        if len(self.ids) > self.most_words:
            self.clear()
        lookup = self.ids.__getitem__
        parts = [np.fromiter(map(lookup, _TOKEN.findall(t.lower())), np.int64) for t in texts]
        self._learn()
        tokens = np.concatenate([np.append(p, -1) for p in parts]) if parts else np.zeros(0, np.int64)
        text_of = np.repeat(np.arange(len(parts)), [len(p) + 1 for p in parts])
        stop = np.where(tokens < 0, True, self.breaks[tokens]) if len(self.breaks) else tokens < 0
        sentence = np.cumsum(stop)
        word = ~stop
        ids, sentence, text_of = tokens[word], sentence[word], text_of[word]
        w = self.weights[ids] if len(ids) else np.zeros((0, 3))
        emission = self.model.bias + w[:, 0]
        linked = sentence[1:] == sentence[:-1]
        emission[1:] += np.where(linked, w[:-1, 1], 0)
        emission[:-1] += np.where(linked, w[1:, 2], 0)
        begin = np.flatnonzero(np.concatenate([[True], ~linked])) if len(ids) else np.zeros(0, np.int64)
        length = np.diff(np.append(begin, len(ids)))
        return emission, begin, length, np.searchsorted(text_of, np.arange(len(parts) + 1))

    def _learn(self) -> None:
        new = list(self.ids)[len(self.weights) :]
        model, rows = self.model, np.zeros((len(new), 3))
        for n, word in enumerate(new):
            parts = [u for u in units(word) if u in model.own]
            if parts:
                rows[n] = [sum(w.get(u, 0.0) for u in parts) for w in (model.own, model.before, model.after)]
        self.weights = np.concatenate([self.weights, rows])
        self.breaks = np.concatenate([self.breaks, np.array([w in _BREAKS for w in new], bool)])

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Per text the numbers of ``Field.document``, and which of its words are more likely toxic than not."""
        emission, begin, length, starts = self.read(texts)
        toxic = marginals(emission, begin, length, self.model.moves)[0]
        sums = np.diff(np.concatenate([[0.0], np.cumsum(toxic)])[starts])
        most = np.zeros(len(texts))
        some = np.diff(starts) > 0
        if some.any():
            most[some] = np.maximum.reduceat(toxic, starts[:-1][some])
        share = sums / np.maximum(np.diff(starts), 1)
        rows = np.stack([np.ones(len(texts)), most, np.log1p(sums), np.sqrt(share)], 1)
        return rows, [np.flatnonzero(toxic[a:b] >= 0.5) if m >= 0.5 else np.zeros(0, np.int64) for a, b, m in zip(starts, starts[1:], most, strict=False)]


def fit_field(sentences: list[tuple[list[str], list[int], float]], evidence: list[str]) -> Field:
    """Gradient ascent on the log-likelihood of the tagged sentences, with a ridge; sentences are (words, tags, weight)."""
    model = Field(own=dict.fromkeys(evidence, 0.0))
    if not sentences or not evidence:
        return model
    number = {u: n for n, u in enumerate(evidence)}
    words = [w for s in sentences for w in s[0]]
    tags = np.array([t for s in sentences for t in s[1]], float)
    length = np.array([len(s[0]) for s in sentences])
    weight = np.repeat([s[2] for s in sentences], length)
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    first = np.zeros(len(words), bool)
    first[begin] = True
    pairs = [(n, number[u]) for n, w in enumerate(words) for u in units(w) if u in number]
    at, unit = np.array(pairs, np.int64).reshape(-1, 2).T
    # the same units as features of the neighbours in the sentence
    after_ok = (at + 1 < len(words)) & ~first[np.minimum(at + 1, len(words) - 1)]
    before_ok = ~first[at]
    places = [(at, unit), (at[after_ok] + 1, unit[after_ok]), (at[before_ok] - 1, unit[before_ok])]
    theta = np.zeros((3, len(evidence)))
    size = np.array([np.bincount(u, weight[p], len(evidence)) for p, u in places]) + 1
    moves, bias = np.zeros((2, 2)), model.bias
    linked = np.flatnonzero(~first)
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[linked - 1].astype(int), tags[linked].astype(int)), weight[linked])
    total = weight.sum()
    grown, grown_moves, grown_bias = np.full_like(theta, 1e-8), np.full((2, 2), 1e-8), 1e-8
    for _ in range(STEPS):
        emission = np.full(len(words), bias)
        for row, (p, u) in zip(theta, places, strict=True):
            emission += np.bincount(p, row[u], len(words))
        toxic, forward, backward = marginals(emission, begin, length, moves)
        miss = weight * (tags - toxic)
        step = np.array([np.bincount(u, miss[p], len(evidence)) for p, u in places]) / size - RIDGE * theta
        grown += step**2
        theta += RATE * step / np.sqrt(grown)
        # expected moves between neighbours
        e, m = _exp(emission), np.exp(moves)
        r, after = forward[linked - 1], e[linked] * backward[linked]
        cells = np.stack([np.ones(len(linked)) * m[0, 0], after * m[0, 1], r * m[1, 0], r * after * m[1, 1]])
        cells *= weight[linked] / cells.sum(0)
        move_step = (seen - cells.sum(1).reshape(2, 2)) / total - RIDGE * moves
        grown_moves += move_step**2
        moves += RATE * move_step / np.sqrt(grown_moves)
        bias_step = miss.sum() / total
        grown_bias += bias_step**2
        bias += RATE * bias_step / np.sqrt(grown_bias)
    model.bias, model.moves = float(bias), moves
    model.own, model.before, model.after = (dict(zip(evidence, row.tolist(), strict=True)) for row in theta)
    return model


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Newton steps for a logistic model with a ridge, each halved until the likelihood grows; raises if they do not settle."""

    def likelihood(theta: np.ndarray) -> float:
        z = x @ theta
        return float(weight @ (y * z - np.logaddexp(0, z)) - ridge / 2 * theta @ theta)

    theta = np.zeros(x.shape[1])
    now = likelihood(theta)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -700, 700)))
        slope = x.T @ (weight * (y - p)) - ridge * theta
        if np.linalg.norm(slope) < SETTLED:
            return theta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        for _ in range(60):
            after = likelihood(theta + step)
            if after >= now - 1e-12 * abs(now):  # rounding, near the end
                break
            step /= 2
        theta, now = theta + step, after
    raise RuntimeError(f"the logistic model does not settle: slope {np.linalg.norm(slope):.2g}")


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each unit, by label, summed up before the shuffle."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        every = list({*counts[0], *counts[1]})
        columns = [pa.array(every, pa.string()), *(pa.array([c[u] for u in every], pa.int64()) for c in counts)]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, ["unit", "clean", "toxic"])

    for batch in batches:
        for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
            counts[label].update({u for w in set(re.findall(r"\w+", (text or "").lower())) for u in units(w)})
            if len(counts[0]) + len(counts[1]) > FLUSH:
                yield out()
    yield out()


def _tagged(evidence: frozenset[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sentences with the tags that evidence gives them; of those without any one in ``EVERY``, drawn by a hash."""

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[list[str], list[int], float]] = []
            for text, label, weight in zip(*(batch[c].to_pylist() for c in ("text", "label", "weight")), strict=True):
                for sentence in re.split(r"[.!?\n]", (text or "").lower()):
                    drawn = zlib.crc32(sentence.encode()) % EVERY == 0
                    words = re.findall(r"\w+", sentence)
                    for k in range(0, len(words), MOST_WORDS):
                        part = words[k : k + MOST_WORDS]
                        held = [int(any(u in evidence for u in units(w))) for w in part]
                        if any(held) or drawn:
                            rows.append((part, held if label else [0] * len(part), weight * (1.0 if any(held) else EVERY)))
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            kinds = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["words", "tags", "weight"])

    return tag


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> Field:
    """Fits on at most ``per_class`` labelled documents of each class, none of them held out.

    Evidence is counted in the tasks; the bounded list of units, a bounded sample of sentences, and four numbers per sampled
    document reach the driver.
    """
    in_small_batches(docs.sparkSession)
    texts = kept(training_texts(docs, labels, label, per_class).dropDuplicates(["doc_id"]), "toxic-sample")
    sizes = {row["label"]: row["n"] for row in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    counts = texts.select("text", "label").mapInArrow(_count_units, "unit string, clean long, toxic long")
    counts = counts.groupBy("unit").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = ((F.col("toxic") + 0.5) / (sizes.get(1, 0) + 1)) / ((F.col("clean") + 0.5) / (sizes.get(0, 0) + 1))
    strong = counts.withColumn("odds", odds).filter((F.col("odds") >= ODDS) & (F.col("toxic") >= SUPPORT))
    strong = strong.orderBy((F.col("toxic") * F.ln("odds")).desc(), "unit").limit(MOST_UNITS)
    evidence = [row["unit"] for row in strong.select("unit").collect()]
    sample = texts.mapInArrow(_tagged(frozenset(evidence)), "words array<string>, tags array<int>, weight double")
    sample = sample.orderBy(F.xxhash64(F.lit("sample"), "words"), "weight").limit(MOST_SENTENCES).collect()
    model = fit_field([(r["words"], r["tags"], r["weight"]) for r in sample if r["words"]], evidence)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            rows, _ = reader.score([t or "" for t in batch["text"].to_pylist()])
            columns = [pa.array(list(rows), pa.list_(pa.float64())), batch["label"], batch["weight"]]
            yield pa.RecordBatch.from_arrays(columns, ["x", "label", "weight"])

    rows = texts.mapInArrow(summed, "x array<double>, label int, weight double").collect()
    if len({r["label"] for r in rows}) == 2:
        x, y, w = (np.array([r[k] for r in rows], float) for k in range(3))
        model.document = fit_logistic(x, y, w)
    else:  # one class, or nothing, was labelled
        n, toxic = len(rows), sum(r["label"] for r in rows)
        model.document[0] = np.log((toxic + 1) / (n - toxic + 1))
    return model


def score_toxicity(docs: DataFrame, model: Field, threshold: float = THRESHOLD) -> DataFrame:
    """All rows with ``held_out``, ``score`` (0 to 1), ``predicted`` and ``spans``: the offending words as ``start:end``, comma-joined.

    One pass, no shuffle, whole texts; places are code points. A null or empty text has no words and the score of one without
    evidence; repeated rows are scored each; an empty table gives no rows; columns named like the new ones are replaced.
    """
    in_small_batches(docs.sparkSession)
    docs = docs.select(*(c for c in docs.columns if c.lower() not in ("held_out", "score", "predicted", "spans")))
    score, spans = private(docs, "score", "spans")
    schema = docs.withColumns({score: F.lit(0.0), spans: F.lit("")}).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            rows, toxic = reader.score(texts)
            found = 1 / (1 + _exp(-(rows @ model.document)))
            marked = [_spans(t, places) if len(places) else "" for t, places in zip(texts, toxic, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64()), pa.array(marked, pa.string())], [*batch.schema.names, score, spans])

    rows = docs.mapInArrow(scored, schema).withColumnsRenamed({score: "score", spans: "spans"})
    return rows.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= threshold).cast("int")})


def _spans(text: str, places: np.ndarray) -> str:
    """Where the words of those numbers stand. Lower case that is longer than its letter is counted by the letter."""
    low = text.lower()
    if len(low) != len(text):
        back = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
    else:
        back = None
    wanted, found = set(places.tolist()), []
    words = (m for m in _TOKEN.finditer(low) if m.group() not in _BREAKS)
    for n, match in enumerate(words):
        if n in wanted:
            start, end = match.span()
            found.append(f"{start}:{end}" if back is None else f"{back[start]}:{back[end - 1] + 1}")
    return ",".join(found)

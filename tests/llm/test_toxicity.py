import itertools
import math
import random
import re

import numpy as np
import pytest

from chunklake.llm.toxicity import Field, Reader, fit_logistic, fit_toxicity, marginals, score_toxicity, units
from tests.llm.conftest import sentence

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(500):
        toxic = rng.random() < 0.3
        words = sentence(rng, rng.randrange(20, 80)).split()
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", f"zorkle{rng.randrange(99)}"]))
        rows.append((i, " ".join(w + "." * (rng.random() < 0.1) for w in words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_marginals_equal_the_sum_over_all_taggings():
    rng = np.random.default_rng(2)
    lengths = np.array([3, 1, 6, 4])
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    emission, moves = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    got = marginals(emission, begin, lengths, moves)[0]
    for b, n in zip(begin, lengths, strict=True):
        total, toxic = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(sum(emission[b + t] for t in range(n) if tags[t]) + sum(moves[tags[t], tags[t + 1]] for t in range(n - 1)))
            total += weight
            toxic += weight * np.array(tags)
        assert np.allclose(got[b : b + n], toxic / total)


def test_held_out_accuracy_and_spans(spark, documents, corpus):
    rows, labels = corpus
    docs = documents(rows)
    model = fit_toxicity(docs, spark.createDataFrame(labels[:400], LABELS))
    found = {r["doc_id"]: r for r in score_toxicity(docs, model).collect()}
    unseen = [i for i in found if found[i]["held_out"] or i >= 400]
    assert np.mean([found[i]["predicted"] == labels[i][2] for i in unseen]) > 0.95
    for i, r in found.items():
        for span in filter(None, r["spans"].split(",")):
            start, end = map(int, span.split(":"))
            assert rows[i][1][start:end].startswith(("idiot", "scum", "zorkle"))
    assert sum(bool(found[i]["spans"]) for i in found if labels[i][2]) > 0.9 * sum(x[2] for x in labels)


def test_odd_rows_and_clashing_names(spark, documents, odd_rows, corpus):
    rows, labels = corpus
    model = fit_toxicity(documents(rows), spark.createDataFrame(labels + [(1, 1, None), (None, 1, 1)], LABELS))
    text = "İİ You IDIOT! Äh, scum? no"
    docs = documents([*odd_rows, (77, text), (78, " ".join(["idiot"] * 5000))], ", Spans int, _score int", (1, 2))
    got = score_toxicity(docs, model).collect()
    assert len(got) == len(odd_rows) + 2 and {r["_score"] for r in got} == {2} and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert [text[int(s.split(":")[0]) : int(s.split(":")[1])] for s in by[77]["spans"].split(",")] == ["IDIOT", "scum"]
    assert by[78]["predicted"] == 1 and by[3]["score"] == by[4]["score"] and by[3]["predicted"] == 0
    assert score_toxicity(documents([]), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 1)]])
def test_without_two_classes_every_score_is_one_number(spark, documents, labels):
    docs = documents([(1, "some text"), (2, None), (3, "other")])
    got = score_toxicity(docs, fit_toxicity(docs, spark.createDataFrame(labels, LABELS))).collect()
    assert len({r["score"] for r in got}) == 1


def test_scores_equal_all_ways_of_tagging(spark, documents):
    """The score from its definition: every sequence of tags of every sentence, weighed, added up word by word."""
    model = Field(
        bias=-1.5, own={"bad": 3.0, "idio^": 2.0, "idiot": 1.5, "day": -1.0}, before={"bad": 0.7, "you": 0.4}, after={"idiot": 0.9, "day": -0.3},
        moves=np.array([[0.2, -0.4], [-0.7, 0.6]]), document=np.array([-3.0, 4.0, 1.0, 0.5]),
    )
    texts = ["a bad day. You idiots, BAD idiot!", "", "bad", "you you you", "nice day\nbad you idiot day you bad. x", "...!", None]

    def weight(words, k):
        part = sum(model.own.get(u, 0) for u in units(words[k])) + model.bias
        if k:
            part += sum(model.before.get(u, 0) for u in units(words[k - 1]))
        if k + 1 < len(words):
            part += sum(model.after.get(u, 0) for u in units(words[k + 1]))
        return part

    # features of a word count only where it has a unit of its own evidence
    model.own |= {u: model.own.get(u, 0.0) for u in [*model.before, *model.after]}

    def score(text):
        marks = []
        for sentence in re.split(r"[.!?\n]", (text or "").lower()):
            words = re.findall(r"\w+", sentence)
            odds = np.zeros(len(words))
            total = 0.0
            for tags in itertools.product((0, 1), repeat=len(words)):
                exponent = sum(weight(words, k) * t for k, t in enumerate(tags)) + sum(model.moves[a, b] for a, b in itertools.pairwise(tags))
                total += math.exp(exponent)
                odds += np.array(tags) * math.exp(exponent)
            marks += list(odds / total) if words else []
        most, sums = max(marks, default=0), sum(marks)
        x = [1, most, math.log1p(sums), math.sqrt(sums / max(len(marks), 1))]
        return 1 / (1 + math.exp(-float(np.dot(x, model.document))))

    found = score_toxicity(documents(list(enumerate(texts))), model).collect()
    for r in found:
        assert r["score"] == pytest.approx(score(texts[r["doc_id"]]), abs=1e-9)


@pytest.mark.parametrize("seed", range(6))
def test_the_logistic_model_settles(seed):
    # few positives, features of different size that all but separate them, weights: clipped steps once went round in circles here
    rng = np.random.default_rng(seed)
    y = (rng.random(3000) < 0.1).astype(float)
    most = np.clip(rng.normal(np.where(y > 0, 0.97, 0.03), 0.05), 0, 1)
    sums = np.log1p(np.where(y > 0, rng.exponential(3, 3000), rng.exponential(0.02, 3000)))
    x = np.stack([np.ones(3000), most, sums, np.sqrt(sums / 300)], 1)
    weight = np.where(y > 0, 1.0, 4.5)
    theta = fit_logistic(x, y, weight)
    p = 1 / (1 + np.exp(-x @ theta))
    assert np.linalg.norm(x.T @ (weight * (y - p)) - 0.01 * theta) < 1e-6
    assert ((p >= 0.5) == (y > 0)).mean() > 0.98


def test_a_reader_that_forgets_scores_alike():
    model = Field(own={"bad": 4.0, "badl^": 3.0}, before={"bad": 1.0}, after={"bad": -1.0})
    texts = ["a bad day. badly done", "", "bad", "...", "x bad bad\nbad"]
    whole, _ = Reader(model).score(texts)
    small = Reader(model, most_words=1)
    assert np.allclose(whole, np.concatenate([small.score([t])[0] for t in texts]))

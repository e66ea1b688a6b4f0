import random

import numpy as np
import pytest

from chunklake.llm.quality import FEATURES, features, fit, fit_quality, score_quality
from tests.llm.conftest import sentence

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        text = sentence(rng, rng.randrange(5, 60))
        rows.append((i, text.capitalize() + "." if good else rng.choice([text.upper().replace(" ", "!! "), " ".join([text[:5]] * 40), text.replace(" ", " | ")])))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy(spark, documents, corpus):
    rows, labels = corpus
    frame = spark.createDataFrame(labels[:300], LABELS)
    docs = documents(rows)
    found = {r["doc_id"]: r for r in score_quality(docs, fit_quality(docs, frame)).collect()}
    unseen = [i for i in found if found[i]["held_out"] or i >= 300]
    assert len(unseen) > 100 and np.mean([found[i]["predicted"] == labels[i][1] for i in unseen]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found.values())


def test_labels_of_held_out_rows_do_not_matter(spark, documents, corpus):
    rows, labels = corpus
    docs = documents(rows)
    held = {r["doc_id"] for r in score_quality(docs, fit(np.zeros((0, len(FEATURES))), np.zeros(0), np.zeros(0))).collect() if r["held_out"]}
    turned = [(i, 1 - q if i in held else q, t) for i, q, t in labels]
    scores = [[r["score"] for r in score_quality(docs, fit_quality(docs, spark.createDataFrame(x, LABELS))).orderBy("doc_id").collect()] for x in (labels, turned)]
    assert 50 < len(held) < 110 and scores[0] == scores[1]


def test_a_pair_is_learned_that_no_single_feature_tells():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit(x, y, np.ones(4000))
    assert {(f, g) for f, g, _ in model.pairs} >= {(1, 0)}
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


def test_scores_equal_brute_force(spark, documents, corpus):
    """Table by table and row by row: of each feature the value of the bin it falls in, of each pair that of its cell."""
    rows, labels = corpus
    docs = documents([*rows, (900, None), (901, "")])
    model = fit_quality(docs, spark.createDataFrame(labels, LABELS))
    texts = {i: t or "" for i, t in [*rows, (900, None), (901, "")]}
    for r in score_quality(docs, model).collect():
        x = features(texts[r["doc_id"]])
        bins = [sum(edge <= value for edge in edges) for edges, value in zip(model.edges, x, strict=True)]
        total = model.base + sum(table[b] for table, b in zip(model.tables, bins, strict=True))
        for f, g, cells in model.pairs:
            total += cells[model.coarse[f][bins[f]], model.coarse[g][bins[g]]]
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)


def test_odd_rows_and_clashing_names(spark, documents, odd_rows, corpus):
    docs = documents(odd_rows, ", Score string, _score int", ("x", 4))
    model = fit_quality(documents(corpus[0]), spark.createDataFrame(corpus[1] + [(1, None, None), (None, 1, 1), (2, 0, 0)], LABELS))
    rows = score_quality(docs, model).collect()
    assert len(rows) == len(odd_rows) and {r["_score"] for r in rows} == {4} and all(0 <= r["score"] <= 1 for r in rows)
    empty = [r["score"] for r in rows if r["text"] in (None, "")]
    assert len(set(empty)) == 1


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(99, 0, 0)]])
def test_without_two_classes_every_score_is_one_number(spark, documents, labels):
    docs = documents([(1, "some text"), (2, None)])
    rows = score_quality(docs, fit_quality(docs, spark.createDataFrame(labels, LABELS))).collect()
    assert len({r["score"] for r in rows}) == 1 and len(rows) == 2
    assert score_quality(documents([]), fit_quality(documents([]), spark.createDataFrame([], LABELS))).count() == 0


def test_features_of_nothing():
    assert features("") == [0.0] * len(FEATURES) and len(features(" \n")) == len(FEATURES)

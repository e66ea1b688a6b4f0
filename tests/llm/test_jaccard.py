import random
import re

import numpy as np
import pytest

from chunklake.llm import jaccard
from chunklake.llm.graph import components
from chunklake.llm.jaccard import drop_duplicates, duplicate_classes, least_agreeing
from tests.llm.conftest import sentence


def runs(text):
    words = re.findall(r"\w+", (text or "").lower())
    return frozenset(" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset([("wordless", text or "")])


def brute(rows):
    """(class, links to documents, links to texts) by comparing all pairs."""
    sets = [runs(t) for _, t in rows]
    names = [" ".join(re.findall(r"\w+", (t or "").lower())) or ("wordless", t or "") for _, t in rows]
    parent, links, texts = list(range(len(rows))), [0] * len(rows), [set() for _ in rows]

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                if names[i] != names[j]:
                    texts[i].add(names[j])
                    texts[j].add(names[i])
                parent[max(root(i), root(j))] = min(root(i), root(j))
    first = {}
    for n, (i, _) in sorted(enumerate(rows), key=lambda r: (r[1][0] is None, r[1][0] or 0)):
        first.setdefault(root(n), i)
    return sorted(((i, first[root(n)], links[n], len(texts[n])) for n, (i, _) in enumerate(rows)), key=repr)


def corpus(seed, families=25, size=14):
    """Families of texts that differ by a few words, so that similarities spread around the threshold."""
    rng, rows = random.Random(seed), []
    for _ in range(families):
        base = sentence(rng, rng.randrange(3, 120), 2000).split()
        for _ in range(rng.randrange(1, size)):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(9999)}"
            rows.append(" ".join(words) if rng.random() < 0.8 else ", ".join(words).upper())
    rng.shuffle(rows)
    return list(enumerate(rows, 1))


def found(frame):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"], r["n_text_links"]) for r in duplicate_classes(frame).collect()), key=repr)


@pytest.mark.parametrize("block, tile", [(1 << 20, 512), (300, 4)])
def test_equals_all_pairs(documents, monkeypatch, block, tile):
    """Also where a group is cut into blocks and a block into tiles."""
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard, "TILE", tile)
    rows = corpus(7) if tile > 4 else corpus(8, 4, 40)
    expected = brute(rows)
    assert sum(e[2] for e in expected) > 100
    assert found(documents(rows)) == expected


def test_a_hot_group_of_copies_and_near_copies(documents):
    rng = random.Random(9)
    base = sentence(rng, 100, 5000)
    rows = [(i, base) for i in range(150)] + [(i, f"{base} tail{i}") for i in range(150, 250)] + [(i, sentence(rng, 20, 5000)) for i in range(250, 300)]
    got = found(documents(rows))
    assert got == brute(rows)
    assert got[0][1:] == (0, 249, 100)


def test_odd_rows(documents, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    docs = documents(odd_rows, ", md5 string, class_id int, _place int", ("x", 1, 2))
    assert found(docs) == brute(rows)
    kept = drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, (1, 3, 5, 6, None, 8, 9, 10)))


@pytest.mark.parametrize("rows", [[], [(1, "x")], [(1, None), (2, "")]])
def test_few_rows(documents, rows):
    assert found(documents(rows)) == brute(rows)
    assert drop_duplicates(documents(rows)).count() == min(len(rows), 1)


def test_one_of_each_class_stays(documents):
    rows = corpus(11, 10)
    classes = {e[1] for e in brute(rows)}
    assert sorted(r["doc_id"] for r in drop_duplicates(documents(rows)).collect()) == sorted(classes)


def test_pruning_keeps_what_may_reach_the_threshold():
    need = least_agreeing()
    rng = np.random.default_rng(1)
    agree = rng.random((20000, jaccard.VALUES)) < 0.8
    lost = np.zeros(20000, bool)
    for n, least in need.items():
        lost |= agree[:, :n].sum(1) < least
    assert lost.sum() <= 1
    low = rng.random((2000, jaccard.VALUES)) < 0.3
    assert (low[:, :32].sum(1) < need[32]).mean() > 0.75


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 50)] + [(90, 91), (91, 92), (92, 90)]])
def test_components(spark, edges):
    got = {(r["node"], r["root"]) for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {(n, root(n)) for n in nodes}

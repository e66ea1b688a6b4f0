import hashlib
import random
from collections import Counter

import pytest

from chunklake.llm import common, merkle
from chunklake.llm.merkle import differing_paragraphs, fingerprint_documents, fingerprints, leaves_of, likeness
from tests.llm.conftest import sentence


def order(row):
    return (row[0] is None, row[0] or 0)


@pytest.mark.parametrize("batch", [3, 2000])
def test_edits_and_likeness_equal_brute_force(documents, monkeypatch, batch):
    monkeypatch.setattr(common, "BATCH_ROWS", batch)
    rng = random.Random(1)
    rows = [(7 * i - 300, "\n".join(sentence(rng, rng.randrange(0, 30)) for _ in range(rng.randrange(1, 9)))) for i in range(90)]
    rows[5] = (rows[5][0], rows[6][1])
    rows[9] = (rows[9][0], None)
    shuffled = rng.sample(rows, len(rows))
    got = {r["doc_id"]: r for r in fingerprint_documents(documents(shuffled)).collect()}
    assert len(got) == len(rows)
    texts = [t or "" for _, t in rows]
    for n, (doc_id, _) in enumerate(rows):
        text, following, r = texts[n], texts[(n + 1) % len(rows)], got[doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert [r["fingerprint"], r["edited_fingerprint"]] == fingerprints([text, edited])
        own, other, after = fingerprints([text, edited, following])
        assert (r["near_edited"], r["near_next"]) == (likeness(own, other), likeness(own, after))
    assert got[rows[5][0]]["near_next"] == 1.0


def test_equal_fingerprints_mean_equal_texts():
    texts = ["", " ", "\n", "\n\n", "a", "a ", " a", "a b", "a  b", "a\nb", "a \nb", "a\n b", "a \n b", "b a", "a\n\nb", "ab", "é", "e"]
    marks = fingerprints(texts)
    assert len(set(marks)) == len(texts) and marks == [fingerprints([t])[0] for t in texts]
    assert fingerprints([]) == []


@pytest.mark.parametrize("lane", [0, 1])
def test_texts_that_collide_in_one_hash_have_different_roots(monkeypatch, lane):
    true = merkle.word_hashes

    def collided(words):
        hashes = true(words).copy()
        hashes[:, lane] = 1 << 20  # ends a leaf, equal for all words
        return hashes

    monkeypatch.setattr(merkle, "word_hashes", collided)
    one, other = fingerprints(["a b c\nd", "a x c\nd"])
    assert one[:32] != other[:32]
    assert one[16 * lane :][:16] == other[16 * lane :][:16] or lane  # the first hash also tells where leaves end
    assert fingerprints(["a b c\nd"]) == [one]


def test_fingerprint_and_likeness_from_their_definition():
    """A slow tree, node by node, with Python's whole numbers."""
    mask = (1 << 64) - 1

    def mixed(x):
        x = (x ^ (x >> 31)) * 0x9E3779B97F4A7C15 & mask
        x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & mask
        return x ^ (x >> 32)

    def fold(hashes, seed):
        total = sum(mixed(h + mixed(k + seed) & mask) for k, h in enumerate(hashes))
        return mixed(total + len(hashes) * (seed | 1) & mask)

    def cut(items, ends):
        out = [[]]
        for item in items:
            out[-1].append(item)
            if ends(item, out[-1]):
                out.append([])
        return out if out[-1] else out[:-1]

    def slow(text):
        words = text.replace("\n", " \n ").split(" ")
        both = [tuple(int(h) for h in row) for row in merkle.word_hashes(words)]
        leaves, paragraphs = [], []
        for lines in cut(list(zip(words, both, strict=True)), lambda w, _: w[0] == "\n"):
            row = cut([b for _, b in lines], lambda b, part: b[0] & 3 == 0 or len(part) == 16)
            row = [(fold([b[0] for b in part], 11), fold([b[1] for b in part], 13)) for part in row]
            leaves += row
            paragraphs.append((fold([b[0] for b in row], 23), fold([b[1] for b in row], 29), len(row)))
        groups = cut(paragraphs, lambda b, _: b[0] & 7 == 0)
        sections = [(fold([b[0] for b in g], 37), fold([b[1] for b in g], 41), len(g)) for g in groups]
        root = fold([b[0] for b in sections], 53), fold([b[1] for b in sections], 71)
        digits = ["".join(f"{b[0] >> 24:010x}{b[2]:06x}" for b in level) for level in (sections, paragraphs)]
        return ".".join(["".join(f"{r:016x}" for r in root), *digits, "".join(f"{b[0] >> 24:010x}" for b in leaves)]), [b[0] >> 24 for b in leaves]

    rng = random.Random(8)
    texts = ["", "a", "\n"] + ["\n".join(sentence(rng, rng.randrange(0, 60)) for _ in range(rng.randrange(1, 30))) for _ in range(20)]
    texts += [texts[5] + " more", texts[6][:200]]
    trees = [slow(t) for t in texts]
    assert fingerprints(texts) == [f for f, _ in trees]
    for (a, mine), (b, theirs) in zip(trees, trees[1:], strict=False):
        shared = sum((Counter(mine) & Counter(theirs)).values())
        assert likeness(a, b) == (1.0 if a[:32] == b[:32] else 2 * shared / (len(mine) + len(theirs)))


def test_likeness_follows_what_is_shared():
    rng = random.Random(2)
    text = "\n".join(sentence(rng, 20) for _ in range(40))
    lines = text.split("\n")
    changed = "\n".join([*lines[:10], sentence(rng, 20), *lines[11:]])
    own, other, apart = fingerprints([text, changed, sentence(rng, 800, 9000)])
    assert likeness(own, own) == 1.0 and 0.9 < likeness(own, other) < 1 and likeness(own, apart) < 0.05
    assert differing_paragraphs(own, other) == ([10], [10]) and differing_paragraphs(own, own) == ([], [])
    assert len(leaves_of(own)) >= 40 * 20 / 16


def test_odd_rows(documents, odd_rows):
    got = fingerprint_documents(documents(odd_rows, ", range int, halo int", (1, 2))).collect()
    assert len(got) == len(odd_rows)
    assert sorted(r["n_chars"] for r in got) == sorted(len(r[1] or "") for r in odd_rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, "one text only")], [(None, "a b"), (None, "a b"), (None, None)], [(5, "x")] * 4])
def test_few_rows(documents, rows):
    got = fingerprint_documents(documents(rows)).collect()
    assert len(got) == len(rows)
    if len(rows) == 1:
        assert got[0]["near_next"] == 1.0

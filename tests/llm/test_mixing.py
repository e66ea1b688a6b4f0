import hashlib
import random
import re

import pytest

from chunklake.llm.mixing import mix_documents, mix_report
from tests.llm.conftest import sentence


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute(rows):
    """Targets by pouring until no source is above its cap, then the queue copy by copy."""
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(count(r[1]) for r in rows if r[2] == s) for s in sources}
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(sources)}
    target, free = {}, list(sources)
    while True:
        left = 1.5 * sum(size.values()) - sum(target.values())
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > 2 * size[s]]
        if not over:
            return size, target | {s: level * weight[s] for s in free}
        target |= {s: 2.0 * size[s] for s in over}
        free = [s for s in free if s not in over]


def key(row):
    return hashlib.md5(f"{'' if row[0] is None else row[0]}:{row[1] or ''}".encode()).hexdigest()


def rows_of(seed):
    rng = random.Random(seed)
    names = ["a", "b", "c", "d", None, "é"]
    return [(i, sentence(rng, rng.randrange(0, 40)), names[0] if i % 3 == 0 else rng.choice(names)) for i in range(300)]


@pytest.mark.parametrize("seed", [1, 2])
def test_queue_equals_brute_force(documents, seed):
    rows = rows_of(seed)
    size, target = brute(rows)
    got = {r["doc_id"]: r for r in mix_report(documents(rows)).collect()}
    assert len(got) == len(rows)
    taken = dict.fromkeys(got, 0)
    for s in target:
        ahead = 0
        own = sorted((r for r in rows if r[2] == s), key=key)
        goal = int(target[s] + 1e-9)
        for r in own + own:
            n = count(r[1])
            part = max(0, min(n, goal - ahead))
            got_row = got[r[0]]
            assert abs(got_row["target"] - target[s]) < 1e-6 and got_row["source_size"] == size[s] and got_row["size"] == n
            ahead += n
            taken[r[0]] += part
    assert {k: r["taken"] for k, r in got.items()} == taken


def test_mixed_rows_are_whole_and_near_their_targets(documents):
    rows = rows_of(3)
    size, target = brute(rows)
    mixed = mix_documents(documents(rows, ", finish int, _lot int", (7, 8))).collect()
    copies = {}
    for r in mixed:
        assert (r["text"], r["source"]) == rows[r["doc_id"]][1:] and r["n_chars"] == len(r["text"]) and r["finish"] == 7
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    expected = {}
    for s in target:
        ahead = 0
        own = sorted((r for r in rows if r[2] == s), key=key)
        for n, r in enumerate(own + own):
            words = count(r[1])
            if ahead + words / 2 <= target[s] if words else n < len(own):
                expected[r[0]] = expected.get(r[0], 0) + 1
            ahead += words
        taken = sum(count(r["text"]) for r in mixed if r["source"] == s)
        assert abs(taken - target[s]) <= max(count(r[1]) for r in own) / 2
    assert copies == expected


def test_odd_rows(documents, odd_rows):
    report = mix_report(documents(odd_rows)).collect()
    assert len(report) == len(odd_rows) and all(r["taken"] <= 2 * r["size"] for r in report)
    assert [r["size"] for r in report if r["doc_id"] in (3, 4, 6)] == [0, 0, 0]
    assert mix_documents(documents(odd_rows)).count() >= 5


def test_empty_and_wordless_tables(documents):
    assert mix_report(documents([])).count() == 0 and mix_documents(documents([])).count() == 0
    assert [(r["target"], r["taken"]) for r in mix_report(documents([(1, ""), (2, None)])).collect()] == [(0.0, 0)] * 2

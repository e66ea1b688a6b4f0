import random
import zlib

import pytest

from chunklake.llm import sharding
from chunklake.llm.sharding import shard_documents
from tests.llm.conftest import sentence


def shards_of(frame, shards):
    rows = frame.collect()
    for shard in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    return rows


def test_bytes_are_equal_within_a_row(documents):
    rng = random.Random(1)
    texts = [sentence(rng, rng.randrange(1, 60)) for _ in range(600)] + ["a hot text of many copies"] * 300
    rows = shards_of(shard_documents(documents(list(enumerate(texts))), 7), 7)
    assert len(rows) == len(texts)
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(7)]
    largest = max(r["size"] for r in rows)
    assert max(sizes) - min(sizes) <= 2 * largest
    for r in rows:
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 16, zlib.crc32(text), "bytes", None)


def test_splitters_are_those_of_a_full_sort(spark):
    rng = random.Random(2)
    keys = [(rng.randrange(3) if k % 3 else rng.randrange(1 << 60), rng.randrange(1 << 60), rng.randrange(1, 99)) for k in range(400)]
    frame = spark.createDataFrame(keys, "k1 bigint, k2 bigint, bytes bigint")
    total = sum(k[2] for k in keys)
    cuts = sharding.splitters(frame, 5, tolerance=0)
    for j, cut in enumerate(cuts, 1):
        below = sum(n for a, b, n in keys if (a, b) < cut)
        sums = [0]
        for _, _, n in sorted(keys):
            sums.append(sums[-1] + n)
        assert abs(below - total * j / 5) == min(abs(s - total * j / 5) for s in sums)


def test_odd_rows_and_clashing_names(documents, odd_rows):
    frame = documents(odd_rows, ", shard string, Slot int, _k1 int", ("x", 1, 2))
    rows = shards_of(shard_documents(frame, 4), 4)
    assert len(rows) == len(odd_rows)
    assert sorted(r["size"] for r in rows if r["text"] is None) == [16, 16]
    assert {r["_k1"] for r in rows} == {2}


@pytest.mark.parametrize("rows", [[], [(1, "x")]])
def test_few_rows(documents, rows):
    assert len(shards_of(shard_documents(documents(rows), 40), 40)) == len(rows)

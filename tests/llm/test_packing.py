import json
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chunklake.llm import packing, queries
from chunklake.llm.packing import TOKENIZER, Ids, Index, Weights, fill, pack_documents
from tests.llm.conftest import sentence


def truth(text, whole=Tokenizer.from_file(TOKENIZER)):
    return [*whole.encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, rows, window):
    """Every id in one piece, sequences gapless and at most a window, no padding but at powers of two."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(truth(text))
    assert by_doc.keys() == texts.keys()
    for doc_id, many in texts.items():
        for ids in {tuple(m) for m in many}:
            copies = many.count(list(ids))
            same = [p for p in by_doc[doc_id] if p["doc_tokens"] == len(ids)]
            if len({tuple(m) for m in many if len(m) == len(ids)}) == 1:
                assert sum(p["length"] for p in same) == copies * len(ids)
                cover = np.zeros(len(ids), int)
                for p in same:
                    cover[p["start"] : p["start"] + p["length"]] += 1
                    part = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4")
                    assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
                assert (cover == copies).all()
    for sequence in by_sequence.values():
        sequence.sort(key=lambda p: p["offset"])
        ends = np.cumsum([p["length"] for p in sequence])
        assert [p["offset"] for p in sequence] == [0, *ends[:-1]]
        assert ends[-1] <= window
        assert ends[-1] & (ends[-1] - 1) == 0
    return by_sequence


@pytest.mark.parametrize(
    "text",
    [
        "", "Plain words, (with) signs!", "it's 'the we'll THEY'RE o'clock 'tis x'sy", "a1b22 3.14 x_y __ ½ ² ٣ Ⅷ", "Äß naïve Straße ÉTÉ été İstanbul ΟΔΟΣ ΑΣ. σς",
        "漢字かな 한국어 😀👍🏽 עברית", "a<|endoftext|>b <|x|> <| |>", "nb sp em\u0085nel ls\x1cfs\x1fus​zw", "tab\tnl\ncr\rvt\x0bff\x0c end", "ŁÓDŹ ǅ ŉ ſ ﬁ K Å", "\x00\x01 ~` <> [x](y)",
    ],
)
def test_ids_are_the_tokenizers(text):
    texts = [text, None, "", " ", text, f" {text}\n"]
    found, ends = Ids(TOKENIZER).of(pa.array(["before", *texts, "after"]).slice(1, 6))
    assert [p.tolist() for p in np.split(found, ends)] == [*(truth(t)[:-1] for t in texts), []]


def test_ids_of_random_text(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 2000)
    rng, ids = random.Random(1), Ids(TOKENIZER)
    letters = "aabcdeEÉéßñ'’.,-!?<|>_ 019½́  漢Σσ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 25))) for _ in range(3000)]
    # all plain characters, long pieces too
    texts += ["".join(chr(rng.choice([rng.randrange(33, 127), rng.randrange(161, 592), 97 + rng.randrange(26), 32])) for _ in range(200)) for _ in range(400)]
    texts += [chr(c) + tail for c in [*range(33, 127), *range(161, 592)] for tail in ("", "a", "#", "Σ")]
    for k in range(0, len(texts), 500):
        found, ends = ids.of(pa.array(texts[k : k + 500]))
        for part, text in zip(np.split(found, ends), texts[k : k + 500], strict=False):
            assert part.tolist() == truth(text)[:-1], text


def test_each_token_is_made_in_one_way():
    """Merging the lowest pair first, a token's own bytes come to the two parts of its merge, so ranks of bytes merge the same pairs."""
    model = json.loads(Path(TOKENIZER).read_text())["model"]
    rank = {tuple(m if isinstance(m, list) else m.split(" ")): k for k, m in enumerate(model["merges"])}
    joined = {a + b: k for (a, b), k in rank.items()}
    assert len(joined) == len(rank) and [model["vocab"][t] for t in joined] == sorted(model["vocab"][t] for t in joined)
    for (a, b), k in rank.items():
        token = a + b
        parts = [*token[:-5], token[-5:]] if token.endswith("</w>") else [*token]
        while len(parts) > 2:
            # by bytes: any two parts whose join is a token, of the lowest rank
            pair = min(range(len(parts) - 1), key=lambda n: joined.get(parts[n] + parts[n + 1], len(rank)))
            assert joined[parts[pair] + parts[pair + 1]] < k
            parts[pair : pair + 2] = [parts[pair] + parts[pair + 1]]
        assert parts == [a, b]


def brute_weights(entries, n, frequency, total):
    rarity = lambda t: np.log1p((n - frequency[t] + 0.5) / (frequency[t] + 0.5))
    mean = total / n
    return [{t: rarity(t) * e.count(t) * 2.2 / (e.count(t) + 1.2 * (0.25 + 0.75 * len(e) / mean)) for t in set(e)} for e in entries]


def test_index_scores_equal_brute_force():
    rng = random.Random(2)
    entries = [[min(int(rng.paretovariate(0.4)), 400) for _ in range(rng.randrange(1, 80))] for _ in range(60)]
    frequency = np.zeros(1 << 16, np.int64)
    for e in entries:
        frequency[list(set(e))] += 1
    total = sum(map(len, entries))
    index = Index([np.array(e, "<u2") for e in entries], Weights(frequency, len(entries), total))
    by_hand = brute_weights(entries, len(entries), frequency, total)
    for seed in range(len(entries)):
        expected = [sum(w.get(t, 0.0) for t in set(entries[seed])) for w in by_hand]
        np.testing.assert_allclose(index.scores(seed), expected, rtol=1e-9)


def test_neighbours_share_a_window():
    rng = random.Random(3)
    topics = [[100 * t + k for k in range(30)] for t in range(8)]
    entries = [np.array([1, 2, 3] + [rng.choice(topics[n % 8]) for _ in range(20 + rng.randrange(8))], "<u2") for n in range(160)]
    frequency = np.zeros(1 << 16, np.int64)
    for e in entries:
        frequency[np.unique(e)] += 1
    windows = fill(entries, Weights(frequency, len(entries), sum(map(len, entries))), 128)
    assert all(sum(p[2] for p in w) == 128 for w in windows[:-1])
    alike = [len({p[0] % 8 for p in w}) for w in windows]
    assert sum(a <= 2 for a in alike) > len(windows) * 0.8


@pytest.mark.parametrize("shard_tokens", [300, 1 << 19])
def test_every_id_in_one_piece(spark, documents, odd_rows, shard_tokens):
    rng = random.Random(4)
    rows = [(k, sentence(rng, rng.randrange(1, 90))) for k in range(100, 160)] + [(200 + k, "the same words over and over " * 3) for k in range(40)]
    frame = documents([*odd_rows, *rows], ", row int, task string", (1, "q")).repartition(3)
    pieces = pack_documents(frame, window=64, shard_tokens=shard_tokens).collect()
    by_sequence = check(pieces, [(r[0], r[1]) for r in odd_rows + rows], 64)
    assert len([s for s in by_sequence.values() if len(s) > 1]) > 10


def test_query_on_whole_windows(spark, documents, tmp_path):
    rng = random.Random(6)
    rows = [(k, sentence(rng, rng.choice([3, 40, 900, 3000]))) for k in range(30)] + [(50, None), (51, "")]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = queries.op13_packing(spark, str(tmp_path)).collect()
    sequences = check(pieces, rows, 4096)
    assert sum(sum(p["length"] for p in s) == 4096 for s in sequences.values()) >= sum(len(truth(t)) for _, t in rows) // 4096 - 1


def test_empty_table_and_odd_window(documents):
    assert pack_documents(documents([])).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        pack_documents(documents([]), window=100)

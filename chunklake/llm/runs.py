"""Periodic runs of words by maximal pairs.

A run is a stretch of words with smallest period q that no neighbouring word extends. Its first word and the word q behind it
are a maximal pair: what follows both agrees over length - q words and no further, and what precedes them differs. So runs are
read off the tree of LCP intervals of a text's suffixes, from the longest common prefixes up, without extending anything: a
node of depth l holds the places that share l words, each in the class of its left word, and joining two of its children pairs
places of different classes; children of one and the same class are only put together. Distance d and depth l tell the run: it begins at the first place, has l + d words and period d.

A run of at least three periods needs d <= l / 2. Two places of a node that have a third between them then belong to a run of
a smaller period (two periods of one stretch have a common divisor), so that only neighbours in a node are pairs of smallest
periods. A child's places are joined into the longer list, whence n log n steps. Only suffixes that share their first words
with another one of the same text are sorted at all.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import in_small_batches, private

#: The least words of a run, and the least number of its periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words that are searched at once; a longer text is searched alone.
LOT_WORDS = 1 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each number."""
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _shared(words: np.ndarray, doc: np.ndarray, room: np.ndarray, share: int) -> np.ndarray:
    """The places whose next ``share`` words stand at another place of the text too, told by a hash: few others may be among them."""
    at = np.flatnonzero(room >= share)
    gram, size = _mixed(words, 1), 1
    with np.errstate(over="ignore"):
        while size < share:  # of size words, then of twice as many; of what is left at last
            step = min(size, share - size)
            ahead = np.zeros_like(gram)
            ahead[:-step] = gram[step:]
            gram, size = _mixed(gram, 2 * size) + ahead, size + step
    key = gram[at] ^ _mixed(doc[at], 0)
    order = np.argsort(key)
    key = key[order]
    same = np.zeros(len(at) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    return np.sort(at[order[same[1:] | same[:-1]]])


def _ranked(words: np.ndarray, places: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """The places and those ``share`` behind them, and the rank of their next ``share`` words in the order of the words' numbers."""
    change = np.zeros(len(words) + 2 * share + 1, np.int64)
    change[places] += 1
    change[places + 2 * share] -= 1
    at = np.flatnonzero(np.cumsum(change[: len(words)]))
    slot = np.full(len(words) + share, -1)
    slot[at] = np.arange(len(at))
    rank = np.unique(words[at], return_inverse=True)[1]
    size = 1
    while size < share:
        step = min(size, share - size)
        ahead = slot[at + step]
        behind = np.where(ahead >= 0, rank[ahead], -1) + 1
        rank = np.unique(rank * (len(at) + 2) + behind, return_inverse=True)[1]
        size += step
    wanted = np.zeros(len(words), bool)
    wanted[places] = wanted[places + share] = True
    return np.flatnonzero(wanted), rank[slot[wanted.nonzero()[0]]]


def _sorted_suffixes(words: np.ndarray, doc: np.ndarray, places: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the text and of what follows them, and how many words each shares with the next, 0 if under ``share``.

    Prefix doubling: tied places are told apart by the rank of what stands ``size`` behind them, itself a place with a rank.
    """
    at, gram = _ranked(words, places, share)
    by = np.lexsort((gram, doc[at]))
    order, gram = at[by], gram[by]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (gram[1:] != gram[:-1]) | (doc[order[1:]] != doc[order[:-1]])
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, len(order)))
    rank = -1 - np.arange(len(words) + 1, dtype=np.int64)
    rank[order] = np.repeat(heads, sizes)
    tied = np.repeat(sizes > 1, sizes)
    levels, size = [], share
    linked = np.flatnonzero(~fresh)  # shares its first words with the place before
    while tied.any():
        levels.append((size, rank.copy()))
        slots = np.flatnonzero(tied)
        at = order[slots]
        at = at[np.lexsort((rank[at + size], rank[at]))]
        major, minor = rank[at], rank[at + size]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])
        order[slots] = at  # tied places are neighbours, and groups come in the order of their rank
        heads = np.flatnonzero(fresh)
        sizes = np.diff(np.append(heads, len(at)))
        rank[at] = np.repeat(slots[heads], sizes)
        tied[slots] = np.repeat(sizes > 1, sizes)
        size *= 2
    a, b, depth = order[linked - 1], order[linked], np.zeros(len(linked), np.int64)
    for size, ranks in reversed(levels):
        depth += size * (ranks[a + depth] == ranks[b + depth])
    going = np.ones(len(linked), bool)
    for _ in range(share - 1):  # ends of texts are words that equal none
        going &= words[a + depth] == words[b + depth]
        depth += going
    shared = np.zeros(len(order), np.int64)
    shared[linked - 1] = depth
    return order, shared


#: The places of a node in the order of the text, and their left word where all have the same, else None.
Node = tuple[list[int], int | None]


def _join(one: Node, other: Node, depth: int, left: dict[int, int], least: int, least_periods: int, found: list[tuple[int, int, int]]) -> Node:
    """Two children of a node of that depth as one. Neighbours in the text of different left words that are near enough are runs.

    Places of one class pair with none of their own: what follows and precedes them agrees, so a deeper node has paired them.
    """
    (longer, word), (shorter, other_word) = (one, other) if len(one[0]) >= len(other[0]) else (other, one)
    if word is not None and word == other_word:
        for place in shorter:
            insort(longer, place)
        return longer, word
    reach, last, before = depth // (least_periods - 1), len(shorter) - 1, -1
    for n, place in enumerate(shorter):
        k = bisect_left(longer, place)
        if k and longer[k - 1] != before:
            near = longer[k - 1]
            if place - near <= reach and depth + place - near >= least and left[near] != left[place]:
                found.append((near, depth + place - near, place - near))
        if k < len(longer) and (n == last or shorter[n + 1] > longer[k]):
            near = longer[k]
            if near - place <= reach and depth + near - place >= least and left[near] != left[place]:
                found.append((place, depth + near - place, near - place))
        longer.insert(k, place)
        before = place
    return longer, None


def runs_of(texts: list[np.ndarray], least: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """Per text of numbered words its runs as (start, length, period), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    # what the two places of a run share: length - q words, and q is at most a part of the length
    share = max(least - least // least_periods, least_periods - 1)
    sizes = np.array([len(t) for t in texts], np.int64)
    if not len(sizes) or sizes.max() < share + 1:
        return out
    ends = np.cumsum(sizes + 1) - 1
    words = np.empty(int(ends[-1]) + 1, np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes + 1)
    room = ends[doc] - np.arange(len(words))
    words[room > 0] = np.concatenate(texts)
    words[ends] = -1 - np.arange(len(texts))
    places = _shared(words, doc, room, share)
    if not len(places):
        return out
    order, shared = _sorted_suffixes(words, doc, places, share)
    # groups whose places all are too far apart for what they share hold no run
    begins = np.flatnonzero(np.append(0, shared[:-1]) == 0)
    group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(order))))
    by_place = order[np.lexsort((order, group))]
    gap = np.full(len(order), len(words))
    gap[1:] = np.diff(by_place)
    gap[begins] = len(words)
    keep = (np.minimum.reduceat(gap, begins) <= np.maximum.reduceat(shared, begins) // (least_periods - 1))[group]
    order, shared = order[keep], shared[keep]
    # the left word of a text's first word is the end of the text before, which equals no word
    before = np.where(order > 0, words[order - 1], -1 - len(texts))
    left = dict(zip(order.tolist(), before.tolist(), strict=True))
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, Node]] = []
    for place, depth in zip(order.tolist(), shared.tolist(), strict=True):
        node: Node = ([place], left[place])
        while stack and stack[-1][0] > depth:
            deeper, child = stack.pop()
            node = _join(child, node, deeper, left, least, least_periods, found)
        if stack and stack[-1][0] == depth:
            stack[-1] = (depth, _join(stack[-1][1], node, depth, left, least, least_periods, found))
        elif depth:
            stack.append((depth, node))
    for start, length, period in found:
        n = int(doc[start])
        out[n].append((start - int(ends[n] - sizes[n]), length, period))
    for runs in out:
        runs.sort(key=lambda run: (run[0], run[2]))
    return out


def _lots(words: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for n, text in enumerate(words):
        if n > begin and size + len(text) > LOT_WORDS:
            yield begin, n
            begin, size = n, 0
        size += len(text)
    if begin < len(words):
        yield begin, len(words)


def _numbered(words: list[list[bytes]]) -> list[np.ndarray]:
    """Equal words have equal numbers."""
    every = pa.array([w for text in words for w in text], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return np.split(every.astype(np.int64), np.cumsum([len(t) for t in words])[:-1])


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])


def _finder(least: int, least_periods: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # white space of a word's end is the six characters bytes are split at
            words = [(t or "").encode().split() for t in batch["text"].to_pylist()]
            runs: list[list[tuple[int, int, int]]] = []
            for lo, hi in _lots(words):
                runs += runs_of(_numbered(words[lo:hi]), least, least_periods)
            texts = pa.array([_collapsed(w, r) for w, r in zip(words, runs, strict=True)], pa.binary()).cast(pa.string())
            starts = pa.array(np.cumsum([0] + [len(r) for r in runs]), pa.int32())
            flat = np.array([run for r in runs for run in r], np.int64).reshape(-1, 3)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
            counts = pa.array([len(w) for w in words], pa.int64())
            lists = pa.ListArray.from_arrays(starts, parts).cast(kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, counts, lists, texts], [*batch.schema.names, *names])

    return find


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """All rows with ``n_words``, ``runs`` (start, length and period in words, by start, then period) and ``collapsed``.

    ``collapsed`` is the text's words joined by one space, less those that a run holds behind its first period. Words are
    stretches without space, tab, line feed, vertical tab, form feed and carriage return. One pass over whole texts, no
    shuffle; a text's work is bounded by n log n of its words. A null or empty text has no words, no runs and an empty
    ``collapsed``; repeated rows are searched each; an empty table gives no rows; columns named like the new ones are replaced.
    """
    if least_periods < 2 or least < 2 * least_periods:
        raise ValueError("a run has two periods or more, of two words or more together")
    in_small_batches(docs.sparkSession)
    names = ["n_words", "runs", "collapsed"]
    docs = docs.select(*(c for c in docs.columns if c.lower() not in names))
    inner = private(docs, *names)
    schema = docs.withColumns({inner[0]: F.lit(0).cast("long"), inner[1]: F.lit(None).cast(RUNS), inner[2]: F.lit("")}).schema
    return docs.mapInArrow(_finder(least, least_periods, inner), schema).withColumnsRenamed(dict(zip(inner, names, strict=True)))

"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as lower-case words with one space between. An item that may differ by k edits is cut into k + 1 pieces:
wherever the item occurs, one piece occurs unchanged. An automaton finds all pieces in one pass over a document, and Myers'
bit-parallel distance verifies the places they point at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import in_small_batches, text_of

#: Edits an item may differ by, as a share of its characters.
ERROR_RATE = 0.08
#: An item shorter than this is too little to be told from chance with edits: it counts where its very words stand.
SHORT = 20
#: Items are matched in blocks of about so many bytes, which bounds the driver and each task.
BLOCK_BYTES = 8 << 20

_WORD = re.compile(r"\w+")
HITS = "doc_id long, item_id long, distance int, budget int, start int, end int"


def lowered(text: str) -> str:
    """Lower case, place for place: a character whose lower case is longer stays as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normalised(text: str) -> str:
    return " ".join(_WORD.findall(lowered(text)))


def places(text: str) -> list[int]:
    """For each character of the normalised text its place in the text; a space has that of the word's end before it."""
    found: list[int] = []
    for match in _WORD.finditer(lowered(text)):
        if found:
            found.append(found[-1])
        found += range(match.start(), match.end())
    return found


def myers(pattern: str, text: str, budget: int) -> tuple[int, int] | None:
    """The least edit distance of the pattern to any part of the text, up to the budget, and where that part ends."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, None
    for j, c in enumerate(text):
        same = masks.get(c, 0)
        down = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        rise = minus | (full & ~(across | plus))
        fall = plus & across
        if rise & last:
            score += 1
        elif fall & last:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        plus, minus = fall | (full & ~(down | rise)), rise & down
        if score <= budget and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


class Matcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE):
        self.items = [(item_id, text, int(error_rate * len(text))) for item_id, text in items if text]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, budget) in enumerate(self.items):
            count = 1 if len(text) < SHORT else budget + 1
            cuts = [len(text) * i // count for i in range(count + 1)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(text[lo:hi], []).append((n, lo))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item, distance, budget, start, end) of each item's first best occurrence; places are those of normalised text."""
        if not self.items:
            return []
        where: dict[int, set[int]] = {}
        for end, (size, owners) in self.automaton.iter(text):
            for n, offset in owners:
                where.setdefault(n, set()).add(end + 1 - size - offset)
        found = []
        for n, begins in sorted(where.items()):
            item_id, item, budget = self.items[n]
            if len(item) < SHORT:
                # the first place that begins and ends with its words
                for begin in sorted(begins):
                    end = begin + len(item)
                    if text[begin - 1 : begin] in ("", " ") and text[end : end + 1] in ("", " "):
                        found.append((item_id, 0, 0, begin, end))
                        break
                continue
            best = None
            for lo, hi in self._windows(sorted(begins), len(item), budget):
                lo = max(lo, 0)
                window = text[lo:hi]
                hit = myers(item, window, budget)
                if hit and (best is None or hit[0] < best[1]):
                    back = myers(item[::-1], window[: hit[1]][::-1], hit[0])
                    best = (item_id, hit[0], budget, lo + hit[1] - back[1], lo + hit[1])
                    if hit[0] == 0:
                        break
            if best:
                found.append(best)
        return found

    @staticmethod
    def _windows(begins: list[int], size: int, budget: int) -> Iterator[tuple[int, int]]:
        """Where to look: around each place a piece points at, overlapping stretches as one."""
        lo = hi = None
        for begin in begins:
            if hi is not None and begin - budget <= hi:
                hi = begin + size + budget
                continue
            if hi is not None:
                yield lo, hi
            lo, hi = begin - budget, begin + size + budget
        if hi is not None:
            yield lo, hi


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items, normalised, in blocks of bounded size. One without words occurs nowhere; one without an id is found as others are."""
    items = benchmark.select("item_id", text_of().alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    lot = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for k in range(blocks):
        rows = items.filter(lot == k).collect()
        found = ((row["item_id"], normalised(row["text"])) for row in rows)
        yield sorted(found, key=lambda item: (item[0] is None, item[0] or 0, item[1]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """One row for each document and item that occurs in it: ``doc_id``, ``item_id``, ``distance``, ``budget``, ``start``, ``end``.

    Places are code points of the document's text, of the best occurrence, the first of equals. Null and empty texts hold
    nothing, repeated rows are reported each, an item without an id has a null one, an empty table or benchmark gives no rows, more columns do not matter.
    """
    in_small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    found = None
    for items in item_blocks(benchmark):
        part = rows.mapInArrow(_finder(items, error_rate), HITS)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], HITS)


def _finder(items: list[tuple[int, str]], error_rate: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, error_rate)
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                hits = matcher.find(normalised(text)) if text else []
                at = places(text) if hits else []
                for item_id, distance, budget, start, end in hits:
                    place = (at[min(start, len(at) - 1)], at[min(end, len(at)) - 1] + 1)
                    for column, value in zip(columns, (doc_id, item_id, distance, budget, *place), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "distance", "budget", "start", "end"])

    return find


def drop_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """The rows, all columns, whose text holds no item. Passes over the rows without a shuffle, once per block of items.

    A null, empty or wordless text holds none and stays; of repeated rows all stay or none; with an empty benchmark all rows
    stay, and an empty table gives no rows.
    """
    in_small_batches(docs.sparkSession)
    for items in item_blocks(benchmark):

        def clean(batches: Iterator[pa.RecordBatch], items: list[tuple[int, str]] = items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, error_rate)
            for batch in batches:
                keep = [not (text and matcher.find(normalised(text))) for text in batch["text"].to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs

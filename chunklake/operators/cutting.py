"""The one step no relational operator expresses: cutting ordered chunks at data-anchored spans, batch by batch.

A cut falls on the first row whose time is at least ``clip_ms`` after the start of the open clip, and that row's time
becomes the next start. A start is never before any earlier time of its run, so rows may be compared by their running
maximum, which is sorted, and the next cut after any row is a binary search.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_FAR = float(1 << 61)
LATEST = np.iinfo(np.int64).max


def last_starts(times: np.ndarray, clip_ms: int) -> np.ndarray:
    """For each of sorted times, the last start reached when a clip starts there. Doubles the stride each round."""
    steps = np.searchsorted(times, np.minimum(times, LATEST - clip_ms) + clip_ms, side="left")
    reach = np.where(steps < len(times), steps, np.arange(len(times)))
    while True:
        further = reach[reach]
        if np.array_equal(further, reach):
            return times[reach]
        reach = further


def cut_points(times: np.ndarray, heads: np.ndarray, anchors: np.ndarray, clip_ms: int) -> np.ndarray:
    """Indices of the rows that a span cut puts at the start of a new clip, over many runs at once.

    ``heads`` are the first rows of the runs, beginning with 0, and ``anchors`` the start times of the clips open
    there. ``times`` must be sorted within each run and not lie before the run's anchor.
    """
    ends = np.append(heads[1:], len(times))
    spans = times[ends - 1] - anchors
    if len(heads) > 1 and spans.astype(float).sum() + len(heads) * (clip_ms + 1.0) >= _FAR:
        parts = zip(heads, ends, anchors, strict=True)
        return np.concatenate(
            [a + cut_points(times[a:b], np.zeros(1, np.int64), np.array([s]), clip_ms) for a, b, s in parts]
        )
    # lay the runs end to end on one axis, each more than a span away from the next: one search serves all
    base = np.concatenate(([0], np.cumsum(spans + clip_ms + 1)[:-1]))
    run = np.repeat(np.arange(len(heads)), ends - heads)
    axis = times - anchors[run] + base[run]
    at = np.minimum(np.searchsorted(axis, base + clip_ms, side="left"), ends)
    if (at == ends).all():
        return np.zeros(0, np.int64)
    steps = np.minimum(np.searchsorted(axis, axis + clip_ms, side="left"), ends[run]).tolist()
    cuts = []
    for row, end in zip(at.tolist(), ends.tolist(), strict=True):
        while row < end:
            cuts.append(row)
            row = steps[row]
    return np.array(cuts, dtype=np.int64)


def highest_so_far(times: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The running maximum within each run."""
    falls = np.flatnonzero(times[1:] < times[:-1]) + 1
    runs = np.searchsorted(heads, falls, side="right") - 1
    high = times.copy()
    ends = np.append(heads[1:], len(times))
    for run in np.unique(runs[heads[runs] != falls]):
        part = slice(heads[run], ends[run])
        np.maximum.accumulate(times[part], out=high[part])
    return high


@dataclass
class Runs:
    """A batch of chunks in order, and the unbroken runs in it. A run or block may have begun in an earlier batch."""

    batch: pa.RecordBatch
    columns: dict[str, np.ndarray]
    #: the first row of each block; row 0 is always one, as of each run
    block_heads: np.ndarray
    #: the first row of each run
    heads: np.ndarray
    #: the breaks so far in its block, for each run
    number: np.ndarray
    #: whether the first block, and the first run, go on from the batch before
    same_block: bool
    same_run: bool

def runs_of(batches: Iterator[pa.RecordBatch], idle_ms: int | None) -> Iterator[Runs]:
    """Finds the breaks in chunks sorted by session, block and line."""
    before: dict | None = None
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        columns = {
            name: batch.column(i).to_numpy(zero_copy_only=False)
            for i, name in enumerate(batch.schema.names)
            if name != "session_id"
        }
        session, block = batch.column("session_id"), columns["block"]
        sequence, offset, length = columns["sequence"], columns["offset"], columns["length"]
        new_block = np.ones(rows, bool)
        new_block[1:] = pc.not_equal(session[1:], session[:-1]).to_numpy(zero_copy_only=False)
        new_block[1:] |= block[1:] != block[:-1]
        broken = np.ones(rows, bool)
        broken[1:] = (sequence[1:] != sequence[:-1] + 1) | (offset[1:] != offset[:-1] + length[:-1])
        if idle_ms is not None:
            arrival = columns["arrival"]
            broken[1:] |= arrival[1:] - arrival[:-1] >= idle_ms
        same_block = before is not None and before["key"] == (session[0].as_py(), int(block[0]))
        same_run = False
        if same_block:
            same_run = sequence[0] == before["sequence"] + 1 and offset[0] == before["offset"] + before["length"]
            if idle_ms is not None:
                same_run = same_run and arrival[0] - before["arrival"] < idle_ms
        head = new_block | broken
        heads, block_heads = np.flatnonzero(head), np.flatnonzero(new_block)
        opening = np.searchsorted(heads, block_heads)
        number = np.arange(len(heads)) - np.repeat(opening, np.diff(np.append(opening, len(heads))))
        if same_block:
            number[: opening[1] if len(opening) > 1 else None] += before["number"] + (not same_run)
        carried = [name for name in ("sequence", "offset", "length", "arrival") if name in columns]
        before = {name: int(columns[name][-1]) for name in carried}
        before["key"] = (session[rows - 1].as_py(), int(block[-1]))
        before["number"] = int(number[-1])
        yield Runs(batch, columns, block_heads, heads, number, same_block, bool(same_run))

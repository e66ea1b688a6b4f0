import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chunklake.operators.cutting import cut_points, highest_so_far, last_starts, runs_of

RUNS = st.lists(st.lists(st.integers(-50, 400), min_size=1, max_size=30), min_size=1, max_size=6)


def _walk(times, start, clip_ms):
    cuts = []
    for i, time in enumerate(times):
        if time - start >= clip_ms:
            cuts.append(i)
            start = time
    return cuts, start


@settings(max_examples=200, deadline=None)
@given(RUNS, st.integers(1, 120), st.integers(0, 60))
def test_cut_points_equal_a_walk(runs, clip_ms, lead):
    heads = np.cumsum([0] + [len(run) for run in runs[:-1]])
    times = np.concatenate([np.array(run, np.int64) for run in runs])
    anchors = np.array([run[0] - lead for run in runs], np.int64)
    sizes = np.diff(np.append(heads, len(times)))
    high = highest_so_far(np.maximum(times, np.repeat(anchors, sizes)), heads)
    expected = [head + i for head, run, a in zip(heads, runs, anchors) for i in _walk(run, a, clip_ms)[0]]
    assert cut_points(high, heads, anchors, clip_ms).tolist() == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=60, unique=True), st.integers(1, 120))
def test_last_starts_equal_a_walk(times, clip_ms):
    times = np.array(sorted(times), np.int64)
    expected = [_walk(times[i:], times[i], clip_ms)[1] for i in range(len(times))]
    assert last_starts(times, clip_ms).tolist() == expected


def test_far_apart_times_do_not_overflow():
    times = np.array([0, 1 << 61, 0, 1 << 61, 5], np.int64)
    heads = np.array([0, 2, 4])
    assert cut_points(times, heads, times[heads], 1000).tolist() == [1, 3]
    assert last_starts(np.array([3, (1 << 63) - 1]), 1000).tolist() == [(1 << 63) - 1] * 2


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_runs_carry_over_batches(size):
    rows = [("a", 0, 1, 0, 4), ("a", 0, 2, 4, 4), ("a", 0, 4, 8, 4), ("a", 1, 5, 12, 4), ("b", 1, 6, 16, 4), ("b", 1, 9, 20, 1)]
    names = ["session_id", "block", "sequence", "offset", "length"]
    table = pa.table({name: [row[i] for row in rows] for i, name in enumerate(names)})
    numbers = []
    for runs in runs_of(iter(table.to_batches(max_chunksize=size)), None):
        sizes = np.diff(np.append(runs.heads, runs.batch.num_rows))
        numbers += np.repeat(runs.number, sizes).tolist()
    assert numbers == [0, 0, 1, 0, 0, 1]

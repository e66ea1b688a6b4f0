import random

import pytest
from folding import fold, random_records
from pyspark.sql import functions as F

from chunklake import continuity_breaks, cut_clips
from chunklake.operators import clips as clips_module
from chunklake.operators.clips import by_number, order_of
from chunklake.operators.rejects import count_clips
from chunklake.plans.fixtures import generate_chunks

# (sequence, offset, length, ts_ms, arrival), span, expected (ts, offset, length, complete)
GOLDEN = {
    "window": ([(1, 0, 4, 0, 0), (2, 4, 4, 3000, 0), (3, 8, 4, 6000, 0)], [(0, 0, 8, True), (6, 8, 4, True)]),
    "break_beats_window": ([(1, 0, 4, 0, 0), (3, 8, 4, 9000, 0)], [(0, 0, 4, False), (9, 8, 4, True)]),
    "gap": ([(1, 0, 4, 0, 0), (5, 16, 4, 1000, 0)], [(0, 0, 4, False), (1, 16, 4, True)]),
    "offset_only": ([(1, 0, 4, 0, 0), (2, 5, 4, 10, 0)], [(0, 0, 4, False), (0, 5, 4, True)]),
    "backward": (
        [(1, 0, 4, 5000, 0), (2, 4, 4, 1000, 0), (3, 8, 4, 9999, 0), (4, 12, 4, 10_000, 0)],
        [(5, 0, 12, True), (10, 12, 4, True)],
    ),
    "boundary": ([(1, 0, 4, 0, 0), (2, 4, 4, 5000, 0)], [(0, 0, 4, True), (5, 4, 4, True)]),
    "one": ([(1, 0, 5, 7000, 0)], [(7, 0, 5, True)]),
    "negative_time": ([(1, 0, 5, -1500, 0)], [(-1, 0, 5, True)]),
}


def _frame(spark, sessions):
    rows = [(name, i + 1, *record) for name, records in sessions.items() for i, record in enumerate(records)]
    random.Random(1).shuffle(rows)
    names = "session_id string, line_no long, sequence long, offset long, length long, ts_ms long, arrival long"
    return spark.createDataFrame(rows, names).repartition(3)


def _by_session(clips, *columns):
    found = {}
    for row in sorted(clips.collect(), key=lambda r: (r.session_id, r.island, r.start_ts_ms)):
        found.setdefault(row.session_id, []).append(tuple(row[c] for c in columns))
    return found


@pytest.mark.parametrize("block_lines", [1, 2, 1 << 22])
def test_golden_cases(spark, block_lines):
    chunks = _frame(spark, {name: records for name, (records, _) in GOLDEN.items()})
    clips = cut_clips(chunks, "/in", order=by_number(block_lines=block_lines), keep_order=True)
    found = _by_session(clips, "ts", "offset", "length", "complete")
    assert found == {name: expected for name, (_, expected) in GOLDEN.items()}
    one = clips.where("session_id = 'one'").first()
    assert (one.type, one.path) == ("clip", "/in/one_7.bin")


def test_idle_pause(spark):
    chunks = _frame(spark, {"s": [(1, 0, 4, 0, 0), (2, 4, 4, 100, 2000), (3, 8, 4, 200, 3999)]})
    clips = cut_clips(chunks, idle_ms=2000, arrival_col="arrival", order=by_number(), keep_order=True)
    assert _by_session(clips, "ts", "offset", "length", "complete")["s"] == [(0, 0, 4, False), (0, 4, 8, True)]


@pytest.fixture(scope="module")
def sessions():
    rnd = random.Random(5)
    return {f"s{i}": random_records(rnd, rnd.choice([1, 2, 5, 30, 200])) for i in range(60)}


@pytest.mark.parametrize("block_lines", [3, 16, 1 << 22])
@pytest.mark.parametrize("idle_ms", [None, 50])
def test_equals_the_fold(spark, sessions, block_lines, idle_ms):
    clips = cut_clips(
        _frame(spark, sessions),
        clip_ms=1000,
        idle_ms=idle_ms,
        arrival_col="arrival" if idle_ms else None,
        order=by_number(block_lines=block_lines),
        keep_order=True,
    )
    expected = {name: fold(records, 1000, idle_ms) for name, records in sessions.items()}
    assert _by_session(clips, "start_ts_ms", "offset", "length", "complete") == expected


@pytest.mark.parametrize("stretch", [1, 3, 64])
def test_unbroken_session_over_many_blocks(spark, monkeypatch, stretch):
    """Steady spacing: no two cut paths ever meet, so every block needs its entry, however long the parts are."""
    monkeypatch.setattr(clips_module, "STRETCH_BLOCKS", stretch)
    records = [(i, i * 4, 4, i * 7, 0) for i in range(3000)]
    clips = cut_clips(_frame(spark, {"hot": records}), clip_ms=100, order=by_number(block_lines=64), keep_order=True)
    assert _by_session(clips, "start_ts_ms", "offset", "length", "complete") == {"hot": fold(records, 100)}


@pytest.mark.parametrize("stretch", [1, 4, 64])
def test_span_longer_than_blocks_and_falling_clock(spark, monkeypatch, stretch):
    monkeypatch.setattr(clips_module, "STRETCH_BLOCKS", stretch)
    rnd = random.Random(9)
    records = [(i, i, 1, i * 10 - rnd.choice([0, 0, 4000]), 0) for i in range(1500)]
    clips = cut_clips(_frame(spark, {"s": records}), clip_ms=3000, order=by_number(block_lines=20), keep_order=True)
    assert _by_session(clips, "start_ts_ms", "offset", "length", "complete") == {"s": fold(records, 3000)}


@pytest.mark.parametrize("block_lines", [3, 1000])
def test_breaks_report(spark, sessions, block_lines):
    found = continuity_breaks(_frame(spark, sessions), by_number(block_lines=block_lines)).drop("block").collect()
    expected = set()
    for name, records in sessions.items():
        for i, (a, b) in enumerate(zip(records, records[1:])):
            if (b[0], b[1]) != (a[0] + 1, a[1] + a[2]):
                expected.add((name, i + 2, b[0], a[0] + 1, b[1], a[1] + a[2]))
    assert {tuple(row) for row in found} == expected and len(found) == len(expected)


def test_generated_sets(spark):
    chunks = generate_chunks(spark, "small")
    for kind in ("medium", "malformed"):
        chunks = chunks.unionByName(generate_chunks(spark, kind))
    clips, seen = count_clips(cut_clips(chunks, order=by_number(block_lines=100), keep_order=True))
    found = _by_session(clips, "ts", "offset", "length", "complete")
    assert found["bench_small"] == [(1, 0, 204_800, True), (6, 204_800, 204_800, True)]
    assert len(found["bench_medium"]) == 200 and found["bench_medium"][-1] == (996, 40_755_200, 204_800, True)
    malformed = found["bench_malformed"]
    assert len(malformed) == 11 and len({clip[0] for clip in malformed}) == 10
    assert malformed[3:6] == [(16, 614_400, 204_800, False), (21, 819_200, 4096, False), (21, 823_296, 204_800, True)]
    assert malformed[-1] == (46, 1_847_296, 200_704, True)
    assert seen.get == {"clips": 213, "cut_short": 2}


def test_lengths_add_up_and_partitions_do_not_matter(spark, sessions):
    chunks = _frame(spark, sessions)
    few = cut_clips(chunks.repartition(2), clip_ms=700, order=by_number(block_lines=8))
    many = cut_clips(chunks.repartition(8, F.rand(3)), clip_ms=700, order=by_number(block_lines=8))
    key = lambda row: tuple(map(str, row))
    assert sorted(few.collect(), key=key) == sorted(many.collect(), key=key)
    assert few.agg(F.sum("length")).first()[0] == chunks.agg(F.sum("length")).first()[0]


def test_no_chunks_and_odd_numbers(spark):
    names = "session_id string, line_no long, sequence long, offset long, length long, ts_ms long"
    assert cut_clips(spark.createDataFrame([], names), order=by_number()).count() == 0
    top = (1 << 63) - 1
    rows = [
        ("neg", -3, 1, 0, 4, 0),
        ("neg", -2, 2, 4, 4, 10),
        ("neg", 1, 3, 8, 4, 20),
        ("top", 1, top, top - 2, 2, 0),
        ("top", 2, 0, top, 1, 5),
        ("none", 1, None, 0, 1, 0),
    ]
    for block_lines in (2, 100):
        clips = cut_clips(spark.createDataFrame(rows, names), order=by_number(block_lines=block_lines), keep_order=True)
        found = _by_session(clips, "ts", "offset", "length", "complete")
        assert found == {"neg": [(0, 0, 12, True)], "top": [(0, top - 2, 2, False), (0, top, 1, True)]}


def test_bad_options(spark):
    chunks = _frame(spark, {"s": [(1, 0, 1, 0, 0)]})
    for options in ({"clip_ms": 0}, {"idle_ms": 5}, {"idle_ms": -1, "arrival_col": "arrival"}):
        with pytest.raises(ValueError):
            cut_clips(chunks, order=by_number(), **options)


def test_chunks_are_scanned_and_shuffled_once(spark, sessions, tmp_path):
    _frame(spark, sessions).write.parquet(str(tmp_path / "chunks"))
    clips = cut_clips(spark.read.parquet(str(tmp_path / "chunks")), clip_ms=1000, order=by_number(block_lines=16))
    clips.collect()
    plan = clips._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_adaptive_splits_do_not_tear_blocks(spark, sessions):
    """A task must see whole blocks, whatever adaptive execution does to partitions it takes for skewed."""
    names = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500b",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        records = [(i, i * 4, 4, i * 7, 0) for i in range(2000)]
        chunks = _frame(spark, sessions | {"hot": records}).repartition(12)
        clips = cut_clips(chunks, clip_ms=1000, order=by_number(block_lines=500), keep_order=True)
        found = _by_session(clips, "start_ts_ms", "offset", "length", "complete")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert found == {name: fold(rows, 1000) for name, rows in (sessions | {"hot": records}).items()}


def numbered(spark, rng, count=300, steady=False):
    rows = [(name, n, *r) for name in ("a", "b", "c") for n, r in enumerate(random_records(rng, count), 1000)]
    if steady:  # one unbroken run through all blocks
        rows = [("s", n, n, 4 * n, 4, n * 10 + rng.randrange(60), n) for n in range(count)]
    return spark.createDataFrame(rows, "session_id string, line_no bigint, sequence bigint, offset bigint, length bigint, ts_ms bigint, arrival bigint")


@pytest.mark.parametrize("idle", [None, 30])
def test_one_block_is_cut_in_one_pass(spark, idle):
    frame = numbered(spark, random.Random(8))
    arrival = "arrival" if idle else None
    whole = cut_clips(frame, "/d", 700, idle, arrival, by_number("line_no", 64))
    order = order_of(frame)
    assert order.most_blocks == 1 and order_of(frame, block_lines=64).most_blocks == 6 and order_of(frame.limit(0)).most_blocks == 1
    single = cut_clips(frame, "/d", 700, idle, arrival, order)
    assert sorted(map(tuple, single.collect())) == sorted(map(tuple, whole.collect()))
    plan = single._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("MapInArrow") == 1


@pytest.mark.parametrize("steady", [False, True])
@pytest.mark.parametrize("clip_ms", [35, 700, 100_000])
def test_few_blocks_are_followed_at_once(spark, steady, clip_ms):
    frame = numbered(spark, random.Random(9), 2000 if steady else 300, steady)
    whole = cut_clips(frame, "/d", clip_ms, order=by_number("line_no", 16))
    few = cut_clips(frame, "/d", clip_ms, order=order_of(frame, block_lines=16))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, whole.collect()))

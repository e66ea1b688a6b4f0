import random

import pytest
from pyspark.sql import functions as F

from chunklake.operators.clips import by_number, cut_clips
from chunklake.sources.growing import read_growing_lines, read_growing_sidecars
from chunklake.streaming.clips import stream_records
from chunklake.streaming.segments import append_cut_stream, cut_batch, read_cut_clips, read_open_clips

RECORD = "session_id string, block bigint, line_id bigint, ended boolean, sequence bigint, offset bigint, length bigint, ts_ms bigint, arrival bigint"
STATE = "session_id string, start_ts_ms bigint, offset bigint, next_sequence bigint, next_offset bigint, arrival bigint"


def random_session(rng, name, count):
    rows, sequence, offset, ts, arrival = [], 0, 0, rng.randrange(1000), 0
    for n in range(count):
        if rng.random() < 0.06:
            sequence += rng.randrange(3)
            offset += rng.choice([0, 0, 9])
        length = rng.randrange(0, 9)
        arrival += rng.choice([1, 1, 1, 40])
        rows.append((name, 0, n, False, sequence, offset, length, ts + rng.randrange(-60, 60), arrival))
        sequence, offset, ts = sequence + 1, offset + length, ts + rng.randrange(40)
    return rows


@pytest.mark.parametrize(("seed", "idle"), [(1, None), (2, 30)])
def test_batches_cut_as_a_whole(spark, seed, idle):
    rng = random.Random(seed)
    sessions = {f"s{n}": random_session(rng, f"s{n}", rng.choice([1, 5, 60, 400])) for n in range(8)}
    whole = spark.createDataFrame([r for rows in sessions.values() for r in rows], RECORD)
    expected = cut_clips(whole, "/d", 300, idle, "arrival" if idle else None, by_number("line_id", 32))
    expected = sorted(map(tuple, expected.collect()))
    # the lines of each session dealt into batches at random places, marks behind the last ones
    batches = [[] for _ in range(3)]
    for name, rows in sessions.items():
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(2))
        for k, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
            batches[k] += rows[lo:hi]
        batches[2].append((name, 0, len(rows), True, 0, 0, 0, 0, rows[-1][-1]))
    found, state = [], spark.createDataFrame([], STATE)
    for rows in batches:
        rng.shuffle(rows)
        out = cut_batch(spark.createDataFrame(rows, RECORD), state, 300, idle, segment_lines=32).collect()
        found += [r for r in out if not r["open"]]
        state = spark.createDataFrame([tuple(r[c.split()[0]] for c in STATE.split(", ")) for r in out if r["open"]], STATE)
    assert state.count() == 0
    got = sorted((r["session_id"], int(r["start_ts_ms"] / 1000), r["offset"], r["length"], r["complete"]) for r in found)
    assert got == sorted((r[1], r[2], r[4], r[5], r[6]) for r in expected)


def test_lines_behind_a_mark_begin_anew(spark):
    rows = [("s", 0, 0, False, 0, 0, 4, 0, 0), ("s", 0, 1, True, 0, 0, 0, 0, 0), ("s", 0, 2, False, 1, 4, 4, 10, 0), ("s", 1, 0, False, 2, 8, 4, 20, 0), ("t", 0, 0, True, 0, 0, 0, 0, 0)]
    out = cut_batch(spark.createDataFrame(rows, RECORD), spark.createDataFrame([("t", 5, 0, 1, 4, 0)], STATE), 100).collect()
    assert sorted((r["session_id"], r["offset"], r["length"], r["complete"], r["open"]) for r in out) == [
        ("s", 0, 4, True, False), ("s", 4, 8, True, True), ("t", 0, 4, True, False)
    ]
    kept = next(r for r in out if r["open"])
    assert (kept["next_sequence"], kept["next_offset"]) == (3, 12)


def test_a_hot_session_fills_many_tasks(spark):
    rows = spark.range(40_000).selectExpr(
        "'hot' AS session_id", "0L AS block", "id AS line_id", "false AS ended", "id AS sequence", "id * 4 AS offset", "4L AS length", "id * 10 AS ts_ms", "0L AS arrival"
    )
    out = cut_batch(rows, spark.createDataFrame([], STATE), 50_000, segment_lines=1000)
    clips = out.collect()
    assert len(clips) == 8 and sum(r["length"] for r in clips) == 160_000 and [r["open"] for r in clips].count(True) == 1
    # 40 segments of the one session are hashed apart
    parts = rows.repartition(8, F.col("session_id"), F.expr("line_id - pmod(line_id, 1000)")).select(F.spark_partition_id().alias("p"))
    assert parts.distinct().count() >= 6
    assert "hashpartitioning(session_id" in out._jdf.queryExecution().executedPlan().toString()


def write(path, text, mode="a"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open(mode, newline="") as file:
        file.write(text)


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None and not query.isActive


def take(spark, root, out, checkpoint, range_bytes=64):
    lines = read_growing_lines(spark, str(root), "*.log", range_bytes)
    drain(lines.writeStream.format("parquet").option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start(str(out)))
    return spark.read.parquet(str(out)) if out.exists() else None


def test_lines_of_growing_files_are_seen_once(spark, tmp_path):
    root, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    rng = random.Random(5)
    texts = {"a.log": "", "sub/b.log": "", "c.log": ""}
    for step in range(4):  # each step is a query of its own that goes on from the checkpoint
        for name in texts:
            more = "".join(rng.choice(["x" * rng.randrange(200), "é" * rng.randrange(9), "\n", "\n\n", "end\n"]) for _ in range(rng.randrange(12)))
            texts[name] += more
            write(root / name, more)
        write(root / "other.txt", "not asked for\n")
        take(spark, root, out, checkpoint)
        found = spark.read.parquet(str(out)).collect()
        for name, text in texts.items():
            own = sorted((r["position"], r["line"]) for r in found if r["source"].endswith("/" + name))
            whole = text.encode()[: text.encode().rfind(b"\n") + 1]
            expected, at = [], 0
            for line in whole.split(b"\n")[:-1]:
                expected.append((at, line.decode()))
                at += len(line) + 1
            assert own == expected, step


def test_a_large_file_is_many_ranges(spark, tmp_path):
    write(tmp_path / "in" / "big.log", "".join(f"line {n}\n" for n in range(20_000)))
    lines = read_growing_lines(spark, str(tmp_path / "in"), "*.log", 5_000)
    seen = []
    drain(
        lines.writeStream.foreachBatch(lambda batch, _: seen.append((batch.rdd.getNumPartitions(), batch.count(), batch.select("position").distinct().count())))
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    assert [s for s in seen if s[1]] == [(-(-(tmp_path / "in" / "big.log").stat().st_size // 5_000), 20_000, 20_000)]


def test_small_files_share_tasks(spark, tmp_path):
    for n in range(300):
        write(tmp_path / "in" / f"r{n % 20}" / f"{n}.log", f"{n} a\n{n} b\n{n} torn")
    for n in range(20):
        write(tmp_path / "in" / f"r{n}" / ".pipeline_end", "")
    lines = read_growing_lines(spark, str(tmp_path / "in"), "*.log")
    seen = []
    drain(
        lines.writeStream.foreachBatch(lambda batch, _: seen.append((batch.rdd.getNumPartitions(), sorted((r.source, r.line) for r in batch.where("NOT marker").collect()), batch.where("marker").count())))
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    [(tasks, found, marks)] = [s for s in seen if s[1]]
    assert tasks <= 2 * spark.sparkContext.defaultParallelism and marks == 20  # a task for each file and marker before
    assert sorted(line for _, line in found) == sorted(f"{n} {c}" for n in range(300) for c in "ab")
    assert all(source.endswith(f"/{line.split()[0]}.log") for source, line in found)


def chunk(sequence, offset, length, ts):
    return f'{{"kind":"data","sequence":{sequence},"offset":{offset},"length":{length},"ts_ms":{ts}}}\n'


def test_a_folders_marker_ends_all_of_its_sessions(spark, tmp_path):
    root, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        drain(append_cut_stream(stream_records(read_growing_sidecars(spark, str(root), 100)), out, checkpoint, 5000, available_now=True))
        return sorted((r.session_id, r.ts, r.offset, r.length, r.complete) for r in read_cut_clips(spark, out).collect())

    for folder in ("a", "b"):
        for session in ("one", "two"):
            write(root / folder / f"{session}.meta.jsonl", chunk(1, 0, 4, 0) + chunk(2, 4, 4, 3000) + chunk(3, 8, 4, 6000)[:20])
    assert run() == [] and read_open_clips(spark, out).count() == 4
    for folder in ("a", "b"):
        for session in ("one", "two"):
            write(root / folder / f"{session}.meta.jsonl", chunk(3, 8, 4, 6000)[20:])
    write(root / "a" / ".pipeline_end", "")
    first = [(s, 0, 0, 8, True) for s in ("one", "one", "two", "two")]
    assert run() == sorted([*first, ("one", 6, 8, 4, True), ("two", 6, 8, 4, True)])
    assert read_open_clips(spark, out).count() == 2
    write(root / "b" / "one.meta.jsonl", chunk(4, 12, 4, 7000))
    write(root / "b" / ".pipeline_end", "")
    assert run() == sorted([*first, ("one", 6, 8, 4, True), ("two", 6, 8, 4, True), ("one", 6, 8, 8, True), ("two", 6, 8, 4, True)])
    assert read_open_clips(spark, out).count() == 0

import json
import os
import random
import time

import pytest
from folding import fold, random_records
from pyspark.sql import functions as F

from chunklake import cut_clips, parse_sidecar, run_pipeline, run_stream_pipeline
from chunklake.operators.logs import extract_log
from chunklake.plans import pipeline
from chunklake.plans.pipeline import MissingInput
from chunklake.plans.queries import QUERIES
from chunklake.sinks.store import append_batch, write_snapshot
from chunklake.sinks.text import write_clips, write_records
from chunklake.sources.lines import scan_lines
from chunklake.sources.sidecar import read_sidecar_stream, read_sidecars, without_payload
from chunklake.sources.store import read_store, write_seq
from chunklake.streaming.clips import cut_clips_stream, stream_rejects
from chunklake.streaming.logs import read_log_stream, write_record_stream
from chunklake.streaming.segments import read_open_clips, read_stream_rejects

NOW = 5000


def _line(sequence, offset, length, ts_ms, *_):
    return json.dumps({"kind": "data", "sequence": sequence, "offset": offset, "length": length, "ts_ms": ts_ms}) + "\n"


def _write(folder, sessions, payload=True):
    for name, records in sessions.items():
        (folder / f"{name}.meta.jsonl").write_text("".join(_line(*r) for r in records))
        if payload:
            (folder / f"{name}.bin").write_bytes(b"")


def _expected_store(sessions, src, ttl):
    rows = {}
    for name, records in sessions.items():
        for start, *_ in fold(records, 5000):
            ts = int(start / 1000)
            rows[f"{name}:{ts}"] = (f"{src}/{name}_{ts}.bin", NOW + ttl)
    return rows


@pytest.fixture
def sessions():
    rnd = random.Random(3)
    return {f"s{i}": random_records(rnd, 60) for i in range(5)} | {"sess_dispatch": [(1, 0, 5, 7000, 0)]}


def test_files_to_store(spark, sessions, tmp_path):
    src, path = tmp_path / "in", str(tmp_path / "db")
    src.mkdir()
    _write(src, sessions)
    (src / ".pipeline_end").write_text("done")
    (src / "empty.meta.jsonl").write_text("")
    (src / "empty.bin").write_bytes(b"")
    run_pipeline(spark, str(src), path, 300, now=NOW, run=1)
    rows = {row.key: (row.value, row.expire_at) for row in read_store(spark, path).orderBy("write_seq").collect()}
    assert rows == _expected_store(sessions, str(src), 300) and rows["sess_dispatch:7"][1] == NOW + 300
    run_pipeline(spark, str(src), path, 0, ["sess_dispatch", "empty"], now=NOW, run=2)
    added = read_store(spark, path).where("write_seq.run = 2").collect()
    assert [(row.key, row.expire_at) for row in added] == [("sess_dispatch:7", 0)]
    run_pipeline(spark, str(src), path, 0, ["sess_dispatch"], NOW, 3, "/in/{session_id}")
    assert read_store(spark, path).where("write_seq.run = 3").first().value == "/in/sess_dispatch/sess_dispatch_7.bin"


def test_missing_files_stop_before_the_write(spark, sessions, tmp_path):
    _write(tmp_path, sessions)
    (tmp_path / "s1.bin").unlink()
    store = tmp_path / "db"
    with pytest.raises(MissingInput, match="payload.*s1"):
        run_pipeline(spark, str(tmp_path), str(store))
    with pytest.raises(MissingInput, match="sidecar.*nobody"):
        run_pipeline(spark, str(tmp_path), str(store), sessions=["s2", "nobody"])
    with pytest.raises(ValueError):
        run_pipeline(spark, str(tmp_path), str(store), ttl=-1)
    assert not store.exists()


def test_sidecar_files_over_many_splits(spark, tmp_path):
    rnd = random.Random(8)
    sessions = {f"s{i}": random_records(rnd, 400) for i in range(3)}
    _write(tmp_path, sessions)
    names = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "10"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        chunks, _ = parse_sidecar(read_sidecars(spark, str(tmp_path)))
        frame = cut_clips(chunks, clip_ms=1000, keep_order=True)
        clips = frame.collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan text") == 1
    for name, records in sessions.items():
        mine = sorted((c for c in clips if c.session_id == name), key=lambda c: (c.island, c.start_ts_ms))
        assert [(c.start_ts_ms, c.offset, c.length, c.complete) for c in mine] == fold(records, 1000)


def test_text_outputs(spark, tmp_path):
    _write(tmp_path, {"s": [(1, 0, 4, 0, 0), (2, 4, 4, 6000, 0)]})
    chunks, _ = parse_sidecar(read_sidecars(spark, str(tmp_path)))
    write_clips(cut_clips(chunks, "/in"), str(tmp_path / "out"))
    assert sorted(row.value for row in spark.read.text(str(tmp_path / "out")).collect()) == [
        '{"type":"clip","session_id":"s","ts":0,"path":"/in/s_0.bin","offset":0,"length":4,"complete":true}',
        '{"type":"clip","session_id":"s","ts":6,"path":"/in/s_6.bin","offset":4,"length":4,"complete":true}',
    ]
    records = spark.createDataFrame([("a,b", "c")], "x string, y string")
    write_records(records, str(tmp_path / "csv"), ["x", "y"], "csv")
    assert spark.read.text(str(tmp_path / "csv")).first().value == '"a,b",c'


def _segments(folder, sessions, size, mark):
    """Sessions as numbered closed files, the last one ended by a mark."""
    for name, records in sessions.items():
        parts = [records[i : i + size] for i in range(0, len(records), size)]
        for n, part in enumerate(parts):
            end = '{"kind":"end"}\n' if mark and n == len(parts) - 1 else ""
            (folder / f"{name}.meta.jsonl.{n}").write_text("".join(_line(*r) for r in part) + "skip me\n\n" + end)
            time.sleep(0.002)


def test_stream_equals_batch(spark, tmp_path):
    rnd = random.Random(4)
    sessions = {f"s{i}": random_records(rnd, rnd.choice([1, 7, 40])) for i in range(6)}
    src = tmp_path / "in"
    src.mkdir()
    _segments(src, sessions, 9, mark=True)
    clips = cut_clips_stream(read_sidecar_stream(spark, str(src), max_files=5), "/in", 1000, idle_ms=None)
    writer = clips.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
    writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    found = {}
    rows = spark.read.schema(clips.schema).parquet(str(tmp_path / "out")).collect()
    for row in sorted(rows, key=lambda r: (r.session_id, r.island, r.start_ts_ms)):
        found.setdefault(row.session_id, []).append((row.start_ts_ms, row.offset, row.length, row.complete))
    assert found == {name: fold(records, 1000) for name, records in sessions.items()}


def test_stream_to_store_and_open_clips_stay(spark, tmp_path):
    src, store = tmp_path / "in", str(tmp_path / "db")
    src.mkdir()
    sessions = {"a": [(1, 0, 4, 0, 0), (2, 4, 4, 6000, 0)], "b": [(1, 0, 4, 7000, 0)]}
    _segments(src, sessions, 1, mark=False)
    run_stream_pipeline(spark, str(src), store, str(tmp_path / "cp"), 300, NOW, True, 1).awaitTermination()
    assert [row.key for row in read_store(spark, store).collect()] == ["a:0"]
    for name in sessions:
        (src / f"{name}.meta.jsonl.9").write_text('{"kind":"end"}\n')
    run_stream_pipeline(spark, str(src), store, str(tmp_path / "cp"), 300, NOW, True).awaitTermination()
    assert sorted(row.key for row in read_store(spark, store).collect()) == ["a:0", "a:6", "b:7"]


def test_silence_closes_a_clip(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _segments(src, {"a": [(1, 0, 4, 0, 0), (2, 4, 4, 100, 0)]}, 2, mark=False)
    clips = cut_clips_stream(read_sidecar_stream(spark, str(src)), "/in", idle_ms=500)
    query = clips.writeStream.format("memory").queryName("idle").trigger(processingTime="200 milliseconds")
    query = query.option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not spark.sql("SELECT * FROM idle").collect():
            time.sleep(0.5)
        (src / "a.meta.jsonl.1").write_text(_line(3, 8, 4, 200) + '{"kind":"end"}\n')
        while time.time() < deadline and spark.sql("SELECT * FROM idle").count() < 2:
            time.sleep(0.5)
        rows = spark.sql("SELECT offset, length, complete FROM idle ORDER BY island, start_ts_ms").collect()
    finally:
        query.stop()
    # the record after the pause continues the closed clip, but opens one of its own
    assert [tuple(row) for row in rows] == [(0, 8, False), (8, 4, True)]


def test_a_slow_batch_is_no_silence(spark, tmp_path):
    """Batches that take longer than a pause may: what was there in time continues its clip, and silence afterwards ends it."""
    src, rows = tmp_path / "in", []
    src.mkdir()
    _segments(src, {"a": [(n, 4 * n, 4, 100 * n) for n in range(4)]}, 1, mark=False)
    clips = cut_clips_stream(read_sidecar_stream(spark, str(src), max_files=1), "/in", idle_ms=1500)

    def slow(batch, _):
        rows.extend(batch.collect())
        time.sleep(2)

    query = clips.writeStream.foreachBatch(slow).trigger(processingTime="100 milliseconds")
    query = query.option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        deadline = time.time() + 90
        while time.time() < deadline and not rows:
            time.sleep(0.3)
    finally:
        query.stop()
    assert [(r.offset, r.length, r.complete) for r in rows] == [(0, 16, False)]


def test_log_stream(spark, tmp_path):
    src = tmp_path / "logs"
    src.mkdir()
    (src / "a.log").write_text("  1 clip /a\nbad\n2 beat /b\n3 clip /c")
    records, _ = extract_log(read_log_stream(spark, str(src)), "^([0-9]+) ([a-z]+) (.+)$", "ts,type,path", "type=clip")
    query = write_record_stream(records, str(tmp_path / "out"), str(tmp_path / "cp"), ["ts", "path"], "csv", True)
    query.awaitTermination()
    assert sorted(row.value for row in spark.read.text(str(tmp_path / "out")).collect()) == ["1,/a", "3,/c"]


def test_marks_of_sessions_in_one_batch(spark, tmp_path):
    """Records after an end mark begin afresh, even if they would continue what came before it."""
    src = tmp_path / "in"
    src.mkdir()
    text = _line(1, 0, 4, 0) + '{"kind":"end"}\n' + _line(2, 4, 4, 100) + _line(3, 8, 4, 200) + '{"kind":"end"}\n'
    (src / "a.meta.jsonl").write_text(text)
    clips = cut_clips_stream(read_sidecar_stream(spark, str(src)), idle_ms=None)
    writer = clips.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
    writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    rows = spark.read.schema(clips.schema).parquet(str(tmp_path / "out")).orderBy("island").select("offset", "length", "complete")
    assert [tuple(row) for row in rows.collect()] == [(0, 4, True), (4, 8, True)]
    assert clips.where(F.col("complete")).isStreaming


def test_equal_names_in_two_folders_are_two_sessions(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        _write(tmp_path / folder, {"s": [(i, 4 * i, 4, 100 * i, 0) for i in range(5)]})
    (tmp_path / "b" / "s.bin").unlink()
    chunks, _ = parse_sidecar(read_sidecars(spark, str(tmp_path)))
    clips = cut_clips(chunks).collect()
    assert [(c.session_id, c.offset, c.length, c.complete) for c in clips] == [("s", 0, 20, True)] * 2
    with pytest.raises(MissingInput, match="payload.*s"):
        run_pipeline(spark, str(tmp_path), str(tmp_path / "db"))


def test_a_named_session_opens_its_file_only(spark, sessions, tmp_path):
    _write(tmp_path, sessions)
    frame = read_sidecars(spark, str(tmp_path), sessions=["s1"])
    assert {row.session_id for row in frame.collect()} == {"s1"}
    names = scan_lines(spark, str(tmp_path), "*.meta.jsonl", ["s1.meta.jsonl"])
    names.collect()
    plan = names._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    assert plan.metrics().apply("numFiles").value() == 1


def test_counts_and_rejects_of_the_job(spark, sessions, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _write(src, sessions)
    with (src / "s0.meta.jsonl").open("a") as file:
        file.write('nonsense\n\n{"kind":"end"}\n')
    counts = run_pipeline(spark, str(src), str(tmp_path / "db"), now=NOW, run=1, rejects_path=str(tmp_path / "rejects"))
    expected = {name: fold(records, 5000) for name, records in sessions.items()}
    clips = [clip for found in expected.values() for clip in found]
    assert counts == {
        "lines": sum(map(len, sessions.values())) + 2,
        "rejects": 2,
        "clips": len(clips),
        "cut_short": sum(not clip[3] for clip in clips),
    }
    refused = spark.read.parquet(str(tmp_path / "rejects" / "run=1")).collect()
    assert sorted(row.line for row in refused) == sorted(["nonsense", '{"kind":"end"}'])


def test_records_and_rejects_come_of_one_scan(spark, sessions, tmp_path, monkeypatch):
    src = tmp_path / "in"
    src.mkdir()
    _write(src, sessions)
    with (src / "s0.meta.jsonl").open("a") as file:
        file.write("nonsense\n")
    scanned = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            scanned.add(batch.num_rows)
            yield batch

    def read(*args, **kwargs):
        lines = read_sidecars(*args, **kwargs)
        return lines.mapInArrow(counting, lines.schema)

    monkeypatch.setattr(pipeline, "read_sidecars", read)
    counts = run_pipeline(spark, str(src), str(tmp_path / "db"), now=NOW, run=1, rejects_path=str(tmp_path / "rejects"))
    assert counts["rejects"] == 1 and scanned.value == counts["lines"] == sum(map(len, sessions.values())) + 1
    assert [r.line for r in spark.read.parquet(str(tmp_path / "rejects" / "run=1")).collect()] == ["nonsense"]
    assert [p.name for p in (tmp_path / "rejects").iterdir() if not p.name.startswith(".")] == ["run=1"]
    run_pipeline(spark, str(src), str(tmp_path / "plain"), now=NOW, run=1)
    assert sorted(map(tuple, read_store(spark, str(tmp_path / "db")).collect())) == sorted(map(tuple, read_store(spark, str(tmp_path / "plain")).collect()))


def test_a_run_without_rejects_has_an_empty_table_of_them(spark, sessions, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _write(src, sessions)
    run_pipeline(spark, str(src), str(tmp_path / "db"), now=NOW, run=1, rejects_path=str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "rejects" / "run=1")).count() == 0


def test_a_stream_in_segments_stores_and_refuses_from_one_parse(spark, tmp_path):
    src, work = tmp_path / "in", str(tmp_path / "work")
    src.mkdir()
    rng = random.Random(4)
    records = {f"s{i}": random_records(rng, 60) for i in range(4)}
    _segments(src, records, 20, mark=True)
    for path, more in ((str(tmp_path / "db"), {"work": work}), (str(tmp_path / "other"), {})):
        query = run_stream_pipeline(spark, str(src), path, f"{path}-cp", 300, NOW, True, max_files=4, clip_src="/c", **more)
        query.awaitTermination()
        assert query.exception() is None
    stored = [sorted((r.key, r.value, r.expire_at) for r in read_store(spark, str(tmp_path / n)).collect()) for n in ("db", "other")]
    assert stored[0] == stored[1] and len(stored[0]) > 8
    refused = read_stream_rejects(spark, work).collect()
    assert [r.line for r in refused] == ["skip me"] * len(refused) and len(refused) >= 4
    assert read_open_clips(spark, f"{work}/cut").count() == 0


@pytest.mark.parametrize("work", [False, True])
def test_payloads_are_asked_for_by_session(spark, tmp_path, work):
    src = tmp_path / "in"
    for folder in ("a b", "c%20d"):
        (src / folder).mkdir(parents=True)
        _segments(src / folder, {"s+1": [(1, 0, 4, 0, 0)]}, 1, mark=True)
        (src / folder / "s+1.bin").touch()
    more = {"work": str(tmp_path / "work")} if work else {}
    args = (spark, str(src), str(tmp_path / "db"), str(tmp_path / "cp"), 300, NOW, True)
    run_stream_pipeline(*args, require_payload=True, **more).awaitTermination()
    assert read_store(spark, str(tmp_path / "db")).count() == 2
    (src / "c%20d" / "s+1.bin").unlink()
    wanted = spark.createDataFrame([(f"file:{src}/a b", "s+1"), (f"file:///{str(src).lstrip('/')}/c%20d", "s+1"), (str(src), "x")], "folder string, session_id string")
    assert sorted(r.session_id for r in without_payload(wanted, str(src)).collect()) == ["s+1", "x"]


def test_streams_and_snapshots_lose_nothing(spark, tmp_path):
    """A snapshot, then two streams of their own checkpoints, one of them run twice."""
    store = str(tmp_path / "db")
    row = spark.createDataFrame([("x:0", "/x", 0)], "key string, value string, expire_at bigint")
    write_snapshot(row.withColumn("write_seq", write_seq(5, F.lit(""), F.lit(0), F.lit(0))), store)
    for name, more in (("y", "z"), ("v", "w")):
        src = tmp_path / name
        src.mkdir()
        for session in (name, more):
            _segments(src, {session: [(1, 0, 4, 9000, 0)]}, 1, mark=True)
            run_stream_pipeline(spark, str(src), store, str(tmp_path / f"cp-{name}"), 300, NOW, True).awaitTermination()
    assert sorted(r.key for r in read_store(spark, store).collect()) == ["v:9", "w:9", "x:0", "y:9", "z:9"]


def test_a_repeated_batch_replaces_its_first_try_only(spark, tmp_path):
    store = str(tmp_path / "db")
    rows = spark.createDataFrame([("a", "/1", 0), ("b", "/1", 0)], "key string, value string, expire_at bigint")
    rows = rows.withColumn("write_seq", write_seq(1, F.lit(""), F.lit(0), F.lit(0)))
    append_batch(rows, store, "query-1", 0)
    append_batch(rows, store, "query-2", 0)
    append_batch(rows.where("key = 'a'"), store, "query-1", 0)
    assert sorted(r.key for r in read_store(spark, store).collect()) == ["a", "a", "b"]


def test_a_missing_payload_ends_the_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _segments(src, {"a": [(1, 0, 4, 0, 0)]}, 1, mark=True)
    query = run_stream_pipeline(spark, str(src), str(tmp_path / "db"), str(tmp_path / "cp"), 300, NOW, True, require_payload=True)
    with pytest.raises(Exception, match="no payload file"):
        query.awaitTermination()
    assert not (tmp_path / "db").exists()


def test_no_state_is_left_and_rejects_are_streamed(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _segments(src, {f"s{i}": [(1, 0, 4, 0, 0), (2, 4, 4, 100, 0)] for i in range(8)}, 2, mark=True)
    lines = read_sidecar_stream(spark, str(src))
    query = cut_clips_stream(lines, idle_ms=None).writeStream.format("noop").trigger(availableNow=True)
    query = query.option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    assert [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]][-1] == 0
    writer = stream_rejects(lines).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp2"))
    writer.trigger(availableNow=True).start(str(tmp_path / "rejects")).awaitTermination()
    assert [r.line for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["skip me"] * 8


def test_a_pause_between_files_of_one_batch(spark, tmp_path):
    for n, at in enumerate((1_000_000, 1_000_001, 1_000_900)):
        file = tmp_path / f"a.meta.jsonl.{n}"
        file.write_text(_line(n, 4 * n, 4, 100 * n) + ('{"kind":"end"}\n' if n == 2 else ""))
        os.utime(file, (at, at))
    clips = cut_clips_stream(read_sidecar_stream(spark, str(tmp_path)), idle_ms=600_000, wall_clock=False)
    writer = clips.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
    writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    rows = spark.read.schema(clips.schema).parquet(str(tmp_path / "out")).orderBy("offset").collect()
    assert [(r.offset, r.length, r.complete) for r in rows] == [(0, 8, False), (8, 4, True)]


@pytest.mark.parametrize("name", ["stream_clip_cut", "stream_log_extract", "stream_json_filter", "stream_store"])
def test_streams_read_a_table_of_parts(spark, tmp_path, name):
    folder = "/root/testdata/sf0.001"
    for table in ("events", "pages"):
        spark.read.parquet(f"{folder}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    found, whole = (QUERIES[name](spark, place).count() for place in (str(tmp_path), folder))
    assert found == whole > 0

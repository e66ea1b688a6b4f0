import pytest
from pyspark.sql import functions as F

from chunklake.sources import lines as line_source
from chunklake.sources.lines import drop_unterminated, number_lines, read_log_lines, scan_lines
from chunklake.sources.sidecar import list_files, missing_sessions, read_sidecars


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "10"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_order_and_numbers_over_splits(spark, tmp_path, small_splits):
    texts = {f"f{i}.log": [f"{i}-{j}" + "x" * (j % 40) for j in range(300 * i)] for i in (1, 2, 3)}
    for name, rows in texts.items():
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    frame = scan_lines(spark, str(tmp_path))
    assert frame.select("source", "block").distinct().count() > 20
    for name, rows in texts.items():
        found = frame.where(F.col("source").endswith(name)).orderBy("block", "line_id").collect()
        assert [row.line for row in found] == rows
        # the blocks lie as far apart as the lines they hold
        blocks = sorted({row.block for row in found})
        counts = [sum(row.block == block for row in found) for block in blocks]
        assert all(b - a >= n for a, b, n in zip(blocks, blocks[1:], counts))
        numbers = number_lines(frame).where(F.col("source").endswith(name)).orderBy("line_no").collect()
        assert [(row.line_no, row.line) for row in numbers] == list(enumerate(rows, 1))


def test_line_ends(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"one\rtwo\n  three \t\r\n\nlast")
    (tmp_path / "b.log").write_bytes("zür\n".encode())
    (tmp_path / "c.log").write_bytes(b"")
    found = sorted(row.line for row in read_log_lines(spark, str(tmp_path)).collect())
    assert found == ["", "last", "one\rtwo", "three", "zür"]
    kept = sorted(row.line for row in drop_unterminated(scan_lines(spark, str(tmp_path))).collect())
    assert kept == ["", "  three \t\r", "one\rtwo", "zür"]


def test_sidecars(spark, tmp_path):
    folder = tmp_path / "s.1"
    folder.mkdir()
    (folder / "s.1.meta.jsonl").write_text('{"a":1}\n\n{"b":2}\n{"part')
    (tmp_path / "t.meta.jsonl").write_text("x\n")
    (tmp_path / "u.meta.jsonl").write_text("")
    (tmp_path / "t.bin").write_bytes(b"12345")
    (tmp_path / "a b+c%d.meta.jsonl").write_text("y\n")
    (tmp_path / "a b+c%d.bin").write_bytes(b"")
    (tmp_path / "other.txt").write_text("no\n")
    lines = read_sidecars(spark, str(tmp_path))
    found = {(row.session_id, row.line) for row in lines.collect()}
    assert found == {("s.1", '{"a":1}'), ("s.1", '{"b":2}'), ("t", "x"), ("a b+c%d", "y")}
    assert read_sidecars(spark, str(tmp_path), keep_unterminated=True).count() == 5
    sessions, payloads = list_files(spark, str(tmp_path), ".meta.jsonl"), list_files(spark, str(tmp_path), ".bin")
    assert {row.session_id for row in payloads.collect()} == {"t", "a b+c%d"}
    assert {row.session_id for row in missing_sessions(sessions, payloads).collect()} == {"s.1", "u"}


def test_torn_lines_whatever_the_splits(spark, tmp_path, small_splits):
    """The split size changes between the call and the action; both scans of the plan see the same one."""
    for i in range(2):
        (tmp_path / f"f{i}.log").write_text("".join(f"{i}-{j}\n" for j in range(400)) + "torn")
    (tmp_path / "g.log").write_text("whole\n" * 30)
    frame = drop_unterminated(scan_lines(spark, str(tmp_path)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    found = [row.line for row in frame.collect()]
    assert len(found) == 830 and "torn" not in found


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
@pytest.mark.parametrize("told", [400_000, 0])
def test_line_numbers_move_no_text(spark, tmp_path, monkeypatch, split, told):
    monkeypatch.setattr(line_source, "TOLD_ROWS", told)
    texts = {f"f{n}.txt": "".join(f"{'x' * (k % 37)}\n" for k in range(40 * n)) + "last" * (n % 2) for n in range(5)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        frame = number_lines(scan_lines(spark, str(tmp_path)))
        rows = frame.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, text in texts.items():
        own = sorted((r.line_no, r.line) for r in rows if r.source.endswith("/" + name))
        assert own == list(enumerate(text.split("\n") if not text.endswith("\n") else text.split("\n")[:-1], 1)) or (own == [] and not text)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange hashpartitioning" not in plan) == bool(told) and ("BroadcastExchange" in plan) == bool(told)


@pytest.mark.parametrize("told", [400_000, 0])
def test_unterminated_lines_go_however_they_are_told(spark, tmp_path, monkeypatch, told):
    monkeypatch.setattr(line_source, "TOLD_ROWS", told)
    for n in range(6):
        (tmp_path / f"s{n}.meta.jsonl").write_text("a\nb\n" + ("torn" if n % 2 else ""), newline="")
    frame = read_sidecars(spark, str(tmp_path))
    assert sorted(r.line for r in frame.collect()) == ["a"] * 6 + ["b"] * 6

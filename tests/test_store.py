import threading

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunklake import compact, lookup, lookup_many, to_store_rows
from chunklake.operators import store as store_ops
from chunklake.operators.store import LINE_PLACE
from chunklake.sinks.store import append_store, compact_store, store_lines
from chunklake.sources.store import parse_clip_lines, read_store, read_store_tsv

NOW = 1_000_000


def _append(spark, lines, path, run, ttl, *texts):
    clips, _ = parse_clip_lines(lines(*texts))
    append_store(to_store_rows(clips, ttl, NOW, run, LINE_PLACE), path, run)


def _clip(ts, path, session="sess_001"):
    return f'{{"type":"clip","session_id":"{session}","ts":{ts},"path":"{path}"}}'


def test_append_get_upsert_compact(spark, lines, tmp_path):
    path, key = str(tmp_path / "db"), "sess_001:1747065600"
    _append(spark, lines, path, 1, 300, _clip(1747065600, "/tmp/one.mp4"))
    assert lookup(read_store(spark, path), key, NOW).first().value == "/tmp/one.mp4"
    _append(spark, lines, path, 2, 300, _clip(1747065600, "/tmp/two.mp4"))
    assert lookup(read_store(spark, path), key, NOW).first().value == "/tmp/two.mp4"
    assert lookup(read_store(spark, path), key, NOW + 300).first() is None
    _append(spark, lines, path, 3, 0, _clip(1747065601, "/tmp/no_expire.mp4"))
    assert lookup(read_store(spark, path), "sess_001:1747065601", 10**12).first().value == "/tmp/no_expire.mp4"
    compact_store(spark, path, str(tmp_path / "new"), NOW)
    rows = {row.key: (row.value, row.expire_at) for row in read_store(spark, str(tmp_path / "new")).collect()}
    assert rows == {key: ("/tmp/two.mp4", NOW + 300), "sess_001:1747065601": ("/tmp/no_expire.mp4", 0)}

    writers = [
        threading.Thread(target=_append, args=(spark, lines, path, 10 + i, 300, _clip(i, f"/tmp/{i}.mp4", "sess_c")))
        for i in range(1, 6)
    ]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert compact(read_store(spark, path), NOW).count() == 7
    with pytest.raises(Exception, match="(?i)already exists"):
        _append(spark, lines, path, 2, 300, _clip(1, "/again"))


def test_last_of_equal_keys_in_one_run_wins(spark, lines, tmp_path):
    path = str(tmp_path / "db")
    _append(spark, lines, path, 1, 0, _clip(1, "/a"), _clip(1, "/b"), _clip('"1"', "/c"))
    assert lookup(read_store(spark, path), "sess_001:1", NOW).first().value == "/c"


def test_refused_clip_lines(lines):
    good, rejects = parse_clip_lines(lines(_clip(1, "/a"), '{"session_id":"s","ts":1}', '{"session_id":"ts","ts":1,"path":"/p"}', "x"))
    assert good.count() == 1
    assert {row.line_id for row in rejects.collect()} == {1, 2, 3}


ROWS = st.lists(
    st.tuples(st.sampled_from("abcde"), st.integers(0, 3), st.sampled_from([0, 10, 50, 51, 100])), min_size=1, max_size=40
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_compaction_changes_no_lookup(spark, rows):
    frame = spark.createDataFrame(
        [(k, str(v), e, (0, "", 0, i)) for i, (k, v, e) in enumerate(rows)],
        "key string, value string, expire_at long, write_seq struct<run:long,source:string,major:long,minor:long>",
    )
    latest = {}
    for key, value, expires in rows:
        latest[key] = (str(value), expires)
    live = {key: value for key, (value, expires) in latest.items() if expires == 0 or expires > 50}
    keys = spark.createDataFrame([(key,) for key in "abcdexyz"], "key string")
    assert {row.key: row.value for row in lookup_many(frame, keys, 50).collect()} == live
    small = compact(frame, 50, in_order=True)
    assert {row.key: row.value for row in lookup_many(small, keys, 50).collect()} == live
    order = list(dict.fromkeys(key for key, _, _ in rows if key in live))
    assert [row.key for row in small.collect()] == order


def test_many_keys_are_not_broadcast(spark, monkeypatch):
    frame = spark.range(100).select(
        F.concat(F.lit("k"), F.col("id") % 10).alias("key"),
        F.col("id").cast("string").alias("value"),
        F.lit(0).cast("long").alias("expire_at"),
        F.col("id").alias("write_seq"),
    )
    keys = spark.range(5).select(F.concat(F.lit("k"), "id").alias("key"))
    few = {tuple(row) for row in lookup_many(frame, keys, 1).collect()}
    monkeypatch.setattr(store_ops, "BROADCAST_KEYS", 2)
    assert {tuple(row) for row in lookup_many(frame, keys, 1).collect()} == few == {(f"k{i}", str(90 + i)) for i in range(5)}


def test_tsv_form(spark, tmp_path):
    text = "a\tv\t5\nno row\nb\tx\t 7zz\nc\t\t0\r\nd\tv\tx\ne\tv\nf\tv\t-3\tmore"
    (tmp_path / "db").write_text(text, newline="")
    rows, rejects = read_store_tsv(spark, str(tmp_path / "db"))
    found = {row.key: (row.value, row.expire_at) for row in rows.collect()}
    assert found == {"a": ("v", 5), "b": ("x", 7), "c": ("", 0), "f": ("v", -3)}
    assert {row.line for row in rejects.collect()} == {"no row", "d\tv\tx", "e\tv"}
    assert {row.value for row in store_lines(rows).collect()} == {"a\tv\t5", "b\tx\t7", "c\t\t0", "f\tv\t-3"}


def test_lookup_is_pushed_down(spark, lines, tmp_path):
    path = str(tmp_path / "db")
    _append(spark, lines, path, 1, 0, _clip(1, "/a"))
    plan = lookup(read_store(spark, path), "sess_001:1", NOW)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(key,sess_001:1)" in plan

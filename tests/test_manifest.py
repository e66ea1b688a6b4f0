import random
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chunklake import compact, latest_per_key, lookup, lookup_many
from chunklake.schemas import STORE
from chunklake.sinks import buckets
from chunklake.sinks.snapshot import begin_merge, finish_merge, merge_store
from chunklake.sinks.store import append_batch, append_store, write_snapshot
from chunklake.sources.manifest import Manifest, ManifestConflict, SnapshotFile, commit_manifest, open_runs, read_manifest, sweep_store
from chunklake.sources.runindex import index_runs, read_index, read_store_for, read_store_for_keys
from chunklake.sources.store import read_folders, read_store


def rows(spark, run, pairs, expires=0):
    return spark.createDataFrame([(k, v, expires if isinstance(expires, int) else expires[n], (run, "", 0, n)) for n, (k, v) in enumerate(pairs)], STORE)


def content(frame):
    return sorted(map(tuple, frame.select("key", "value", "expire_at").collect()))


def test_a_run_appended_while_a_snapshot_is_made_survives(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [("a", "1"), ("b", "1")]), path, 1)
    merge = begin_merge(spark, path, 0)
    append_store(rows(spark, 2, [("b", "2"), ("c", "2")]), path, 2)
    manifest = finish_merge(merge)
    assert manifest.covered == {"run=1"} and open_runs(spark, path, manifest) == ["run=2"]
    assert content(latest_per_key(read_store(spark, path))) == [("a", "1", 0), ("b", "2", 0), ("c", "2", 0)]
    before = read_store(spark, path)
    assert content(compact(before, 0)) == content(merge_store(spark, path, 0) and read_store(spark, path))
    # a reader that planned before the swap still finds its files, until they are swept away
    assert before.count() == 4
    assert sweep_store(spark, path) == 3  # two runs and the first snapshot
    assert content(read_store(spark, path)) == [("a", "1", 0), ("b", "2", 0), ("c", "2", 0)]


def test_of_two_merges_at_once_one_wins(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [("a", "1")]), path, 1)
    first, second = begin_merge(spark, path, 0), begin_merge(spark, path, 0)
    finish_merge(first)
    with pytest.raises(ManifestConflict):
        finish_merge(second)
    assert content(read_store(spark, path)) == [("a", "1", 0)]


def test_a_version_is_put_once_by_many_writers(spark, tmp_path):
    path, won = str(tmp_path / "db"), []

    def put(n):
        try:
            commit_manifest(spark, path, Manifest(1, (SnapshotFile(f"f{n}", "a", "b", n, 0),)))
            won.append(n)
        except ManifestConflict:
            pass

    writers = [threading.Thread(target=put, args=(n,)) for n in range(8)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert len(won) == 1 and read_manifest(spark, path).files[0].rows == won[0]
    assert not [f.name for f in (tmp_path / "db" / "_manifest").iterdir() if "draft" in f.name and not f.name.endswith(".crc")]


def test_unfinished_runs_are_neither_read_nor_covered(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [("a", "1")]), path, 1)
    append_batch(rows(spark, 2, [("b", "2")]), path, "q", 0)
    append_batch(rows(spark, 3, [("c", "3")]), path, "q", 1)
    (tmp_path / "db" / "stream=q" / "batch=1" / "_SUCCESS").unlink()
    manifest = merge_store(spark, path, 0)
    assert manifest.covered == {"run=1", "stream=q/batch=0"}
    assert content(read_store(spark, path)) == [("a", "1", 0), ("b", "2", 0)]
    append_batch(rows(spark, 3, [("c", "3")]), path, "q", 1)  # the try that is repeated
    assert content(read_store(spark, path)) == [("a", "1", 0), ("b", "2", 0), ("c", "3", 0)]


def test_merges_equal_compaction_and_touch_little(spark, tmp_path):
    path, rng = str(tmp_path / "db"), random.Random(3)
    made, old = [], ()
    for run, (count, lo, hi, now) in enumerate([(1500, 0, 2000, 40), (60, 0, 100, 40), (0, 0, 1, 41), (80, 1900, 2100, 42), (40, 700, 720, 160)], 1):
        pairs = [(f"k{rng.randrange(lo, hi):05d}", f"{run}-{n}") for n in range(count)]
        made.append(rows(spark, run, pairs, [rng.choice([0, 0, 50, 150, 500]) for _ in pairs]))
        append_store(made[-1], path, run)
        merge = begin_merge(spark, path, now)
        manifest = finish_merge(merge, 200)
        whole = made[0]
        for more in made[1:]:
            whole = whole.unionByName(more)
        assert content(read_store(spark, path)) == content(compact(whole, now))
        assert all(a.most < b.least for a, b in zip(manifest.files, manifest.files[1:], strict=False))
        assert sum(f.rows for f in manifest.files) == read_store(spark, path).count()
        if run in (2, 4):  # the plan reads the new run and the files of its ranges, and no others
            read = {f.rsplit("/", 1)[1] for f in merge.rows.inputFiles()}
            untouched = {f.path.rsplit("/", 1)[1] for n, f in enumerate(old) if n not in merge.touched}
            assert len(untouched) >= 2 and not read & untouched
        if run == 3:
            assert merge.touched == [] and manifest.files == old
        old = manifest.files
    assert {f.expires for f in old} <= {0, 500}


def test_a_store_that_was_written_as_a_snapshot_goes_on(spark, tmp_path):
    path = str(tmp_path / "db")
    write_snapshot(rows(spark, 1, [("a", "1"), ("b", "1")]), path)
    append_store(rows(spark, 2, [("b", "2")]), path, 2)
    merge_store(spark, path, 0)
    assert content(read_store(spark, path)) == [("a", "1", 0), ("b", "2", 0)]


def test_an_empty_store_and_one_that_empties(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [("a", "1")], 10), path, 1)
    assert len(merge_store(spark, path, 5).files) == 1
    assert merge_store(spark, path, 10).files == () and content(read_store(spark, path)) == []


@pytest.fixture(scope="module")
def many_runs(spark, tmp_path_factory):
    """500 runs, written at once; each has keys of its own, and some keys come back in later runs. One run is not indexed."""
    path = tmp_path_factory.mktemp("runs") / "db"
    key = F.when(F.col("id") % 10 == 0, F.concat(F.lit("shared"), F.col("id") % 70)).otherwise(F.concat(F.lit("own"), F.col("id")))
    seq = F.struct(F.col("run").cast("bigint").alias("run"), F.lit("").alias("source"), F.col("id").alias("major"), F.lit(0).cast("bigint").alias("minor"))
    frame = spark.range(20_000).withColumn("run", (F.col("id") / 40).cast("int"))
    frame = frame.select(key.alias("key"), F.col("id").cast("string").alias("value"), F.lit(0).cast("bigint").alias("expire_at"), seq.alias("write_seq"), "run")
    frame.coalesce(1).write.partitionBy("run").parquet(str(path))
    for folder in path.glob("run=*"):
        (folder / "_SUCCESS").touch()
    assert len(index_runs(spark, str(path))) == 500 and index_runs(spark, str(path)) == []
    append_store(rows(spark, 900, [("late", "x"), ("", "empty")]), str(path), 900)
    return str(path)


@pytest.mark.parametrize("key", ["own1234", "own19999", "shared40", "late", "", "absent", "own", "shared40 "])
def test_lookup_opens_only_runs_that_may_hold_the_key(spark, many_runs, key):
    found, whole = read_store_for(spark, many_runs, key), read_store(spark, many_runs)
    assert content(lookup(found, key, 1).withColumn("expire_at", F.lit(0))) == content(lookup(whole, key, 1).withColumn("expire_at", F.lit(0)))
    opened = {Path(f).parent.name for f in found.inputFiles()}
    holders = {Path(r.f).parent.name for r in whole.where(F.col("key") == key).select(F.input_file_name().alias("f")).distinct().collect()}
    assert holders <= opened and "run=900" in opened
    assert len(opened - holders) <= 40  # false hits; 500 runs there are
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Scan" in plan


def test_bulk_lookup_by_the_index(spark, many_runs):
    keys = spark.createDataFrame([("own1234",), ("own77",), ("late",), ("nothing",), ("own1234",)], "key string")
    found = read_store_for_keys(spark, many_runs, keys)
    assert sorted(map(tuple, lookup_many(found, keys, 1).collect())) == [("late", "x"), ("own1234", "1234"), ("own77", "77")]
    assert len({Path(f).parent.name for f in found.inputFiles()}) <= 80


def test_index_and_snapshot_together(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [(f"k{n:03d}", "1") for n in range(300)]), path, 1)
    append_batch(rows(spark, 2, [("k005", "2")]), path, "q", 0)
    assert index_runs(spark, path) == ["run=1", "stream=q/batch=0"]
    manifest = merge_store(spark, path, 0, 50)
    append_store(rows(spark, 3, [("k250", "3")]), path, 3)
    index_runs(spark, path)
    assert read_index(spark, path).select("name").distinct().count() == 3
    found = read_store_for(spark, path, "k005")
    assert [r.value for r in lookup(found, "k005", 1).collect()] == ["2"]
    assert {f.rsplit("/", 1)[1] for f in found.inputFiles()} == {f.path.rsplit("/", 1)[1] for f in manifest.files if f.least <= "k005" <= f.most}
    assert [r.value for r in lookup(read_store_for(spark, path, "k250"), "k250", 1).collect()] == ["3"]


def test_bucketed_store_moves_nothing(spark, tmp_path):
    first = [(f"k{n % 300}", f"a{n}") for n in range(1000)]
    later = [(f"k{n % 70}", f"b{n}") for n in range(200)]
    for run, pairs in ((1, first), (2, later)):
        buckets.append_bucketed(rows(spark, run, pairs, 0 if run == 1 else 5), "bucketed_store", str(tmp_path / "store"), 8)
    buckets.write_bucketed_keys(spark.createDataFrame([("k1",), ("k200",), ("k1",), ("none",)], "key string"), "bucketed_keys", str(tmp_path / "keys"), 8)
    latest = buckets.bucketed_latest(spark, "bucketed_store")
    assert content(latest) == content(latest_per_key(rows(spark, 1, first).unionByName(rows(spark, 2, later, 5))))
    found = buckets.bucketed_lookup(spark, "bucketed_store", "bucketed_keys", 5)
    assert sorted(map(tuple, found.collect())) == [("k200", "a800")]
    assert sorted(map(tuple, buckets.bucketed_lookup(spark, "bucketed_store", "bucketed_keys", 4).collect())) == [("k1", "b141"), ("k200", "a800")]
    for frame in (latest, found):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_reading_by_folders(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [("a", "1")]), path, 1)
    assert read_folders(spark, path, []).count() == 0 and read_folders(spark, path, ["run=1"]).count() == 1


def test_filters_of_small_files_are_small(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [(f"k{n:04d}", "1") for n in range(1000)]).coalesce(1), path, 1)
    manifest = merge_store(spark, path, 0, 100)
    append_store(rows(spark, 2, [("k0005", "2")]).coalesce(1), path, 2)
    written = [file for pattern in ("run=*", "merged=*/slot=*") for file in (tmp_path / "db").glob(f"{pattern}/*.parquet")]
    assert len(manifest.files) >= 5 and len(written) == len(manifest.files) + 2
    assert max(file.stat().st_size for file in written) < 50_000  # a filter of a fixed size took 1 MB
    assert [r.value for r in lookup(read_store(spark, path), "k0005", 1).collect()] == ["2"]


def test_a_merge_cuts_files_by_keys_and_joins_small_ones(spark, tmp_path):
    path = str(tmp_path / "db")
    for run in (1, 2, 3):
        append_store(rows(spark, run, [(f"k{n % 200:04d}", f"{run}-{n}") for n in range(6000)]), path, run)
        manifest = merge_store(spark, path, 0, 100)
        # by rows instead of keys there were 60 files of about three rows, and more with each merge
        assert sum(f.rows for f in manifest.files) == 200 and len(manifest.files) <= 5
        assert all(a.most < b.least for a, b in zip(manifest.files, manifest.files[1:], strict=False))
    stored = read_store(spark, path).select("key", "value").collect()
    assert sorted(r.key for r in stored) == [f"k{n:04d}" for n in range(200)] and all(r.value.startswith("3-") for r in stored)


def test_stretches_between_untouched_files_keep_apart(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [(f"k{n:04d}", "1") for n in range(1000)]), path, 1)
    before = merge_store(spark, path, 0, 100).files
    first, last = before[0].least, before[-1].least
    append_store(rows(spark, 2, [(first, "2"), (last, "2"), ("a", "2")]), path, 2)
    after = merge_store(spark, path, 0, 100).files
    assert set(before[1:-1]) <= set(after) and all(a.most < b.least for a, b in zip(after, after[1:], strict=False))
    changed = {r.key for r in read_store(spark, path).where("value = '2'").collect()}
    assert changed == {"a", first, last} and read_store(spark, path).count() == 1001


def test_an_indexed_lookup_reads_few_files(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [(f"k{n % 200:04d}", f"1-{n}") for n in range(6000)]), path, 1)
    merge_store(spark, path, 0, 100)
    append_store(rows(spark, 2, [("k0005", "2")]).coalesce(1), path, 2)
    index_runs(spark, path)
    keys = spark.createDataFrame([("k0000",), ("k0005",), ("k0199",)], "key string")
    found = read_store_for_keys(spark, path, keys)
    assert len(found.inputFiles()) <= 5  # of the snapshot alone there were 60 files
    assert sorted(map(tuple, lookup_many(found, keys, 1).collect())) == [("k0000", "1-5800"), ("k0005", "2"), ("k0199", "1-5999")]


def test_an_index_is_as_large_as_the_keys_need(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [(f"k{n % 200:04d}", f"1-{n}") for n in range(6000)]), path, 1)
    append_store(rows(spark, 2, [(f"k{n % 7:04d}", f"2-{n}") for n in range(3000)]), path, 2)
    assert index_runs(spark, path) == ["run=1", "run=2"]
    blocks = {r["name"]: (r.blocks, r.least, r.most) for r in read_index(spark, path).collect()}
    assert blocks == {"run=1": (8, "k0000", "k0199"), "run=2": (1, "k0000", "k0006")}  # by rows there were 256 and 128
    for key in ("k0000", "k0006", "k0007", "k0199"):
        found, whole = lookup(read_store_for(spark, path, key), key, 1), lookup(read_store(spark, path), key, 1)
        assert found.collect() == whole.collect() != []


def test_a_bulk_lookup_leaves_out_rows_beyond_the_keys(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [(f"k{n:04d}", "1") for n in range(1000)]), path, 1)
    index_runs(spark, path)
    append_store(rows(spark, 2, [("a", "2"), ("k0011", "2"), ("z", "2")]), path, 2)  # not indexed
    keys = spark.createDataFrame([("k0010",), ("k0012",), (None,)], "key string")
    found = read_store_for_keys(spark, path, keys)
    assert {r.key for r in found.collect()} == {"k0010", "k0011", "k0012"}  # before: all 1003
    assert sorted(map(tuple, lookup_many(found, keys, 1).collect())) == [("k0010", "1"), ("k0012", "1")]
    assert lookup_many(read_store_for_keys(spark, path, keys.where("false")), keys, 1).count() == 0


def test_a_merge_shuffles_rows_by_key_once(spark, tmp_path):
    path = str(tmp_path / "db")
    append_store(rows(spark, 1, [(f"k{n:04d}", "1") for n in range(1000)], [n % 3 for n in range(1000)]), path, 1)
    for run in (1, 2):
        merge = begin_merge(spark, path, 1)
        plan = merge.rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(key") == 1  # new rows were reduced first, then all
        finish_merge(merge, 100)
        append_store(rows(spark, run + 1, [("k0500", "2"), ("new", "2")]), path, run + 1)
    merge_store(spark, path, 1)
    assert content(read_store(spark, path)) == content(compact(read_folders(spark, path, ["run=1", "run=2", "run=3"]), 1))


def test_store_files_are_small(spark, tmp_path):
    path = str(tmp_path / "db")
    keys = [f"click:{n * 7919 % 60_000}" for n in range(60_000)]
    append_store(rows(spark, 1, [(key, f"1-{n}") for n, key in enumerate(keys)]).coalesce(1), path, 1)
    merge_store(spark, path, 0)
    index_runs(spark, path)
    append_store(rows(spark, 2, [(key, f"2-{n}") for n, key in enumerate(keys)]).coalesce(1), path, 2)
    for pattern in ("run=*", "merged=*/slot=*"):
        files = list((tmp_path / "db").glob(f"{pattern}/*.parquet"))
        assert files and all(file.name.endswith(".zstd.parquet") for file in files)  # snappy took two to four times the bytes

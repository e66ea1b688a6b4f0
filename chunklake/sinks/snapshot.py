"""Snapshots of a store that is being appended to, made from new runs and the ranges of keys they touch.

The snapshot is a row of files sorted by key, no key in two of them. The keys of new runs are told their
file; only files that a new key falls into, or that hold a row which has expired, are read again, merged and replaced. What
covers which run is put into the store's manifest with a single rename.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.operators.store import compact
from chunklake.schemas import STORE_FIELDS
from chunklake.sinks.store import FILE_OPTIONS
from chunklake.sources.manifest import Manifest, SnapshotFile, commit_manifest, open_runs, read_manifest
from chunklake.sources.store import read_folders

#: Rows of a snapshot file, about; a file that has grown beyond it is cut where it is written again.
ROWS_PER_FILE = 4_000_000


def _slot_of(least: list[str]):
    """The number of the file whose range holds a key: the last that begins at or before it, or the first."""

    @F.pandas_udf("int")
    def slot(keys: pd.Series) -> pd.Series:
        return pd.Series([max(bisect_right(least, key) - 1, 0) for key in keys], dtype="int32")

    return slot


def _with_slots(rows: DataFrame, least: list[str]) -> DataFrame:
    return rows.withColumn("slot", _slot_of(least)("key") if least else F.lit(0))


def _stretches(manifest: Manifest, touched: list[int]) -> list[str]:
    """The least keys of the stretches of neighbouring files that are touched: within one, files may be cut anew anywhere."""
    return [manifest.files[n].least for i, n in enumerate(touched) if not i or touched[i - 1] != n - 1]


@dataclass(frozen=True)
class Merge:
    """What a merge is about to write: the version it starts from, the runs it takes in, the ranges it replaces, their rows.

    ``most`` is about the greatest number of these rows: the new keys, told by a sketch, and the rows of the files that are replaced.
    """

    path: str
    manifest: Manifest
    runs: list[str]
    touched: list[int]
    rows: DataFrame
    most: int


def begin_merge(spark: SparkSession, path: str, now: int) -> Merge:
    """Plans a merge of all runs finished by now. A range is touched where a new run has a key in it, or a row of it has expired."""
    path = path.rstrip("/")
    manifest = read_manifest(spark, path)
    runs = open_runs(spark, path, manifest)
    placed = _with_slots(read_folders(spark, path, runs).select("key"), [f.least for f in manifest.files])
    # at most one number for each file, and a sketch of the keys: none of them is sent to another task
    found = placed.agg(F.collect_set("slot"), F.hll_sketch_estimate(F.hll_sketch_agg("key")))
    slots, keys = found.first() if runs else ([], 0)
    expired = {n for n, f in enumerate(manifest.files) if 0 < f.expires <= now}
    touched = sorted(expired.union(slots)) if manifest.files else []
    # old and new rows are reduced together, with one shuffle by key
    both = read_folders(spark, path, [*(manifest.files[n].path for n in touched), *runs])
    rows = _with_slots(compact(both, now), _stretches(manifest, touched))
    # a sketch counts no null: where rows are, there is a part at least
    most = max(keys, len(slots)) + sum(manifest.files[n].rows for n in touched)
    return Merge(path, manifest, runs, touched, rows, most)


def _write_ranges(rows: DataFrame, path: str, folder: str, parts: int) -> list[SnapshotFile]:
    """Writes rows sorted by slot and key in so many parts, no file over two stretches, and tells the files."""
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(parts, "slot", "key").sortWithinPartitions("slot", "key")
    ranged.select(*STORE_FIELDS, "slot").write.options(**FILE_OPTIONS).partitionBy("slot").mode("errorifexists").parquet(f"{path}/{folder}")
    expires = F.coalesce(F.min(F.when(F.col("expire_at") != 0, F.col("expire_at"))), F.lit(0))
    files = read_folders(spark, path, [folder]).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("key").alias("least"), F.max("key").alias("most"), F.count("*").alias("rows"), expires.alias("expires")
    )
    # one row for each file, the folder's name being its own
    return [SnapshotFile(folder + r.file.split(folder, 1)[1], r.least, r.most, r.rows, r.expires) for r in files.collect()]


def finish_merge(merge: Merge, rows_per_file: int = ROWS_PER_FILE) -> Manifest:
    """Writes the touched ranges and commits the version that names them.

    Fails, without effect on readers, where another merge has come first. Runs appended since the merge began are not covered.
    """
    spark, old = merge.rows.sparkSession, merge.manifest
    parts = -(-merge.most // rows_per_file)
    written = _write_ranges(merge.rows, merge.path, f"merged={uuid.uuid4().hex}", parts) if parts else []
    kept = [f for n, f in enumerate(old.files) if n not in merge.touched]
    files = tuple(sorted([*kept, *written], key=lambda f: f.least))
    merged = Manifest(old.version + 1, files, old.covered | set(merge.runs))
    commit_manifest(spark, merge.path, merged)
    return merged


def merge_store(spark: SparkSession, path: str, now: int, rows_per_file: int = ROWS_PER_FILE) -> Manifest:
    """Brings a store's snapshot up to date with every run finished by now: what compacting the whole store at ``now`` gives."""
    return finish_merge(begin_merge(spark, path, now), rows_per_file)

"""Writing the keyed store: a folder of Parquet files, one subfolder per run.

Every run writes a folder of its own, named for its writer, so runs that append at the same time share no commit folder
and lose no row. Only a streaming batch that is repeated replaces what its first try left behind, in the folder of its own
query and batch number; no writer ever replaces another's.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.operators.store import compact
from chunklake.schemas import STORE_FIELDS
from chunklake.sources.store import read_store

#: How files of a store are written: zstd leaves less of keys, values and write orders than snappy does. The filter lets a
#: lookup skip row groups whose keys only seem to range over the one asked for. It is as large as its row group's keys need,
#: 1 KB to 1 MB: without these settings it takes 1 MB however few the rows.
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.bloom.filter.enabled#key": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.candidates.number#key": "15",  # of sizes, each half of the next
}


def append_store(rows: DataFrame, path: str, run: int) -> None:
    """Add the rows of one run. A run id may be used once."""
    _write(rows, f"{path.rstrip('/')}/run={run}", "errorifexists")


def append_batch(rows: DataFrame, path: str, query_id: str, batch_id: int) -> None:
    """Add the rows of a streaming query's micro-batch, or replace those of an earlier try of the same one.

    The id of a query is kept in its checkpoint: another checkpoint is another query, with folders of its own.
    """
    _write(rows, f"{path.rstrip('/')}/stream={query_id}/batch={batch_id}", "overwrite")


def _write(rows: DataFrame, folder: str, mode: str) -> None:
    rows.select(*STORE_FIELDS).write.options(**FILE_OPTIONS).mode(mode).parquet(folder)


def write_snapshot(rows: DataFrame, path: str) -> None:
    """These rows as a run of a store, ranged and sorted by key so that lookups read few row groups.

    The store is to be a new one: the caller points its readers at it once this returns. Rows keep the order they were
    written in, and the run's folder is new, so nothing that is there already is replaced.
    """
    ranged = rows.select(*STORE_FIELDS).repartitionByRange(F.col("key")).sortWithinPartitions("key")
    _write(ranged, f"{path.rstrip('/')}/snapshot={uuid.uuid4().hex}", "errorifexists")


def compact_store(spark: SparkSession, path: str, new_path: str, now: int) -> None:
    """Compact one store into a new one."""
    write_snapshot(compact(read_store(spark, path), now), new_path)


def store_lines(rows: DataFrame) -> DataFrame:
    """The tab-separated text form of store rows."""
    return rows.select(F.concat_ws("\t", "key", "value", F.col("expire_at").cast("string")).alias("value"))

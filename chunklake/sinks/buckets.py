"""The store as a table bucketed by key: what one key needs lies in one bucket, so latest rows and joins move nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chunklake.functions.fields import is_live
from chunklake.operators.store import latest_per_key
from chunklake.schemas import STORE_FIELDS

#: Buckets of a table, unless another number is given; a bucket of latest rows is to fit a task.
BUCKETS = 64


def append_bucketed(rows: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> None:
    """Adds the rows of one run, a file for each bucket, to a table of that name that lies at ``path``."""
    _write(rows.select(*STORE_FIELDS), table, path, buckets)


def write_bucketed_keys(keys: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> None:
    """A set of keys to look up, bucketed like the store; each once."""
    _write(keys.select("key").distinct(), table, path, buckets)


def _write(rows: DataFrame, table: str, path: str, buckets: int) -> None:
    placed = rows.repartition(buckets, "key")
    placed.write.bucketBy(buckets, "key").sortBy("key").option("path", path).mode("append").format("parquet").saveAsTable(table)


def bucketed_latest(spark: SparkSession, table: str) -> DataFrame:
    """The last written row of each key. No row leaves its bucket."""
    return latest_per_key(spark.table(table))


def bucketed_lookup(spark: SparkSession, table: str, keys: str, now: int) -> DataFrame:
    """``(key, value)`` of the keys in table ``keys`` that have a live latest row. With equally many buckets nothing is shuffled."""
    found = bucketed_latest(spark, table).join(spark.table(keys).hint("shuffle_hash"), "key", "left_semi")
    return found.where(is_live("expire_at", now)).select("key", "value")

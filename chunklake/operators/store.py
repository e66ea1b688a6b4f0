"""The keyed store with time-to-live: rows are appended, the latest written row of a key counts, expiry comes after.

An expired latest row therefore hides an older live one, in lookups and in compaction alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.functions.fields import expire_at, is_live, store_key
from chunklake.functions.options import DEFAULT_TTL_SECONDS, check_ttl
from chunklake.schemas import STORE_FIELDS
from chunklake.sources.store import write_seq

#: Key sets up to both bounds are sent to every task by `lookup_many`; larger ones are joined by shuffle.
BROADCAST_KEYS = 200_000
BROADCAST_BYTES = 16 << 20

CLIP_PLACE = ("session_id", "island", "start_ts_ms")
LINE_PLACE = ("source", "block", "line_id")


def to_store_rows(
    clips: DataFrame,
    ttl: int | str = DEFAULT_TTL_SECONDS,
    now: Column | int | None = None,
    run: Column | int = 0,
    place: tuple[str, str, str] = CLIP_PLACE,
) -> DataFrame:
    """Store rows of clip records, keyed ``session_id:ts``; records without session, ts or path give none.

    ``run`` and the three ``place`` columns order the writes, so that of equal keys the last one counts.
    """
    now = F.unix_timestamp() if now is None else now
    rows = clips.select(
        store_key(F.col("session_id"), F.col("ts")).alias("key"),
        F.col("path").alias("value"),
        expire_at(check_ttl(ttl), now).alias("expire_at"),
        write_seq(run, *[F.col(name) for name in place]).alias("write_seq"),
    )
    return rows.where(F.col("key").isNotNull() & F.col("value").isNotNull())


def latest_per_key(store: DataFrame, seq_col: str = "write_seq") -> DataFrame:
    """The last written row of each key. Reduced to one row per key and task before the shuffle."""
    row = F.struct("value", "expire_at", F.col(seq_col).alias("write_seq"))
    return store.groupBy("key").agg(F.max_by(row, F.col(seq_col)).alias("row")).select("key", "row.*")


def lookup(store: DataFrame, key: str, now: int, seq_col: str = "write_seq") -> DataFrame:
    """``(key, value)`` of one key, or no row. The key is pushed down to the scan."""
    found = latest_per_key(store.where(F.col("key") == key), seq_col)
    return found.where(is_live("expire_at", now)).select("key", "value")


def lookup_many(store: DataFrame, keys: DataFrame, now: int, seq_col: str = "write_seq") -> DataFrame:
    """``(key, value)`` of all keys in ``keys`` that have a live latest row.

    The number and size of the keys are counted first, up to the bound. A set within it is broadcast, and the store is
    filtered before it is shuffled. A larger one is shuffled with the store, both reduced to one row per key and task.
    """
    keys = keys.select("key").distinct()
    counted = keys.limit(BROADCAST_KEYS + 1).agg(F.count("*"), F.coalesce(F.sum(F.octet_length("key")), F.lit(0)))
    count, size = counted.first()
    if count <= BROADCAST_KEYS and size <= BROADCAST_BYTES:
        latest = latest_per_key(store.join(F.broadcast(keys), "key", "left_semi"), seq_col)
    else:
        rows = store.select("key", F.col(seq_col).alias("seq"), F.struct("value", "expire_at").alias("row"))
        both = rows.withColumn("asked", F.lit(False)).unionByName(
            keys.withColumn("asked", F.lit(True)), allowMissingColumns=True
        )
        latest = both.groupBy("key").agg(F.max_by("row", "seq").alias("row"), F.max("asked").alias("asked"))
        latest = latest.where("asked AND row IS NOT NULL").select("key", "row.*")
    return latest.where(is_live("expire_at", now)).select("key", "value")


def compact(store: DataFrame, now: int, seq_col: str = "write_seq", in_order: bool = False) -> DataFrame:
    """The live latest rows; ``in_order`` sorts them by the first appearance of their keys."""
    # the greatest row, its order first: beside a row to keep, `max_by` would carry the order a second time
    row = F.struct(F.col(seq_col).alias("write_seq"), "value", "expire_at")
    latest = store.groupBy("key").agg(
        F.max(F.when(F.col(seq_col).isNotNull(), row)).alias("row"), *([F.min(seq_col).alias("first_seq")] if in_order else [])
    )
    latest = latest.where(is_live(F.col("row.expire_at"), now))
    if in_order:
        latest = latest.orderBy("first_seq")
    return latest.select("key", "row.*").select(*STORE_FIELDS)

"""Appending a stream to the keyed store."""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chunklake.operators.store import CLIP_PLACE, to_store_rows
from chunklake.sinks.store import append_batch

#: The order number of a micro-batch: the time at which it was first tried, in nanoseconds, as batch runs have. Spark
#: keeps that time with the batch's offsets, so a repeat has the same one.
_RUN = "_run"
#: Called with each micro-batch before it is written; raises to end the query.
Check = Callable[[DataFrame], None] | None


def append_stream(
    rows_of: Callable[[DataFrame, Column], DataFrame], stream: DataFrame, store_path: str, checkpoint: str, available_now: bool, check: Check = None
) -> StreamingQuery:
    """Each micro-batch is one run of the store, so one that is repeated after a failure replaces its first try."""
    started, query_id = Event(), []

    def append(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        if check is not None:
            check(batch)
        append_batch(rows_of(batch, F.col(_RUN)), store_path, query_id[0], batch_id)

    trigger = {"availableNow": True} if available_now else {"processingTime": "1 second"}
    stream = stream.withColumn(_RUN, F.unix_millis(F.current_timestamp()) * 1_000_000)
    query = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    query_id.append(query.id)
    started.set()
    return query


def append_clip_stream(
    clips: DataFrame,
    store_path: str,
    checkpoint: str,
    ttl: int | str,
    now: int | None = None,
    available_now: bool = False,
    place: tuple[str, str, str] = CLIP_PLACE,
    check: Check = None,
) -> StreamingQuery:
    """Store rows of a clip stream. Of equal keys the one written later counts, be it by a batch run or a stream."""

    def rows_of(batch: DataFrame, run: Column) -> DataFrame:
        return to_store_rows(batch, ttl, now, run, place)

    return append_stream(rows_of, clips, store_path, checkpoint, available_now, check)

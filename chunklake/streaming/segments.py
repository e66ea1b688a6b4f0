"""Cutting clips from a stream with many tasks a session.

A micro-batch is cut as a batch is: by session and segment, segments reduced in parallel, one small row for each followed. What
a session brings over from the batch before is its open clip, and an open clip is what a single chunk would be: it begins at
the clip's time and offset, is as long, and the next chunk continues it. So the state is a table of such chunks, one for each
session with an open clip, written along with the clips that the batch closed: one folder a batch, its rows parted by whether
they are open, replaced where a batch is tried again.

An end mark behind a session's lines closes its clip; a mark of a folder closes those of all of its sessions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chunklake.functions.fields import CLIP_TYPE, END_KIND, field_kind, session_folder, session_key
from chunklake.functions.options import DEFAULT_CLIP_MS, DEFAULT_TTL_SECONDS, check_span_ms, check_ttl
from chunklake.operators.clips import Order, by_number, cut_by_key, finish_clips
from chunklake.operators.sidecar import read_records, read_rejects, tag_sidecar, write_both
from chunklake.operators.store import to_store_rows
from chunklake.schemas import META
from chunklake.sinks.store import append_batch
from chunklake.sources.manifest import Folder

#: Lines of a segment, which one task cuts; and sessions ended by a batch whose marks are told to every task.
SEGMENT_LINES, TOLD_MARKS = 1 << 16, 50_000
#: Places in a session: its files' numbers, and within a file so many lines or bytes.
_FILE = 1 << 40
_STATE = "session_id string, start_ts_ms bigint, offset bigint, next_sequence bigint, next_offset bigint, arrival bigint"
_NUMBERS = ["sequence", "offset", "length", "ts_ms", "arrival"]
_ROWS = f"{_STATE}, island bigint, length bigint, complete boolean, open boolean"


def _opened(state: DataFrame) -> DataFrame:
    """Open clips as chunks in front of all others."""
    return state.selectExpr(
        "session_id", "-1L AS place", "next_sequence - 1 AS sequence", "offset", "next_offset - offset AS length", "start_ts_ms AS ts_ms", "arrival"
    )


def _marks(records: DataFrame, sessions: DataFrame, folder_marks: DataFrame | None) -> DataFrame:
    """``key`` and ``marks``, the sorted places at which a session ends in this batch."""
    own = records.where("ended").select("session_id", "place")
    if folder_marks is not None:
        # a mark is put when its folder's lines are all there, so it stands behind them
        ended = sessions.select("session_id").distinct().withColumn("folder", session_folder("session_id"))
        ended = ended.join(folder_marks.select("folder").distinct(), "folder", "left_semi")
        own = own.unionByName(ended.select("session_id", F.lit((1 << 63) - 1).alias("place")))
    return own.groupBy(F.col("session_id").alias("key")).agg(F.array_sort(F.collect_set("place")).alias("marks"))


def cut_batch(
    records: DataFrame,
    state: DataFrame,
    clip_ms: int = DEFAULT_CLIP_MS,
    idle_ms: int | None = None,
    folder_marks: DataFrame | None = None,
    segment_lines: int = SEGMENT_LINES,
) -> DataFrame:
    """Clips of one micro-batch, closed ones and, ``open``, what each session takes over into the next.

    ``records`` are shaped like those of `stream_records`, ``folder_marks`` has the ``folder`` of each end marker.
    """
    placed = records.withColumn("place", F.col("block") * F.lit(_FILE) + F.col("line_id"))
    chunks = placed.where("NOT ended").select("session_id", "place", *_NUMBERS).unionByName(_opened(state))
    marks = _marks(placed, chunks, folder_marks)
    few = marks.limit(TOLD_MARKS + 1).count() <= TOLD_MARKS
    chunks = chunks.join(F.broadcast(marks) if few else marks, F.col("session_id") == F.col("key"), "left")
    # a session that goes on behind a mark is another one for the cutter
    life = F.coalesce(F.size(F.filter("marks", lambda m: m < F.col("place"))), F.lit(0))
    last_life = F.coalesce(F.size("marks"), F.lit(0))
    chunks = chunks.select(
        F.col("session_id").alias("whole"), life.alias("life"), (life == last_life).alias("goes_on"), "place", *_NUMBERS
    ).withColumn("session_id", session_key(F.col("life").cast("string"), "whole"))
    order: Order = by_number("place", segment_lines)
    clips = cut_by_key(chunks, clip_ms, idle_ms, "arrival" if idle_ms is not None else None, order)
    ends = chunks.groupBy("session_id").agg(
        F.first("whole").alias("whole"),
        F.first("goes_on").alias("goes_on"),
        (F.max_by("sequence", "place") + 1).alias("next_sequence"),
        F.max_by(F.col("offset") + F.col("length"), "place").alias("next_offset"),
        F.max_by("arrival", "place").alias("arrival"),
    )
    last = clips.groupBy("session_id").agg(F.max(F.struct("island", "start_ts_ms")).alias("last"))
    told = clips.join(last.join(ends, "session_id").hint("shuffle_hash"), "session_id")
    is_last = F.struct("island", "start_ts_ms") == F.col("last")
    return told.withColumn("open", F.col("goes_on") & is_last).drop("session_id").withColumnRenamed("whole", "session_id").select(
        *[part.split()[0] for part in _ROWS.split(", ")]
    )


def append_cut_stream(
    records: DataFrame,
    path: str,
    checkpoint: str,
    clip_ms: int = DEFAULT_CLIP_MS,
    idle_ms: int | None = None,
    available_now: bool = False,
    segment_lines: int = SEGMENT_LINES,
) -> StreamingQuery:
    """Cuts a stream shaped like `stream_records` into ``path``; `read_cut_clips` reads what is closed.

    Records may have ``folder_mark``, the folder of an end marker (their other columns are then null). Pauses show in the
    ``arrival`` times of records; a clip whose session falls silent is closed by its next record or mark.
    """
    check_span_ms("clip_ms", clip_ms)
    if idle_ms is not None:
        check_span_ms("idle_ms", idle_ms)
    spark = records.sparkSession

    def cut(batch: DataFrame, batch_id: int) -> None:
        folder_marks = None
        if "folder_mark" in batch.columns:
            folder_marks = batch.where("folder_mark IS NOT NULL").select(F.col("folder_mark").alias("folder"))
            batch = batch.where("folder_mark IS NULL").drop("folder_mark")
        rows = cut_batch(batch, read_open_clips(spark, path, batch_id), clip_ms, idle_ms, folder_marks, segment_lines)
        rows.write.mode("overwrite").partitionBy("open").parquet(f"{path}/batch={batch_id}")

    trigger = {"availableNow": True} if available_now else {"processingTime": "1 second"}
    return records.writeStream.foreachBatch(cut).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def append_pipeline_stream(
    lines: DataFrame,
    path: str,
    store_path: str,
    checkpoint: str,
    ttl: int | str = DEFAULT_TTL_SECONDS,
    now: int | None = None,
    clip_src: str = "",
    clip_ms: int = DEFAULT_CLIP_MS,
    idle_ms: int | None = None,
    available_now: bool = False,
    check: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """The whole job over a stream of sidecar lines: clips to the store, refused lines to ``{path}/parsed``, from one parse.

    Each micro-batch is parsed once and written as a table of two parts, records and rejects (`read_stream_rejects`); its
    records are cut segment by segment, and the clips it closes are one run of the store. ``check`` is called with the clips
    of a micro-batch before any is stored, and raises to end the query.
    """
    spark = lines.sparkSession
    ttl = check_ttl(ttl)
    marked = "folder_mark" in lines.columns
    stream = lines.withColumn("_run", F.unix_millis(F.current_timestamp()) * 1_000_000)
    started, query_id = Event(), []

    def take(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        parsed = f"{path}/parsed/batch={batch_id}"
        folder_marks = batch.where("folder_mark IS NOT NULL").select(F.col("folder_mark").alias("folder")) if marked else None
        text = batch.where("folder_mark IS NULL").drop("folder_mark") if marked else batch
        # end marks are neither data nor refused: they are few, and kept as records of their own kind
        write_both(tag_stream(text), parsed, "overwrite")
        records = read_stream_records(spark, parsed)
        rows = cut_batch(records, read_open_clips(spark, f"{path}/cut", batch_id), clip_ms, idle_ms, folder_marks)
        rows.write.mode("overwrite").partitionBy("open").parquet(f"{path}/cut/batch={batch_id}")
        closed = finish_clips(_read(spark, f"{path}/cut", [batch_id], False), clip_src, keep_order=True, keep_folder=True)
        if check is not None:
            check(closed)
        run = batch.select("_run").first()  # the time the batch was first tried, the same when it is tried again
        if run is not None:
            stored = to_store_rows(closed.where(F.col("type") == CLIP_TYPE), ttl, now, F.lit(run["_run"]))
            append_batch(stored, store_path, query_id[0], batch_id)

    trigger = {"availableNow": True} if available_now else {"processingTime": "1 second"}
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    query_id.append(query.id)
    started.set()
    return query


def tag_stream(lines: DataFrame) -> DataFrame:
    """Tagged lines of a stream; an end mark counts as a record of that kind, of no bytes."""
    numbers = {f.name: F.lit(0).cast("bigint") for f in META if f.name != "kind"}
    mark = F.struct(*[numbers.get(f.name, F.lit(END_KIND)).alias(f.name) for f in META])
    tagged = tag_sidecar(lines.withColumn("session_id", session_key("folder", "session_id")))
    ended = F.coalesce(field_kind("line") == END_KIND, F.lit(False))
    return tagged.withColumn("parsed", F.coalesce("parsed", F.when(ended, mark)))


def read_stream_records(spark: SparkSession, parsed: str) -> DataFrame:
    """The records of one micro-batch, shaped like those of `stream_records`."""
    records = read_records(spark, parsed, arrival=True)
    numbers = ["sequence", "offset", "length", "ts_ms"]
    return records.select("session_id", "block", "line_id", (F.col("kind") == END_KIND).alias("ended"), *numbers, F.col("arrival_ms").alias("arrival"))


def read_stream_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The refused lines of all micro-batches."""
    folder = Folder(spark, f"{path}/parsed")
    parts = [read_rejects(spark, f"{path}/parsed/{name}") for name in folder.names() if folder.holds(f"{name}/_SUCCESS")]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "source string, block bigint, line_id bigint, reason string, line string")


def _batches(spark: SparkSession, path: str) -> list[int]:
    folder = Folder(spark, path)
    names = [name for name in folder.names() if name.startswith("batch=") and folder.holds(f"{name}/_SUCCESS")]
    return sorted(int(name.removeprefix("batch=")) for name in names)


def _read(spark: SparkSession, path: str, batches: list[int], is_open: bool) -> DataFrame:
    folder, part = Folder(spark, path), f"open={str(is_open).lower()}"
    schema = _ROWS.rsplit(", ", 1)[0]
    paths = [f"batch={n}/{part}" for n in batches]
    found = [f"{path}/{name}" for name in paths if folder.holds(name)]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def read_open_clips(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """What sessions took over from the last batch, or from the one before a batch."""
    batches = [n for n in _batches(spark, path) if before is None or n < before]
    return _read(spark, path, batches[-1:], True).select(*[part.split()[0] for part in _STATE.split(", ")])


def read_cut_clips(spark: SparkSession, path: str, src: str = "") -> DataFrame:
    """The records of all closed clips, with ``island`` and ``start_ts_ms``."""
    return finish_clips(_read(spark, path, _batches(spark, path), False), src, keep_order=True)

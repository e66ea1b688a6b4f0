"""The whole job: cut clips, keep clip records, append them to the store."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chunklake.functions.fields import CLIP_TYPE, PAYLOAD_SUFFIX, SIDECAR_SUFFIX
from chunklake.functions.options import DEFAULT_IDLE_MS, DEFAULT_TTL_SECONDS, check_ttl
from chunklake.operators.clips import Order, cut_clips
from chunklake.operators.rejects import count_clips, count_rejects
from chunklake.operators.sidecar import REJECTS, read_records, read_rejects, split_sidecar, tag_sidecar, write_both
from chunklake.operators.store import to_store_rows
from chunklake.sinks.store import append_store
from chunklake.sources.manifest import Folder
from chunklake.sources.sidecar import list_files, missing_sessions, read_sidecar_stream, read_sidecars, without_payload
from chunklake.streaming.clips import cut_clips_stream
from chunklake.streaming.segments import append_pipeline_stream
from chunklake.streaming.store import append_clip_stream


class MissingInput(FileNotFoundError):
    """A session lacks its payload or its sidecar file."""


def clips_to_store(
    chunks: DataFrame,
    src: str,
    ttl: int | str = DEFAULT_TTL_SECONDS,
    now: Column | int | None = None,
    run: int = 0,
    order: Order = Order(),
) -> DataFrame:
    """Store rows of all sessions in ``chunks``, as one plan."""
    clips = cut_clips(chunks, src, order=order, keep_order=True)
    return to_store_rows(clips.where(F.col("type") == CLIP_TYPE), ttl, now, run)


def run_pipeline(
    spark: SparkSession,
    src: str,
    store_path: str,
    ttl: int | str = DEFAULT_TTL_SECONDS,
    sessions: list[str] | None = None,
    now: int | None = None,
    run: int | None = None,
    clip_src: str | None = None,
    rejects_path: str | None = None,
) -> dict[str, int]:
    """Cut every session under ``src`` (or the named ones) and append the clips to the store.

    ``clip_src`` is the folder named in clip paths if that is not ``src``, as in ``/data/in/{session_id}``. Refused lines
    go to a folder of the run under ``rejects_path``, if given. Returns the counts of ``lines``, ``rejects``, ``clips`` and
    ``cut_short`` clips, taken while the clips were written.

    With rejects the lines are parsed once, into a folder beside them that holds the records until the clips are stored.

    Fails before anything is written when a session has no payload file, or a named one no sidecar. Of named sessions only
    their files are opened.
    """
    ttl = check_ttl(ttl)
    wanted = list_files(spark, src, SIDECAR_SUFFIX)
    if sessions is not None:
        named = spark.createDataFrame([(name,) for name in sessions], "session_id string")
        _require(missing_sessions(named, wanted), "sidecar")
        wanted = wanted.join(named.distinct(), "session_id", "left_semi")
    _require(missing_sessions(wanted, list_files(spark, src, PAYLOAD_SUFFIX)), "payload")
    run = time.time_ns() if run is None else run
    tagged, seen = count_rejects(tag_sidecar(read_sidecars(spark, src, sessions=sessions)))
    if rejects_path:
        # one pass over the text for both outputs; what it wrote becomes the run's rejects once the clips are stored
        parsed = f"{rejects_path.rstrip('/')}/_parsed-{uuid.uuid4().hex}"
        write_both(tagged, parsed)
        chunks = read_records(spark, parsed)
    else:
        chunks, _ = split_sidecar(tagged)
    clips, cut = count_clips(cut_clips(chunks, clip_src or src, keep_order=True))
    append_store(to_store_rows(clips.where(F.col("type") == CLIP_TYPE), ttl, now, run), store_path, run)
    if rejects_path:
        commit_rejects(spark, parsed, f"{rejects_path.rstrip('/')}/run={run}")
    return dict(seen.get) | dict(cut.get)


def commit_rejects(spark: SparkSession, parsed: str, to: str) -> None:
    """The rejects of a pass, moved to where their run's belong; its records, which are stored as clips, are removed."""
    folder = Folder(spark, parsed)
    if folder.holds(f"part={REJECTS}"):
        folder.rename(f"part={REJECTS}", to)
    else:
        read_rejects(spark, parsed).write.mode("errorifexists").parquet(to)
    folder.remove("")


def _require(missing: DataFrame, what: str) -> None:
    names = [row.session_id for row in missing.limit(10).collect()]
    if names:
        raise MissingInput(f"no {what} file for {names} (at most 10 shown)")


def run_stream_pipeline(
    spark: SparkSession,
    src: str,
    store_path: str,
    checkpoint: str,
    ttl: int | str = DEFAULT_TTL_SECONDS,
    now: int | None = None,
    available_now: bool = False,
    max_files: int | None = None,
    require_payload: bool = False,
    clip_src: str | None = None,
    work: str | None = None,
) -> StreamingQuery:
    """The same over closed segment files as they arrive. ``available_now`` ends after what is there.

    With ``require_payload`` a micro-batch with clips of a session that has no payload file ends the query before it is
    written. With a ``work`` folder each micro-batch is parsed once into records and rejects there, and cut segment by segment,
    many tasks a session; without it the state is Spark's, the wall clock closes clips, and refused lines are those of
    `stream_rejects` over the same stream.
    """
    lines = read_sidecar_stream(spark, src, max_files=max_files)

    def check(batch: DataFrame) -> None:
        _require(without_payload(batch, src), "payload")

    ttl, check_clips = check_ttl(ttl), check if require_payload else None
    if work is not None:
        return append_pipeline_stream(lines, work, store_path, checkpoint, ttl, now, clip_src or src, available_now=available_now, check=check_clips)
    clips = cut_clips_stream(lines, clip_src or src, idle_ms=None if available_now else DEFAULT_IDLE_MS, keep_folder=True)
    return append_clip_stream(clips, store_path, checkpoint, ttl, now, available_now, check=check_clips)

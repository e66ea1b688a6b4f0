"""Cutting clips from a stream of sidecar lines.

The state of a session is its one open clip; a session without one has none. A session's lines of a micro-batch come to
one task, so the bytes taken per trigger bound that task; within it the lines are put in file and line order, and lateness
is a break, as in batch. A pause shows in the times at which files were closed, however late or slow the batch is that reads
them; the wall clock closes the clip of a session from which no file comes any more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chunklake.functions.fields import END_KIND, field_kind, session_key
from chunklake.functions.options import DEFAULT_CLIP_MS, DEFAULT_IDLE_MS, check_span_ms
from chunklake.operators.clips import finish_clips
from chunklake.operators.cutting import cut_points, highest_so_far
from chunklake.operators.sidecar import parse_sidecar, tag_sidecar

_CLIP = "session_id string, island bigint, start_ts_ms bigint, offset bigint, length bigint, complete boolean"
_STATE = (
    "open boolean, island bigint, start_ts_ms bigint, offset bigint, length bigint, "
    "next_sequence bigint, next_offset bigint, arrival bigint"
)
_NUMBERS = ["sequence", "offset", "length", "ts_ms"]


def stream_records(lines: DataFrame, mode: str = "textual") -> DataFrame:
    """Data records and end marks of a sidecar line stream, each with its place and, as ``arrival``, its file's time.

    Where lines have a ``folder`` it is part of the session's key. End markers of folders, rows with a ``folder_mark``, are kept.
    """
    marked = "folder_mark" in lines.columns
    if "folder" in lines.columns:
        lines = lines.withColumn("session_id", session_key("folder", "session_id")).drop("folder")
    arrival = F.col("arrival_ms") if "arrival_ms" in lines.columns else F.lit(0).cast("bigint")
    ended = F.col("parsed").isNull() & F.coalesce(F.col("ended"), F.lit(False))
    numbers = [F.coalesce(F.col(f"parsed.{name}"), F.lit(0)).alias(name) for name in _NUMBERS]
    record = F.struct("session_id", "block", "line_id", ended.alias("ended"), *numbers, arrival.alias("arrival"), *(["folder_mark"] if marked else []))
    tagged = tag_sidecar(lines, mode).withColumn("ended", field_kind("line") == END_KIND)
    wanted = F.col("parsed").isNotNull() | F.col("ended")
    if marked:
        wanted = F.col("folder_mark").isNotNull() | wanted
    return tagged.select(F.inline(F.when(wanted, F.array(record))))


def stream_rejects(lines: DataFrame, mode: str = "textual") -> DataFrame:
    """The refused lines of a sidecar line stream: all but data records, end marks and empty lines."""
    ended = F.coalesce(field_kind("line") == END_KIND, F.lit(False))
    return parse_sidecar(lines.where(~ended), mode)[1]


def _advance(clip_ms: int, idle_ms: int | None, wall_clock: bool):
    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_, island, start, offset, length, next_sequence, next_offset, last_arrival = (
            state.get if state.exists else (False, 0, 0, 0, 0, 0, 0, 0)
        )
        if state.hasTimedOut:
            if open_:
                yield _frame(key[0], [island], [start], [offset], [length], [False])
            state.remove()
            return
        rows = pd.concat(list(frames), ignore_index=True).sort_values(["block", "line_id"], ignore_index=True)
        marks = rows["ended"].to_numpy(bool)
        behind_mark = np.cumsum(marks)[~marks]
        sequence, offsets, lengths, times, arrival = (rows[name].to_numpy(np.int64)[~marks] for name in (*_NUMBERS, "arrival"))
        count = len(times)
        if not count:
            if open_ and marks.any():
                yield _frame(key[0], [island], [start], [offset], [length], [True])
                open_, island = False, island + 1
        else:
            head = np.ones(count, bool)
            after_mark = behind_mark[1:] != behind_mark[:-1]
            head[1:] = after_mark | (sequence[1:] != sequence[:-1] + 1) | (offsets[1:] != (offsets + lengths)[:-1])
            goes_on = open_ and behind_mark[0] == 0 and sequence[0] == next_sequence and offsets[0] == next_offset
            if idle_ms is not None:
                head[1:] |= arrival[1:] - arrival[:-1] >= idle_ms
                goes_on = goes_on and arrival[0] - last_arrival < idle_ms
            if open_ and not goes_on:
                yield _frame(key[0], [island], [start], [offset], [length], [bool(behind_mark[0] > 0)])
                island += 1
            heads = np.flatnonzero(head)
            anchors = times[heads]
            if goes_on:
                anchors[0] = start
            sizes = np.diff(np.append(heads, count))
            highest = highest_so_far(np.maximum(times, np.repeat(anchors, sizes)), heads)
            cuts = cut_points(highest, heads, anchors, clip_ms)
            firsts = np.union1d(heads, cuts)
            run = np.searchsorted(heads, firsts, side="right") - 1
            is_cut = np.isin(firsts, cuts, assume_unique=True)
            starts = np.where(is_cut, highest[firsts], anchors[run])
            sums, begins = np.add.reduceat(lengths, firsts), offsets[firsts]
            # a clip is complete when a cut or an end mark follows it
            marked = np.append(behind_mark[1:] != behind_mark[:-1], marks.sum() > behind_mark[-1])
            lasts = np.append(firsts[1:], count) - 1
            complete = marked[lasts]
            complete[:-1] |= is_cut[1:]
            islands = island + run
            if goes_on and is_cut[0]:
                yield _frame(key[0], [island], [start], [offset], [length], [True])
            elif goes_on:
                begins[0] = offset
                sums[0] += length
            ended = bool(marked[-1])
            keep = len(firsts) if ended else len(firsts) - 1
            if keep:
                yield _frame(key[0], islands[:keep], starts[:keep], begins[:keep], sums[:keep], complete[:keep])
            open_, island = not ended, int(islands[-1]) + ended
            start, offset, length = int(starts[-1]), int(begins[-1]), int(sums[-1])
            next_sequence, next_offset = int(sequence[-1]) + 1, int(offsets[-1] + lengths[-1])
            last_arrival = int(arrival[-1])
        if open_:
            state.update((open_, island, start, offset, length, next_sequence, next_offset, last_arrival))
            if idle_ms is not None and wall_clock:
                state.setTimeoutDuration(idle_ms)
        elif state.exists:
            state.remove()  # later clips come in a later run, so islands may begin again

    return advance


def _frame(session_id: str, island, start, offset, length, complete) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "session_id": session_id,
            "island": island,
            "start_ts_ms": start,
            "offset": offset,
            "length": length,
            "complete": complete,
        }
    )


def cut_record_stream(
    records: DataFrame,
    src: str = "",
    clip_ms: int = DEFAULT_CLIP_MS,
    idle_ms: int | None = DEFAULT_IDLE_MS,
    wall_clock: bool = True,
    keep_folder: bool = False,
) -> DataFrame:
    """Clips, with ``island`` and ``start_ts_ms``, of a stream shaped like `stream_records`.

    ``idle_ms`` closes a clip incomplete where the session's ``arrival`` times pause that long and, with ``wall_clock``, when
    nothing of it has come for that long; without it a clip stays open until a later record or an end mark closes it.
    """
    check_span_ms("clip_ms", clip_ms)
    if idle_ms is not None:
        check_span_ms("idle_ms", idle_ms)
    wall_clock = wall_clock and idle_ms is not None
    timeout = GroupStateTimeout.ProcessingTimeTimeout if wall_clock else GroupStateTimeout.NoTimeout
    clips = records.groupBy("session_id").applyInPandasWithState(
        _advance(clip_ms, idle_ms, wall_clock), _CLIP, _STATE, "append", timeout
    )
    return finish_clips(clips, src, keep_order=True, keep_folder=keep_folder)


def cut_clips_stream(
    lines: DataFrame,
    src: str = "",
    clip_ms: int = DEFAULT_CLIP_MS,
    idle_ms: int | None = DEFAULT_IDLE_MS,
    wall_clock: bool = True,
    keep_folder: bool = False,
) -> DataFrame:
    """Clips of a sidecar line stream."""
    return cut_record_stream(stream_records(lines), src, clip_ms, idle_ms, wall_clock, keep_folder)

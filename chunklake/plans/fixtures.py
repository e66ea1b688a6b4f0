"""Sidecars made by Spark: the generator of plain test sessions, and sessions derived from a table of events."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.functions.fields import DATA_KIND, END_KIND, END_MARKER_NAME, PAYLOAD_SUFFIX, SIDECAR_SUFFIX
from chunklake.sources.files import located

# Fixed values of the generated sets: chunk counts, bytes per chunk, spacing and where the numbering jumps.
CHUNKS = {"small": 100, "medium": 10_000, "malformed": 500}
CHUNK_BYTES = 4096
FIRST_TS_MS = 1000
SPACING_MS = 100
JUMP_AT, JUMP_BY = 200, 5

#: Microseconds since the epoch of a time without a zone, whatever zone the session has.
EPOCH_MICROS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"


def generate_chunks(spark: SparkSession, kind: str = "medium", session_id: str | None = None) -> DataFrame:
    """``(session_id, line_no, kind, sequence, offset, length, ts_ms)`` of one generated session."""
    i = F.col("id")
    jump = F.when(i == JUMP_AT, JUMP_BY).otherwise(0) if kind == "malformed" else F.lit(0)
    return spark.range(CHUNKS[kind]).select(
        F.lit(session_id or f"bench_{kind}").alias("session_id"),
        (i + 1).alias("line_no"),
        F.lit(DATA_KIND).alias("kind"),
        (i + 1 + jump).alias("sequence"),
        (i * CHUNK_BYTES).alias("offset"),
        F.lit(CHUNK_BYTES).cast("bigint").alias("length"),
        (FIRST_TS_MS + i * SPACING_MS).alias("ts_ms"),
    )


def meta_line() -> Column:
    """A chunk as a sidecar line."""
    return F.to_json(F.struct("kind", "sequence", "offset", "length", "ts_ms"))


def event_chunks(events: DataFrame) -> DataFrame:
    """Chunks of about thirty sessions, one of which holds a third of all events.

    The hot session takes every third stretch of 640 events, the others take 64 in turn. Sequence jumps every 997
    events, offset every 1,009, and every thirteenth chunk's clock is two hours behind. A chunk has ``1 + i % 4096``
    bytes; the sum of that over all earlier events has a closed form, so offsets need no running sum.
    """
    return events.selectExpr(
        "if((event_id div 640) % 3 = 0, 'hot', concat('cam', (event_id div 64) % 29)) AS session_id",
        "event_id AS line_no",
        "'data' AS kind",
        "event_id + event_id div 997 AS sequence",
        "event_id + (event_id div 4096) * 8386560 + ((event_id % 4096) * (event_id % 4096 - 1)) div 2"
        " + (event_id div 1009) * 7 AS offset",
        "1 + event_id % 4096 AS length",
        f"{EPOCH_MICROS} div 1000 - if(event_id % 13 = 5, 7200000, 0) AS ts_ms",
        f"{EPOCH_MICROS} div 1000 AS arrival_ms",
    )


def event_lines(events: DataFrame) -> DataFrame:
    """The same chunks as sidecar lines, some of them of another kind, damaged, or in an older spelling."""
    event_id = F.col("line_no")
    line = meta_line()
    damaged = (
        F.when(event_id % 50 == 7, F.replace(line, F.lit('"data"'), F.lit('"json"')))
        .when(event_id % 50 == 11, F.replace(line, F.lit('"sequence"'), F.lit('"seq"')))
        .when(event_id % 50 == 13, F.substr(line, F.lit(1), F.lit(30)))
        .when(event_id % 50 == 17, F.replace(line, F.lit('"offset":'), F.lit('"offset":-')))
        .when(event_id % 50 == 19, F.lit(""))
        .otherwise(line)
    )
    return event_chunks(events).select("session_id", F.col("line_no").alias("line_id"), damaged.alias("line"))


#: Lines of a table that lie in one folder, so that a session with many of them is many files.
FOLDER_LINES = 20_000


def folder_of(line_id: str = "line_id") -> Column:
    """The folder of a line: ``r0``, ``r1`` and so on."""
    return F.concat(F.lit("r"), F.expr(f"{line_id} div {FOLDER_LINES}").cast("string"))


def write_sidecars(
    lines: DataFrame, root: str, torn: Column | None = None, ended: bool = False, payloads: bool = False, append: bool = False
) -> int:
    """Lines as files ``{folder}/{session}.meta.jsonl`` under ``root``, in the order of ``line_id``; returns their number.

    ``lines`` has ``folder``, ``session_id``, ``line_id`` and ``line``. The last line of a ``torn`` session has no line end.
    ``ended`` puts an end mark behind each session, ``payloads`` an empty payload beside it. Files are written by tasks, one for
    each session of a folder, under the names they keep; ``append`` adds to files that are there.
    """
    keys = ["folder", "session_id"]

    def write(group: pa.Table) -> pa.Table:
        group = group.sort_by("line_id")
        folder, session = group["folder"][0].as_py(), group["session_id"][0].as_py()
        system, top = located(f"{root}/{folder}")
        system.create_dir(top)
        text = "".join(f"{line}\n" for line in group["line"].to_pylist())
        if ended:
            text += f'{{"kind":"{END_KIND}"}}\n'
        if group["torn"][0].as_py():
            text = text.removesuffix("\n")
        name = f"{top}/{session}{SIDECAR_SUFFIX}"
        with system.open_append_stream(name) if append else system.open_output_stream(name) as file:
            file.write(text.encode())
        if payloads:
            system.open_output_stream(f"{top}/{session}{PAYLOAD_SUFFIX}").close()
        return pa.table({"lines": pa.array([group.num_rows], pa.int64())})

    placed = lines.select(*keys, "line_id", "line", (F.lit(False) if torn is None else torn).alias("torn"))
    return placed.groupBy(*keys).applyInArrow(write, "lines bigint").count()


def put_markers(root: str, folders: list[str]) -> None:
    """An end marker in each folder."""
    for folder in folders:
        system, top = located(f"{root}/{folder}")
        system.open_output_stream(f"{top}/{END_MARKER_NAME}").close()

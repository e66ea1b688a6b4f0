"""The registered queries. Each reads whole tables of the given folder."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.functions.fields import (
    field_integer,
    field_scalar,
    field_string,
    is_end_marker,
    is_live,
    looks_like_object,
    trim_line,
)
from chunklake.operators.clips import by_number, continuity_breaks, cut_clips, order_of
from chunklake.operators.logs import extract_log, filter_json_lines, format_records
from chunklake.operators.sidecar import parse_sidecar, tag_sidecar
from chunklake.operators.store import LINE_PLACE, compact, latest_per_key, lookup, lookup_many, to_store_rows
from chunklake.plans.fixtures import EPOCH_MICROS, FOLDER_LINES, event_chunks, event_lines, folder_of, put_markers, write_sidecars
from chunklake.plans.pipeline import clips_to_store, run_pipeline, run_stream_pipeline
from chunklake.schemas import CLIP_FIELDS, STORE
from chunklake.session import shared_folder
from chunklake.sinks.buckets import append_bucketed, bucketed_latest, bucketed_lookup, write_bucketed_keys
from chunklake.sinks.snapshot import begin_merge, finish_merge, merge_store
from chunklake.sinks.store import append_store, compact_store, store_lines
from chunklake.sinks.text import clip_lines, write_clips
from chunklake.sources.growing import read_growing_lines, read_growing_sidecars
from chunklake.sources.lines import number_lines, read_log_lines, scan_lines
from chunklake.sources.runindex import index_runs, read_store_for_keys
from chunklake.sources.sidecar import ended_sessions, missing_sessions, read_sidecars
from chunklake.sources.store import parse_clip_lines, read_store, read_store_tsv
from chunklake.streaming.clips import cut_record_stream, stream_records
from chunklake.streaming.segments import append_cut_stream, read_cut_clips, read_stream_rejects
from chunklake.streaming.store import append_clip_stream
from chunklake.streaming.table import latest_rows_stream, read_table, write_table_stream

Query = Callable[[SparkSession, str], DataFrame]

SRC = "/data/in"
CLIP_MS = 1_800_000
IDLE_MS = 600_000
NOW = 1000
URL_PATTERN = r"^(https?)://([^/]+)(/[^?]*)"
URL_FIELDS = "scheme,host,path"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    return event_chunks(_table(spark, folder, "events"))


#: Blocks so short that sessions of every table fill several.
SHORT_LINES = 1024
#: A span longer than any of these blocks lasts.
LONG_CLIP_MS, TINY_BLOCKS = 40 * CLIP_MS, by_number("line_no", 64)


#: So few rows that snapshots of every table have several files.
SNAPSHOT_ROWS = 100


def _event_json(spark: SparkSession, folder: str) -> DataFrame:
    """Event records as JSON lines, some with blanks around them, some cut short."""
    whole = F.to_json(F.struct(F.col("event_type").alias("type"), "user_id", "event_id", "props"))
    line = (
        F.when(F.col("event_id") % 40 == 3, F.concat(F.lit(" \t"), whole, F.lit("  ")))
        .when(F.col("event_id") % 40 == 9, F.substr(whole, F.lit(1), F.length(whole) - F.lit(1)))
        .otherwise(whole)
    )
    return _table(spark, folder, "events").select("event_id", line.alias("line"))


def _store(spark: SparkSession, folder: str) -> DataFrame:
    """Events as store rows: a key per type and user, an expiry that some rows lack."""
    expires = F.when(F.col("event_id") % 5 == 0, 0).otherwise(F.col("event_id") % 2000)
    return _table(spark, folder, "events").select(
        F.concat_ws(":", "event_type", "user_id").alias("key"),
        F.col("event_id").cast("string").alias("value"),
        expires.cast("bigint").alias("expire_at"),
        F.struct("ts", "event_id").alias("write_seq"),
    )


def _full_store(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows with the write order a stored table has."""
    order = F.struct(
        F.lit(0).cast("bigint").alias("run"),
        F.lit("events").alias("source"),
        F.col("write_seq.event_id").alias("major"),
        F.lit(0).cast("bigint").alias("minor"),
    )
    return _store(spark, folder).withColumn("write_seq", order)


def _clip_json(spark: SparkSession, folder: str) -> DataFrame:
    """Clip records as JSON lines with a place, some lacking a path, some with a quoted time."""
    event_id = F.col("event_id")
    path = F.concat(F.lit("/clips/"), event_id.cast("string"), F.lit(".mp4"))
    seconds = F.expr(f"{EPOCH_MICROS} div 1000000")
    head = F.concat(F.lit('{"type":"clip","session_id":"u'), F.col("user_id").cast("string"), F.lit('","ts":'))
    ts = F.when(event_id % 9 == 4, F.concat(F.lit('"'), seconds.cast("string"), F.lit('"'))).otherwise(
        seconds.cast("string")
    )
    tail = F.when(event_id % 11 == 6, F.lit("}")).otherwise(F.concat(F.lit(',"path":"'), path, F.lit('"}')))
    return _table(spark, folder, "events").select(
        F.lit("events").alias("source"), F.lit(0).cast("bigint").alias("block"), event_id.alias("line_id"),
        F.concat(head, ts, tail).alias("line"),
    )


def clip_cut(spark: SparkSession, folder: str) -> DataFrame:
    chunks = _chunks(spark, folder)
    return cut_clips(chunks, SRC, CLIP_MS, order=order_of(chunks))


def clip_cut_blocks(spark: SparkSession, folder: str) -> DataFrame:
    chunks = _chunks(spark, folder)
    return cut_clips(chunks, SRC, CLIP_MS, order=order_of(chunks, block_lines=SHORT_LINES))


def clip_cut_long_span(spark: SparkSession, folder: str) -> DataFrame:
    """A span over many blocks, and all sessions without a break but where time stands still: stretches of many blocks."""
    # every third stretch of 640 events is the hot session's, so its chunks' numbers have a closed form; those of another
    # session count its stretches of 64 by their own number, which leaves a gap wherever the hot session was in between
    nth = F.expr("if(session_id = 'hot', line_no div 1920 * 640 + line_no % 640, line_no div 1856 * 64 + line_no % 64)")
    chunks = _chunks(spark, folder).withColumns({"sequence": nth, "offset": nth * 5, "length": F.lit(5)})
    return cut_clips(chunks, SRC, LONG_CLIP_MS, order=TINY_BLOCKS)


def clip_cut_idle(spark: SparkSession, folder: str) -> DataFrame:
    chunks = _chunks(spark, folder)
    return cut_clips(chunks, SRC, CLIP_MS, idle_ms=IDLE_MS, arrival_col="arrival_ms", order=order_of(chunks, block_lines=SHORT_LINES))


def clip_lines_out(spark: SparkSession, folder: str) -> DataFrame:
    return clip_lines(clip_cut(spark, folder)).withColumnRenamed("value", "line")


def break_report(spark: SparkSession, folder: str) -> DataFrame:
    breaks = continuity_breaks(_chunks(spark, folder), by_number("line_no", SHORT_LINES))
    return breaks.select(
        "session_id", F.col("line").alias("line_no"), "sequence", "expected_sequence", "offset", "expected_offset"
    )


def sidecar_records(spark: SparkSession, folder: str) -> DataFrame:
    return parse_sidecar(event_lines(_table(spark, folder, "events")))[0]


def sidecar_records_json(spark: SparkSession, folder: str) -> DataFrame:
    return parse_sidecar(event_lines(_table(spark, folder, "events")), mode="json")[0]


def sidecar_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return parse_sidecar(event_lines(_table(spark, folder, "events")))[1]


def clip_cut_from_lines(spark: SparkSession, folder: str) -> DataFrame:
    """From text to clips: parse, keep data records, cut."""
    lines = event_lines(_table(spark, folder, "events"))
    chunks, _ = parse_sidecar(lines)
    return cut_clips(chunks, SRC, CLIP_MS, order=order_of(lines, "line_id"))


def log_regex_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract_log(_table(spark, folder, "pages"), URL_PATTERN, URL_FIELDS, line_col="url", keep=("page_id",))[0]


def log_regex_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return extract_log(pages, URL_PATTERN, URL_FIELDS, "scheme=https", "url", ("page_id",))[0]


def log_regex_unknown_key(spark: SparkSession, folder: str) -> DataFrame:
    """A name that is no field keeps nothing; beside it one that is."""
    pages = _table(spark, folder, "pages")
    cases = [extract_log(pages, URL_PATTERN, URL_FIELDS, f"{key}=https", "url", ("page_id",))[0] for key in ("nokey", "scheme")]
    return cases[0].withColumn("key", F.lit("nokey")).unionByName(cases[1].withColumn("key", F.lit("scheme")))


def log_regex_rejects(spark: SparkSession, folder: str) -> DataFrame:
    texts = _table(spark, folder, "documents").select("text")
    return extract_log(texts, r"^([A-Z][a-z]+) ([[:alpha:]]+)", "a,b", line_col="text")[1]


def log_regex_words(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return extract_log(documents, r"^([A-Z][a-z]+) ([[:alpha:]]+)", "a,b", line_col="text", keep=("doc_id",))[0]


def log_regex_optional(spark: SparkSession, folder: str) -> DataFrame:
    """A group that takes no part refuses the line."""
    pattern = r"^https?://(m\.|blog\.)?([a-z]+)"
    return extract_log(_table(spark, folder, "pages"), pattern, "prefix,name", line_col="url", keep=("page_id",))[0]


def json_kv_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_json_lines(_event_json(spark, folder), "type=click", keep=("event_id",))[0]


def json_kv_filter_scalar(spark: SparkSession, folder: str) -> DataFrame:
    return filter_json_lines(_event_json(spark, folder), "user_id=8", keep=("event_id",), scalars=True)[0]


def json_kv_number_no_match(spark: SparkSession, folder: str) -> DataFrame:
    """A number does not equal a string of the same digits; beside it the same number as a string, which does."""
    lines = _event_json(spark, folder)
    quoted = lines.withColumn("line", F.regexp_replace("line", r'"user_id":(\d+)', r'"user_id":"$1"'))
    cases = [filter_json_lines(frame, "user_id=8", keep=("event_id",))[0] for frame in (lines, quoted)]
    return cases[0].unionByName(cases[1])


def json_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    return filter_json_lines(_event_json(spark, folder), keep=("event_id",))[0]


def json_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return filter_json_lines(_event_json(spark, folder), "type=click")[1]


def to_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").withColumn("doc_id", F.col("doc_id").cast("string"))
    return format_records(documents, "doc_id,text,lang", "json").withColumnRenamed("value", "line")


def to_csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").withColumn("doc_id", F.col("doc_id").cast("string"))
    return format_records(documents, "doc_id,text,lang", "csv").withColumnRenamed("value", "line")


def trimmed_lines(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit("\t \r"), F.col("text"), F.lit(" \u000b\n"))
    return _table(spark, folder, "conversations").select("conv_id", "turn", trim_line(padded).alias("line"))


def textual_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Lookups of strings, numbers and whole values; `nested_fields` has the odd cases."""
    line = F.col("line")
    return _event_json(spark, folder).select(
        "event_id",
        field_string(line, "type").alias("type_string"),
        field_string(line, "user_id").alias("user_string"),
        field_scalar(line, "user_id").alias("user_scalar"),
        field_string(line, "props").alias("props_string"),
        field_integer(line, "event_id").alias("event_integer"),
        looks_like_object(line).alias("is_object"),
    )


def meta_structs(spark: SparkSession, folder: str) -> DataFrame:
    return tag_sidecar(event_lines(_table(spark, folder, "events"))).select("line_id", "meta.*")


def end_markers(spark: SparkSession, folder: str) -> DataFrame:
    ending = F.when(F.col("page_id") % 7 == 0, F.lit("/.pipeline_end")).otherwise(F.lit("/x.pipeline_end"))
    paths = _table(spark, folder, "pages").select("page_id", F.concat(F.col("url"), ending).alias("path"))
    return paths.where(is_end_marker("path"))


def sessions_ended(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as sidecars in a folder per host, some of which hold an end marker."""
    pages = _table(spark, folder, "pages")
    host = F.concat(F.lit("/in/"), F.regexp_extract("url", "://([^/]+)", 1), F.lit("/"))
    sidecars = pages.select(F.concat(host, F.lit("p"), F.col("page_id"), F.lit(".meta.jsonl")).alias("path"))
    markers = pages.where("page_id % 7 = 0").select(F.concat(host, F.lit(".pipeline_end")).alias("path"))
    return ended_sessions(sidecars.unionByName(markers))


def missing_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as sessions, their labels as payloads."""
    sessions = _table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("session_id"))
    payloads = _table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("session_id"))
    return missing_sessions(sessions, payloads)


def _lines_to_rows(spark: SparkSession, folder: str) -> DataFrame:
    clips, _ = parse_clip_lines(_clip_json(spark, folder))
    return to_store_rows(clips, ttl=300, now=NOW, place=LINE_PLACE)


def store_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _lines_to_rows(spark, folder).select("key", "value", "expire_at")


def store_rows_no_ttl(spark: SparkSession, folder: str) -> DataFrame:
    clips, _ = parse_clip_lines(_clip_json(spark, folder))
    return to_store_rows(clips, ttl=0, now=NOW, place=LINE_PLACE).select("key", "value", "expire_at")


def store_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return parse_clip_lines(_clip_json(spark, folder))[1].select("line_id", "reason", "line")


def store_latest(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(_store(spark, folder)).select("key", "value", "expire_at")


def store_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return lookup(_store(spark, folder), "click:8", 0)


def store_lookup_many(spark: SparkSession, folder: str) -> DataFrame:
    keys = _table(spark, folder, "customer").select(F.concat(F.lit("view:"), F.col("c_custkey")).alias("key"))
    return lookup_many(_store(spark, folder), keys, NOW)


def store_compact(spark: SparkSession, folder: str) -> DataFrame:
    return compact(_full_store(spark, folder), NOW).select("key", "value", "expire_at")


def store_live_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _store(spark, folder).where(is_live("expire_at", NOW)).select("key", "value", "expire_at")


def store_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    return store_lines(_full_store(spark, folder)).withColumnRenamed("value", "line")


def store_append_read(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs appended to a stored table; the later run wins."""
    path, rows = shared_folder(spark, "store"), _full_store(spark, folder)
    append_store(rows, path, run=1)
    later = rows.where(F.col("value").cast("bigint") % 3 == 0).withColumn("value", F.concat(F.lit("new-"), "value"))
    second = F.col("write_seq").withField("run", F.lit(2).cast("bigint"))
    append_store(later.withColumn("write_seq", second), path, run=2)
    return latest_per_key(read_store(spark, path)).select("key", "value", "expire_at")


def store_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table compacted into a new one."""
    path, new_path = shared_folder(spark, "store"), shared_folder(spark, "snapshot")
    append_store(_full_store(spark, folder), path, run=1)
    compact_store(spark, path, new_path, NOW)
    return read_store(spark, new_path).select("key", "value", "expire_at")


def _round(rows: DataFrame, run: int, key_div: int) -> DataFrame:
    """The rows of a later run: keys of several users in one, values that tell the run."""
    key = F.concat_ws(":", F.substring_index("key", ":", 1), F.expr(f"cast(substring_index(key, ':', -1) as bigint) div {key_div}").cast("string"))
    order = F.col("write_seq").withField("run", F.lit(run).cast("bigint"))
    return rows.withColumns({"key": key, "value": F.concat(F.lit(f"{run}-"), "value"), "write_seq": order})


def store_append_during_compaction(spark: SparkSession, folder: str) -> DataFrame:
    """A run appended after a merge has been planned, and before its snapshot is committed: its rows count."""
    path, rows = shared_folder(spark, "store"), _full_store(spark, folder)
    append_store(rows, path, run=1)
    merge = begin_merge(spark, path, NOW)
    append_store(_round(rows, 2, 2), path, run=2)
    finish_merge(merge, SNAPSHOT_ROWS)
    return compact(read_store(spark, path), NOW).select("key", "value", "expire_at")


def store_merge_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs, merged into the snapshot one after the other: what compacting all of them gives."""
    path, rows = shared_folder(spark, "store"), _full_store(spark, folder)
    for run in (1, 2, 3):
        append_store(_round(rows, run, run), path, run)
        merge_store(spark, path, NOW // (4 - run), SNAPSHOT_ROWS)
    return read_store(spark, path).select("key", "value", "expire_at")


def store_index_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Keys looked up in a snapshot and in later runs, of which an index tells those that may hold them."""
    path, rows = shared_folder(spark, "store"), _full_store(spark, folder)
    append_store(rows, path, run=1)
    merge_store(spark, path, 0, SNAPSHOT_ROWS)
    for run in (2, 3, 4):
        append_store(_round(rows, run, run), path, run)
    index_runs(spark, path)
    keys = _table(spark, folder, "customer").select(F.concat(F.lit("view:"), "c_custkey").alias("key"))
    return lookup_many(read_store_for_keys(spark, path, keys), keys, NOW)


def _bucketed(spark: SparkSession, folder: str) -> str:
    table, rows = f"store_{uuid.uuid4().hex}", _full_store(spark, folder)
    path = shared_folder(spark, "bucketed")
    for run in (1, 2):
        append_bucketed(_round(rows, run, run), table, path)
    return table


def store_bucketed_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Latest rows of a store of two runs, bucketed by key: nothing is shuffled."""
    return bucketed_latest(spark, _bucketed(spark, folder)).select("key", "value", "expire_at")


def store_bucketed_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """A bulk lookup in it, of keys that are bucketed as well."""
    keys = f"keys_{uuid.uuid4().hex}"
    wanted = _table(spark, folder, "customer").select(F.concat(F.lit("view:"), "c_custkey").alias("key"))
    write_bucketed_keys(wanted, keys, shared_folder(spark, "keys"))
    return bucketed_lookup(spark, _bucketed(spark, folder), keys, NOW)


def store_import_tsv(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written in the tab-separated text form and read back, with a line in it that is no row."""
    path = shared_folder(spark, "tsv")
    rows = store_lines(_full_store(spark, folder))
    damaged = F.when(F.col("value").startswith("error:8\t"), "no row").otherwise(F.col("value"))
    rows.select(damaged.alias("value")).write.text(path)
    return read_store_tsv(spark, path)[0].select("key", "value", "expire_at")


def log_file_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines written to files and read back with their numbers; the numbers of a file are 1 to its line count."""
    path = shared_folder(spark, "lines")
    _event_json(spark, folder).select("line").write.text(path)
    numbered = number_lines(scan_lines(spark, path)).groupBy("source").agg(
        F.count("*").alias("n"),
        F.countDistinct("line_no").alias("d"),
        F.min("line_no").alias("lo"),
        F.max("line_no").alias("hi"),
    )
    wrong = numbered.where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n")))
    return read_log_lines(spark, path).select("line").unionByName(wrong.select(F.col("source").alias("line")))


def clip_file_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Clips written as JSON Lines and read back as clip records."""
    path = shared_folder(spark, "clips")
    write_clips(clip_cut(spark, folder), path)
    return parse_clip_lines(scan_lines(spark, path))[0].select("session_id", "ts", "path")


def pipeline_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    chunks = _chunks(spark, folder)
    rows = clips_to_store(chunks, SRC, ttl=300, now=NOW, order=order_of(chunks))
    return latest_per_key(rows).select("key", "value", "expire_at")


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table as a stream, be it one file or a folder of them."""
    reader = spark.readStream.schema(_table(spark, folder, name).schema).option("maxBytesPerTrigger", str(128 << 20))
    return reader.parquet(f"{folder}/{name}.parquet*")


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _cut_records(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks as a stream of records, an end mark behind each session's last one."""
    numbers = ["sequence", "offset", "length", "ts_ms"]
    records = event_chunks(_stream(spark, folder, "events")).select(
        "session_id", F.lit(0).cast("bigint").alias("block"), F.col("line_no").alias("line_id"),
        F.lit(False).alias("ended"), *numbers, F.col("arrival_ms").alias("arrival"),
    )
    last = _chunks(spark, folder).groupBy("session_id").agg(F.max("line_no").alias("last_id"))
    marks = records.join(last, "session_id").where(F.col("line_id") == F.col("last_id"))
    marks = marks.select(
        "session_id", F.lit(1).cast("bigint").alias("block"), "line_id", F.lit(True).alias("ended"),
        *[F.lit(0).cast("bigint").alias(name) for name in numbers], "arrival",
    )
    return records.unionByName(marks)


def _stream_cut(spark: SparkSession, folder: str, idle_ms: int | None) -> DataFrame:
    out, checkpoint = shared_folder(spark, "clips"), shared_folder(spark, "checkpoint")
    clips = cut_record_stream(_cut_records(spark, folder), SRC, CLIP_MS, idle_ms, wall_clock=False)
    writer = clips.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    _run(writer.start(out))
    return spark.read.schema(clips.schema).parquet(out).select(*CLIP_FIELDS)


def stream_clip_cut(spark: SparkSession, folder: str) -> DataFrame:
    """Clips cut from a stream, an end mark behind each session's last chunk; the same clips as in batch."""
    return _stream_cut(spark, folder, None)


def stream_clip_cut_idle(spark: SparkSession, folder: str) -> DataFrame:
    """The same with pauses in arrival."""
    return _stream_cut(spark, folder, IDLE_MS)


def stream_log_extract(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = shared_folder(spark, "records"), shared_folder(spark, "checkpoint")
    records, _ = extract_log(_stream(spark, folder, "pages"), URL_PATTERN, URL_FIELDS, line_col="url", keep=("page_id",))
    writer = records.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    _run(writer.start(out))
    return spark.read.schema(records.schema).parquet(out)


def stream_json_filter(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = shared_folder(spark, "records"), shared_folder(spark, "checkpoint")
    events = _stream(spark, folder, "events")
    line = F.to_json(F.struct(F.col("event_type").alias("type"), "user_id", "event_id", "props"))
    kept, _ = filter_json_lines(events.select("event_id", line.alias("line")), "type=click", keep=("event_id",))
    writer = kept.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    _run(writer.start(out))
    return spark.read.schema(kept.schema).parquet(out)


def stream_store(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of clip records appended to the store, then read as its latest rows."""
    path, checkpoint = shared_folder(spark, "store"), shared_folder(spark, "checkpoint")
    event_id = F.col("event_id")
    clips = _stream(spark, folder, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("session_id"),
        (event_id % 10).alias("ts"),
        F.concat(F.lit("/clips/"), event_id.cast("string"), F.lit(".mp4")).alias("path"),
        F.lit("events").alias("source"), F.lit(0).cast("bigint").alias("block"), event_id.alias("line_id"),
    )
    _run(append_clip_stream(clips, path, checkpoint, 300, NOW, available_now=True, place=LINE_PLACE))
    return latest_per_key(read_store(spark, path)).select("key", "value", "expire_at")


def _clip_stream(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    event_id = F.col("event_id")
    return _stream(spark, folder, "events").select(
        F.concat(F.lit(prefix), F.col("user_id").cast("string")).alias("session_id"),
        (event_id % 10).alias("ts"),
        F.concat(F.lit(f"/{prefix}/"), event_id.cast("string"), F.lit(".mp4")).alias("path"),
        F.lit("events").alias("source"), F.lit(0).cast("bigint").alias("block"), event_id.alias("line_id"),
    )


def store_stream_after_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot, then two streams with checkpoints of their own onto it: no row of any of the three is lost."""
    path, new_path = shared_folder(spark, "store"), shared_folder(spark, "snapshot")
    append_store(_full_store(spark, folder), path, run=1)
    compact_store(spark, path, new_path, NOW)
    for prefix in ("a", "b"):
        clips = _clip_stream(spark, folder, prefix)
        checkpoint = shared_folder(spark, "checkpoint")
        _run(append_clip_stream(clips, new_path, checkpoint, 300, NOW, available_now=True, place=LINE_PLACE))
    return latest_per_key(read_store(spark, new_path)).select("key", "value", "expire_at")


def store_batch_then_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A batch run and a later stream of the same keys: the stream's rows count."""
    path, event_id = shared_folder(spark, "store"), F.col("event_id")
    old = _table(spark, folder, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("session_id"),
        (event_id % 12).alias("ts"),
        F.lit("/old.mp4").alias("path"),
        F.lit("events").alias("source"), F.lit(0).cast("bigint").alias("block"), event_id.alias("line_id"),
    )
    run = time.time_ns()
    append_store(to_store_rows(old, 0, NOW, run, LINE_PLACE), path, run)
    clips = _clip_stream(spark, folder, "u")
    _run(append_clip_stream(clips, path, shared_folder(spark, "checkpoint"), 300, NOW, available_now=True, place=LINE_PLACE))
    return latest_per_key(read_store(spark, path)).select("key", "value", "expire_at")


def _sidecar_lines(spark: SparkSession, folder: str) -> DataFrame:
    return event_lines(_table(spark, folder, "events")).withColumn("folder", folder_of())


def sidecar_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Sidecar files, some of them torn: their last line, which has no line end, is not read."""
    root, torn = shared_folder(spark, "in"), F.col("session_id").like("cam%3")
    lines = _sidecar_lines(spark, folder).where(~torn | F.col("line").endswith("}"))
    write_sidecars(lines, root, torn=torn)
    return read_sidecars(spark, root).select("session_id", "line")


def sidecar_files_two_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Equally named sessions in two folders, one of them with every second half of its chunks' lengths: two sessions each."""
    root, lines = shared_folder(spark, "in"), _sidecar_lines(spark, folder)
    late = lines.where(F.col("line_id") >= 500)
    parts = [part.withColumn("folder", F.concat(F.lit(f"{name}/"), "folder")) for name, part in (("a", lines), ("b", late))]
    write_sidecars(parts[0].unionByName(parts[1]), root)
    return cut_clips(parse_sidecar(read_sidecars(spark, root))[0], SRC, CLIP_MS)


def pipeline_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job from sidecar files and payloads to the store, for half of the sessions by name, then for all."""
    root, path = shared_folder(spark, "in"), shared_folder(spark, "store")
    lines = _sidecar_lines(spark, folder)
    write_sidecars(lines, root, payloads=True)
    some = [row.session_id for row in lines.select("session_id").distinct().where("session_id LIKE 'cam%'").collect()]
    run_pipeline(spark, root, path, 0, some, NOW, 1, "/old")
    run_pipeline(spark, root, path, 300, None, NOW, 2, SRC, shared_folder(spark, "rejects"))
    return latest_per_key(read_store(spark, path)).select("key", "value", "expire_at")


def pipeline_stream_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream over closed files, each session ended by a mark."""
    root, path, checkpoint = (shared_folder(spark, purpose) for purpose in ("in", "store", "checkpoint"))
    write_sidecars(_sidecar_lines(spark, folder), root, ended=True, payloads=True)
    _run(run_stream_pipeline(spark, root, path, checkpoint, 300, NOW, available_now=True, require_payload=True, clip_src=SRC))
    return latest_per_key(read_store(spark, path)).select("key", "value", "expire_at")


def pipeline_stream_in_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The same job over a stream that is parsed once and cut segment by segment: what it stores, and what it refuses."""
    root, path, checkpoint, work = (shared_folder(spark, purpose) for purpose in ("in", "store", "checkpoint", "work"))
    write_sidecars(_sidecar_lines(spark, folder), root, ended=True, payloads=True)
    _run(run_stream_pipeline(spark, root, path, checkpoint, 300, NOW, available_now=True, require_payload=True, clip_src=SRC, work=work))
    stored = latest_per_key(read_store(spark, path)).select("key", "value", "expire_at")
    refused = read_stream_rejects(spark, work).select("reason", "line")
    return stored.unionByName(refused.select(F.col("reason").alias("key"), F.col("line").alias("value"), F.lit(-1).cast("bigint").alias("expire_at")))


def _halves(lines: DataFrame) -> list[DataFrame]:
    """The lines of each folder in two parts, earlier and later ones."""
    early = F.col("line_id") % FOLDER_LINES < FOLDER_LINES // 40
    return [lines.where(early), lines.where(~early)]


def stream_growing_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Files that grow between two runs of one query: every line is seen, and seen once."""
    root, out, checkpoint = (shared_folder(spark, purpose) for purpose in ("in", "out", "checkpoint"))
    for part in _halves(_sidecar_lines(spark, folder)):
        write_sidecars(part, root, append=True)
        lines = read_growing_lines(spark, root, "*.meta.jsonl", 1 << 16)
        _run(lines.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
    found = spark.read.schema("source string, position bigint, line string, marker boolean").parquet(out)
    session = F.regexp_extract("source", "([^/]*)[.]meta[.]jsonl$", 1)
    return found.select(F.regexp_extract("source", "([^/]*)/[^/]*$", 1).alias("folder"), session.alias("session_id"), "line")


def stream_folder_markers(spark: SparkSession, folder: str) -> DataFrame:
    """Growing sessions, all those of a folder ended by its marker: what a batch cuts, folder by folder."""
    root, out, checkpoint = (shared_folder(spark, purpose) for purpose in ("in", "out", "checkpoint"))
    lines = _sidecar_lines(spark, folder)
    folders = [row.folder for row in lines.select("folder").distinct().collect()]
    for n, part in enumerate(_halves(lines)):
        write_sidecars(part, root, append=True)
        if n:
            put_markers(root, folders)
        records = stream_records(read_growing_sidecars(spark, root))
        _run(append_cut_stream(records, out, checkpoint, CLIP_MS, available_now=True, segment_lines=1 << 12))
    return read_cut_clips(spark, out, SRC).select(*CLIP_FIELDS)


def stream_clip_cut_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Clips cut from a stream segment by segment: a session of a micro-batch fills many tasks."""
    out, checkpoint = shared_folder(spark, "clips"), shared_folder(spark, "checkpoint")
    _run(append_cut_stream(_cut_records(spark, folder), out, checkpoint, CLIP_MS, available_now=True, segment_lines=1024))
    return read_cut_clips(spark, out, SRC).select(*CLIP_FIELDS)


def stream_lookup_table(spark: SparkSession, folder: str) -> DataFrame:
    """Store rows streamed into a table that keeps the latest live row of each key, in state with a time to live."""
    path, out, checkpoint = (shared_folder(spark, purpose) for purpose in ("store", "table", "checkpoint"))
    rows = _full_store(spark, folder)
    append_store(rows, path, run=1)
    stream = spark.readStream.schema(STORE).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(path)
    query, wanted = write_table_stream(latest_rows_stream(stream, 3600), out, checkpoint), rows.count()
    # a query with state that ages by the clock never runs out of batches: it is ended once all rows are in
    taken: dict[int, int] = {}
    try:
        while query.isActive and sum(taken.values()) < wanted:
            time.sleep(0.2)
            taken |= {p["batchId"]: p["numInputRows"] for p in query.recentProgress}  # the last ones only
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return read_table(spark, out, NOW).select("key", "value", "expire_at")


def log_regex_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Optional, nested and alternative groups; a line in which a used one takes no part is refused."""
    pattern = "^https?://((m|blog)[.])?([a-z]+)[.](example)[.](com|(net))/([a-z]*)"
    return extract_log(_table(spark, folder, "pages"), pattern, "prefix,kind,name,label,end", line_col="url", keep=("page_id",))[0]


def nested_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Lookups by text: the first mention of a key counts, be it nested; an escaped one is none."""
    note = F.concat(F.lit('{"note":"say \\"k\\": 9 \\\\ ok","props":'), F.col("props"), F.lit(',"k":"later","event_id" : '))
    line = F.concat(note, F.col("event_id").cast("string"), F.lit("}"))
    made = _table(spark, folder, "events").select("event_id", line.alias("line"))
    return made.select(
        "event_id",
        field_scalar("line", "k").alias("k_scalar"),
        field_string("line", "note").alias("note_string"),
        field_integer("line", "event_id").alias("event_integer"),
    )


QUERIES: dict[str, Query] = {
    "clip_cut": clip_cut,
    "clip_cut_blocks": clip_cut_blocks,
    "clip_cut_idle": clip_cut_idle,
    "clip_cut_from_lines": clip_cut_from_lines,
    "clip_jsonl": clip_lines_out,
    "clip_file_lines": clip_file_lines,
    "continuity_breaks": break_report,
    "sidecar_parse": sidecar_records,
    "sidecar_parse_json": sidecar_records_json,
    "sidecar_rejects": sidecar_rejects,
    "meta_structs": meta_structs,
    "log_regex_extract": log_regex_extract,
    "log_regex_filter": log_regex_filter,
    "log_regex_unknown_key": log_regex_unknown_key,
    "log_regex_words": log_regex_words,
    "log_regex_optional": log_regex_optional,
    "log_rejects": log_regex_rejects,
    "log_file_lines": log_file_lines,
    "json_kv_filter": json_kv_filter,
    "json_kv_filter_scalar": json_kv_filter_scalar,
    "json_kv_number_no_match": json_kv_number_no_match,
    "json_passthrough": json_passthrough,
    "json_rejects": json_rejects,
    "to_jsonl": to_jsonl,
    "to_csv_lines": to_csv_lines,
    "trimmed_lines": trimmed_lines,
    "textual_fields": textual_fields,
    "marker_sessions": end_markers,
    "ended_sessions": sessions_ended,
    "missing_payload": missing_payload,
    "store_rows": store_rows,
    "store_rows_no_ttl": store_rows_no_ttl,
    "store_rejects": store_rejects,
    "store_latest": store_latest,
    "store_lookup": store_lookup,
    "store_lookup_many": store_lookup_many,
    "store_compact": store_compact,
    "store_live_rows": store_live_rows,
    "store_text_lines": store_text_lines,
    "store_append_read": store_append_read,
    "store_snapshot": store_snapshot,
    "store_append_during_compaction": store_append_during_compaction,
    "store_merge_rounds": store_merge_rounds,
    "store_index_lookup": store_index_lookup,
    "store_bucketed_latest": store_bucketed_latest,
    "store_bucketed_lookup": store_bucketed_lookup,
    "store_import_tsv": store_import_tsv,
    "pipeline_end_to_end": pipeline_end_to_end,
    "stream_clip_cut": stream_clip_cut,
    "stream_log_extract": stream_log_extract,
    "stream_json_filter": stream_json_filter,
    "stream_store": stream_store,
    "clip_cut_long_span": clip_cut_long_span,
    "stream_clip_cut_idle": stream_clip_cut_idle,
    "store_stream_after_snapshot": store_stream_after_snapshot,
    "store_batch_then_stream": store_batch_then_stream,
    "sidecar_file_scan": sidecar_file_scan,
    "sidecar_files_two_folders": sidecar_files_two_folders,
    "pipeline_from_files": pipeline_from_files,
    "pipeline_stream_from_files": pipeline_stream_from_files,
    "pipeline_stream_in_segments": pipeline_stream_in_segments,
    "stream_growing_lines": stream_growing_lines,
    "stream_folder_markers": stream_folder_markers,
    "stream_clip_cut_segments": stream_clip_cut_segments,
    "stream_lookup_table": stream_lookup_table,
    "log_regex_nested": log_regex_nested,
    "nested_fields": nested_fields,
}

"""Session sidecars and payloads."""

from __future__ import annotations

from urllib.parse import urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.functions.fields import PAYLOAD_SUFFIX, SIDECAR_SUFFIX, is_end_marker
from chunklake.sources.files import located
from chunklake.sources.lines import decoded_folder, decoded_name, drop_unterminated, scan_lines, split_lines

# How sidecar files are named. A growing session is a row of closed files, numbered from 0.
_BATCH_GLOB = f"*{SIDECAR_SUFFIX}"
_SEGMENT_GLOB = f"*{SIDECAR_SUFFIX}*"
_SEGMENT_NAME = r"^(.*)\.meta\.jsonl(?:\.([0-9]+))?$"


def read_sidecars(
    spark: SparkSession, path: str | list[str], keep_unterminated: bool = False, sessions: list[str] | None = None
) -> DataFrame:
    """Every line of every ``{session}.meta.jsonl`` under a folder, empty lines left out; of ``sessions`` only, if given.

    A session is a ``folder`` and a ``session_id``: files of one name in two folders are two sessions.
    """
    names = None if sessions is None else [f"{session}{SIDECAR_SUFFIX}" for session in sessions]
    lines = scan_lines(spark, path, _BATCH_GLOB, names)
    if not keep_unterminated:
        lines = drop_unterminated(lines)
    return lines.where(F.col("line") != "").select(
        decoded_folder("source").alias("folder"),
        F.regexp_extract(decoded_name("source"), _SEGMENT_NAME, 1).alias("session_id"),
        "source",
        "block",
        "line_id",
        "line",
    )


def read_sidecar_stream(spark: SparkSession, path: str, max_bytes: int = 128 << 20, max_files: int | None = None) -> DataFrame:
    """A stream of sidecar lines from closed segment files ``{session}.meta.jsonl[.{n}]``.

    Each file is taken once and must not grow afterwards; segments are to be a few megabytes, since a file is one row
    until it is split. ``max_bytes``, or ``max_files`` in its place, bounds what one micro-batch takes in, and so what
    one session can bring to one task.
    """
    limit = ("maxFilesPerTrigger", str(max_files)) if max_files else ("maxBytesPerTrigger", str(max_bytes))
    reader = (
        spark.readStream.option("pathGlobFilter", _SEGMENT_GLOB)
        .option("recursiveFileLookup", "true")
        .option(*limit)
    )
    name = decoded_name("_metadata.file_path")
    files = reader.text(path, wholetext=True).select(
        decoded_folder("_metadata.file_path").alias("folder"),
        F.regexp_extract(name, _SEGMENT_NAME, 1).alias("session_id"),
        F.coalesce(F.regexp_extract(name, _SEGMENT_NAME, 2).try_cast("bigint"), F.lit(0)).alias("block"),
        F.col("_metadata.file_path").alias("source"),
        F.unix_millis("_metadata.file_modification_time").alias("arrival_ms"),
        split_lines(F.col("value"), terminated_only=True).alias("lines"),
    )
    lines = files.select("folder", "session_id", "source", "block", "arrival_ms", F.posexplode("lines").alias("line_id", "line"))
    return lines.where(F.col("line") != "").withColumn("line_id", F.col("line_id").cast("bigint"))


def list_files(spark: SparkSession, path: str | list[str], suffix: str) -> DataFrame:
    """``folder`` and ``session_id`` of the session files with a suffix, empty files too; no file is opened.

    A scan would leave empty files out, so the names are those of the reader's file index, which the driver has anyway;
    they become a table inside the JVM.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
    found = reader.option("recursiveFileLookup", "true").load(path)._jdf.inputFiles()
    jvm = spark._jvm
    files = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(found)
    names = spark._jsparkSession.createDataset(files, jvm.org.apache.spark.sql.Encoders.STRING())
    name = decoded_name("path")
    return DataFrame(names.toDF(), spark).withColumnRenamed("value", "path").select(
        decoded_folder("path").alias("folder"), F.substr(name, F.lit(1), F.length(name) - F.lit(len(suffix))).alias("session_id")
    )


def missing_sessions(sessions: DataFrame, present: DataFrame) -> DataFrame:
    """Sessions that are not among those present, by folder and id where both sides have folders, else by id.

    Both sides are reduced by session before they are shuffled together, so no session is a hot key.
    """
    keys = [name for name in ("folder", "session_id") if name in sessions.columns and name in present.columns]
    both = sessions.select(*keys, F.lit(0).alias("there")).unionByName(present.select(*keys, F.lit(1).alias("there")))
    return both.groupBy(*keys).agg(F.max("there").alias("there")).where("there = 0").select(*keys)


#: File systems that tasks can ask by themselves. Of others the folders of the sessions in question are listed.
_ASKED = ("file", "hdfs", "s3", "gs")


def without_payload(sessions: DataFrame, src: str) -> DataFrame:
    """``folder`` and ``session_id`` of those sessions that have no payload file beside their sidecar.

    Tasks ask for the files of these sessions, each once; nothing else under ``src`` is listed.
    """
    wanted = sessions.select("folder", "session_id").distinct()
    scheme = urlsplit(src).scheme or "file"
    if scheme not in _ASKED:
        folders = [row.folder for row in wanted.select("folder").distinct().collect()]
        return missing_sessions(wanted, list_files(sessions.sparkSession, folders, PAYLOAD_SUFFIX)) if folders else wanted

    @F.pandas_udf("boolean")
    def present(paths: pd.Series) -> pd.Series:
        places = (located(path) for path in paths)
        return pd.Series([system.get_file_info(name).type == fs.FileType.File for system, name in places], dtype=bool)

    path = F.concat("folder", F.lit("/"), "session_id", F.lit(PAYLOAD_SUFFIX))
    return wanted.withColumn("present", present(path)).where("NOT present").drop("present")


def ended_sessions(paths: DataFrame) -> DataFrame:
    """``folder`` and ``session_id`` of sessions whose folder holds an end marker, from the ``path`` of every file.

    A marker ends all sessions of its folder. Spark's own file listing leaves markers out, since their name begins
    with a dot, so the paths have to come from elsewhere. A folder of many sidecars may be a hot key: the join's other side
    has one row per folder, so adaptive execution splits it.
    """
    path = F.col("path")
    folder = F.regexp_extract(path, "^(.*)/", 1)
    files = paths.select(folder.alias("folder"), F.substring_index(path, "/", -1).alias("name"), "path")
    marked = files.where(is_end_marker("path")).select("folder").distinct()
    sidecars = files.where(F.col("name").endswith(SIDECAR_SUFFIX)).join(marked, "folder", "left_semi")
    name = F.col("name")
    return sidecars.select("folder", F.substr(name, F.lit(1), F.length(name) - F.lit(len(SIDECAR_SUFFIX))).alias("session_id"))

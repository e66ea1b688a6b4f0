"""Text lines with a place in their file.

A line's place is ``(block, line)``: the byte at which its input split begins, and a number growing along the split.
Both come from the scan itself, so no window over a whole file is needed to know the order, and a block, being one
split, is a bounded run of consecutive lines however large the file is.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunklake.functions.fields import trim_line
from chunklake.session import shared_folder

#: Rows about files or splits, a path and a few numbers each, that are told to every task: 100 MB at most, with long paths.
TOLD_ROWS = 400_000


def decoded_name(path: Column | str) -> Column:
    """The file name at the end of a path as Spark gives it, which is URL-encoded, except for ``+``."""
    return F.url_decode(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))


def decoded_folder(path: Column | str) -> Column:
    """The folder of a path as Spark gives it, up to its last slash."""
    path = F.col(path) if isinstance(path, str) else path
    return F.url_decode(F.replace(F.regexp_extract(path, "^(.*)/", 1), F.lit("+"), F.lit("%2B")))


def scan_lines(spark: SparkSession, path: str | list[str], glob: str | None = None, names: list[str] | None = None) -> DataFrame:
    """``(source, block, line_id, line, file_size)`` for every line, split on LF only.

    ``names`` are the names of the files wanted; the others are not opened.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path)
    if names is not None:
        # the name stands in the metadata as it is, or as it is written in a URL
        lines = lines.where(F.col("_metadata.file_name").isin(sorted({n for name in names for n in (name, quote(name))})))
    return lines.select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def drop_unterminated(lines: DataFrame) -> DataFrame:
    """Without the last line of each file that does not end in a line feed.

    Such a file has one byte less than its lines with one line end each. Which files those are is found within the same
    plan, in a pass over the lengths of lines, when the result is asked for and not before. They are at most as many as the
    files, which the reader has counted: up to a bound they are told to every task, beyond it the join is Spark's to choose.
    """
    size = F.sum(F.octet_length("line") + 1)
    last = F.max(F.struct("block", "line_id"))
    ends = lines.groupBy("source").agg(size.alias("bytes"), F.max("file_size").alias("file_size"), last.alias("last"))
    cut = ends.where("bytes > file_size").select("source", F.col("last.block").alias("block"), F.col("last.line_id").alias("line_id"))
    few = len(lines._jdf.inputFiles()) <= TOLD_ROWS
    return lines.join(F.broadcast(cut) if few else cut, ["source", "block", "line_id"], "left_anti").select(*lines.columns)


def number_lines(lines: DataFrame) -> DataFrame:
    """Adds ``line_no``, from 1 in each file. No line is moved.

    A first pass counts the lines of each block; the sums of what lies before are kept in the shared folder and told to the
    tasks that read the lines again, one row for each input split. Beyond a bound of rows the lines are joined by a shuffle.
    """
    blocks = lines.groupBy("source", "block").agg(F.count("*").alias("n"), F.min("line_id").alias("first_id"))
    before = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = blocks.select(
        "source", "block", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines_before")
    )
    path = shared_folder(lines.sparkSession, "line-counts")
    starts.write.parquet(path)
    starts = lines.sparkSession.read.schema(starts.schema).parquet(path)
    few = starts.count() <= TOLD_ROWS
    numbered = lines.join(F.broadcast(starts) if few else starts.hint("shuffle_hash"), ["source", "block"])
    line_no = F.col("lines_before") + F.col("line_id") - F.col("first_id") + 1
    return numbered.select(*lines.columns, line_no.alias("line_no"))


def read_log_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Log lines, white space stripped from both ends. An unterminated last line counts."""
    return scan_lines(spark, path).withColumn("line", trim_line("line")).drop("file_size")


def split_lines(text: Column, terminated_only: bool) -> Column:
    """The lines of a whole text; the last element, which no line end follows, is dropped or kept if not empty."""
    parts = F.split(text, "\n")
    head = F.slice(parts, F.lit(1), F.size(parts) - F.lit(1))
    if terminated_only:
        return head
    return F.when(F.element_at(parts, -1) == "", head).otherwise(parts)

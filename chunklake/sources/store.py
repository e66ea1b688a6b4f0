"""Reading the keyed store, its text form, and clip records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake import schemas
from chunklake.functions.fields import field_scalar, field_string
from chunklake.operators.rejects import split_tagged
from chunklake.sources.lines import scan_lines
from chunklake.sources.manifest import open_runs, read_manifest


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a store, every run and every duplicate. Filters on ``key`` reach the Parquet scan.

    Of a store with a manifest these are the rows of its snapshot and of all finished runs that the snapshot does not cover.
    """
    manifest = read_manifest(spark, path)
    if not manifest.version:
        return spark.read.schema(schemas.STORE).option("recursiveFileLookup", "true").parquet(path)
    return read_folders(spark, path, [*(f.path for f in manifest.files), *open_runs(spark, path, manifest)])


def read_folders(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The rows of some files and folders of a store."""
    if not names:
        return spark.createDataFrame([], schemas.STORE)
    reader = spark.read.schema(schemas.STORE).option("recursiveFileLookup", "true")
    return reader.parquet(*[f"{path.rstrip('/')}/{name}" for name in names])


def read_store_tsv(spark: SparkSession, path: str | list[str], run: int = 0) -> tuple[DataFrame, DataFrame]:
    """Rows of the tab-separated text form, and the lines that are none."""
    return parse_store_tsv(scan_lines(spark, path), run)


def parse_store_tsv(lines: DataFrame, run: int = 0) -> tuple[DataFrame, DataFrame]:
    """Key up to the first tab, value up to the second, then a leading integer."""
    parts = F.split(F.regexp_extract("line", r"\A[^\r\n]*+", 0), "\t", 3)
    expires = F.regexp_extract(F.get("_parts", F.lit(2)), r"\A[ \t\n\x0b\f\r]*+([+-]?[0-9]++)", 1).try_cast("bigint")
    row = F.struct(
        F.get("_parts", F.lit(0)).alias("key"),
        F.get("_parts", F.lit(1)).alias("value"),
        F.col("_expires").alias("expire_at"),
        write_seq(run, F.col("source"), F.col("block"), F.col("line_id")).alias("write_seq"),
    )
    tagged = lines.withColumn("_parts", parts).withColumn("_expires", expires)
    tagged = tagged.withColumn("parsed", F.when(F.col("_expires").isNotNull(), row))
    return split_tagged(tagged, F.lit("not a store row"))


def write_seq(run, source, major, minor):
    """The write order as a struct of `schemas.WRITE_SEQ`."""
    run = F.lit(run) if isinstance(run, int) else run
    parts = zip(schemas.WRITE_SEQ.fields, (run, source, major, minor), strict=True)
    return F.struct(*[part.cast(field.dataType).alias(field.name) for field, part in parts])


def parse_clip_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(session_id, ts, path)`` of clip JSON lines, ``ts`` as its raw token, with the line's place.

    Other fields are ignored, the record type too. A line that lacks one of the three is refused.
    """
    fields = {
        "_session_id": field_string("line", "session_id"),
        "_ts": field_scalar("line", "ts"),
        "_path": field_string("line", "path"),
    }
    whole = F.col("_session_id").isNotNull() & F.col("_ts").isNotNull() & F.col("_path").isNotNull()
    record = F.struct(*[F.col(name).alias(name[1:]) for name in fields], "source", "block", "line_id")
    tagged = lines.withColumns(fields).withColumn("parsed", F.when(whole, record))
    return split_tagged(tagged, F.lit("malformed clip JSON"))

"""What the operators share: tables, texts without null, names out of the way, and tables kept in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.session import shared_folder

#: Rows a Python task holds at once, whatever the session's setting: long texts make a batch of many rows too large.
BATCH_ROWS = 2000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, a null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def kept(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to a folder of their own under the shared one and read again: cuts the lineage for good."""
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def private(frame: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of the frame has."""
    taken = {c.lower() for c in frame.columns}
    mark = "_"
    while any(f"{mark}{n}".lower() in taken for n in names):
        mark = f"_{uuid.uuid4().hex[:6]}_"
    return [f"{mark}{n}" for n in names]


def in_small_batches(spark: SparkSession) -> None:
    """Arrow batches bounded in rows, and in bytes where the setting is known."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))

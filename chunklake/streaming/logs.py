"""Log lines as a stream. Extraction and filtering are those of `operators.logs`; they keep no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chunklake.functions.fields import trim_line
from chunklake.operators.logs import format_records


def read_log_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.text(path).select(F.col("_metadata.file_path").alias("source"), trim_line("value").alias("line"))


def write_record_stream(
    records: DataFrame, path: str, checkpoint: str, fields: list[str], fmt: str = "json", available_now: bool = False
) -> StreamingQuery:
    """Output lines, exactly once, as text files."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 second"}
    writer = format_records(records, fields, fmt).writeStream.format("text").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start(path)

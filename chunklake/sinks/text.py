"""JSON Lines and CSV text files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chunklake.functions.formats import json_line
from chunklake.operators.logs import format_records
from chunklake.schemas import CLIP_FIELDS


def clip_lines(clips: DataFrame) -> DataFrame:
    """One JSON object per clip, in the fixed field order."""
    return clips.select(json_line(*CLIP_FIELDS).alias("value"))


def write_clips(clips: DataFrame, path: str, mode: str = "errorifexists") -> None:
    clip_lines(clips).write.mode(mode).text(path)


def write_records(records: DataFrame, path: str, fields: list[str], fmt: str = "json", mode: str = "errorifexists") -> None:
    format_records(records, fields, fmt).write.mode(mode).text(path)

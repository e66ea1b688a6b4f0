"""Log extraction and filtering, alike for batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.functions.fields import field_equals, looks_like_object, trim_line
from chunklake.functions.formats import csv_line, json_line
from chunklake.functions.options import check_fields, check_filter, check_log_options
from chunklake.functions.regex import regex_records
from chunklake.operators.rejects import PLACE


def _rejects(refused: DataFrame, reason: str) -> DataFrame:
    place = [name for name in PLACE if name in refused.columns]
    return refused.select(*place, F.lit(reason).alias("reason"), "line")


def extract_log(
    lines: DataFrame,
    pattern: str,
    fields: str | list[str],
    condition: str | None = None,
    line_col: str = "line",
    keep: tuple[str, ...] = (),
    strict: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)``: one string column per field, from the first match in the trimmed line.

    ``condition`` is ``key=value`` on a field; a name that is no field keeps nothing. What it drops is no reject.
    """
    check_log_options(pattern, fields, None)
    names = check_fields(fields)
    wanted = check_filter(condition) if condition is not None else None
    trimmed = lines.withColumn("line", trim_line(line_col))
    records, refused = regex_records(trimmed, F.col("line"), pattern, names, keep, strict)
    if wanted is not None:
        key, value = wanted
        records = records.where(F.col(f"`{key}`") == value if key in names else F.lit(False))
    return records, _rejects(refused, "line did not match regex")


def format_records(records: DataFrame, fields: str | list[str], fmt: str = "json") -> DataFrame:
    """One output line per record, as JSON Lines or as CSV without a header."""
    check_log_options("", fields, fmt)
    names = check_fields(fields)
    return records.select((csv_line if fmt == "csv" else json_line)(*names).alias("value"))


def json_condition(line: Column, condition: str, scalars: bool = False) -> Column:
    """``key=value`` on a JSON line: true for equal string values, with ``scalars`` also for equal raw tokens."""
    key, value = check_filter(condition)
    return field_equals(line, key, value, scalars)


def filter_json_lines(
    lines: DataFrame,
    condition: str | None = None,
    line_col: str = "line",
    keep: tuple[str, ...] = (),
    scalars: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(lines, rejects)``: object-like lines, trimmed but else unchanged, that meet the condition if there is one.

    A line without the key, or with a value that is not a string, is dropped and is no reject.
    """
    trimmed = lines.withColumn("line", trim_line(line_col))
    whole = looks_like_object("line")
    kept = trimmed.where(whole)
    if condition is not None:
        kept = kept.where(json_condition(F.col("line"), condition, scalars))
    return kept.select(*keep, "line"), _rejects(trimmed.where(~whole), "malformed JSON line")

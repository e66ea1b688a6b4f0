"""Output lines: JSON objects and CSV records, built as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_line(*columns: str) -> Column:
    """One JSON object in the given field order, everything escaped."""
    return F.to_json(F.struct(*columns))


def _csv_value(value: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(value.rlike('[,"\r\n]'), quoted).otherwise(value)


def csv_line(*columns: str) -> Column:
    """Comma-separated values; quoted only where a comma, quote or line end asks for it, quotes doubled."""
    return F.concat_ws(",", *[_csv_value(F.coalesce(F.col(name).cast("string"), F.lit(""))) for name in columns])

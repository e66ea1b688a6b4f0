"""Sidecar lines to chunk records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake import schemas
from chunklake.functions.fields import DATA_KIND, meta_fields, whole_meta
from chunklake.operators.rejects import PLACE, split_tagged
from chunklake.sources.manifest import Folder


def tag_sidecar(lines: DataFrame, mode: str = "textual") -> DataFrame:
    """The lines with ``meta``, the parsed record, and ``parsed``, the same if it is a data record.

    Fields, record and choice are steps of their own, so that each field is computed once.
    """
    if mode == "json":
        tagged = lines.withColumn("_json", F.from_json("line", schemas.META))
        fields = {name: F.col("_json")[name] for name in schemas.META.fieldNames()}
    else:
        tagged = lines.withColumns({f"_{name}": field for name, field in meta_fields("line", mode).items()})
        fields = {name: F.col(f"_{name}") for name in schemas.META.fieldNames()}
    tagged = tagged.withColumn("meta", whole_meta(fields)).select(*lines.columns, "meta")
    return tagged.withColumn("parsed", F.when(F.col("meta.kind") == DATA_KIND, F.col("meta")))


def parse_sidecar(lines: DataFrame, mode: str = "textual") -> tuple[DataFrame, DataFrame]:
    """``(chunks, rejects)``: data records with session and place, and all other lines. Empty lines are neither."""
    return split_sidecar(tag_sidecar(lines, mode))


#: How a pass that yields both is written: one row for each line, its columns filled by what it is.
_BOTH = ("folder", "session_id", *PLACE, *schemas.META.fieldNames(), "arrival_ms", "reason", "line")
RECORDS, REJECTS = "records", "rejects"


def write_both(tagged: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Writes data records and refused lines of tagged lines in one pass, as parts ``records`` and ``rejects`` of a table.

    Empty lines are neither. `read_records` and `read_rejects` read the parts.
    """
    reason = F.when(F.col("parsed").isNull(), F.when(F.col("meta").isNull(), "malformed record").otherwise("not a data record"))
    fields = {name: F.col(f"parsed.{name}") for name in schemas.META.fieldNames()}
    made = {"reason": reason, "line": F.when(F.col("parsed").isNull(), F.col("line")), **fields}
    columns = [made[name].alias(name) if name in made else name for name in _BOTH if name in made or name in tagged.columns]
    part = F.when(F.col("parsed").isNull(), REJECTS).otherwise(RECORDS).alias("part")
    # kept as rows of one array, so that no line is parsed a second time for a filter
    row = F.struct(*columns, part)
    both = tagged.select(F.inline(F.when(F.col("parsed").isNotNull() | (F.col("line") != ""), F.array(row))))
    both.write.mode(mode).partitionBy("part").parquet(path)


def _read_part(spark: SparkSession, path: str, part: str, names: tuple[str, ...]) -> DataFrame:
    kinds = {"folder": "string", "session_id": "string", "source": "string", "block": "bigint", "line_id": "bigint", "arrival_ms": "bigint"}
    kinds |= {f.name: f.dataType.simpleString() for f in schemas.META} | {"reason": "string", "line": "string"}
    schema = ", ".join(f"{name} {kinds[name]}" for name in names)
    if not Folder(spark, path).holds(f"part={part}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/part={part}")


def read_records(spark: SparkSession, path: str, arrival: bool = False) -> DataFrame:
    """The data records of what `write_both` wrote, with session and place."""
    names = ("folder", "session_id", *PLACE, *schemas.META.fieldNames(), *(["arrival_ms"] if arrival else []))
    return _read_part(spark, path, RECORDS, names)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The refused lines, each with its place and reason."""
    return _read_part(spark, path, REJECTS, (*PLACE, "reason", "line"))


def split_sidecar(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same of lines that are tagged already."""
    place = tuple(name for name in ("folder", "session_id", *PLACE) if name in tagged.columns)
    records, _ = split_tagged(tagged, F.lit(""), place)
    refused = F.col("parsed").isNull() & (F.col("line") != "")
    reason = F.when(F.col("meta").isNull(), "malformed record").otherwise("not a data record")
    row = F.struct(*[name for name in place if name in PLACE], reason.alias("reason"), "line")
    return records, tagged.select(F.inline(F.when(refused, F.array(row))))

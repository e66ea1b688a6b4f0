"""Refused input as data.

Every parser tags its lines with a ``parsed`` struct. The two halves of that one frame are the records and the rejects;
which of them a job runs is decided by what it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

PLACE = ("source", "block", "line_id")


def split_tagged(tagged: DataFrame, reason: Column, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of lines tagged with ``parsed``, NULL where the line is refused.

    The halves are unpacked from arrays of one or no element: a filter on ``parsed`` would be pushed below the parser,
    and parse every line a second time.
    """
    records = tagged.select(*carry, F.inline(F.when(F.col("parsed").isNotNull(), F.array("parsed"))))
    place = [name for name in PLACE if name in tagged.columns]
    refused = F.struct(*place, reason.alias("reason"), "line")
    return records, tagged.select(F.inline(F.when(F.col("parsed").isNull(), F.array(refused))))


def count_rejects(tagged: DataFrame, name: str = "lines") -> tuple[DataFrame, Observation]:
    """The same frame, with counts of all and of refused lines taken while it runs. Empty lines are neither."""
    seen = Observation(name)
    some = F.col("line") != ""
    refused = F.count_if(some & F.col("parsed").isNull())
    return tagged.observe(seen, F.count_if(some).alias("lines"), refused.alias("rejects")), seen


def count_clips(clips: DataFrame, name: str = "clips") -> tuple[DataFrame, Observation]:
    """The same clips, with counts of all and of those a break or a pause cut short."""
    seen = Observation(name)
    cut_short = F.count_if(~F.col("complete"))
    return clips.observe(seen, F.count(F.lit(1)).alias("clips"), cut_short.alias("cut_short")), seen

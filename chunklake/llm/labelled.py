"""Bounded samples of labelled documents, for operators that fit a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Of each class so many labelled rows at most serve to fit a model: a bound on what is broadcast and on the driver.
SAMPLE_PER_CLASS = 6000


def held_out(doc_id: Column) -> Column:
    """Whether a row may not be learned from: crc32 of the id as text leaves 0 by 5. A null id is learned from never, too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_ids(labels: DataFrame, label: str, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``doc_id``, ``label``, ``weight`` of at most ``per_class`` rows of each class, in the order of a hash.

    Labels of one id are averaged; ids without a label or held out take no part. ``weight`` makes up for the sampling.
    """
    one = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    one = one.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    sizes = {row["label"]: row["n"] for row in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.lit("sample"), F.col("doc_id"))
    parts = [one.filter(F.col("label") == k).orderBy(order, "doc_id").limit(per_class) for k in (0, 1)]
    weights = F.when(F.col("label") == 1, max(1.0, sizes.get(1, 0) / per_class)).otherwise(max(1.0, sizes.get(0, 0) / per_class))
    return parts[0].unionByName(parts[1]).withColumn("weight", weights)


def training_texts(docs: DataFrame, labels: DataFrame, label: str, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``doc_id``, ``text``, ``label``, ``weight`` of the sampled documents; the sample is bounded, so it is broadcast."""
    return docs.select("doc_id", "text").join(F.broadcast(training_ids(labels, label, per_class)), "doc_id")

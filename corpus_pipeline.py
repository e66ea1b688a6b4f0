"""The corpus pipeline: quality, near duplicates, decontamination, mixing, sharding.

Of every stage: a null or empty text is a text without words, and stays unless the stage rejects texts without words; rows
alike are rows of their own but to the near-duplicate stage, which keeps one of them; an empty table gives an empty one; more
columns are carried along, whatever their names, up to sharding, whose own columns replace ones named like them. No stage
changes a text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chunklake.llm.common import kept, table
from chunklake.llm.decontamination import drop_leaks
from chunklake.llm.jaccard import drop_duplicates
from chunklake.llm.mixing import mix_documents
from chunklake.llm.quality import fit_quality, score_quality
from chunklake.llm.sharding import shard_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier does not reject, learned from labels of documents not held out.

    Without labels of both classes every document has the same score, that of the labels there are, and all stay or all go.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).filter("predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates; documents without words are copies of each other only if their texts are equal."""
    return drop_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no passage of the benchmark; with an empty benchmark all."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that weighted fair queueing takes of the documents, each whole: none, one or two of each; those without words once."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their shard of 40 and their slot in it."""
    return shard_documents(docs, 40)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Fitted models and hashes of whole texts are no SQL. The tests hold each operator against brute force, and the stages, one
#: after the other, against what the operators' own results say of their input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = kept(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs

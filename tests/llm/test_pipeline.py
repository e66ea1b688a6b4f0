import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from chunklake.llm.decontamination import find_leaks
from chunklake.llm.jaccard import duplicate_classes
from chunklake.llm.mixing import mix_report, words
from chunklake.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import sentence

FOLDER = "/root/testdata/sf0.001"


def test_stages_are_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing", "sharding"]
    registered = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_each_stage_keeps_what_it_should(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, FOLDER)
        if name != "sharding":
            assert found.columns == docs.columns
        found.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
    before = 200
    for name in ("quality classifier", "n-gram Jaccard join", "benchmark decontamination"):
        assert len(set(seen[name])) == len(seen[name]) and 0.6 * before < len(seen[name]) <= before
        before = len(seen[name])
    assert len(seen["sharding"]) == len(seen["mixing"]) and set(seen["mixing"]) <= set(seen["benchmark decontamination"])
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in whole.collect()) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in docs.collect())


@pytest.fixture
def side_tables(spark, tmp_path):
    """Labels and a benchmark of their own for tables made in a test."""

    def make(labels, items):
        folder = tmp_path / "tables"
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(folder / "benchmark.parquet"))
        return str(folder)

    return make


def test_stages_with_odd_rows_and_clashing_names(spark, documents, odd_rows, side_tables, tmp_path):
    rng = random.Random(2)
    good = [(100 + k, sentence(rng, rng.randrange(5, 60)).capitalize() + ".", "ab"[k % 2]) for k in range(60)]
    leak = sentence(rng, 20, 7000)
    rows = [*odd_rows, *good, (300, f"{good[0][1]} {leak} {good[1][1]}", "a"), (301, None, None), (302, good[3][1], "c")]
    folder = side_tables([(k, 1, 0) for k, *_ in good] + [(3, 0, 0), (4, 0, 0), (5, 0, 0), (1, None, None)], [(1, leak), (2, None), (None, "?")])
    docs = documents(rows, ", score int, class_id string, finish int, slot string, _row int", (1, "x", 2, "y", 3))
    texts = {r[1] for r in rows}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, folder)
        if name == "sharding":
            assert set(docs.columns) <= set(found.columns) and len(set(found.columns)) == len(found.columns)
        else:
            assert found.columns == docs.columns
        found.write.parquet(str(tmp_path / str(k)))
        before, docs = [tuple(r) for r in docs.select("doc_id", "text").collect()], spark.read.parquet(str(tmp_path / str(k)))
        after = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert {t for _, t in after} <= texts and set(after) <= set(before)  # no stage changes a text
        if name == "benchmark decontamination":
            assert set(before) - set(after) <= {(300, rows[-3][1])} and all(leak not in (t or "") for _, t in after)
        if name == "n-gram Jaccard join":
            assert len({t for _, t in after}) == len(after)
        if name == "sharding":
            assert sorted(after, key=repr) == sorted(before, key=repr)


def test_stages_of_empty_tables(spark, documents, side_tables):
    folder = side_tables([], [])
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_stages_keep_what_their_operators_say(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    ids = lambda frame: sorted(r["doc_id"] for r in frame.select("doc_id").collect())
    stages = dict(corpus_pipeline.STAGES)
    one = stages["n-gram Jaccard join"](spark, docs, FOLDER)
    classes = {r["doc_id"]: r["class_id"] for r in duplicate_classes(docs).select("doc_id", "class_id").collect()}
    assert sorted(classes[i] for i in ids(one)) == sorted(set(classes.values()))
    leaky = {r["doc_id"] for r in find_leaks(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    assert ids(stages["benchmark decontamination"](spark, docs, FOLDER)) == sorted(set(classes) - leaky) and leaky
    report = mix_report(docs).collect()
    mixed = stages["mixing"](spark, docs, FOLDER).groupBy("source").agg(F.sum(words(F.col("text"))).alias("n")).collect()
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    for row in mixed:
        own = [r for r in report if sources[r["doc_id"]] == row["source"]]
        assert abs(row["n"] - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    cursor = duck.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_its_table(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    whole = spark.read.parquet(f"{FOLDER}/{'pages' if 'html' in name else 'documents'}.parquet").count()
    if "whitening" in name:
        assert len(rows) == 16 * spark.read.parquet(f"{FOLDER}/embeddings.parquet").count()
    elif "packing" in name:
        assert len({r["doc_id"] for r in rows}) == whole <= len(rows)
    else:
        assert len(rows) == whole if "decontamination" not in name else 0 < len(rows) < whole

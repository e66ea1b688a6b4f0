"""An index of a store's runs, read before the runs are: which of them may hold a key.

A run has a blocked Bloom filter over its distinct keys, eight bits a key: a key sets one bit in each of the four words of its block.
The index is a table of blocks beside the runs, each with the range of its run's keys; it is added to after runs are finished,
and a run that is not in it yet is read. Built and asked with built-in functions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.sources.manifest import Folder, open_runs, read_manifest
from chunklake.sources.store import read_folders

_FOLDER = "_index"
_WORDS = ("w0", "w1", "w2", "w3")
_SCHEMA = "name string, least string, most string, blocks bigint, block bigint, w0 bigint, w1 bigint, w2 bigint, w3 bigint"
#: Keys for each block of 256 bits.
KEYS_PER_BLOCK = 32
#: Blocks of an index file, about.
BLOCKS_PER_FILE = 1 << 20


def _block(key: Column, blocks: Column | int) -> Column:
    """The block of a key, of a number of blocks that is a power of two."""
    last = blocks - 1 if isinstance(blocks, Column) else F.lit(blocks - 1).cast("bigint")
    return F.xxhash64(F.lit("block"), key).bitwiseAND(last)


def _bit(key: Column, word: int) -> Column:
    place = F.shiftrightunsigned(F.xxhash64(F.lit("bits"), key), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All blocks of all indexed runs, covered ones too."""
    path = path.rstrip("/")
    parts = [name for name in Folder(spark, path).names(_FOLDER) if Folder(spark, f"{path}/{_FOLDER}/{name}").holds("_SUCCESS")]
    if not parts:
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(*[f"{path}/{_FOLDER}/{name}" for name in parts])


def index_runs(spark: SparkSession, path: str) -> list[str]:
    """Indexes all finished runs that are neither covered nor indexed yet, and returns their names. One row of a run goes to the driver."""
    path = path.rstrip("/")
    known = {row.name for row in read_index(spark, path).select("name").distinct().collect()}  # one row for each run
    names = [name for name in open_runs(spark, path, read_manifest(spark, path)) if name not in known]
    if not names:
        return []
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    # the run's folder: what stands between the store and the file
    name = F.regexp_extract(file, r"((?:run|snapshot)=[^/]*|stream=[^/]*/batch=[^/]*)/[^/]*$", 1)
    keys = read_folders(spark, path, names).select(name.alias("name"), "key")
    # distinct keys are told by a sketch in each task: no key is sorted or sent to another task for it
    distinct = F.hll_sketch_estimate(F.hll_sketch_agg("key"))
    power = F.ceil(F.log2(F.greatest(distinct / KEYS_PER_BLOCK, F.lit(1)))).cast("int")
    blocks = F.call_function("shiftleft", F.lit(1).cast("bigint"), power)
    facts = keys.groupBy("name").agg(F.min("key").alias("least"), F.max("key").alias("most"), blocks.alias("blocks")).collect()
    runs = F.broadcast(spark.createDataFrame(facts, "name string, least string, most string, blocks bigint"))  # one row for each run
    placed = keys.join(runs, "name").withColumn("block", _block(F.col("key"), F.col("blocks")))
    bits = [F.bit_or(_bit(F.col("key"), i)).alias(w) for i, w in enumerate(_WORDS)]
    parts = 1 + sum(row.blocks for row in facts) // BLOCKS_PER_FILE
    placed.groupBy("name", "least", "most", "blocks", "block").agg(*bits).coalesce(parts).write.option("compression", "zstd").parquet(
        f"{path}/{_FOLDER}/{uuid.uuid4().hex}"
    )
    return names


def runs_for(index: DataFrame, keys: DataFrame) -> DataFrame:
    """``name`` of each indexed run that may hold one of the keys."""
    sizes = [row.blocks for row in index.select("blocks").distinct().collect()]  # powers of two
    at = F.explode(F.array(*[F.struct(F.lit(n).cast("bigint").alias("blocks"), _block(F.col("key"), n).alias("block")) for n in sizes] or [
        F.struct(F.lit(0).cast("bigint").alias("blocks"), F.lit(0).cast("bigint").alias("block"))
    ]))
    asked = keys.select("key").distinct().select("key", at.alias("at")).select("key", "at.*")
    held = [F.col(w).bitwiseAND(_bit(F.col("key"), i)) != 0 for i, w in enumerate(_WORDS)]
    maybe = index.join(asked, ["blocks", "block"]).where(F.col("key").between(F.col("least"), F.col("most")))
    return maybe.where(held[0] & held[1] & held[2] & held[3]).select("name").distinct()


def runs_for_key(index: DataFrame, key: str) -> DataFrame:
    """The same for one key; its blocks are pushed down to the scan of the index."""
    sizes = [row.blocks for row in index.select("blocks").distinct().collect()]
    if not sizes:
        return index.select("name")
    spark, one = index.sparkSession, F.lit(key)
    hashes = spark.range(1).select(*[_block(one, n) for n in sizes], *[_bit(one, i) for i in range(len(_WORDS))]).first()
    place = F.lit(False)
    for n, block in zip(sizes, hashes, strict=False):
        place = place | ((F.col("blocks") == n) & (F.col("block") == block))
    found = index.where(place & (F.col("least") <= key) & (F.col("most") >= key))
    for word, bit in zip(_WORDS, hashes[len(sizes) :], strict=True):
        found = found.where(F.col(word).bitwiseAND(F.lit(bit)) != 0)
    return found.select("name").distinct()


def _rows_for(spark: SparkSession, path: str, index: DataFrame, maybe: DataFrame, in_snapshot: list[str]) -> DataFrame:
    """The rows of those snapshot files, of runs that may hold a key, and of runs that are not indexed. Names go to the driver."""
    runs = open_runs(spark, path, read_manifest(spark, path))
    known = {row.name for row in index.select("name").distinct().collect()}
    wanted = {row.name for row in maybe.collect()}
    return read_folders(spark, path, [*in_snapshot, *(name for name in runs if name in wanted or name not in known)])


def read_store_for(spark: SparkSession, path: str, key: str) -> DataFrame:
    """All rows of a store in files that may hold the key, for `lookup`."""
    manifest, index = read_manifest(spark, path), read_index(spark, path)
    files = [f.path for f in manifest.files if f.least <= key <= f.most]
    return _rows_for(spark, path, index, runs_for_key(index, key), files)


def read_store_for_keys(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """All rows between the least and the greatest key in files that may hold one of the keys, for `lookup_many`."""
    manifest, index = read_manifest(spark, path), read_index(spark, path)
    least, most = keys.agg(F.min("key"), F.max("key")).first()
    files = [f.path for f in manifest.files if least is not None and f.least <= most and f.most >= least]
    rows = _rows_for(spark, path, index, runs_for(index, keys), files)
    return rows.where(F.col("key").between(F.lit(least), F.lit(most)))

"""N-gram Jaccard join with Bayesian pruning of candidates.

A text is the set of its runs of five words. Texts of the same words are one. Each distinct one has 128 MinHash values; texts
that agree on the four values of one of 32 bands are linked, and what is linked stays together in one candidate group. Within
a group all pairs are compared, 32 values at a time: a pair is dropped when, given the values that agreed so far, its
similarity reaches the threshold with a probability below the tolerance. The shared runs of the others are counted exactly.

A pair of similarity 0.8 agrees in no band with a probability of (1 - 0.8 ** 4) ** 32 < 5e-8.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import in_small_batches, kept, private, text_of
from chunklake.llm.graph import components

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
VALUES = BANDS * ROWS
#: Values compared between two looks at the posterior, and the probability below which a pair is dropped.
STEP, TOLERANCE = 32, 1e-7
#: A candidate group is cut into blocks of about so many word runs; pairs of blocks are compared apart.
BLOCK_SHINGLES = 1 << 20
#: Rows of a block compared at once with rows of another.
TILE = 512

_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(1, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _RNG.integers(0, 1 << 32, VALUES, dtype=np.uint32)
_NOT_WORD = r"[^\p{L}\p{N}\p{M}_]+"


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the texts, lower-cased, one text after another, and where each text begins."""
    words = pc.split_pattern(pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(texts), _NOT_WORD, " "), " "), " ")
    offsets = words.offsets.to_numpy().astype(np.int64)
    coded = words.flatten().dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    tokens = hashes[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.uint64)
    return tokens, offsets - offsets[0]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the distinct runs of five words; a shorter text is one run."""
    length = min(len(words), WORDS)
    run = np.full(len(words) - length + 1, length, np.uint64)
    for k in range(length):
        run = _mixed(run * np.uint64(31) + words[k : len(words) - length + 1 + k])
    return np.unique(run)


def run_sets(texts: pa.Array) -> tuple[list[np.ndarray], list[bytes]]:
    """The runs of each text, and a name that texts of the same words share; one without words is a run by itself."""
    sets, names = [], []
    with np.errstate(over="ignore"):
        tokens, offsets = token_hashes(texts)
        for n, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
            words = tokens[a:b]
            if b - a <= 1 and (a == b or words[0] == _EMPTY):
                raw = texts[n].as_py().encode()
                sets.append(np.array([xxhash.xxh3_64_intdigest(b"\0" + raw)], np.uint64))
                names.append(xxhash.xxh3_128_digest(b"\0" + raw))
            else:
                sets.append(shingles(words))
                names.append(xxhash.xxh3_128_digest(words.tobytes()))
    return sets, names


_EMPTY = xxhash.xxh3_64_intdigest("")


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of each set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    found = np.empty((len(sets), VALUES), np.uint32)
    lo = 0
    while lo < len(sets):
        # a few thousand runs at once stay in the cache
        hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), 16384)))
        x = (np.concatenate(sets[lo:hi]) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum(sizes[lo:hi])[:-1]])
        for v in range(VALUES):
            y = x * _FACTORS[v] + _SHIFTS[v]
            y ^= y >> np.uint32(15)
            found[lo:hi, v] = np.minimum.reduceat(y, starts)
        lo = hi
    return found


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets, names = run_sets(batch["text"])
        found = signatures(sets).astype("<u4")
        columns = [pa.array(names, pa.binary()), pa.array(map(len, sets), pa.int32()), pa.array([row.tobytes() for row in found], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["md5"], *columns], ["doc_id", "md5", "name", "size", "signature"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.frombuffer(b"".join(batch["signature"].to_pylist()), "<u4").reshape(-1, BANDS, ROWS).astype(np.uint64)
        with np.errstate(over="ignore"):
            key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), found.shape[:2]).copy()
            for r in range(ROWS):
                key = _mixed(key * np.uint64(1 << 32 | 1) + found[:, :, r])
        rid = np.repeat(batch["rid"].to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(rid)], ["band", "rid"])


def least_agreeing(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of values compared, how many must agree for a pair to stay.

    With no prior knowledge of the similarity, m of n values agreeing leave it a Beta(m + 1, n - m + 1) posterior; its mass
    above the threshold is the chance of at most m successes in n + 1 draws of that probability.
    """

    def above(m: int, n: int) -> float:
        return sum(math.comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1))

    return {n: next(m for m in range(n + 1) if above(m, n) >= tolerance) for n in range(STEP, VALUES + 1, STEP)}


class Block:
    """Texts of one block: ids, weights, signatures, and their runs under small numbers."""

    def __init__(self, rid: np.ndarray, weight: np.ndarray, signature: np.ndarray, runs: list[np.ndarray]):
        self.rid, self.weight, self.signature, self.runs = rid, weight, signature, runs
        self.size = np.array([len(r) for r in runs], np.int64)


def similar_pairs(left: Block, right: Block, same: bool, need: dict[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of the pairs that reach the threshold, tile by tile; of one block with itself only i < j."""
    for lo in range(0, len(left.rid), TILE):
        for start in range(lo if same else 0, len(right.rid), TILE):
            i, j = _unpruned(left, right, lo, start, same and lo == start, need)
            if len(i):
                shared = _shared(left, right, i, j)
                union = left.size[i] + right.size[j] - shared
                good = shared >= np.ceil(THRESHOLD * union - 1e-9)
                if good.any():
                    yield i[good], j[good]


def _unpruned(left: Block, right: Block, lo: int, start: int, same: bool, need: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    a, b = left.signature[lo : lo + TILE], right.signature[start : start + TILE]
    agree = np.zeros((len(a), len(b)), np.uint8)
    for v in range(STEP):
        agree += a[:, v, None] == b[None, :, v]
    if same:
        agree[np.tril_indices(len(a), 0, len(b))] = 0
    i, j = np.nonzero(agree >= max(need[STEP], 1))
    count = agree[i, j].astype(np.int32)
    for n in range(2 * STEP, VALUES + 1, STEP):
        more = np.empty(len(i), np.int32)
        for k in range(0, len(i), 1 << 16):
            part = slice(k, k + (1 << 16))
            more[part] = (a[i[part], n - STEP : n] == b[j[part], n - STEP : n]).sum(1)
        count += more
        stay = count >= need[n]
        i, j, count = i[stay], j[stay], count[stay]
    return i + lo, j + start


def _shared(left: Block, right: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many runs the texts of each pair share.

    Runs that only one text of the tile has cannot be shared; over the rest a product of 0/1 matrices counts, or, where few
    pairs stayed, a look-up for each.
    """
    rows, at_i = np.unique(i, return_inverse=True)
    cols, at_j = np.unique(j, return_inverse=True)
    if len(i) * 8 < len(rows) * len(cols) or len(i) < 64:
        return np.array([len(np.intersect1d(left.runs[p], right.runs[q], assume_unique=True)) for p, q in zip(i, j, strict=True)], np.int64)
    x, y = [left.runs[p] for p in rows], [right.runs[q] for q in cols]
    both = np.intersect1d(np.concatenate(x), np.concatenate(y))
    total = np.zeros((len(rows), len(cols)), np.float32)
    for lo in range(0, len(both), 4096):
        some = both[lo : lo + 4096]
        total += _ones(x, some) @ _ones(y, some).T
    return total[at_i, at_j].astype(np.int64)


def _ones(runs: list[np.ndarray], among: np.ndarray) -> np.ndarray:
    found = np.zeros((len(runs), len(among)), np.float32)
    for n, r in enumerate(runs):
        r = r[np.searchsorted(r, among[0]) : np.searchsorted(r, among[-1], side="right")]
        at = np.searchsorted(among, r)
        hit = among[at] == r
        found[n, at[hit]] = 1
    return found


def compare(left: Block, right: Block, same: bool, need: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text of both blocks: its id, linked texts, linked documents, and the least id that links reach within."""
    offset = 0 if same else len(left.rid)
    rid = left.rid if same else np.concatenate([left.rid, right.rid])
    weight = left.weight if same else np.concatenate([left.weight, right.weight])
    texts, docs, parent = np.zeros(len(rid), np.int64), np.zeros(len(rid), np.int64), np.arange(len(rid))
    for i, j in similar_pairs(left, right, same, need):
        j = j + offset
        for p, q in ((i, j), (j, i)):
            texts += np.bincount(p, minlength=len(rid))
            docs += np.bincount(p, weight[q], len(rid)).astype(np.int64)
        while True:
            x, y = parent[i], parent[j]
            differ = x != y
            if not differ.any():
                break
            i, j = i[differ], j[differ]
            np.minimum.at(parent, np.maximum(x, y)[differ], np.minimum(x, y)[differ])
            parent = _flat(parent)
    least = np.full(len(rid), np.iinfo(np.int64).max)
    np.minimum.at(least, parent, rid)
    return rid, texts, docs, least[parent]


def _flat(parent: np.ndarray) -> np.ndarray:
    while (parent[parent] != parent).any():
        parent = parent[parent]
    return parent


LINKS = "rid long, texts long, docs long, root long"


def _joiner(need: dict[int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compares the rows of each (root, left, right), which come sorted, one after another."""

    def compared(rows: list[tuple]) -> pa.RecordBatch:
        seen: set[tuple[int, int]] = set()
        sides: dict[int, list[tuple]] = {}
        for _, left, right, block, rid, weight, text in rows:
            if (block, rid) not in seen:  # repeated rows of one document
                seen.add((block, rid))
                sides.setdefault(block, []).append((rid, weight, text))
        _, left, right, *_ = rows[0]
        blocks = []
        for block in dict.fromkeys((left, right)):
            side = sorted(sides.get(block, []))
            runs, _ = run_sets(pa.array([t for _, _, t in side], pa.string()))
            ids, weights = (np.array([s[k] for s in side], np.int64) for k in (0, 1))
            blocks.append(Block(ids, weights, signatures(runs), runs))
        found = compare(blocks[0], blocks[-1], left == right, need)
        linked = found[1] > 0
        return pa.RecordBatch.from_arrays([pa.array(x[linked]) for x in found], ["rid", "texts", "docs", "root"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    if rows:
                        yield compared(rows)
                    key, rows = row[:3], []
                rows.append(row)
        if rows:
            yield compared(rows)

    return join


def _md5(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def duplicate_classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``md5`` of its text, ``class_id``, ``n_links``, ``n_text_links``, ``copies``, ``first_of_class``.

    Texts are linked whose runs of five words have a Jaccard similarity of 0.8 or more; a class is what links connect, named
    by the least id in it. ``n_links`` counts the other documents linked to a document, ``n_text_links`` the other texts,
    ``copies`` the documents of the same words, itself with them. Upper case and marks do not tell texts apart. A text of fewer
    than five words is one run; texts without a word, null as empty, are alike where they are equal. A null id counts as
    larger than others; rows alike in all are copies of each other. ``first_of_class`` marks one (id, text) of each class.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("md5", _md5(F.col("text")))
    schema = "doc_id long, md5 binary, name binary, size int, signature binary"
    signed = kept(rows.mapInArrow(_sign, schema), "signatures")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "md5")
    texts = signed.groupBy("name").agg(F.min(order).alias("first"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("signature").alias("signature"))
    texts = kept(texts.withColumn("rid", F.monotonically_increasing_id()), "texts")

    bands = texts.select("rid", "signature").mapInArrow(_bands, "band long, rid long")
    least = bands.groupBy("band").agg(F.min("rid").alias("b"), F.count("*").alias("n")).filter("n > 1").select("band", "b")
    groups = components(bands.join(least, "band").select(F.col("rid").alias("a"), "b").filter("a <> b"))

    member = texts.select("rid", "first", "copies", "size").join(groups.select(F.col("node").alias("rid"), "root"), "rid")
    member = kept(member, "candidates")
    blocks = member.groupBy("root").agg(F.ceil(F.sum("size") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    member = member.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    member = member.select("root", "rid", "copies", "blocks", "block", F.col("first.doc_id").alias("id"), F.col("first.md5").alias("md5"))
    found = rows.join(member, F.col("doc_id").eqNullSafe(F.col("id")) & (rows["md5"] == member["md5"]))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("block")).alias("left"), F.greatest(k, F.col("block")).alias("right")),
    )
    sides = found.select("root", F.explode(pairs).alias("pair"), "block", "rid", "copies", "text")
    sides = sides.select("root", "pair.left", "pair.right", "block", "rid", "copies", "text")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sides = sides.repartition(width, "root", "left", "right").sortWithinPartitions("root", "left", "right")
    links = kept(sides.mapInArrow(_joiner(least_agreeing()), LINKS), "links")

    classes = components(links.filter("rid <> root").select(F.col("rid").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("rid").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    full = texts.select("rid", "name", "first", "copies").join(classes.select(F.col("node").alias("rid"), "root"), "rid", "left").join(counted, "rid", "left")
    full = full.withColumn("root", F.coalesce("root", "rid"))
    firsts = full.groupBy("root").agg(F.min("first").alias("head"))
    full = full.join(firsts, "root").select("name", "head", "copies", F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("docs", F.lit(0)).alias("docs"))
    every = signed.select("doc_id", "md5", "name").join(full, "name")
    return every.select(
        "doc_id",
        "md5",
        F.col("head.doc_id").alias("class_id"),
        (F.col("docs") + F.col("copies") - 1).alias("n_links"),
        F.col("texts").alias("n_text_links"),
        "copies",
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("md5") == F.col("head.md5"))).alias("first_of_class"),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows, all columns, of one document of each class: that of the least id; of rows alike in id and text one."""
    heads = duplicate_classes(docs).filter("first_of_class").select("doc_id", "md5").distinct()
    md5, place, head_id, head_md5 = private(docs, "md5", "place", "head_id", "head_md5")
    heads = heads.select(F.col("doc_id").alias(head_id), F.col("md5").alias(head_md5))
    rows = docs.withColumn(md5, _md5(text_of()))
    rows = rows.join(heads, F.col("doc_id").eqNullSafe(F.col(head_id)) & (F.col(md5) == F.col(head_md5)))
    rows = rows.withColumn(place, F.expr(f"row_number() OVER (PARTITION BY doc_id, {md5} ORDER BY {md5})"))
    return rows.filter(F.col(place) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))

"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a line; words whose hash says so end a leaf, four words on average and 16 at most, and paragraphs whose hash
says so end a section, so an edit moves no boundary beyond its place. A node's hash is made of its children's in order.

Every node has two independent hashes of 64 bits, made of those of its children from the words up: texts that collide in one of
them differ in the other, and so do the roots.

A fingerprint is text: the root (both hashes, 32 hex digits), then the levels of sections, of paragraphs and of leaves, each
after a ``.``. A section or paragraph has 10 digits of its first hash and 6 of its number of children, a leaf 10 digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import in_small_batches, text_of

#: A word ends a leaf where these bits of its hash are zero, a paragraph a section; a leaf has so many words at most.
LEAF_BITS, SECTION_BITS, MOST_LEAF_WORDS = 3, 7, 16
#: Ranges of ids for each shuffle partition, and of rows without an id.
RANGES_PER_PARTITION, NULL_RANGES = 2, 16
#: Bytes of text that a shuffle partition holds, about.
PARTITION_BYTES = 32 << 20


def word_hashes(words: list[str]) -> np.ndarray:
    """Two hashes of each word, as columns: the halves of one of 128 bits."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in words]), ">u8").reshape(-1, 2).astype(np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _fold(hashes: np.ndarray, begin: np.ndarray, seed: int) -> np.ndarray:
    """One hash for each stretch of hashes: their sum, each mixed with its place in the stretch."""
    count = np.diff(np.append(begin, len(hashes)))
    place = (np.arange(len(hashes)) - np.repeat(begin, count)).astype(np.uint64)
    mixed = _mixed(hashes + _mixed(place + np.uint64(seed)))
    return _mixed(np.add.reduceat(mixed, begin) + count.astype(np.uint64) * np.uint64(seed | 1)) if len(begin) else hashes[:0]


def _begins(ends: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ends[:-1]])) if len(ends) else np.zeros(0, np.int64)


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text. All levels of all texts are made at once."""
    with np.errstate(over="ignore"):
        words = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n "), " ")
        offsets = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        different = coded.dictionary.to_pylist()
        at_word = coded.indices.to_numpy() if len(coded) else np.zeros(0, np.int64)
        token, second = word_hashes(different).T[:, at_word]
        is_break = np.array([w == "\n" for w in different], bool)[at_word]
        last = np.zeros(len(token), bool)
        last[offsets[1:] - 1] = True  # a text has one word at least, be it empty
        # leaves: a line break is the last word of its paragraph
        paragraph_end = last | is_break
        ends = paragraph_end | ((token & np.uint64(LEAF_BITS)) == 0)
        begin = _begins(ends)
        count = np.diff(np.append(begin, len(token)))
        place = np.arange(len(token)) - np.repeat(begin, count)
        ends |= place % MOST_LEAF_WORDS == MOST_LEAF_WORDS - 1
        begin = _begins(ends)
        leaves, second = _fold(token, begin, 11), _fold(second, begin, 13)
        at = np.append(begin, len(token))[1:] - 1
        par_begin = _begins(paragraph_end[at])
        paragraphs, second = _fold(leaves, par_begin, 23), _fold(second, par_begin, 29)
        par_at = at[np.append(par_begin, len(leaves))[1:] - 1]
        sec_begin = _begins(last[par_at] | ((paragraphs & np.uint64(SECTION_BITS)) == 0))
        sections, second = _fold(paragraphs, sec_begin, 37), _fold(second, sec_begin, 41)
        sec_at = par_at[np.append(sec_begin, len(paragraphs))[1:] - 1]
        text_begin = _begins(last[sec_at])
        roots = [_fold(sections, text_begin, 53), _fold(second, text_begin, 71)]

    def level(hashes: np.ndarray, children: np.ndarray) -> np.ndarray:
        rows = np.empty((len(hashes), 8), np.uint8)
        rows[:, :5] = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :5]
        rows[:, 5:] = children.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:]
        return rows

    top = np.stack(roots, 1).astype(">u8") if len(texts) else np.zeros((0, 2), ">u8")
    rows = [
        level(sections, np.diff(np.append(sec_begin, len(paragraphs)))),
        level(paragraphs, np.diff(np.append(par_begin, len(leaves)))),
        leaves.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :5],
    ]
    cut_sections = np.append(text_begin, len(sections))
    cut_paragraphs = np.append(sec_begin, len(paragraphs))[cut_sections]
    cut_leaves = np.append(par_begin, len(leaves))[cut_paragraphs]
    found = []
    for n in range(len(texts)):
        parts = [r[c[n] : c[n + 1]].tobytes().hex() for r, c in zip(rows, (cut_sections, cut_paragraphs, cut_leaves), strict=True)]
        found.append(".".join([top[n].tobytes().hex(), *parts]))
    return found


def leaves_of(fingerprint: str) -> np.ndarray:
    """The leaves' hashes as sorted numbers."""
    raw = np.frombuffer(bytes.fromhex(fingerprint.rpartition(".")[2]), np.uint8).reshape(-1, 5)
    whole = np.zeros((len(raw), 8), np.uint8)
    whole[:, 3:] = raw
    return np.sort(whole.view(">u8").ravel().astype(np.uint64))


def likeness(one: str, other: str, leaves: tuple[np.ndarray, np.ndarray] | None = None) -> float:
    """1 for equal roots, else the leaves that both have, over the mean number of leaves."""
    if one[:32] == other[:32]:
        return 1.0
    a, b = leaves or (leaves_of(one), leaves_of(other))
    # equal numbers meet one by one
    shared = _numbered(a), _numbered(b)
    return 2.0 * len(np.intersect1d(*shared, assume_unique=True)) / (len(a) + len(b))


def _numbered(values: np.ndarray) -> np.ndarray:
    """Sorted values of 40 bits made distinct by their number among equals."""
    if not len(values):
        return values
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    nth = np.arange(len(values)) - np.repeat(begin, np.diff(np.append(begin, len(values))))
    return values << np.uint64(24) | nth.astype(np.uint64)


def differing_paragraphs(one: str, other: str) -> tuple[list[int], list[int]]:
    """Numbers of the paragraphs of each text that lie in sections, and are paragraphs, which the other has not."""

    def branches(fingerprint: str) -> tuple[list[str], list[str], list[int]]:
        _, sections, paragraphs, _ = fingerprint.split(".")
        rows = [sections[i : i + 16] for i in range(0, len(sections), 16)]
        parents = [n for n, row in enumerate(rows) for _ in range(int(row[10:], 16))]
        return [r for r in rows], [paragraphs[i : i + 16] for i in range(0, len(paragraphs), 16)], parents

    if one[:32] == other[:32]:
        return [], []
    first, second = branches(one), branches(other)

    def only(a: tuple, b: tuple) -> list[int]:
        sections, paragraphs = set(b[0]), set(b[1])
        return [n for n, p in enumerate(a[1]) if a[0][a[2][n]] not in sections and p not in paragraphs]

    return only(first, second), only(second, first)


def _range_of(doc_id: Column, order: Column, edges: list[int]) -> Column:
    """The number of the id's range, searched among the edges; rows without an id come last, spread by the hash of their text."""
    bounds = np.array(edges, np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(np.int64), side="right").astype(np.int32))

    by_id = place(F.coalesce(doc_id, F.lit(0).cast("long"))) if edges else F.lit(0)
    return F.when(doc_id.isNotNull(), by_id).otherwise(len(edges) + 1 + NULL_RANGES // 2 + F.shiftright(order, 60).cast("int")).cast("int")


def with_next(docs: DataFrame) -> DataFrame:
    """``range``, ``halo``, ``doc_id``, ``text``, sorted by range and id in each partition.

    Every range's rows are followed by the row that begins the next range (after the last, the first) with ``halo`` true, so
    each row's next is the one behind it. Ranges are as many as the bytes of the texts ask for. The driver learns the first id
    of each range, no more.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).withColumn("order", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    ranges = width * RANGES_PER_PARTITION
    quantiles = rows.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 0.1 / ranges)
    edges = sorted({int(q) for q in quantiles})
    rows = rows.withColumn("range", _range_of(F.col("doc_id"), F.col("order"), edges))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "order")
    firsts = sorted(rows.groupBy("range").agg(F.min(key).alias("first")).collect(), key=lambda r: r["range"])
    if not firsts:
        return rows.select("range", F.lit(False).alias("halo"), "doc_id", "order", "text")
    places = spark.createDataFrame(
        [(before["range"], r["first"]["doc_id"], r["first"]["order"]) for before, r in zip([firsts[-1], *firsts], firsts, strict=False)],
        "range int, doc_id long, order long",
    ).alias("p")
    halo = rows.alias("r").join(F.broadcast(places), F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("r.order") == F.col("p.order")))
    halo = halo.groupBy("p.range", "r.doc_id", "r.order").agg(F.min("r.text").alias("text"))
    both = rows.select("range", F.lit(False).alias("halo"), "doc_id", "order", "text").unionByName(
        halo.select("range", F.lit(True).alias("halo"), "doc_id", "order", "text")
    )
    return both.repartition(width, "range").sortWithinPartitions("range", "halo", F.col("doc_id").asc_nulls_last(), "order", "text")


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    carried: tuple[list, list, list] = ([], [], [])
    for batch in batches:
        ranges, ids, texts = (c + batch[n].to_pylist() for c, n in zip(carried, ("range", "doc_id", "text"), strict=True))
        halo = [False] * len(carried[0]) + batch["halo"].to_pylist()
        own = fingerprints(texts)
        leaves = [leaves_of(f) for f in own]
        take = [n for n in range(len(texts) - 1) if not halo[n] and ranges[n] == ranges[n + 1]]
        edited = []
        for n in take:
            half = len(texts[n]) // 2
            edited.append(texts[n][: len(texts[n]) - half] + texts[n + 1][:half])
        marks = fingerprints(edited)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[n] for n in take], pa.int64()),
                pa.array([len(texts[n]) for n in take], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([own[n] for n in take], pa.string()),
                pa.array(marks, pa.string()),
                pa.array([likeness(own[n], m, (leaves[n], leaves_of(m))) for n, m in zip(take, marks, strict=True)], pa.float64()),
                pa.array([likeness(own[n], own[n + 1], (leaves[n], leaves[n + 1])) for n in take], pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )
        # the last row waits for its next, unless it only was one
        carried = ([], [], []) if halo and halo[-1] else (ranges[-1:], ids[-1:], texts[-1:])


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per row: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text ends in the beginning of the next document's, by ascending id; rows without an id come last, and rows of
    one id, in the order of a hash of their text. A null text is empty; an empty text has a fingerprint, of one empty leaf; a
    table of one row is its own next; an empty table gives no rows; more columns do not matter.
    """
    in_small_batches(docs.sparkSession)
    return with_next(docs).select("range", "halo", "doc_id", "text").mapInArrow(_compared, RESULT)

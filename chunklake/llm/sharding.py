"""Shards of equal bytes by histogram sort.

Rows are ordered by a key that hashes the text, then the row: equal texts lie together, yet a group of copies larger than
a shard can be cut. The bytes below candidate boundaries are counted exactly, only intervals that still hold a splitter
are probed again, 4096 times finer, and once every splitter is known to tolerance all rows are exchanged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import kept, private, text_of

#: Bits by which each round refines an interval.
ROUND_BITS = 12
#: An interval is fine enough once it holds this share of a shard's bytes.
TOLERANCE = 0.001
#: The key has two words of 60 bits: text, then row.
WORD_BITS = 60
#: Parts of a shard that are numbered apart: so many key ranges of the whole, times so many lots of rows.
RANGES, LOTS = 4096, 16


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def _prefix(key: tuple[str, str], bits: int) -> Column:
    """The first bits of the two-word key: the first word's as a number, or the rest of the second word's."""
    first, second = key
    if bits <= WORD_BITS:
        return F.shiftright(first, WORD_BITS - bits)
    return F.shiftright(second, 2 * WORD_BITS - bits)


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """The keys at which shards 1, 2, ... begin. ``keys`` has ``k1``, ``k2`` and ``bytes``.

    Only histograms reach the driver: 4096 counts for the whole, then for each splitter's interval.
    """
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    wanted = [(j, total * j / shards) for j in range(1, shards)]
    found: dict[int, tuple[int, int]] = {}
    # an interval: the value of the first word so far, of the second so far, bytes below it -> splitters within
    open_intervals: dict[tuple[int, int], tuple[int, list[tuple[int, float]]]] = {(0, 0): (0, wanted)}
    bits = 0
    while open_intervals and total:
        finer = bits + ROUND_BITS
        rows = keys
        if bits:
            places = [F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in open_intervals]
            first = _prefix(("k1", "k2"), min(bits, WORD_BITS))
            second = F.lit(0).cast("long") if bits <= WORD_BITS else _prefix(("k1", "k2"), bits)
            rows = rows.filter(F.struct(first.alias("a"), second.alias("b")).isin(places))
        first = _prefix(("k1", "k2"), min(finer, WORD_BITS)).alias("a")
        second = (F.lit(0).cast("long") if finer <= WORD_BITS else _prefix(("k1", "k2"), finer)).alias("b")
        counts: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
        for a, b, n, held in rows.groupBy(first, second).agg(F.sum("bytes"), F.count("*")).collect():
            parent = (a >> ROUND_BITS, 0) if finer <= WORD_BITS else (a, b >> ROUND_BITS)
            counts.setdefault(parent, []).append((a, b, n, held))
        following: dict[tuple[int, int], tuple[int, list[tuple[int, float]]]] = {}
        for place, (below, inside) in open_intervals.items():
            inside = list(inside)
            for a, b, n, held in sorted(counts.get(place, [])):
                here = [w for w in inside if w[1] <= below + n]
                inside = inside[len(here) :]
                for j, goal in here:
                    # the nearer boundary, once it is near enough or no row lies between the two
                    low, high = goal - below, below + n - goal
                    if min(low, high) <= tolerance * total / shards or held == 1 or finer >= 2 * WORD_BITS:
                        edge = (a, b) if low <= high else _after(a, b, finer)
                        found[j] = _at_full_length(edge, finer)
                    else:
                        following.setdefault((a, b), (below, []))[1].append((j, goal))
                below += n
        open_intervals, bits = following, finer
    return [found[j] for j in sorted(found)]


def _after(a: int, b: int, bits: int) -> tuple[int, int]:
    if bits <= WORD_BITS:
        return a + 1, b
    return (a, b + 1) if b + 1 < 1 << (bits - WORD_BITS) else (a + 1, 0)


def _at_full_length(edge: tuple[int, int], bits: int) -> tuple[int, int]:
    a, b = edge
    return (a << max(0, WORD_BITS - bits), b << max(0, min(WORD_BITS, 2 * WORD_BITS - bits)) if bits > WORD_BITS else 0)


def shard_documents(docs: DataFrame, shards: int = 40, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    Law ``bytes``: sizes of shards differ by the tolerance and one row. ``size`` is the UTF-8 bytes of the text plus 16,
    a null text has none; ``slot`` numbers a shard's rows from 0 without gaps; ``grown_shard`` is null under this law.
    A null text or id is a value like others, an empty table gives no rows, rows alike in all columns stay together, and
    columns of the input named as new ones are replaced.
    """
    new = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    docs = docs.select(*(c for c in docs.columns if c.lower() not in new))
    k1, k2, part, lot, before, rank = private(docs, "k1", "k2", "part", "lot", "before", "rank")
    mask = F.lit((1 << WORD_BITS) - 1)
    keyed = docs.withColumns(
        {
            k1: F.xxhash64(text_of()).bitwiseAND(mask),
            k2: F.xxhash64(F.lit("row"), *(F.col(f"`{c}`") for c in docs.columns if c != "text"), text_of()).bitwiseAND(mask),
            "size": row_bytes(F.col("text")),
            "text_crc32": F.crc32(text_of().cast("binary")).cast("long"),
        }
    )
    light = kept(keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col("size").alias("bytes")), "shard-keys")
    cuts = splitters(light, shards, tolerance)

    def placed(first: str, second: str) -> tuple[Column, Column, Column]:
        shard = sum(((F.col(first) > a) | ((F.col(first) == a) & (F.col(second) >= b))).cast("int") for a, b in cuts) if cuts else F.lit(0)
        return shard, F.shiftright(first, WORD_BITS - 12).cast("int"), F.col(second).bitwiseAND(F.lit(LOTS - 1)).cast("int")

    shard, in_range, in_lot = placed("k1", "k2")
    counts = light.groupBy(shard.alias("shard"), in_range.alias(part), in_lot.alias(lot)).agg(F.count("*").alias("n"))
    order = "PARTITION BY shard ORDER BY {p}, {q} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING".format(p=part, q=lot)
    offsets = counts.select("shard", part, lot, F.coalesce(F.expr(f"sum(n) OVER ({order})"), F.lit(0)).cast("long").alias(before))
    shard, in_range, in_lot = placed(k1, k2)
    numbered = keyed.withColumns({"shard": shard, part: in_range, lot: in_lot}).withColumn(
        rank, F.expr(f"row_number() OVER (PARTITION BY shard, {part}, {lot} ORDER BY {k1}, {k2})")
    )
    return numbered.join(offsets, ["shard", part, lot]).select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.col("size").cast("long").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col(before) + F.col(rank) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

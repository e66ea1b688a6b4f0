"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash. A copy's virtual finish time is its source's words up to its end, divided
by the source's target; a second round over a source continues its count. All copies are range-sorted by that time and the
queue ends when the total budget is spent, which is time 1 for every source. The report cuts a copy in service then at the
word; the mixed documents hold it whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import kept, private, text_of

#: Weights of the sources in order of their names, repeating; null comes last.
WEIGHTS = (5, 2, 1)
#: The mix holds this share of all words, and no source more than this many times its own.
BUDGET, MOST = 1.5, 2
_SPACE = r"\x20\x09-\x0D"


def words(text: Column) -> Column:
    """The number of runs without white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{_SPACE}]+")), F.lit(0)).cast("long")


def targets(light: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """One row per source: ``source``, ``source_size`` and ``target`` words. ``light`` has ``source`` and ``size``.

    The level is where the targets, none above its cap, spend the budget. The windows run over one row per source.
    """
    sizes = light.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.expr("row_number() OVER (ORDER BY source NULLS LAST)")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight)
    caps = ranked.withColumn("cap", F.col("source_size") * float(MOST)).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = "ORDER BY ratio, source NULLS LAST ROWS BETWEEN"
    full = caps.withColumns(
        {
            "spent": F.coalesce(F.expr(f"sum(cap) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING)"), F.lit(0.0)),
            "left": F.expr(f"sum(weight) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING)"),
            "total": F.expr("sum(source_size) OVER ()"),
        }
    ).withColumn("level", (F.col("total") * budget - F.col("spent")) / F.col("left"))
    # levels fall from the first source that lies below its cap; that first one holds
    level = F.expr("max(CASE WHEN level <= ratio THEN level END) OVER ()")
    held = full.withColumn("held", level)
    return held.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("held") * F.col("weight"), F.col("cap"))).alias("target"))


def keys(docs: DataFrame) -> dict[str, Column]:
    """What the queue needs of a row: its words and its place in the shuffle."""
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_of())
    return {"size": words(F.col("text")), "shuffled": F.md5(name.cast("binary"))}


def queue(rows: DataFrame, light: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """``rows`` with ``source_size``, ``target``, ``before`` (its source's words ahead of it) and ``first``, ``second``.

    The last two are the words taken in the two rounds; ``whole_first`` and ``whole_second`` tell whether whole copies are, if
    none may be cut. ``light`` has ``source``, ``size`` and ``shuffled`` of the same rows.
    Words ahead are summed per source and 4096th of the shuffle, then within: no window holds a source.
    """
    lot, ahead, ties, alike = private(rows, "lot", "ahead", "ties", "alike")
    goals = targets(light, weights, budget)
    lots = light.groupBy("source", F.substring("shuffled", 1, 3).alias(lot)).agg(F.sum("size").alias("n"))
    earlier = f"sum(n) OVER (PARTITION BY source ORDER BY {lot} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    lots = lots.select("source", lot, F.coalesce(F.expr(earlier), F.lit(0)).alias(ahead))
    ahead_of = lots.alias("o").join(goals.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source")))
    ahead_of = ahead_of.select(F.col("o.source").alias("of_source"), F.col(lot).alias("of_lot"), ahead, "source_size", "target")
    rows = rows.withColumn(lot, F.substring("shuffled", 1, 3))
    placed = rows.withColumns(
        {
            ties: F.expr(f"sum(size) OVER (PARTITION BY source, {lot}, shuffled)"),
            alike: F.expr(f"count(*) OVER (PARTITION BY source, {lot}, shuffled)"),
            "before": F.expr(f"sum(size) OVER (PARTITION BY source, {lot} ORDER BY shuffled)"),
        }
    ).join(ahead_of, F.col("source").eqNullSafe(F.col("of_source")) & (F.col(lot) == F.col("of_lot")))
    placed = placed.withColumn("before", F.col("before") - F.col(ties) + F.col(ahead))

    def taken(start: Column) -> Column:
        # rows alike in id and text share what the queue has for them
        room = F.floor(F.col("target")) - start
        return F.floor(F.greatest(F.lit(0), F.least(F.col(ties), room)) / F.col(alike)).cast("long")

    def whole(start: Column) -> Column:
        # the border falls behind the middle of what stands there
        return 2 * start + F.col(ties) <= 2 * F.col("target")

    rounds = {"first": F.col("before"), "second": F.col("before") + F.col("source_size")}
    columns = {name: taken(start) for name, start in rounds.items()} | {f"whole_{name}": whole(start) for name, start in rounds.items()}
    return placed.withColumns(columns).drop(lot, ahead, ties, alike, "of_source", "of_lot")


def finish(taken: str, round_before: Column) -> Column:
    """Virtual finish time of a copy: words of its source up to its end over the target."""
    return F.when(F.col("target") > 0, (round_before + F.col(taken)) / F.col("target")).otherwise(F.lit(0.0))


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """Per document, in the order of its first copy: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``finish``.

    A null text has no words, a null source is a source of its own, the last; a document without words is taken with 0;
    rows alike in id and text share their words evenly; an empty table gives no rows; more columns do not matter.
    """
    light = kept(docs.select("doc_id", "source", *(c.alias(n) for n, c in keys(docs).items())), "mixing")
    report = queue(light, light, weights, budget)
    return report.select(
        "doc_id", "size", "source_size", "target", (F.col("first") + F.col("second")).alias("taken"), finish("first", F.col("before")).alias("finish")
    ).orderBy("finish", "doc_id")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """The mixed rows, as they are in ``docs``, range-sorted by virtual finish time: one row for each copy taken.

    No text is cut. The copy in service at the end of the budget is taken if the budget reaches its middle, so that a source
    comes within half a document of its target; rows alike in id and text, which stand at one place of the queue, are taken
    together. Documents without words, null texts too, stay once, as they cost nothing; an empty table gives no rows. Names of
    the input that clash with those used inside do no harm.
    """
    light = kept(docs.select("source", *(c.alias(n) for n, c in keys(docs).items())), "mixing")
    row = "row"
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), F.col("source"), *(c.alias(n) for n, c in keys(docs).items()))
    queued = queue(whole, light, weights, budget)
    starts = {"first": F.col("before"), "second": F.col("before") + F.col("source_size")}
    copies = [
        F.when((F.col("size") > 0) & F.col(f"whole_{name}") | (F.lit(name == "first") & (F.col("size") == 0)), finish("size", start))
        for name, start in starts.items()
    ]
    each = queued.select(row, F.explode(F.array_compact(F.array(*copies))).alias("finish"))
    return each.orderBy("finish").select(*(F.col(f"{row}.`{c}`").alias(c) for c in docs.columns))

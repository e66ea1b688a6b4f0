"""Personal data: patterns find what is protected, corpus co-occurrence finds terms that would give it away.

How strongly a term reveals an entity is their pointwise mutual information over texts, as a share of the entity's own
information: 1 where the term occurs in the entity's texts only. An entity stands for its value, its kind and, an e-mail, its
domain, so that one of a single text counts along with others of its class. Of the many pairs of a term and an entity some meet
by chance alone: only those count whose joint occurrences chance would not bring about in any of all pairs looked at. Terms of
an entity's texts that pass both are spans too, wherever they stand. All of it is built-in functions on columns.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.llm import bloom
from chunklake.llm.common import kept, private, text_of

KINDS = ("email", "ip", "card", "phone")
#: A term reveals an entity from this share of its information, seen together in so many texts; from the second it is removed.
DISCLOSURE, SUPPORT, REMOVED = 0.75, 2, 0.95
#: The chance that any pair at all is taken for evidence where terms and entities are independent.
CHANCE = 0.01

# The patterns of the contract. Where a match could begin within a run of its first class it would have begun with the run, or
# where the match before ended; saying so, and taking runs whole, keeps the search linear in the text.
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this holds no valid match.
_HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
#: What an e-mail leaves in a text whose terms are read. The other kinds hold no letters.
_GONE = "\uE000"
#: A word with its combining marks that is no part of a name with digits; the second also keeps off what an e-mail cuts short.
_TERM = r"(?<![\p{L}\p{M}\p{N}_])\p{L}[\p{L}\p{M}]*+(?![\p{N}_])"
_WHOLE_TERM = rf"(?<![\p{{L}}\p{{M}}\p{{N}}_{_GONE}])\p{{L}}[\p{{L}}\p{{M}}]*+(?![\p{{N}}_{_GONE}])"
_SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def matches(text: Column, pattern: str, kind: str, valid: Callable[[Column], Column]) -> Column:
    """The valid matches, leftmost and not overlapping, with their places in code points.

    Places come from the lengths of matches and of what lies between them.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value"))
    )
    none = F.lit(None).cast(_SPAN)

    def add(state: Column, step: Column) -> Column:
        start = (state["at"] + step["gap"]).cast("int")
        end = (start + F.length(step["value"])).cast("int")
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), step["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(valid(step["value"]), F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    empty = F.struct(F.lit(0).cast("int").alias("at"), F.coalesce(none, F.array().cast(_SPAN)).alias("spans"))
    return F.aggregate(steps, empty, add, lambda state: state["spans"])


def base_spans(text: Column) -> Column:
    """All base spans of a text that is not null, by kind as listed, then start."""
    nothing = F.array().cast(_SPAN)
    each = [
        F.when(text.rlike(_HINTS[kind]), matches(text, _PATTERNS[kind], kind, lambda value, kind=kind: _valid(kind, value))).otherwise(nothing)
        for kind in KINDS
    ]
    return F.concat(*each)


def _written(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def _entity(span: Column) -> Column:
    """A protected value, however it was written."""
    value = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def _keys(spans: Column) -> Column:
    """What the entities of a text stand for: values, kinds and e-mail domains, each once."""
    domain = lambda s: F.when(s["kind"] == "email", F.concat(F.lit("@"), F.lower(F.substring_index(s["value"], "@", -1))))
    each = F.concat(F.transform(spans, _entity), F.transform(spans, lambda s: s["kind"]), F.transform(spans, domain))
    return F.array_distinct(F.filter(each, lambda key: key.isNotNull()))


def _terms(text: Column) -> Column:
    """The different words of a text, lower-cased, that are not part of a span."""
    rest = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, _PATTERNS["email"], _GONE)).otherwise(text)
    return F.array_distinct(F.regexp_extract_all(F.lower(rest), F.lit(_WHOLE_TERM), F.lit(0)))


def _pairs(held: DataFrame) -> DataFrame:
    """``text_id``, ``key``, ``term`` of each text, for keys of ``SUPPORT`` texts at least; a few others may be among them.

    ``held`` has ``text_id``, ``keys`` and ``terms``.
    """
    shared = held.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT).select("key")
    shared = kept(shared, "shared-keys")
    asked, blocks = bloom.build(shared, "key", shared.count())
    each = bloom.tagged(held.select("text_id", F.explode("keys").alias("key"), "terms"), F.col("key"), asked, blocks, "maybe")
    return each.filter("maybe").select("text_id", "key", F.explode("terms").alias("term"))


def revealing_terms(held: DataFrame, pairs: DataFrame, docs: DataFrame, texts: int) -> DataFrame:
    """``key``, ``term``, ``disclosure`` of the pairs over the threshold. Counts are of different texts, of the whole corpus.

    ``docs`` has ``text_id`` and ``text``. Only words that pass a Bloom filter of the candidate terms are counted, then joined
    exactly. The words of a text that may have copies, as another filter tells, are counted once for the text; those of all
    others are summed up before the shuffle.
    """
    together = kept(pairs.groupBy("key", "term").agg(F.count("*").alias("both")), "together")
    looked_at = max(together.count(), 1)
    together = together.filter(F.col("both") >= SUPPORT)
    candidates = together.select("term").distinct()
    asked, blocks = bloom.build(candidates, "term", candidates.count())
    copied = docs.groupBy("text_id").agg(F.count("*").alias("n")).filter("n > 1").select("text_id")
    copied = kept(copied, "copied-texts")
    asked_texts, text_blocks = bloom.build(copied, "text_id", copied.count())
    rows = bloom.tagged(docs, F.col("text_id"), asked_texts, text_blocks, "copied")
    words = rows.select(F.when(F.col("copied"), F.col("text_id")).alias("copied"), F.explode(_terms(F.col("text"))).alias("term"))
    words = bloom.tagged(words, F.col("term"), asked, blocks, "maybe").filter("maybe")
    counts = words.groupBy("term", "copied").agg(F.count("*").alias("n")).withColumn("n", F.when(F.col("copied").isNull(), F.col("n")).otherwise(1))
    of_term = counts.groupBy("term").agg(F.sum("n").alias("with_term"))
    of_key = held.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("with_key"))
    counted = together.join(of_term, "term").join(of_key, "key")
    pmi = F.ln(F.col("both") * F.lit(float(texts)) / (F.col("with_term") * F.col("with_key")))
    information = F.ln(F.lit(float(texts)) / F.col("with_key"))
    counted = counted.withColumn("disclosure", F.when(information > 0, pmi / information).otherwise(0.0))
    by_chance = log_chance(F.col("both"), F.col("with_term") * F.col("with_key") / F.lit(float(texts)))
    evident = (F.col("disclosure") >= DISCLOSURE) & (by_chance + math.log(looked_at) <= math.log(CHANCE))
    return kept(counted.filter(evident).select("key", "term", "disclosure"), "revealing")


def log_chance(seen: Column, expected: Column) -> Column:
    """The logarithm of a bound (Chernoff's) on the chance of so many joint occurrences, or more, where so many are expected."""
    return F.when(seen > expected, seen - expected - seen * F.ln(seen / expected)).otherwise(0.0)


def _marked(held: DataFrame, pairs: DataFrame, terms: DataFrame) -> DataFrame:
    """``text_id`` and ``terms``, by start, of each text with spans of revealing terms. ``held`` also has ``base`` and ``text``."""
    # most pairs reveal nothing, and are turned away before the shuffle
    pair = F.concat("key", F.lit("\n"), "term")
    asked, blocks = bloom.build(terms.select(pair.alias("pair")), "pair", terms.count())
    passed = bloom.tagged(pairs, pair, asked, blocks, "maybe").filter("maybe").drop("maybe")
    each = passed.join(terms, ["key", "term"]).groupBy("text_id", "term").agg(F.max("disclosure").alias("disclosure"))
    told = each.groupBy("text_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("told"))
    found = matches(F.col("text"), _TERM, "term", lambda value: F.map_contains_key("told", F.lower(value)))
    apart = F.filter(found, lambda w: ~F.exists("base", lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))
    doing = lambda w: F.when(F.element_at("told", F.lower(w["value"])) >= REMOVED, "removed").otherwise("generalised")
    spans = F.transform(apart, lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), w["kind"].alias("kind"), doing(w).alias("doing")))
    return held.join(told, "text_id").select("text_id", spans.alias("terms"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row: ``doc_id``, ``text_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans``, ``found``.

    ``spans`` is all spans as ``kind:start:end``, base ones by kind then start, then ``term`` by start, comma-joined, in code
    points; ``found`` the same as structs with the value's kind or what is done with a term. A null text is empty and has none;
    rows of one text have the same spans and count as one text; an empty table gives no rows; more columns do not matter.
    """
    text = text_of()
    rows = docs.select("doc_id", text.alias("text")).withColumn("text_id", F.unhex(F.md5(F.col("text").cast("binary"))))
    based = rows.withColumn("base", base_spans(F.col("text")))
    light = kept(based.select("doc_id", "text_id", "base", F.when(F.size("base") > 0, F.col("text")).alias("text")), "personal-data")

    texts = light.select("text_id").distinct().count()
    held = light.filter(F.size("base") > 0).groupBy("text_id").agg(F.first("base").alias("base"), F.first("text").alias("text"))
    held = kept(held.select("*", _keys(F.col("base")).alias("keys"), _terms(F.col("text")).alias("terms")), "texts-held")
    pairs = _pairs(held)
    terms = revealing_terms(held, pairs, rows, texts)
    marked = _marked(held.drop("keys", "terms"), pairs, terms)

    light = light.drop("text")
    found = light.filter(F.size("base") > 0).join(marked, "text_id", "left")
    full = found.unionByName(light.filter(F.size("base") == 0), allowMissingColumns=True)
    terms_of = F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,kind:string,doing:string>>"))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), F.upper(s["kind"]).alias("doing")))
    full = full.withColumn("found", F.concat(base, terms_of))
    counts = [_count(kind).alias(f"n_{kind}") for kind in KINDS]
    return full.select(
        "doc_id",
        "text_id",
        *counts,
        F.sha2(F.array_join(_written(F.col("base")), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(_written(F.col("found")), ",").alias("spans"),
        "found",
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows with ``sanitised``: entities replaced by their kind in brackets, terms by ``[TERM]`` or, the strongest, by nothing.

    Where spans overlap the first, then the longest, counts. A null text stays null. A column of that name is replaced.
    """
    docs = docs.select(*(c for c in docs.columns if c.lower() != "sanitised"))
    text_id, ordered, spans_of, id_of = private(docs, "text_id", "ordered", "spans_of", "id_of")
    spans = find_personal_data(docs).select(F.col("text_id").alias(id_of), F.col("found").alias(spans_of))
    spans = spans.filter(F.size(spans_of) > 0).groupBy(id_of).agg(F.first(spans_of).alias(spans_of))
    rows = docs.withColumn(text_id, F.unhex(F.md5(text_of().cast("binary")))).join(spans, F.col(text_id) == F.col(id_of), "left")
    first = F.array_sort(F.coalesce(F.col(spans_of), F.array().cast("array<struct<start:int,end:int,kind:string,doing:string>>")), _by_place)

    def replace(state: Column, s: Column) -> Column:
        mark = F.when(s["doing"] == "removed", "").when(s["kind"] == "term", "[TERM]").otherwise(F.concat(F.lit("["), s["doing"], F.lit("]")))
        out = F.concat(state["out"], F.substring(text_of(), state["at"] + 1, s["start"] - state["at"]), mark)
        return F.when(s["start"] >= state["at"], F.struct(s["end"].alias("at"), out.alias("out"))).otherwise(state)

    begin = F.struct(F.lit(0).cast("int").alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(F.col(ordered), begin, replace, lambda s: F.concat(s["out"], F.substring(text_of(), s["at"] + 1, F.length(text_of()) - s["at"])))
    rows = rows.withColumn(ordered, first).withColumn("sanitised", F.when(F.col("text").isNotNull(), whole))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns), "sanitised")


def _by_place(a: Column, b: Column) -> Column:
    by_start = F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
    return F.coalesce(by_start, F.when(a["end"] > b["end"], -1).when(a["end"] < b["end"], 1).otherwise(0))

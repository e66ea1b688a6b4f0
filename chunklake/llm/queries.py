"""The registered queries: one for each operator, over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.llm.common import table
from chunklake.llm.decontamination import find_leaks
from chunklake.llm.extraction import extract_text
from chunklake.llm.jaccard import duplicate_classes
from chunklake.llm.merkle import fingerprint_documents
from chunklake.llm.mixing import mix_report
from chunklake.llm.packing import pack_documents
from chunklake.llm.pii import find_personal_data
from chunklake.llm.quality import fit_quality, score_quality
from chunklake.llm.runs import find_runs
from chunklake.llm.sharding import shard_documents
from chunklake.llm.toxicity import fit_toxicity, score_toxicity
from chunklake.llm.urls import judge_urls, listed_urls
from chunklake.llm.whitening import whiten


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, folder, "labels"))
    return score_quality(docs, model).select("doc_id", "held_out", "score", "predicted")


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_classes(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links", "n_text_links", "copies")


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return judge_urls(pages.select("page_id", "url"), listed_urls(pages)).select("page_id", "host", "path", "rule", "verdict", "canonical", "in_list")


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return shard_documents(docs, 40).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_report(table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, folder, "labels"))
    return score_toxicity(docs, model).select("doc_id", "held_out", "score", "predicted", "spans")


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(table(spark, folder, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(table(spark, folder, "documents"))


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; of one document in ten, told by the checksum of its id, the words repeat from some word on."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.when(checksum % 10 == 0, F.floor(checksum / 10)).alias("g"))
    rows = rows.withColumn("w", F.when(F.col("g").isNotNull(), F.expr(r"regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0)")))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rows = rows.withColumn("p", F.expr("cast(1 + floor((n - a) / (3 + g % 8)) as int)"))
    again = "flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int)))"
    return rows.select("doc_id", F.expr(f"CASE WHEN n > 0 THEN array_join(concat(slice(w, 1, a), slice({again}, 1, n - a)), ' ') ELSE text END").alias("text"))


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = find_runs(looped(table(spark, folder, "documents")))
    # the greatest length / period by exact products; runs come by start, then period, which settles ties
    best = F.expr(
        "aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>),"
        " (b, r) -> CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)"
    )
    listed = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_url_filters": op3_url_filters,
    "op4_sharding": op4_sharding,
    "op5_mixing": op5_mixing,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_personal_data": op8_personal_data,
    "op9_html_extraction": op9_html_extraction,
    "op10_fingerprints": op10_fingerprints,
    "op11_runs": op11_runs,
    "op12_whitening": op12_whitening,
    "op13_packing": op13_packing,
}

ORACLES: dict[str, str] = {
    "op3_url_filters": r"""
        WITH p AS (
            SELECT page_id, coalesce(url, '') AS url, length(html) AS size,
                   translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path,
                   regexp_extract(coalesce(url, ''), '(?s)\A[^?#]*\?([^#]*)', 1) AS query
            FROM pages),
        q AS (
            SELECT *, regexp_replace(regexp_replace(host, '^www[.]', ''), ':(80|443)?$', '') AS name,
                   array_to_string(list_sort(list_filter(string_split(query, '&'),
                       lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]*|ref)(=|$)'))), '&') AS params
            FROM p),
        c AS (
            SELECT *, CASE WHEN name <> '' THEN name || regexp_replace(path, '/+$', '') || CASE WHEN params <> '' THEN '?' || params ELSE '' END END AS canonical
            FROM q),
        l AS (SELECT DISTINCT canonical FROM c WHERE canonical IS NOT NULL AND size < 3000),
        r(rule, name, start, kind) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
            ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
        f AS (
            SELECT page_id, url, arg_max(rule, length(rule)) AS rule, arg_max(kind, length(rule)) AS kind
            FROM c JOIN r ON (c.host = r.name OR ends_with(c.host, '.' || r.name)) AND starts_with(c.path, r.start)
            GROUP BY page_id, url)
        SELECT c.page_id, host, path, f.rule, coalesce(f.kind, CASE WHEN l.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
               c.canonical, l.canonical IS NOT NULL AS in_list
        FROM c LEFT JOIN l ON c.canonical = l.canonical LEFT JOIN f ON f.page_id = c.page_id AND f.url = c.url
    """,
    "op5_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS shuffled
            FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM d GROUP BY source),
        w AS (SELECT source, source_size, CAST([5, 2, 1][(n - 1) % 3 + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
        r AS (SELECT *, cap / weight AS ratio FROM w),
        l AS (
            SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
                       - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM r),
        t AS (SELECT source, source_size, least(cap, (max(CASE WHEN level <= ratio THEN level END) OVER ()) * weight) AS target FROM l),
        q AS (
            SELECT doc_id, d.source, size, source_size, target, count(*) OVER same AS alike, sum(size) OVER same AS ties,
                   sum(size) OVER (PARTITION BY d.source ORDER BY shuffled) - sum(size) OVER same AS before
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
            WINDOW same AS (PARTITION BY d.source, shuffled)),
        c AS (
            SELECT *, CAST(floor(greatest(0, least(ties, floor(target) - before)) / alike) AS BIGINT) AS first,
                   CAST(floor(greatest(0, least(ties, floor(target) - before - source_size)) / alike) AS BIGINT) AS second
            FROM q)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, first + second AS taken,
               CASE WHEN target > 0 THEN CAST(before + first AS DOUBLE) / target ELSE 0 END AS finish
        FROM c
    """,
}

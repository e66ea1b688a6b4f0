"""URL filters: rules for hosts and paths first, then a list of canonical URLs behind a blocked Bloom filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.llm import bloom
from chunklake.llm.common import private

#: The registered query lists the URLs of thin pages, whose whole markup has fewer characters than this: a URL does not tell.
THIN = 3000
#: (verdict, host, path): a rule fits the host and its subdomains where the path begins with its path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty where there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), _CAPITALS, _SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host and path with the query's own parameters: no scheme, ``www.``, default port, campaign marks, fragment or last slash.

    Null where the URL has no host.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), "^www[.]", ""), ":(80|443)?$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1)
    query = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]*|ref)(=|$)"))), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host/path`` text, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def listed_urls(pages: DataFrame, thin: int = THIN) -> DataFrame:
    """A list of canonical URLs: those of thin pages. Every other spelling of such a URL is listed with it."""
    marked = F.length("html") < thin
    return pages.filter(marked).select(canonical(F.col("url")).alias("listed")).filter("listed IS NOT NULL").distinct()


def judge_urls(pages: DataFrame, listed: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """Each row with ``host``, ``path``, ``rule``, ``verdict``, ``canonical`` and ``in_list``.

    A rule decides; without one a URL whose canonical form is in ``listed`` (one column of that name) is blocked, others are
    allowed. Only URLs that pass the Bloom filter go to the exact join. A null URL, or one without ``://``, has an empty host
    and path, fits no rule and is allowed. Rows alike stay as many as they were; an empty table or list is fine; columns of
    the input named like the new ones are replaced.
    """
    new = ("host", "path", "rule", "verdict", "canonical", "in_list")
    rows = pages.select(*(c for c in pages.columns if c.lower() not in new))
    listed = listed.select("listed").filter("listed IS NOT NULL").distinct()
    (maybe,) = private(rows, "maybe")
    asked, blocks = bloom.build(listed, "listed", listed.count())
    rows = bloom.tagged(rows.withColumn("canonical", canonical(F.col("url"))), F.col("canonical"), asked, blocks, maybe)
    passed = rows.filter(maybe).join(listed.withColumn("in_list", F.lit(True)), F.col("canonical") == F.col("listed"), "left").drop("listed")
    rest = rows.filter(~F.col(maybe)).withColumn("in_list", F.lit(False))
    rows = passed.withColumn("in_list", F.coalesce("in_list", F.lit(False))).unionByName(rest).drop(maybe)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumns(
        {"rule": rule, "verdict": F.coalesce(verdict, F.when(F.col("in_list"), "block").otherwise("allow"))}
    )

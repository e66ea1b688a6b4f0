import random

import pytest

from chunklake.llm import bloom
from chunklake.llm.urls import judge_urls, listed_urls

CASES = [
    ("http://Sub.Example.NET/en/x?utm_source=a#t", "sub.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://example.net/de/x", "example.net", "/de/x", "net/", "block"),
    ("https://example.net", "example.net", "", None, "allow"),
    ("https://notexample.com/de/x", "notexample.com", "/de/x", None, "allow"),
    ("ftp://a.b.org/fr/", "a.b.org", "/fr/", "org/fr/", "allow"),
    ("http://thin.example.com/en/1?ref=x", "thin.example.com", "/en/1", None, "block"),
    ("http://www.thin.example.com:80/en/1/", "www.thin.example.com:80", "/en/1/", None, "block"),
    ("http://thin.example.com/en/1?page=2", "thin.example.com", "/en/1", None, "allow"),
    ("http://good.example.com/en/1", "good.example.com", "/en/1", None, "allow"),
    ("no scheme/net/", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("x://y://z/net", "y:", "//z/net", None, "allow"),
    ("http://ÉX.net/é", "Éx.net", "/é", "net/", "block"),
    ("http://h\n.net/en/\nx", "h\n.net", "/en/\nx", "net/", "block"),
]


def test_rules_then_list(spark):
    html = {"http://thin.example.com/en/1?ref=x": "<p>thin</p>", "https://example.net": None}
    rows = [(n, c[0], 9, 8, html.get(c[0], "<p>" + "long " * 700)) for n, c in enumerate(CASES)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, Host int, w0 int, html string")
    rows = {r["page_id"]: r for r in judge_urls(frame, listed_urls(frame)).collect()}
    assert [tuple(rows[n][c] for c in ("url", "host", "path", "rule", "verdict")) for n in range(len(CASES))] == CASES
    assert {r["w0"] for r in rows.values()} == {8}


@pytest.mark.parametrize("blocks", [1, 4])
def test_false_hits_are_turned_away(spark, monkeypatch, blocks):
    """A filter far too small lets nearly everything pass; the exact join behind it still decides."""
    monkeypatch.setattr(bloom, "MOST_BLOCKS", blocks)
    rng = random.Random(1)
    urls = [f"http://h{rng.randrange(300)}.example.com/en/{rng.randrange(5)}" for _ in range(800)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    listed = spark.createDataFrame([(u[7:],) for u in set(urls[:200])] + [(None,)], "listed string")
    rows = judge_urls(frame, listed).collect()
    assert len(rows) == len(urls)
    assert all((r["verdict"] == "block") == (r["url"] in set(urls[:200])) for r in rows)


def test_the_list_decides_where_no_rule_does(spark):
    """One page of a URL is thin; all other spellings of it, and no other URL, are blocked by filter and join."""
    spelled = ["http://a.example.com/en/{}", "https://www.a.example.com:443/en/{}/", "http://A.example.com/en/{}?utm_source=x#top", "http://a.example.com/en/{}?ref=1"]
    rows = [(4 * n + k, s.format(n), "thin" if k == n % 4 and n % 3 == 0 else "long " * 700) for n in range(60) for k, s in enumerate(spelled)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r["page_id"]: r for r in judge_urls(frame.select("page_id", "url"), listed_urls(frame)).collect()}
    assert all(found[i]["verdict"] == ("block" if i // 4 % 3 == 0 else "allow") and found[i]["rule"] is None for i in found)
    none = judge_urls(frame.select("page_id", "url"), listed_urls(frame.limit(0))).collect()
    assert {r["verdict"] for r in none} == {"allow"}


def test_very_long_urls(spark):
    path = "/".join(["seg"] * 60000)
    url = f"http://h.example.com/{path}?{'&'.join(f'k{n}=v' for n in range(3000))}#{'t' * 50000}"
    frame = spark.createDataFrame([(1, url, "thin"), (2, url.replace("http:", "https:") + "x", "long " * 700), (3, "x" * 200000, None)], "page_id bigint, url string, html string")
    found = {r["page_id"]: r for r in judge_urls(frame.select("page_id", "url"), listed_urls(frame)).collect()}
    assert found[1]["path"] == f"/{path}" and (found[1]["verdict"], found[2]["verdict"], found[3]["verdict"]) == ("block", "block", "allow")


def test_filter_forgets_nothing_and_passes_little(spark):
    keys = spark.range(4000).selectExpr("concat('k', id) AS key")
    asked, blocks = bloom.build(keys, "key", 4000)
    rows = spark.range(8000).selectExpr("concat('k', id) AS key", "id < 4000 AS inside")
    found = bloom.tagged(rows, rows["key"], asked, blocks, "maybe").groupBy("inside", "maybe").count().collect()
    counts = {(r["inside"], r["maybe"]): r["count"] for r in found}
    assert counts[True, True] == 4000 and counts.get((False, True), 0) < 200


def test_empty(spark):
    frame = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert judge_urls(frame, listed_urls(frame)).count() == 0

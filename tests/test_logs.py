import random
import re


import pytest
from pyspark.sql import functions as F

from chunklake import extract_log, filter_json_lines
from chunklake.functions.regex import regex_records, translate
from chunklake.operators.logs import format_records

PATTERN = "^([0-9]+) ([a-z_]+) (.+)$"
CLIP = "1747065600 clip /tmp/clips/sess_001/1747065600.mp4"


def _run(frame, fmt="json", condition=None, fields="ts,type,path", pattern=PATTERN):
    records, rejects = extract_log(frame, pattern, fields, condition)
    out = [row.value for row in format_records(records, fields, fmt).collect()]
    return out, [row.line for row in rejects.collect()]


def test_golden_records(lines):
    json = '{"ts":"1747065600","type":"clip","path":"/tmp/clips/sess_001/1747065600.mp4"}'
    csv = "1747065600,clip,/tmp/clips/sess_001/1747065600.mp4"
    frame = lines(f"  {CLIP}  ", "1747065601 heartbeat /tmp/heartbeat", "bad line")
    assert _run(frame, "json", "type=clip") == ([json], ["bad line"])
    assert _run(frame, "csv", "type=clip") == ([csv], ["bad line"])
    assert _run(frame, "json", "nokey=x") == ([], ["bad line"])
    assert len(_run(frame)[0]) == 2


def test_quoting(lines):
    frame = lines('1747065600 clip alpha,"beta"', '1 clip path="C:\\tmp\\clip"', "2 clip plain  inner\tblanks")
    assert _run(frame, "csv")[0] == [
        '1747065600,clip,"alpha,""beta"""',
        '1,clip,"path=""C:\\tmp\\clip"""',
        "2,clip,plain  inner\tblanks",
    ]
    assert _run(frame, "json")[0][1] == '{"ts":"1","type":"clip","path":"path=\\"C:\\\\tmp\\\\clip\\""}'


def test_csv_line_ends_and_empty_values(spark):
    frame = spark.createDataFrame([("a\nb", "", " x ")], "a string, b string, c string")
    assert format_records(frame, "a,b,c", "csv").first()[0] == '"a\nb",, x '


def test_fewer_and_more_fields_than_groups(lines):
    assert _run(lines("1 clip p"), fields="ts,type")[0] == ['{"ts":"1","type":"clip"}']
    with pytest.raises(ValueError):
        extract_log(lines("1 clip p"), "^(.)", "a,b")
    records, rejects = extract_log(lines("1 clip p"), "^(.)", "a,b", strict=False)
    assert records.count() == 0 and rejects.count() == 1


def test_group_that_takes_no_part_refuses_the_line(lines):
    out, refused = _run(lines("b", "ab", "c"), fields="x,y", pattern="^(a)?(b)")
    assert out == ['{"x":"a","y":"b"}'] and refused == ["b", "c"]
    # an empty group is not a missing one
    assert _run(lines("b"), fields="x,y", pattern="^(a*)(b)")[0] == ['{"x":"","y":"b"}']


@pytest.mark.parametrize(
    "pattern, text, expected",
    [
        ("^([[:alpha:]]+)", "abc1", "abc"),
        ("([[:digit:]]{2})", "a123", "12"),
        (r"([^]]+)\]", "ab]c", "ab"),
        (r"([\.]+)", r"a\.b", r"\."),
        ("([[:space:]x-]+)b", "a x-b", " x-"),
        ("a.([^&&]+)", "a\rb&", "b"),
    ],
)
def test_posix_brackets(lines, pattern, text, expected):
    assert [row.a for row in extract_log(lines(text), pattern, "a")[0].collect()] == [expected]
    assert re.search("(?s)" + translate(pattern).pattern, text)[1] == expected


@pytest.mark.parametrize(
    "pattern, expected",
    [
        ("^(GET|POST) (.+)$", set()),
        ("^(a)?(b)", {1}),
        ("((a)|b)(c)", {2}),
        ("(a)|(b)", {1, 2}),
        ("((a)(b|c))*(d)", {1, 2, 3}),
        ("(a){0,2}(b){1,2}(c){2}", {1}),
        ("(?:(a)|x)(b)", {1}),
        (r"(a\|b[|?(]+)\)?(c)", set()),
        ("(s?)(t*)", set()),
    ],
)
def test_which_groups_may_take_no_part(pattern, expected):
    assert translate(pattern).skippable == expected


def test_alternation_inside_a_group_stays_native(lines):
    records, _ = extract_log(lines("GET /a", "POST /b", "PUT /c"), "^(GET|POST) (.+)$", "verb,path")
    assert "Python" not in records._jdf.queryExecution().executedPlan().toString()
    assert [tuple(row) for row in records.collect()] == [("GET", "/a"), ("POST", "/b")]


def test_bad_patterns(lines):
    for pattern in ("(", "[a", "[[:nope:]]", "*"):
        with pytest.raises(ValueError):
            extract_log(lines("x"), pattern, "a")


def test_json_filter(lines):
    clip = '{"type":"clip","session_id":"sess_001","ts":1747065600}'
    frame = lines(f"  {clip}  ", '{"type":"heartbeat"}', "not json", '{"id":1}', "{", "{}")
    kept, rejects = filter_json_lines(frame, "type=clip")
    assert [row.line for row in kept.collect()] == [clip]
    assert [(row.line_id, row.reason) for row in rejects.collect()] == [(2, "malformed JSON line"), (4, "malformed JSON line")]
    assert filter_json_lines(frame, "id=1")[0].count() == 0
    assert filter_json_lines(frame, "id=1", scalars=True)[0].count() == 1
    assert filter_json_lines(frame)[0].count() == 4
    with pytest.raises(ValueError):
        filter_json_lines(frame, "type")


def test_filters_stay_native_and_reach_the_scan(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    records, _ = extract_log(pages, "^(https?)://([^/]+)", "scheme,host", line_col="url", keep=("page_id",))
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "html" not in plan
    assert records.where(F.col("scheme") == "https").count() > 0


def test_required_groups_equal_a_search_that_looks_at_them(spark):
    """Random patterns with optional, repeated, nested and alternative groups, against a search in Python.

    Repeated groups that hold groups or may be empty are left out: Java keeps what a given-up repetition captured there.
    """
    rng = random.Random(12)

    def pattern(depth):
        kind = rng.randrange(6 if depth else 2)
        if kind < 2:
            return rng.choice(["a", "b", "c", "[ab]", "[^a]", "a*", "b?", "."])
        if kind == 2:
            return pattern(depth - 1) + pattern(depth - 1)
        inner = pattern(depth - 1) + ("|" + pattern(depth - 1) if kind == 3 else "")
        return f"({inner})" + rng.choice(["", "", "?"] if "(" in inner or re.fullmatch(inner, "") else ["", "?", "*", "+"])

    lines = ["".join(rng.choice("abc") for _ in range(rng.randrange(7))) for _ in range(60)] + ["", "a\nb"]
    frame = spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).cache()
    tried = 0
    while tried < 60:
        text = pattern(4)
        groups = re.compile(text).groups
        if not groups or not translate(text).skippable:
            continue
        tried += 1
        records, refused = regex_records(frame, F.col("line"), text, [f"g{i}" for i in range(groups)], ("line",))
        expected = []
        for line in lines:
            match = re.search(f"(?s){text}", line)
            if match and None not in match.groups():
                expected.append((line, *match.groups()))
        assert sorted(map(tuple, records.collect())) == sorted(expected), text
        assert refused.count() == len(lines) - len(expected)
    assert "Python" not in records._jdf.queryExecution().toString()

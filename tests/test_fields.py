import pytest

from chunklake.functions import fields, options
from chunklake.operators.rejects import count_rejects
from chunklake.operators.sidecar import parse_sidecar, tag_sidecar

LINES = [
    # line, string(k), scalar(k), integer(k)
    ('{"k":"v"}', "v", "v", None),
    ('{"k" \t:\t "v" }', "v", "v", None),
    ('{"k":12abc}', None, "12abc", 12),
    ('{"k":1.5}', None, "1.5", 1),
    ('{"k":"12"}', "12", "12", None),
    ('{"k":-7,"x":1}', None, "-7", -7),
    ('{"k":+7 }', None, "+7", 7),
    ('{"k":99999999999999999999}', None, "99999999999999999999", None),
    ('{"a":{"k":"in"},"k":"out"}', "in", "in", None),
    ('{"a":"k","k":"v"}', None, None, None),
    ('{"k":"a\\nb\\u0041\\"c\\\\"}', 'anbu0041"c\\', 'anbu0041"c\\', None),
    ('{"k":"open', None, None, None),
    ('{"k":"esc\\"', None, None, None),
    ('{"k":""}', "", "", None),
    ('{"k":}', None, None, None),
    ('{"k":[1,2]}', None, "[1", None),
    ('{"k":tr"ue"}', None, 'tr"ue"', None),
    ('{"j":1}', None, None, None),
    ('{"k":"line\none"}', "line\none", "line\none", None),
    ("", None, None, None),
]


def test_textual_lookup(spark):
    frame = spark.createDataFrame([(i, row[0]) for i, row in enumerate(LINES)], "i int, line string")
    found = frame.select(
        "i", fields.field_string("line", "k"), fields.field_scalar("line", "k"), fields.field_integer("line", "k")
    )
    assert {row[0]: tuple(row)[1:] for row in found.collect()} == {i: row[1:] for i, row in enumerate(LINES)}


def test_equality_is_that_of_the_lookup(spark):
    frame = spark.createDataFrame([(i, row[0]) for i, row in enumerate(LINES)], "i int, line string")
    for value in ("v", "12", "1.5", "anbu0041\"c\\", '"12"', "12abc", "in"):
        for scalars, lookup in ((False, fields.field_string), (True, fields.field_scalar)):
            wanted = frame.where(lookup("line", "k") == value).select("i").collect()
            assert frame.where(fields.field_equals("line", "k", value, scalars)).select("i").collect() == wanted


def test_long_values_and_odd_keys(spark):
    text = "a\\\"b" * 50_000
    frame = spark.createDataFrame([('{"a.b[$":"' + text + '"}',)], "line string")
    assert frame.select(fields.field_string("line", "a.b[$")).first()[0] == 'a"b' * 50_000


META = [
    # line, textual (kind, sequence, offset, length, ts_ms) or None, same in json mode
    ('{"kind":"data","sequence":1,"offset":0,"length":4,"ts_ms":-5}', ("data", 1, 0, 4, -5), True),
    ('{"kind":"data","seq":1,"offset":0,"length":4,"ts_ms":0}', None, True),
    ('{"kind":"json","sequence":1,"offset":0,"length":4,"ts_ms":0}', ("json", 1, 0, 4, 0), True),
    ('{"kind":"data","sequence":"1","offset":0,"length":4,"ts_ms":0}', None, True),
    ('{"kind":"data","sequence":-1,"offset":0,"length":4,"ts_ms":0}', None, True),
    ('{"kind":"data","sequence":9223372036854775808,"offset":0,"length":4,"ts_ms":0}', None, True),
    ('{"kind":"data","sequence":1x,"offset":0,"length":4.5,"ts_ms":0}', ("data", 1, 0, 4, 0), False),
    ('{"kind":"a-kind-of-more-than-15","sequence":1,"offset":0,"length":4,"ts_ms":0}', ("a-kind-of-more-than-15", 1, 0, 4, 0), True),
    ('{"kind":5,"sequence":1,"offset":0,"length":4,"ts_ms":0}', None, False),
    ("not json", None, True),
]


@pytest.mark.parametrize("mode", ["textual", "json"])
def test_meta_records(spark, lines, mode):
    found = tag_sidecar(lines(*[row[0] for row in META]), mode).select("line_id", "meta").collect()
    for row in found:
        line, expected, same = META[row.line_id]
        if mode == "textual" or same:
            assert (tuple(row.meta) if row.meta else None) == expected, line


def test_one_expression_equals_the_steps(lines):
    tagged = tag_sidecar(lines(*[row[0] for row in META]))
    assert tagged.where(~fields.parse_meta("line").eqNullSafe(tagged["meta"])).count() == 0


def test_rejects_and_counts(lines):
    texts = [row[0] for row in META] + ["", ""]
    records, rejects = parse_sidecar(lines(*texts))
    assert records.count() == 2
    reasons = {row.line_id: row.reason for row in rejects.collect()}
    assert reasons[2] == "not a data record" and reasons[1] == "malformed record"
    assert len(reasons) + records.count() == len(META)
    tagged, seen = count_rejects(tag_sidecar(lines(*[row[0] for row in META])))
    tagged.collect()
    assert seen.get == {"lines": 10, "rejects": 8}


def test_small_expressions(spark):
    frame = spark.createDataFrame([("  {x} ", 100, "/a/.pipeline_end")], "line string, at long, path string")
    row = frame.select(
        fields.looks_like_object("line"),
        fields.looks_like_object(fields.F.lit("{")),
        fields.is_live("at", 100),
        fields.is_live("at", 99),
        fields.is_live(fields.F.lit(0), 10**9),
        fields.expire_at(0, 50),
        fields.expire_at(7, 50),
        fields.is_end_marker("path"),
        fields.is_end_marker(fields.F.lit("x.pipeline_end")),
        fields.is_end_marker(fields.F.lit(".pipeline_end")),
        fields.clip_ts(fields.F.lit(-1500)),
    ).first()
    assert tuple(row) == (True, False, False, True, True, 0, 57, True, False, True, -1)


def test_options():
    assert options.check_filter("a=b=c") == ("a", "b=c")
    assert options.check_fields("a,b") == ["a", "b"]
    assert options.check_ttl(" 5") == 5 and options.check_ttl("+5") == 5 and options.check_ttl(0) == 0
    assert options.seconds_to_ms(2.5) == 2500
    for check, bad in [
        (options.check_filter, ["type", "=x", "x=", ""]),
        (options.check_fields, ["", "a,,b", "a,", ",a", "a,a"]),
        (options.check_ttl, ["-1", "5x", "", "1.5", -1, True]),
        (options.check_format, ["xml", ""]),
    ]:
        for value in bad:
            with pytest.raises(ValueError):
                check(value)
    for bad in [("p", None, None), (None, "a", None), (None, None, "csv"), ("p", "a", "xml")]:
        with pytest.raises(ValueError):
            options.check_log_options(*bad)

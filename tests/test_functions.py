"""Golden rows for the column expressions, and a property test of the CSV rules."""

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventmart.functions import times
from eventmart.functions import values as v
from eventmart.functions.csvtext import split_fields
from eventmart.functions.identity import numeric_user_id


def column(spark, texts, expr):
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, x STRING")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


# -- CSV ------------------------------------------------------------------------------------
CSV = {
    "": [""],
    "a,b": ["a", "b"],
    ",": ["", ""],
    " a , b\t": ["a", "b"],
    '"a,b",c': ["a,b", "c"],
    '"a ""b"" c"': ['a "b" c'],
    'x"y,z"w,q': ["xy,zw", "q"],
    '"open, to the end': ["open, to the end"],
    '""': [""],
    '""""': ['"'],
    '"" ""': [""],
    '" a ",b': ["a", "b"],
    'a,"b",': ["a", "b", ""],
    "﻿ts, x　": ["ts", "x"],
    '"é, ü", ö ': ["é, ü", "ö"],
    'a"': ["a"],
}


def test_csv_lines(spark):
    assert column(spark, list(CSV), split_fields) == list(CSV.values())


def test_long_quoted_field_needs_no_stack(spark):
    text = '"' + "x" * 200_000 + '""' * 50_000 + '",' + "y" * 1000
    (fields,) = column(spark, [text], split_fields)
    assert fields == ["x" * 200_000 + '"' * 50_000, "y" * 1000]


def by_rule(line):
    """The quote rule, character by character."""
    out, field, inside, i = [], "", False, 0
    while i < len(line):
        c = line[i]
        if c == '"' and inside and line[i + 1 : i + 2] == '"':
            field, i = field + '"', i + 1
        elif c == '"':
            inside = not inside
        elif c == "," and not inside:
            out.append(field)
            field = ""
        else:
            field += c
        i += 1
    return [f.strip(v.WHITESPACE) for f in [*out, field]]


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='ab," \té ', max_size=25), min_size=200, max_size=300))
def test_csv_property(spark, lines):
    assert column(spark, lines, split_fields) == [by_rule(x) for x in lines]


# -- times ----------------------------------------------------------------------------------
def resolve(spark, texts, mode="reference"):
    return [tuple(r) for r in column(spark, texts, lambda c: times.resolve_time(c, mode))]


def test_resolve_time_reference(spark):
    got = resolve(
        spark,
        [
            "20241101123456",  # 14 digits
            "20241301000000",  # 14 digits, month 13: taken, cannot be stored
            "946684799",  # seconds
            "946684800",  # milliseconds from here on
            "1730419200000",
            "2024-11-01 10:00",  # the number 2024
            " 12.9abc",
            "-1.5",
            "Jan 5, 2024",
            "Fri Jan 05 2024 10:11:12 GMT+0000 (UTC)",
            "Friday, January 5, 2024 10:11:12",
            "Fri, 05 Jan 2024 01:02:03 GMT",
            "5 Jan 2024",  # the number 5
            "soon",
            "9e15",  # no time at all
            "300000000000000",  # year 11476: taken, cannot be stored
            ".5",
        ],
    )
    assert got == [
        (True, datetime(2024, 11, 1, 12, 34, 56)),
        (True, None),
        (True, datetime(1999, 12, 31, 23, 59, 59)),
        (True, datetime(1970, 1, 11, 22, 58, 4)),
        (True, datetime(2024, 11, 1)),
        (True, datetime(1970, 1, 1, 0, 33, 44)),
        (True, datetime(1970, 1, 1, 0, 0, 12)),
        (True, datetime(1969, 12, 31, 23, 59, 58)),
        (True, datetime(2024, 1, 5)),
        (True, datetime(2024, 1, 5, 10, 11, 12)),
        (True, datetime(2024, 1, 5, 10, 11, 12)),
        (True, datetime(2024, 1, 5, 1, 2, 3)),
        (True, datetime(1970, 1, 1, 0, 0, 5)),
        (False, None),
        (False, None),
        (True, None),
        (True, datetime(1970, 1, 1)),
    ]


def test_resolve_time_corrected(spark):
    got = resolve(spark, ["2024-11-01 10:00:00", "1730419200", "1730419200000"], "corrected")
    assert got == [
        (True, datetime(2024, 11, 1, 10)),
        (True, datetime(2024, 11, 1)),
        (True, datetime(2024, 11, 1)),
    ]


def test_first_time(spark):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    df = spark.createDataFrame(
        [(0, ["soon", "20240101000000"]), (1, []), (2, ["20241301000000", "20240101000000"]), (3, ["x"])],
        "i INT, c ARRAY<STRING>",
    )
    got = df.select("i", times.first_time(F.col("c"), as_of).alias("t")).orderBy("i").collect()
    assert [r["t"] for r in got] == [datetime(2024, 1, 1), datetime(2024, 1, 31), None, datetime(2024, 1, 31)]


def test_strict_forms(spark):
    texts = ["2024-02-30", "2024-02-29 10:00:00.5", "2024-02-29T10:00:00", "2024/02/29", ""]
    assert column(spark, texts, times.strict_date) == [None, date(2024, 2, 29), date(2024, 2, 29), None, None]
    want = [None, datetime(2024, 2, 29, 10), None, None, None]
    assert column(spark, texts, times.strict_timestamp) == want
    assert column(spark, ["2020-01-15 14:57:24.898", ""], times.passthrough_timestamp) == [
        datetime(2020, 1, 15, 14, 57, 24, 898000),
        None,
    ]


def test_auto_timestamp(spark):
    got = column(
        spark,
        ["2024-01-02T03:04:05", "2024-1-2", "20240102030405", "1/2/2024 03:04", "Jan 2, 2024", "2024", "x"],
        times.auto_timestamp,
    )
    assert got == [
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2),
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2, 3, 4),
        datetime(2024, 1, 2),
        None,
        None,
    ]
    assert column(spark, ["20240102", "2024-01-02", "no"], times.auto_date) == [
        date(2024, 1, 2),
        date(2024, 1, 2),
        None,
    ]


# -- values ---------------------------------------------------------------------------------
def test_truncate_bytes(spark):
    texts = ["abcdef", "aéééé", "a€€", "a😀😀", None]
    got = column(spark, texts, lambda c: F.expr(v.truncate_bytes_sql("x", 5)))
    assert got == ["abcde", "aéé", "a€", "a😀", None]


def test_blank_as_null(spark):
    texts = [" \t ", "", " a "]
    assert column(spark, texts, lambda c: F.expr(v.blank_as_null_sql("x"))) == [None, None, " a "]


def test_blanks_are_not_searched_for_beside_visible_ascii(spark):
    texts = ["!", "~", "a", " a", "a ", "\x7f", "\x1fa", "a\u3000", "\u00e9", "\ufeffx", "a b", " ", "", None]
    blanks = v.WHITESPACE
    assert column(spark, texts, v.trim_all) == [t if t is None else t.strip(blanks) for t in texts]
    kept = [t if t is not None and t.strip(blanks) else None for t in texts]
    assert column(spark, texts, lambda c: F.expr(v.blank_as_null_sql("x"))) == kept
    plan = spark.range(1).select(v.trim_all(F.lit("").substr(F.col("id").cast("int"), F.lit(1))))._jdf.queryExecution().analyzed().toString()
    assert plan.index(">=") < plan.index("trim")


def test_months_and_times_are_worked_out_once(spark):
    texts = [f"{m.title()} 5, 2024" for m in times.MONTHS] + ["5 january 2024", "Sept 5, 2024", "nosuch 5, 2024"]
    months = [t and t.month for t in column(spark, texts, times.parse_worded)]
    assert months == [*range(1, 13), 1, 9, None]
    df = spark.createDataFrame([("x",)], "x STRING").select(times.first_time(F.array("x"), F.lit("2024-01-01").cast("timestamp")).alias("ts"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1


def test_replace_invalid_bytes(spark):
    hexes = ["61FF62", "E282", "C3A9", "61E28262", "F0808080", "EDA080", ""]
    got = column(spark, hexes, lambda c: v.replace_invalid_bytes(F.unhex(c).cast("string")))
    assert got == ["a?b", "??", "é", "a??b", "????", "???", ""]


def test_variant_coercion(spark):
    texts = ['{"a": 1}', "[1,2]", "plain", '"q"', "12", "true", "", None]
    got = column(spark, texts, lambda c: v.json_text(v.as_variant(c)))
    assert got == ['{"a":1}', "[1,2]", '"plain"', '"q"', "12", "true", None, None]
    docs = ['"{\\"a\\":1}"', '"text"', "null", '""', "[1]"]
    got = column(spark, docs, lambda c: v.json_text(v.normalize_variant(F.parse_json(c))))
    assert got == ['{"a":1}', '"text"', None, None, "[1]"]


def test_column_names(spark):
    got = column(spark, ["Extra Col", "1st", "a--b", "$", "", "__", "É"], v.safe_column_name)
    assert got == ["extra_col", "_1st", "a_b", None, None, None, None]


def test_file_names_and_urls(spark):
    names = ["a/b/17-18-x.csv", "17.csv", "x-9y-z", "-5-6", " 7-8"]
    first = column(spark, names, lambda c: v.file_name_numbers(c)[0])
    second = column(spark, names, lambda c: v.file_name_numbers(c)[1])
    assert first == [17, 17, None, None, 7]
    assert second == [18, None, 9, 5, 8]
    urls = ["s3://b/k/x", "gs://b/", "nothing", "file://h/p"]
    assert column(spark, urls, lambda c: v.url_parts(c)[0]) == ["b", None, None, "h"]
    assert column(spark, urls, lambda c: v.url_parts(c)[1]) == ["k/x", None, None, "p"]


def test_numeric_user_id(spark):
    docs = [
        '{"profile":{"identity":"12"}}',
        '{"profile":{"identity":12}}',
        '{"profile":{"identity":"+12","all_identities":["a@b","77","78"]}}',
        '{"profile":{"all_identities":["a","b","c","d","e","f","g","h","i","j","88"]}}',
        '{"profile":{"identity":"12\\n"}}',
        '{"profile":{"identity":""}}',
        '{"x":1}',
        "[]",
    ]
    got = column(spark, docs, lambda c: numeric_user_id(F.parse_json(c)))
    assert got == ["12", "12", "77", None, None, None, None, None]


@pytest.mark.parametrize("mode", ["other"])
def test_unknown_mode(spark, mode):
    with pytest.raises(ValueError):
        times.resolve_time(F.lit("x"), mode)


def test_written_dates(spark):
    """The accepted shapes; a zone or an offset shifts to UTC."""
    want = {
        "January 5, 2024 3:04 PM": datetime(2024, 1, 5, 15, 4),
        "Jan 5 2024 10:00": datetime(2024, 1, 5, 10),
        "Jan-05-2024": datetime(2024, 1, 5),
        "Jan 5, 2024 10:00:00 EST": datetime(2024, 1, 5, 15),
        "Jan 5, 2024 10:00 +0200": datetime(2024, 1, 5, 8),
        "Fri Jan 05 2024 10:00:00 GMT+0530 (India Standard Time)": datetime(2024, 1, 5, 4, 30),
        "Fri, 05 Jan 2024 10:00:00 GMT": datetime(2024, 1, 5, 10),
        "5 January 2024": datetime(2024, 1, 5),
        "1st March 2024 at 5:00pm": datetime(2024, 3, 1, 17),
        "Jan 5, 2024 12:01 am": datetime(2024, 1, 5, 0, 1),
        "Jan 5, 2024 10:00 -03:30": datetime(2024, 1, 5, 13, 30),
        "Jan 5, 2024 13:00 PM": None,
        "Feb 30, 2024": None,
        "Jan 5": None,
        "soon": None,
    }
    assert column(spark, list(want), times.parse_worded) == list(want.values())
    as_of = F.lit("2030-01-01 00:00:00").cast("timestamp")
    for mode in ("reference", "corrected"):
        worded = [t for t, v in want.items() if v and not t[0].isdigit()]
        got = column(spark, worded, lambda c: times.first_time(F.array(c), as_of, mode))
        assert got == [want[t] for t in worded]

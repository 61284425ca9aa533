import datetime as dt
import html
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (clip, coerce_cell, coerce_typed, date_parts, extract_links,
                                extract_or_null, iso_text, null_as_zero_sum, parse_day,
                                parse_mixed_date, parse_timestamp_text, pick_link, plain_text,
                                recovered_sessions, round_to_long, safe_ratio, signed_percent,
                                squash, translated)
from tidemark.functions.cells import SinkField
from tidemark.functions.links import _plain
from tidemark.sources.reports import normalise_headers

from .conftest import rows_of

D = dt.date


def values(frame, inputs, kind, fn):
    df = frame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]


def test_mixed_dates_and_two_digit_years(frame):
    texts = ["3/5/26", "03/05/2026", "2026-03-05", "3/5/70", "3/5/68", "3/5/69", "12/31/99", "bad",
             "13/45/2026", "2/30/24", "2/29/72", None, "", "3/15/2026 x"]
    got = values(frame, texts, "string", parse_mixed_date)
    assert got == [D(2026, 3, 5), D(2026, 3, 5), D(2026, 3, 5), D(1970, 3, 5), D(2068, 3, 5),
                   D(1969, 3, 5), D(1999, 12, 31), None, None, None, D(1972, 2, 29), None, None, None]
    assert values(frame, [D(2026, 3, 5)], "date", parse_mixed_date) == [D(2026, 3, 5)]


def test_lenient_day(frame):
    got = values(frame, ["3/5/2026", "2026-03-05T10:00:00Z", " 2026-03-05 ", "3/5/26", "x"],
                 "string", parse_day)
    assert got == [D(2026, 3, 5), D(2026, 3, 5), D(2026, 3, 5), None, None]


def test_timestamp_text(frame):
    got = values(frame, ["3/5/2026 1:02:03 PM", "03/05/2026 12:00:00am", "2026-03-05 07:08:09",
                         "3/5/26 1:02:03 PM", "25/5/2026 1:02:03 PM", "x"], "string",
                 parse_timestamp_text)
    assert got == [dt.datetime(2026, 3, 5, 13, 2, 3), dt.datetime(2026, 3, 5),
                   dt.datetime(2026, 3, 5, 7, 8, 9), None, None, None]


def test_date_parts_iso_week_and_names(frame):
    row = date_parts(frame([(D(2027, 1, 1),)], "d date"), "d", "2027-01-11").first()
    assert (row.year, row.month, row.week_of_year, row.month_name, row.day_of_week, row.days_ago) \
        == (2027, 1, 53, "January", "Friday", 10)


def test_iso_text(frame):
    stamp = dt.datetime(2026, 3, 5, 1, 2, 3, 400)
    assert values(frame, [stamp], "timestamp", lambda c: iso_text(c, "timestamp")) == [
        "2026-03-05T01:02:03.000400+00:00"]
    assert values(frame, [D(2026, 3, 5)], "date", lambda c: iso_text(c, "date")) == ["2026-03-05"]


def test_ratios_and_rounding(frame):
    df = frame([(1, 0), (1, 4), (None, 4), (1, None)], "a int, b int")
    got = [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [None, 0.25, None, None]
    assert values(frame, [2.5, -2.5, 2.4, None], "double", round_to_long) == [3, -3, 2, None]
    df = frame([(10, 0.0), (10, 0.4), (10, None)], "e int, r double")
    assert [r[0] for r in df.select(recovered_sessions(F.col("e"), F.col("r"))).collect()] == [
        None, 25, None]
    df = frame([(110, 100), (1, 0), (None, 5), (5, None)], "a int, b int")
    assert [r[0] for r in df.select(signed_percent(F.col("a"), F.col("b"))).collect()] == [
        10.0, None, None, None]
    df = frame([(None, None), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(null_as_zero_sum(F.col("a"), F.col("b"))).collect()] == [0, 1]


def test_text(frame):
    assert values(frame, ["ñ" * 600], "string", lambda c: clip(c, 500)) == ["ñ" * 500]
    assert values(frame, ["x@abc/video/1", "x/video", None], "string",
                  lambda c: extract_or_null(c, "@([^/]+)/video")) == ["abc", None, None]
    assert values(frame, ["Web", "Other", None], "string", lambda c: translated(c, {"Web": "Site"})) \
        == ["Site", "Other", None]
    assert values(frame, [" \t x y\n", "  ", ""], "string", squash) == ["x y", "", ""]


def test_plain_text_writes_doubles_in_full(frame):
    df = frame([(x,) for x in (1.0, 1e7, 12345678.9, 1.23e-4, -2e9, None)], "v double")
    got = [r[0] for r in df.select(plain_text(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == ["1.0", "10000000.0", "12345678.9", "0.000123", "-2000000000.0", None]
    df = frame([(["a", "b"],)], "v array<string>")
    assert df.select(plain_text(F.col("v"), df.schema["v"].dataType)).first()[0] == "a,b"


@pytest.mark.parametrize("text,kind,value", [
    ("45.2%", "percent", 0.452), ("1,000%", "percent", 10.0), ("-5%", "percent", -0.05),
    ("%", "text", "%"), ("$1,234.56", "currency", 1234.56), ("-$5", "text", "-$5"),
    ("$5%", "text", "$5%"), ("1234", "integer", 1234), ("1,234", "integer", 1234),
    ("+7", "integer", 7), ("3.14", "number", 3.14), ("1e5", "number", 1e5), ("5.", "number", 5.0),
    ("123456789012345678901", "number", 123456789012345678901.0),
    ("3/15/2026", "date", "2026-03-15"), ("15/3/2026", "date", "2026-03-15"),
    ("3/4/2026", "date", "2026-03-04"), ("3/15/26", "date", "2026-03-15"),
    ("3/15/70", "date", "1970-03-15"), ("2026-03-15", "text", "2026-03-15"),
    ("33/33/2026", "text", "33/33/2026"), ("  hello ", "text", "hello"), (" ", "blank", None),
    (None, "blank", None)])
def test_cells(frame, text, kind, value):
    cell = frame([(text,)], "v string").select(coerce_cell(F.col("v")).alias("c")).first().c
    assert cell.kind == kind
    filled = [v for v in (cell.long_value, cell.double_value, cell.iso_date, cell.text_value)
              if v is not None]
    assert filled == ([value] if value is not None else [])


def test_nan_cell(frame):
    cell = frame([("nan",)], "v string").select(coerce_cell(F.col("v")).alias("c")).first().c
    assert cell.kind == "number" and math.isnan(cell.double_value)


def test_typed_coercion(frame):
    df = frame([("2026-03-05", "1,234", "0.5", "x", "u"), ("3/5/2026", "1e5", "1.5e1", "", "u"),
                ("25/3/2026", "7.6", "bad", None, "u"), ("2026/3/5", " 8 ", "", "y", "u"),
                ("soon", "", "1", "z", "u"), ("", "-3", "2", "z", "u")],
               "date string, users string, rate string, label string, unknown string")
    got = coerce_typed(df, [SinkField("date", "date"), SinkField("users", "number"),
                            SinkField("rate", "number", 8), SinkField("label", "text"),
                            SinkField("absent", "text")])
    assert got.columns == ["date", "users", "rate", "label"]
    assert [tuple(r) for r in got.collect()] == [
        ("2026-03-05", 1234, 0.5, "x"), ("2026-03-05", None, 15.0, None),
        ("2026-03-25", 8, None, None), ("2026-03-05", 8, None, "y"), ("soon", None, 1.0, "z"),
        (None, -3, 2.0, "z")]


LINKS = [
    ('<a href="/x">go</a><a href="/d">Click to <b>DOWNLOAD</b> it</a>', "/d"),
    ('<a href="/x">go</a><A HREF="/my/Export?a=1&amp;b=2">here</A>', "/my/Export?a=1&b=2"),
    ('<a href="mailto:a@b">m</a><a href="/unsubscribe">u</a><a href="/ok">o</a>', "/ok"),
    ('<a href="#top">t</a><a href="/manage">m</a><a>none</a>', ""),
    ('<p>nothing</p>', None), ("", None), (None, None),
    ('<!-- <a href="/download">x</a> --><a href="/fine">y</a>', "/fine"),
]


def test_links(frame):
    df = frame([(i, h) for i, (h, _) in enumerate(LINKS)], "i int, h string")
    got = df.orderBy("i").select(pick_link(extract_links(F.col("h")))).collect()
    assert [r[0] for r in got] == [want for _, want in LINKS]


def test_link_text_and_order(frame):
    html = '<a href="/1"> a <i>b</i> </a><a href="/2">c'
    df = frame([(html,)], "h string").select(extract_links(F.col("h")).alias("l"))
    assert [(a.href, a.text) for a in df.first().l] == [("/1", "a b")]


def test_all_character_references_are_decoded(frame):
    html = '<a href="https://x/y?id&#61;5&amp;f=&#x2F;&#38;lt;">Caf&eacute; &#8217;a&#x1F642; &amp;lt; A&B &#0;&#xD800;&#99999999999; &nope; &#150;</a>'
    link = frame([(html,)], "h string").select(extract_links(F.col("h")).alias("l")).first().l[0]
    assert link.href == "https://x/y?id=5&f=/&lt;"
    assert link.text == "Caf\u00e9 \u2019a\U0001f642 &lt; A&B \ufffd\ufffd\ufffd &nope; \u2013"


def test_headers():
    assert normalise_headers(["Email Name", "% Open", "2024 Total", "﻿Name", "a--b__c", "", "é"]) \
        == ["email_name", "open", "_2024_total", "name", "a_b_c", "col", "col"]


def test_rows_helper(frame):
    assert rows_of(frame([(2,), (1,)], "a int")) == [(1,), (2,)]


def test_references_without_a_semicolon(frame):
    words = ["copy", "copyright", "amp", "amplify", "ampamp", "notin", "notin;", "notit;", "lt", "ltimes;", "AMP", "uml3", "zzz", "zzz;", "b", "",
             "CounterClockwiseContourIntegral;", "thorn", "times", "timesbar;", "reg=1", "reg-1", "#65", "#x41;b", "frac12x", "sup1"]
    texts = [f"x &{a}&{b} y&{b}." for a in words for b in words]
    got = frame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", _plain(F.col("t")).alias("d")).collect()
    assert {r.i: r.d for r in got} == {i: html.unescape(t) for i, t in enumerate(texts)}


def test_references_in_addresses(frame):
    cases = {"/a?x=1&copy=2": "/a?x=1&copy=2", "/a?x=1&amp;copy=2": "/a?x=1&copy=2", "/a&copy": "/a©", "/a&copyright": "/a&copyright",
             "/a?b&amp=1&lt": "/a?b&amp=1<", "/a&notin;": "/a∉", "/a&copy;=1": "/a©=1", "/a&reg-1": "/a®-1"}
    rows = frame([(i, f'<a href="{a}">x</a>') for i, a in enumerate(cases)], "i int, h string")
    got = {r.i: r.links[0].href for r in rows.select("i", extract_links(F.col("h")).alias("links")).collect()}
    assert got == dict(enumerate(cases.values()))

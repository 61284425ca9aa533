import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.sources import reports, typed
from tidemark.sources.ingest import ingest, read_ledger, read_raw
from tidemark.sources.tables import read_grid
from tidemark.sources.typed import file_heads, read_csv_report
from tidemark.streaming.incremental import load_new_files, loaded

from .conftest import rows_of

NOW = "2026-03-06 12:00:00"
CONFIGS = [
    reports.ReportConfig("mail", "Mail Comparison", r"Mail_.*\.csv", "mail", "weekly"),
    reports.ReportConfig("people", "Daily People", r"People_.*\.csv", "people", "daily", ("status", "method")),
]
MESSAGES = ("message_id string, sender string, subject string, internal_date_ms bigint, path string, "
            "content_type string, disposition string, url string")


def write(folder: Path, name: str, text: str) -> str:
    path = folder / name
    path.write_bytes(text.encode())
    return str(path)


def message(i, subject, path, ctype="text/csv", disposition=None, url=None, ms=1772703000000):
    return (i, "Reports@x.example", subject, ms, path, ctype, disposition, url)


def run(spark, frame, root, rows, mode="all"):
    return ingest(spark, frame(rows, MESSAGES), CONFIGS, f"{root}/raw", f"{root}/ledger",
                  F.lit(NOW).cast("timestamp"), mode, "reports@x.example")


CSV = ('﻿Mail Name,% Open,2024 Total,First Sent,Mail  name\r\n'
       '"a, ""q""\nb", 45.2% ,"$1,234.50",3/5/26,late\r\n'
       'c,,,bad\r\n'
       'd,7%,8,3/6/26,x,surplus\r\n')


def test_round_trip_types_and_second_run(spark, frame, tmp_path):
    a = write(tmp_path, "a.csv", CSV)
    page = write(tmp_path, "p.csv", " \n<!DOCTYPE html><html>sign in, please</html>")
    odd = write(tmp_path, "o.csv", "x,y\n1,2\n")
    empty = write(tmp_path, "e.csv", "Mail Name,Nothing\n")
    rows = [message("m1", "Re: mail comparison", a, disposition='attachment; filename="Mail_1.csv"'),
            message("m2", "Mail Comparison", page), message("m3", "Mail Comparison", odd, "Text/HTML; x"),
            message("m4", "Mail Comparison", empty), message("m5", "Something else", a)]
    out = {r.message_id: (r.rows_loaded, r.error) for r in run(spark, frame, tmp_path, rows).collect()}
    assert out["m1"] == (3, None) and out["m4"] == (0, "empty file") and "m5" not in out
    assert "web page" in out["m2"][1] and "web page" in out["m3"][1]
    got = {r.open: r for r in read_raw(spark, f"{tmp_path}/raw/mail").collect()}
    assert got[45.2]._2024_total == 1234.5 and got[45.2].mail_name == "late"
    assert got[45.2]._source_filename == "Mail_1.csv" and got[45.2]._gmail_message_id == "m1"
    assert got[45.2]._import_timestamp == dt.datetime(2026, 3, 6, 12)
    assert got[45.2]._email_date.startswith("2026-03-05T09:30:00")
    assert got[None].first_sent == "bad"                    # one bad date makes the column text
    assert rows_of(read_ledger(spark, f"{tmp_path}/ledger"), "message_id") == [("m1",)]
    again = run(spark, frame, tmp_path, rows)
    assert rows_of(again, "message_id") == [("m2",), ("m3",), ("m4",)]
    assert read_raw(spark, f"{tmp_path}/raw/mail").count() == 3


def test_later_loads_keep_types_and_add_columns(spark, frame, tmp_path):
    one = write(tmp_path, "1.csv", "Name,Count\na,1\n")
    two = write(tmp_path, "2.csv", "Count,Name,New\nx,b,2026-01-02\n5,c,2026-01-03\n")
    run(spark, frame, tmp_path, [message("m1", "Mail Comparison", one, ms=0)])
    run(spark, frame, tmp_path, [message("m2", "Mail Comparison", two)])
    raw = read_raw(spark, f"{tmp_path}/raw/mail")
    assert rows_of(raw, "name", "count", "new") == sorted([
        ("a", 1.0, None), ("b", None, dt.date(2026, 1, 2)), ("c", 5.0, dt.date(2026, 1, 3))], key=str)
    first = raw.filter("name = 'a'").first()
    # unknown receipt time: now; no file name anywhere: the fallback name
    assert first._email_date.startswith("2026-03-06T12:00:00")
    assert first._source_filename == "mail_20260306_120000.csv"


def test_summary_reports_store_one_row(spark, frame, tmp_path):
    one = write(tmp_path, "People_1.csv", "Status,Method\nSubscribed,\n Subscribed ,Link\n,\n")
    two = write(tmp_path, "People_2.csv", "Status,Other\nNo,1\n")
    url = "https://x.example/f/People_1.csv?sig=1"
    out = run(spark, frame, tmp_path, [message("m1", "Daily People", one, url=url),
                                       message("m2", "daily people", two)], "daily")
    assert rows_of(out, "message_id", "rows_loaded", "error") == [("m1", 1, None), ("m2", 1, None)]
    raw = read_raw(spark, f"{tmp_path}/raw/people")
    assert rows_of(raw, "record_count", "status_counts", "method_counts", "_source_filename") == sorted([
        (3, '{"Subscribed":2}', '{"Link":1}', "People_1.csv"),
        (1, '{"No":1}', None, "people_20260306_120000.csv")], key=str)
    assert raw.first().report_date == dt.date(2026, 3, 5)
    assert run(spark, frame, tmp_path, [message("m9", "Mail Comparison", one)], "daily").count() == 0


def test_a_bad_report_does_not_stop_the_others(spark, frame, tmp_path):
    good = write(tmp_path, "g.csv", "Name\na\n")
    rows = [message("m1", "Mail Comparison", good), message("m2", "Daily People", good)]
    got = run(spark, frame, tmp_path, rows)      # the list report has none of its summary fields
    out = {r.message_id: r.error for r in got.collect()}
    assert out["m1"] is None
    summary = {r.report: r for r in reports.run_summary(got, CONFIGS).collect()}
    assert summary["mail"].status == "OK" and summary["mail"].rows_loaded == 1


def test_selection_and_attachments(frame):
    parts = "array<struct<filename:string,body:string>>"
    log = frame([
        ("1", "R@x.example", "FW: Mail Comparison - May", [("note.txt", "n"), ("mail_1.CSV", "A"), ("Mail_2.csv", "B")]),
        ("2", "other@x.example", "Mail Comparison", []), ("3", "r@x.example", "Daily People", [("People_x.csv", None)]),
        ("4", "r@x.example", "Mail Comparison", [("xMail_1.csv", "A")])],
        f"message_id string, sender string, subject string, parts {parts}")
    done = frame([("4",)], "message_id string")
    got = reports.select_reports(log, CONFIGS, done, "all", "r@x.example")
    part = reports.pick_report_attachment(F.col("parts"), F.col("report"), CONFIGS)
    assert rows_of(got.select("message_id", "report", "table", part["filename"], part["body"])) == sorted([
        ("1", "mail", "mail", "mail_1.CSV", "A"), ("3", "people", "people", None, None)], key=str)
    assert reports.select_reports(log, CONFIGS, done, "weekly", "r@x.example").count() == 1
    assert reports.select_reports(log, CONFIGS, done, "never").count() == 0
    assert rows_of(reports.messages(log, "r@x.example", "people", True), "message_id") == [("3",)]


@pytest.mark.parametrize("disposition,url,want", [
    ('attachment; filename="r 1.csv"; x=1', "https://x/y.csv", "r 1.csv"),
    ("attachment; filename*='r.csv'", None, "r.csv"), (None, "https://x.example/a/b.csv?x=1#f", "b.csv"),
    (None, "https://x.example/a.csv/b", "rep_20260306_120000.csv"), (None, None, "rep_20260306_120000.csv")])
def test_file_names(frame, disposition, url, want):
    df = frame([(disposition, url)], "d string, u string")
    now = F.lit(NOW).cast("timestamp")
    assert df.select(reports.resolve_filename(F.col("d"), F.col("u"), F.lit("rep"), now)).first()[0] == want


def test_quarantine(frame):
    df = frame([(1, "﻿ \n<!DocType html>", "text/csv"), (2, "a,b", "Text/HTML"), (3, "a,b", None),
                (4, "<HTML>", None), (5, "x <html>", "text/csv"), (6, None, None)], "i int, b string, t string")
    ok, bad = reports.quarantine(df, "b", "t")
    assert rows_of(bad, "i") == [(1,), (2,), (4,)] and rows_of(ok, "i") == [(3,), (5,), (6,)]
    assert [r[0] for r in df.orderBy("i").select(reports.looks_csv(F.col("b"))).collect()][:5] == [
        False, True, True, False, False]


def test_inference_whole_and_sampled(frame):
    rows = [(i, "1", "3/5/26", "3/5/2026 1:02:03 PM", "", "2026-01-01") for i in range(150)]
    rows += [(150, "x", "", None, " ", "1"), (151, "-$1,000.5%", "2026-03-05", None, None, None)]
    df = frame(rows, "i int, n string, d string, t string, e string, m string")
    whole = typed.inferred(df.drop("i"))
    assert whole == {"n": "string", "d": "date", "t": "timestamp", "e": "string", "m": "string"}
    sampled = typed.inferred(df, 100, "i")
    assert sampled == {"n": "double", "d": "date", "t": "timestamp", "e": "string", "m": "date"}
    with pytest.raises(ValueError, match="index"):
        typed.infer_types(df, 100)


def test_coercion_and_rejects(frame):
    df = frame([("45.2%", "3/5/26", "x"), ("$1,000", "2026-03-05", " "), ("n/a", "5 May", "y"), ("", None, "z")],
               "n string, d string, s string")
    got, lost = typed.coerce(df, {"n": "double", "d": "date", "s": "string"})
    day = dt.date(2026, 3, 5)
    assert [tuple(r) for r in got.collect()] == [(45.2, day, "x"), (1000.0, day, None), (None, None, "y"), (None, None, "z")]
    assert rows_of(lost) == [("d", "5 May", 1), ("n", "n/a", 1)]


def test_heads_and_grid(spark, tmp_path):
    a = write(tmp_path, "a.csv", "﻿A,B\r\n1,2\r\n")
    b = write(tmp_path, "b.csv", "\n<html>no</html>")
    write(tmp_path, "e.csv", "")
    assert rows_of(file_heads(spark, str(tmp_path)), "path", "head") == sorted([(a, "A,B"), (b, "<html>no</html>")], key=str)
    with pytest.raises(ValueError, match="different headers"):
        read_csv_report(spark, [a, write(tmp_path, "other.csv", "B,A\n1,2\n")])
    assert read_grid(spark, a, 1).count() == 1
    with pytest.raises(ValueError, match="empty"):
        read_grid(spark, write(tmp_path, "c.csv", "A,B\n"))


def test_stream_loads_each_file_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    args = (spark, str(folder), ["Item Id", "Value"], {"item_id": "bigint", "value": "double"},
            str(tmp_path / "raw"), str(tmp_path / "state"))
    write(folder, "1.csv", "Item Id,Value\n1, 2.5 \n2,bad\n")
    assert load_new_files(*args) == 1
    assert load_new_files(*args) == 0
    write(folder, "2.csv", "Item Id,Value\n3,\n")
    assert load_new_files(*args) == 1
    assert rows_of(loaded(spark, str(tmp_path / "raw")), "item_id", "value", "_source_filename") == sorted([
        (1, 2.5, "1.csv"), (2, None, "1.csv"), (3, None, "2.csv")], key=str)


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_jobs_do_not_grow_with_the_number_of_headers(spark, frame, tmp_path):
    """200 files of 200 headers: as many jobs as for three, and every cell under its name."""
    counts = {}
    for n in (3, 200):
        root = tmp_path / str(n)
        root.mkdir()
        rows = []
        for i in range(n):
            # the same three columns in turning order, and one of its own
            names = ["Name", "Share", "Day"][i % 3:] + ["Name", "Share", "Day"][:i % 3]
            cells = {"Name": f"n{i}", "Share": f"{i}%", "Day": "2026-01-02"}
            text = ",".join([*names, f"Own {i}"]) + "\n" + ",".join([*(cells[c] for c in names), str(i * 10)]) + "\n"
            rows.append(message(f"m{i}", "Mail Comparison", write(root, f"f{i}.csv", text)))
        counts[n] = jobs_of(spark, f"headers-{n}", lambda: run(spark, frame, root, rows))
        raw = read_raw(spark, f"{root}/raw/mail")
        assert len(raw.columns) == 3 + n + 4
        own = F.coalesce(*[F.col(f"own_{i}") for i in range(n)])
        got = raw.select("name", "share", "day", own.alias("own"), "_gmail_message_id")
        assert rows_of(got) == sorted([(f"n{i}", float(i), dt.date(2026, 1, 2), float(i * 10), f"m{i}") for i in range(n)], key=str)
    # adaptive execution may split a query in a job more or less
    assert counts[200] <= counts[3] + 5


def test_a_run_that_dies_has_loaded_nothing(spark, frame, tmp_path, monkeypatch):
    """Killed between the data and the commit: readers see none of it, and the rerun has each row once."""
    from tidemark.sources import commits
    from tidemark.sources import ingest as module
    first = [message("m0", "Mail Comparison", write(tmp_path, "0.csv", "Name,Old\nz,1\n"))]
    run(spark, frame, tmp_path, first)
    rows = [message("m1", "Mail Comparison", write(tmp_path, "1.csv", "Name,New\na,x\nb,y\n")),
            message("m2", "Daily People", write(tmp_path, "2.csv", "Status\nS\n"))]

    def die(*_):
        raise SystemExit("killed")
    for step in ("publish", "tie_ledger"):
        with monkeypatch.context() as m:
            m.setattr(module, step, die)
            with pytest.raises(SystemExit):
                run(spark, frame, tmp_path, rows)
        raw = read_raw(spark, f"{tmp_path}/raw/mail")
        assert raw.columns[:2] == ["name", "old"] and raw.count() == 1
        assert read_raw(spark, f"{tmp_path}/raw/people") is None
        assert rows_of(read_ledger(spark, f"{tmp_path}/ledger"), "message_id") == [("m0",)]
    run(spark, frame, tmp_path, rows)
    assert rows_of(read_raw(spark, f"{tmp_path}/raw/mail"), "name", "old", "new") == sorted([
        ("z", 1.0, None), ("a", None, "x"), ("b", None, "y")], key=str)
    assert read_raw(spark, f"{tmp_path}/raw/people").count() == 1
    assert rows_of(read_ledger(spark, f"{tmp_path}/ledger"), "message_id") == [("m0",), ("m1",), ("m2",)]
    # what the dead runs left: twice both tables, once the ledger
    assert len(commits.vacuum(spark, f"{tmp_path}/raw", f"{tmp_path}/ledger")) == 5
    assert commits.vacuum(spark, f"{tmp_path}/raw", f"{tmp_path}/ledger") == []
    assert read_raw(spark, f"{tmp_path}/raw/mail").count() == 3


def test_two_reports_fill_one_table(spark, frame, tmp_path):
    configs = [reports.ReportConfig("a", "Alpha", r".*", "both", "daily"), reports.ReportConfig("b", "Beta", r".*", "both", "daily")]
    rows = [message("m1", "Alpha", write(tmp_path, "a.csv", "Name,Count\na,1\n")),
            message("m2", "Beta", write(tmp_path, "b.csv", "Day,Count\n2026-01-02,x\n"))]
    ingest(spark, frame(rows, MESSAGES), configs, f"{tmp_path}/raw", f"{tmp_path}/ledger", F.lit(NOW).cast("timestamp"))
    assert rows_of(read_raw(spark, f"{tmp_path}/raw/both"), "name", "count", "day") == sorted([
        ("a", 1.0, None), (None, None, dt.date(2026, 1, 2))], key=str)


def test_a_free_text_field_is_refused(spark, frame, tmp_path):
    many = write(tmp_path, "People_1.csv", "Status,Method\n" + "".join(f"s{i},m\n" for i in range(30)))
    few = write(tmp_path, "People_2.csv", "Status,Method\nS,m\nT,m\n")
    rows = [message("m1", "Daily People", many), message("m2", "Daily People", few)]
    out = ingest(spark, frame(rows, MESSAGES), CONFIGS, f"{tmp_path}/raw", f"{tmp_path}/ledger", F.lit(NOW).cast("timestamp"), most_values=20)
    got = {r.message_id: (r.rows_loaded, r.error) for r in out.collect()}
    assert got == {"m1": (0, "too many values for a category: status"), "m2": (1, None)}
    assert [r.record_count for r in read_raw(spark, f"{tmp_path}/raw/people").collect()] == [2]
    assert rows_of(read_ledger(spark, f"{tmp_path}/ledger"), "message_id") == [("m2",)]


def test_header_names_in_spark_are_those_of_python(frame):
    heads = ["A,B", '"a, ""q""",% Open,2024 Total,,É é, x ,', "x", ",", '"one, two","three"', "A,a,A b,a_b", " _x_ ,9"]
    got = frame([(h,) for h in heads], "head string").select(typed.head_names(F.col("head"), 9).alias("n")).collect()
    assert [r.n for r in got] == [reports.normalise_headers(typed.header_cells(h)) for h in heads]

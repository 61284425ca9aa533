"""What the plans promise at scale, and the cases in which earlier versions went wrong."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality, sync
from tidemark.operators.breakdown import topn_other
from tidemark.operators.calendar import copy_report, gap_summary
from tidemark.operators.latest import first_ranked
from tidemark.operators.shape import ordered_scan
from tidemark.plans.cross_channel import email_items
from tidemark.registry import copies, models, raw
from tidemark.session import stored
from tidemark.sources import tables

from .conftest import rows_of


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [2, 40, 2000])
def test_no_rank_gathers_a_hot_day(spark, n):
    """Whatever n is, rows are ranked by input task before what is left is ranked together."""
    rows = spark.range(40_000).select(F.lit("2026-01-01").alias("day"), F.lit("City").alias("type"),
                                      F.col("id").cast("string").alias("value"), (F.col("id") * 7 % 40_000).alias("users"))
    got = first_ranked(rows, ["day"], [F.col("users").desc()], n)
    assert re.findall(r"Window \[row_number\(\)[^\n]*_input_task", plan(got))
    assert rows_of(got, "users") == sorted(((40_000 - 1 - k,) for k in range(n)), key=str)
    bucketed = topn_other(rows, ["day"], "type", "value", "users", {"City": n}, ["users"])
    assert re.findall(r"Window \[row_number\(\)[^\n]*_input_task", plan(bucketed))
    total, kept, rest = bucketed.agg(F.sum("users"), F.count_if(F.col("value") != "(other)"),
                                     F.sum(F.when(F.col("value") == "(other)", F.col("users")))).first()
    assert (total, kept, rest) == (40_000 * 39_999 // 2, n, sum(range(40_000 - n)))


def test_key_duplicates_are_not_cut(frame):
    df = frame([(k,) for k in range(70) for _ in range(2)], "k int")
    assert quality.key_duplicates(df, ["k"]).count() == 70
    assert [r.k for r in quality.key_duplicates(df, ["k"], 3).collect()] == [0, 1, 2]


def test_plan_reads_source_and_target_twice(spark):
    folder = "/root/testdata/sf0.001"
    source = stored(copies.source_records(spark, folder), "s")
    target = stored(copies.target_records(spark, folder), "t")
    decided = sync.upsert_plan(source, target, ["name"])
    assert plan(decided).count("FileScan parquet") == 4
    fixed = stored(decided, "plan")
    assert plan(sync.apply_plan(target, fixed, prune=True, dedupe=True)).count("FileScan parquet") == 2


def test_hot_key_of_the_sync(frame):
    source = frame([(k, "same" if k < 300 else f"k{k}", k % 3) for k in range(400)], "source_order bigint, name string, v int")
    target = frame([(f"r{k}", k, " SAME " if k < 200 else f"k{k + 150}", 0) for k in range(300)], "id string, seq bigint, name string, v int")
    decided = sync.upsert_plan(source, target, ["name"])
    counts = {r.action: r["count"] for r in decided.groupBy("action").count().collect()}
    assert counts["duplicate"] == 199 and counts["create"] == 299 + 50 and counts["stale"] == 50
    assert counts.get("update", 0) + counts.get("skip", 0) == 51
    assert decided.where("action <> 'duplicate' and action <> 'stale'").agg(F.count_distinct("source_order")).first()[0] == 400
    after = sync.apply_plan(target, decided, prune=True, dedupe=True)
    assert after.count() == 300 - 199 - 50 + 349 and after.agg(F.count_distinct("id")).first()[0] == after.count()


def test_whole_sync_builds_each_model_once(spark, monkeypatch):
    built = []
    for name in ("social_posts", "breakdown_365d"):
        monkeypatch.setattr(models, name, lambda *a, f=getattr(models, name), n=name: (built.append(n), f(*a))[1])
    got = {(r.copy, r.run): r for r in copies.end_to_end_sync(spark, "/root/testdata/sf0.001").collect()}
    assert sorted(built) == ["breakdown_365d", "social_posts"]
    assert sorted(got) == [("dashboard", 1), ("dashboard", 2), ("social", 1), ("social", 2), ("web", 1)]
    assert all(r.rows_read == r.created > 0 for (_, run), r in got.items() if run == 1)


def test_only_copies_are_compared(frame):
    target = frame([("a", 1, "k", "x"), ("b", 2, "K ", "x"), ("c", 3, "k", "y"), ("d", 4, "alone", "z"), ("e", 5, "k", "y")],
                   "id string, seq bigint, name string, v string")
    got = rows_of(sync.duplicate_diff(target, ["name"]))
    assert got == sorted([("name", 1, "k", "K ", "k"), ("v", 2, "k", "x", "y")], key=str)


def test_versions_follow_the_writing(spark, tmp_path):
    root = str(tmp_path / "table")
    assert tables.current(spark, root) is None
    for version in ("9", "10", "1"):
        tables.replace(spark.range(1).select(F.lit(version).alias("v")), root, version)
        assert tables.current(spark, root).first().v == version


def test_one_bad_date_stops_no_row(spark):
    report = raw.emails(spark, "/root/testdata/sf0.001")
    kinds = dict(report.dtypes)
    cut = report.withColumn("last_sent_date", F.when(F.hash("email_name") % 2 == 0, "3/5/26").when(
        F.hash("email_name") % 3 == 0, "no date").otherwise("2026-03-05"))
    assert "last_sent_date" in kinds
    days = {r.date for r in email_items(cut).select("date").distinct().collect()}
    assert days == {None, dt.date(2026, 3, 5)}


def test_median_keeps_large_whole_numbers_and_infinities(frame):
    big = 2 ** 53
    whole = frame([(1, big + k) for k in range(5)], "g int, v bigint")
    assert [tuple(r) for r in quality.numeric_profile(whole, ["g"]).collect()] == [(1, "v", big, big + 2, big + 4, 5)]
    inf = float("inf")
    wild = frame([(1, x) for x in (-inf, -inf, 0.5, 1.5, 2.5, inf, inf, inf)], "g int, v double")
    assert quality.numeric_profile(wild, ["g"]).first().median == 2.5
    ends = frame([(1, x) for x in (-inf, inf, inf)], "g int, v double")
    assert quality.numeric_profile(ends, ["g"]).first().median == inf


def test_gaps_and_copies_without_a_calendar(frame):
    loaded = frame([("a", "2026-01-01"), ("a", "2026-01-03"), ("a", "2025-12-01"), ("b", "2025-12-31"), (None, "2026-01-02"), ("c", None)],
                   "s string, day string")
    sent = frame([("a", "2026-01-02", True), ("a", "2026-01-02", False), ("a", "2026-01-03", True), ("b", "2026-01-01", False),
                  ("z", "2026-01-01", True), ("a", "2027-01-01", True)], "s string, day string, processed boolean")
    got = gap_summary(loaded, sent, ["s"], "2026-01-01", "2026-01-04")
    assert rows_of(got) == sorted([("a", 2, 1, 1, 1), ("b", 4, 1, 3, 0), (None, 3, 0, 3, 0)], key=str)
    copy = frame([("a", "2026-01-01"), ("a", "2026-01-01"), ("a", "2026-01-04")], "s string, day string")
    row = copy_report(copy, "day", ["s"], "2026-01-01", "2026-01-05").first()
    assert tuple(row) == ("a", 2, 3, dt.date(2026, 1, 1), dt.date(2026, 1, 4), "2026-01-02..2026-01-03 (2d), 2026-01-05..2026-01-05 (1d)", 3, 1, 1)


def test_an_empty_scan_is_an_error(frame):
    df = frame([(2,), (1,)], "a int")
    assert [r.a for r in ordered_scan(df, [F.col("a").asc()]).collect()] == [1, 2]
    with pytest.raises(ValueError, match="empty"):
        ordered_scan(df.limit(0), [F.col("a").asc()])

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.operators.breakdown import breakdown, daily_summary, topn_other
from tidemark.operators.calendar import (coverage, day_ranges, gap_summary, missing_days,
                                         missing_ranges, value_runs)
from tidemark.operators.latest import latest_per_key
from tidemark.operators.shape import aligned_union, align, real_loads, rolling_window, zone_date
from tidemark.schemas import layout

from .conftest import rows_of

D = dt.date


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- latest per key -------------------------------------------------------

def test_latest_ties_nulls_and_determinism(frame, spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 1, "n1"), (None, 3, "n2"),
            ("b", None, "q"), ("b", 0, "r")]
    df = frame(rows, "k string, t int, v string")
    got = latest_per_key(df, ["k"], ["t"], ["v"])
    assert rows_of(got) == sorted([("a", 2, "z"), (None, 3, "n2"), ("b", 0, "r")], key=str)
    shuffled = frame(random.Random(1).sample(rows, len(rows)), "k string, t int, v string")
    assert rows_of(latest_per_key(df, ["k"], ["t"])) == rows_of(latest_per_key(shuffled, ["k"], ["t"]))
    oldest = latest_per_key(df.filter("t is not null"), ["k"], ["t"], ["v"], ascending=True)
    assert rows_of(oldest) == sorted([("a", 1, "x"), (None, 1, "n1"), ("b", 0, "r")], key=str)


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 2).withColumn("pad", F.lit("x"))
    plan = plan_of(latest_per_key(df, ["k"], ["id"], ["id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


# --- top-N with other -----------------------------------------------------

def brute_topn(rows, caps):
    groups = defaultdict(list)
    for day, kind, value, users, extra in rows:
        groups[(day, kind)].append((value, users, extra))
    out = defaultdict(lambda: [None, None])
    for (day, kind), members in groups.items():
        order = sorted(members, key=lambda m: (
            m[1] is None, -(m[1] or 0), m[0] is not None, m[0] or "", m[2] is None, -(m[2] or 0)))
        for rank, (value, users, extra) in enumerate(order, 1):
            label = "(other)" if rank > caps.get(kind, 10 ** 9) else value
            acc = out[(day, kind, label)]
            for i, x in enumerate((users, extra)):
                if x is not None:
                    acc[i] = (acc[i] or 0) + x
    return sorted(((*k, *v) for k, v in out.items()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_topn_other_against_brute_force(frame, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randint(1, 3), rnd.choice(["Page", "City", "Device"]),
             rnd.choice([None, "(other)", *"abcdefgh"]), rnd.choice([None, 0, 1, 2, 3]),
             rnd.choice([None, 1, 5])) for _ in range(150)]
    rows += [(1, "Page", "a", 3, 5)] * 20          # exact copies across the boundary
    caps = {"Page": 4, "City": 2}
    df = frame(rows, "day int, kind string, value string, users bigint, extra bigint")
    got = topn_other(df, ["day"], "kind", "value", "users", caps, ["users", "extra"])
    assert rows_of(got) == brute_topn(rows, caps)


def test_topn_other_keeps_totals_and_refuses_doubles(frame):
    df = frame([(1, "P", str(i), i, 1.0) for i in range(50)],
               "day int, kind string, value string, users bigint, x double")
    got = topn_other(df, ["day"], "kind", "value", "users", {"P": 5}, ["users"])
    assert got.count() == 6 and got.agg(F.sum("users")).first()[0] == sum(range(50))
    with pytest.raises(ValueError, match="integer"):
        topn_other(df, ["day"], "kind", "value", "users", {"P": 5}, ["x"])


def test_topn_other_never_shuffles_raw_rows_of_a_group(spark):
    df = spark.range(10000).select((F.col("id") % 2).alias("day"), F.lit("P").alias("kind"),
                                   F.col("id").cast("string").alias("value"), F.col("id").alias("users"))
    plan = plan_of(topn_other(df, ["day"], "kind", "value", "users", {"P": 5}, ["users"]))
    assert "WindowGroupLimit" in plan and "partial_sum" in plan


# --- union, windows, filters ----------------------------------------------

def test_union_by_name_pads_and_checks(frame):
    schema = layout("a string\nb bigint\nc double")
    one = frame([(1, "x")], "b int, a string")
    two = frame([(2.5, "y")], "c double, a string")
    got = aligned_union([one, two], schema)
    assert got.schema == schema
    assert rows_of(got) == [("x", 1, None), ("y", None, 2.5)]
    with pytest.raises(ValueError, match="outside"):
        aligned_union([one, frame([(1,)], "zzz int")], schema)
    assert align(two, schema).columns == ["a", "b", "c"]


def test_rolling_window_is_inclusive_and_ordered(frame):
    df = frame([(D(2025, 1, 1), 1), (D(2025, 1, 2), 2), (D(2026, 1, 2), 3), (None, 4)], "date date, v int")
    assert [r.v for r in rolling_window(df, "date", 365, "2026-01-02").orderBy("v").collect()] == [2, 3]
    top = rolling_window(df, "date", 9999, "2026-01-02", limit=1, order_by=[F.col("date").desc()])
    assert top.first().v == 3


def test_window_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int"))
                           .alias("date"), "id").write.parquet(str(tmp_path / "t"))
    plan = plan_of(rolling_window(spark.read.parquet(str(tmp_path / "t")), "date", 3, "2026-01-10"))
    assert "GreaterThanOrEqual(date,2026-01-07)" in plan


def test_zone_date(frame):
    df = frame([(dt.datetime(2026, 1, 2, 3, 0),)], "t timestamp")
    assert df.select(zone_date(F.col("t"), "America/Los_Angeles")).first()[0] == D(2026, 1, 1)


def test_real_loads(frame):
    df = frame([(None, "Daily_List_1.csv"), (0, "a.csv"), (1, "a.csv"), (2, "Daily_List_1.csv"),
                (2, "daily_full_list_20260821_101112.csv"), (9, None)],
               "record_count int, _source_filename string")
    assert rows_of(real_loads(df)) == [(2, "Daily_List_1.csv")]


# --- value counts ---------------------------------------------------------

def test_breakdown_and_summary(frame):
    df = frame([("f1", "Subscribed", None), ("f1", " Subscribed ", "Link"), ("f1", "", "  "),
                ("f2", "No", None)], "file string, status string, method string")
    assert rows_of(breakdown(df, ["status", "method", "gone"], ["file"])) == sorted([
        ("f1", "status", "Subscribed", 2), ("f1", "method", "Link", 1), ("f2", "status", "No", 1)], key=str)
    assert rows_of(daily_summary(df, ["status", "method", "gone"], ["file"])) == [
        ("f1", 3, '{"Subscribed":2}', '{"Link":1}'), ("f2", 1, '{"No":1}', None)]


# --- calendar -------------------------------------------------------------

def brute_ranges(days, start, end):
    missing = [start + dt.timedelta(i) for i in range((end - start).days + 1)
               if start + dt.timedelta(i) not in days]
    out = []
    for d in missing:
        if out and d == out[-1][1] + dt.timedelta(1):
            out[-1][1] = d
        else:
            out.append([d, d])
    return [(a, b, (b - a).days + 1) for a, b in out]


def test_missing_ranges_against_brute_force(frame):
    rnd = random.Random(3)
    start, end = D(2026, 1, 1), D(2026, 2, 10)
    rows = [(s, start + dt.timedelta(rnd.randint(-5, 45))) for s in "abc" for _ in range(25)]
    rows += [("out", D(2020, 1, 1)), ("nul", None)]
    df = frame(rows, "s string, d date")
    want = []
    for s in ("a", "b", "c", "out"):
        want += [(s, *r) for r in brute_ranges({d for k, d in rows if k == s}, start, end)]
    assert rows_of(missing_ranges(df, "d", ["s"], start, end)) == sorted(want, key=str)
    # the same days, listed and collapsed again
    listed = missing_days(df.filter("s <> 'nul'"), "d", ["s"], start, end)
    assert rows_of(day_ranges(listed, ["s"])) == sorted(want, key=str)


def test_coverage_counts_add_up(frame):
    df = frame([("a", D(2026, 1, 1)), ("a", D(2026, 1, 2)), ("a", D(2026, 1, 5)), ("a", D(2025, 1, 5)),
                ("b", D(2026, 1, 1))], "s string, d date")
    got = {r.s: r for r in coverage(df, "d", ["s"], "2026-01-01", "2026-01-06").collect()}
    assert got["a"].missing_ranges == "2026-01-03..2026-01-04 (2d), 2026-01-06..2026-01-06 (1d)"
    assert (got["a"].days_present, got["a"].days_missing, got["a"].first_date) == (3, 3, D(2025, 1, 5))
    assert got["b"].days_present + got["b"].days_missing == 6


def test_gap_summary(frame):
    have = frame([("a", D(2026, 1, 1))], "s string, day date")
    sent = frame([("a", D(2026, 1, 2), True), ("a", D(2026, 1, 2), False), ("a", D(2026, 1, 3), False)],
                 "s string, day date, processed boolean")
    row = gap_summary(have, sent, ["s"], "2026-01-01", "2026-01-04").first()
    assert tuple(row) == ("a", 3, 2, 1, 1)


def test_value_runs_span_missing_days(frame):
    days = [(1, 5), (2, 5), (6, 5), (7, 4), (8, 5), (9, None), (10, None)]
    df = frame([("s", D(2026, 1, d), n, f"f{d}") for d, n in days], "s string, d date, n int, file string")
    got = value_runs(df, ["s"], "d", "n", "d", "file").orderBy("run_start").collect()
    assert [(r.run_start.day, r.run_end.day, r.n, r.days, r.same_value, r.files) for r in got] == [
        (1, 6, 5, 6, True, 3), (7, 7, 4, 1, False, 1), (8, 8, 5, 1, False, 1),
        (9, 10, None, 2, False, 2)]


def test_value_runs_take_the_newest_of_a_day(frame):
    df = frame([("s", D(2026, 1, 1), 1, 10), ("s", D(2026, 1, 1), 2, 20), ("s", D(2026, 1, 2), 1, 20)],
               "s string, d date, loaded int, n int")
    got = value_runs(df, ["s"], "d", "n", newest_by=["loaded"]).collect()
    assert [(r.run_start.day, r.run_end.day, r.n) for r in got] == [(1, 2, 20)]


# --- quality --------------------------------------------------------------

def test_key_duplicates_and_summary(frame):
    df = frame([("a", 1), ("a", 1), ("a", 1), ("b", None), ("b", None), ("", 2), (None, 3)], "k string, d int")
    top = q.key_duplicates(df, ["k", "d"]).collect()
    assert [(r.k, r[2]) for r in top] == [("a", 3), ("b", 2)]
    plain = q.key_duplicate_summary(df, ["k", "d"]).first()
    assert tuple(plain) == (7, 4, 2, 3, 2, 3)
    strict = q.key_duplicate_summary(df, ["k", "d"], blank_is_missing=True).first()
    assert tuple(strict) == (7, 4, 1, 2, 3, 4)


def test_mark_duplicates_with_null_keys(frame):
    df = frame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)], "k string, v int")
    got = {r.v: r.n for r in q.mark_duplicates(df, ["k"]).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 5: 1}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5000, 60001])
def test_upper_median_is_exact(spark, n):
    df = spark.range(n).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 60013).alias("v"))
    row = q.numeric_profile(df, ["g"]).first()
    values = sorted((i * 7919) % 60013 for i in range(n))
    assert (row["median"], row["min"], row["max"], row["n"]) == (
        values[n // 2], values[0], values[-1], n)


def test_upper_median_of_skewed_values(frame):
    rows = [("a", 5.0)] * 700 + [("a", float(i)) for i in range(300)] + [("b", None), ("b", 2.0)]
    got = {(r.g, r.field): r for r in q.numeric_profile(frame(rows, "g string, v double"), ["g"]).collect()}
    assert got[("a", "v")]["median"] == 5.0 and got[("b", "v")]["n"] == 1


@pytest.mark.parametrize("most", [0, 10_000])
def test_upper_medians_of_many_groups(frame, monkeypatch, most):
    """Both ways, bounds joined by key and broadcast, against sorted lists."""
    monkeypatch.setattr(q, "_BROADCAST_BOUNDS", most)
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([0.0, 1.5, rng.gauss(0, 9), None]), rng.choice([1, None, rng.randrange(5000)]))
            for _ in range(3000)]
    want = {}
    for g in ("hot", "a", "b", None):
        for n, field in enumerate(("v", "w"), 1):
            own = sorted(float(r[n]) for r in rows if r[0] == g and r[n] is not None)
            want[g, field] = (own[0], own[len(own) // 2], own[-1], len(own))
    got = q.numeric_profile(frame(rows, "g string, v double, w int"), ["g"]).collect()
    assert {(r.g, r.field): (r["min"], r["median"], r["max"], r.n) for r in got} == want and len(got) == len(want)


def test_compare_and_reconcile(frame):
    old = frame([("a", 1), ("b", 2)], "k string, v bigint")
    new = frame([("a", 5), ("c", 2), ("c", 1)], "k string, v bigint")
    got = rows_of(q.compare_full(old, new, ["k"], ["v"]))
    assert got == sorted([("a", 1, 5, 1, 1), ("b", None, None, 1, 2), ("c", 2, 3, None, None)], key=str)
    same = q.reconcile(old.withColumn("t", F.lit("x")), new.withColumn("t", F.lit("x")), ["t", "k"], "v", ["t"])
    assert rows_of(same) == [("x", 1, 1)]


def test_truth_totals_skip_missing_days(frame):
    truth = frame([(1, 100), (2, 0), (3, 50)], "d int, u bigint")
    seen = frame([(1, 110), (2, 5)], "d int, users bigint")
    compared = q.versus_truth(truth, {"new": seen}, ["d"], {"u": "users"})
    assert [r.new_users_pct for r in compared.orderBy("d").collect()] == [10.0, None, None]
    total = q.truth_totals(compared, "new", {"u": "users"}).first()
    assert (total.days, total.u, total.users, total.users_pct) == (2, 100, 115, 15.0)


def test_fill_coverage_freshness(frame):
    df = frame([("x", "", 0, D(2026, 1, 1)), ("x", "v", 3, None), ("y", None, None, D(2026, 2, 1))],
               "g string, t string, clicks int, d date")
    assert rows_of(q.fill_rate(df, ["g"])) == sorted([
        ("x", "t", 1), ("x", "clicks", 2), ("x", "d", 1), ("y", "d", 1)], key=str)
    assert rows_of(q.metric_coverage(df, ["click"])) == [(3, 1)]
    row = q.freshness({"t": df}).first()
    assert (row.table, row.max_date, row.row_count) == ("t", D(2026, 2, 1), 3)


def test_schema_tools(frame):
    df = frame([(1, "a", D(2026, 1, 1))], "page_followers int, follower_name string, d date")
    assert q.find_columns({"t": df, "u": frame([(1,)], "x int")}, "follow") == {"t": ["page_followers"]}
    assert [tuple(r) for r in q.schema_rows({"t": df}).collect()][0] == ("t", 1, "page_followers", "int")


def test_declared_tests(frame):
    df = frame([("Email", "a"), ("Form", None), ("Other", "b"), (None, "c")], "type string, name string")
    got = q.run_tests(df, [q.NotNull("type"), q.Accepted("type", ("Email", "Form")), q.NotNull("name")])
    assert rows_of(got) == [("accepted_values", "type", 1), ("not_null", "name", 1), ("not_null", "type", 1)]
    assert q.expect_in(df, "type", ["Email"]).first().failures == 2
    assert q.expect_not_null(df, ["name"]).first().failures == 1


def test_duplicate_days(frame):
    df = frame([(1, "p", "a", 2), (1, "p", "a", 3), (1, "q", "a", 1), (2, "p", "b", 1)],
               "day int, prop string, dim string, users bigint")
    assert rows_of(q.duplicate_days(df, "day", ["prop"], "dim", ["users"])) == [(1, 3, 1, 2, 6), (2, 1, 1, 0, 1)]

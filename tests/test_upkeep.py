"""Comparison by checksums, sketches of days, answers from footers, and scratch folders that go."""

import datetime as dt
import os
import random
from collections import Counter

import pytest

from tidemark.registry import QUERIES
from tidemark.session import scratch_path, scratch_scope, shared_dir, stored, sweep_scratch
from tidemark.sources import checksums, sketches
from tidemark.sources.checksums import differing_ranges, differing_rows, read_ranges, write_summed
from tidemark.sources.footers import footer_bounds, footer_session

from .conftest import rows_of

SCHEMA = "k string, v int, note string"


def brute(left, right):
    a, b = Counter(left), Counter(right)
    return sorted(((*r, a[r], b[r]) for r in set(a) | set(b) if a[r] != b[r]), key=str)


@pytest.fixture
def pair(frame, tmp_path):
    """Writes two tables and gives their roots."""
    made = iter(range(100))

    def make(left, right, levels=3):
        roots = [str(tmp_path / f"t{next(made)}") for _ in range(2)]
        for root, rows in zip(roots, (left, right)):
            write_summed(frame(rows, SCHEMA), root, ["k"], levels)
        return roots
    return make


def test_finds_the_rows_that_differ_and_reads_few_ranges(spark, pair):
    rng = random.Random(4)
    left = [(str(i), rng.randrange(9), "x") for i in range(3000)]
    right = [r for r in left if r[0] != "17"] + [("new", 1, None)]
    right[40] = (right[40][0], -1, "x")
    one, two = pair(left, right)
    found = differing_ranges(spark, one, two)
    assert len(found.looked_at) == 3 and max(found.looked_at) <= 48 and 1 <= len(found.ranges) <= 3
    assert read_ranges(spark, one, found.ranges).count() < 30
    assert rows_of(differing_rows(spark, one, two)) == brute(left, right)
    # alike in another order: nothing below the top is looked at, no row is read
    one, two = pair(left, left[::-1])
    assert differing_ranges(spark, one, two) == checksums.Descent((16,), ())
    assert differing_rows(spark, one, two).count() == 0


def test_random_pairs_nulls_copies_and_a_hot_key(spark, pair):
    for seed in range(4):
        rng = random.Random(seed)
        keys = ["hot"] * 30 + [None, "", *map(str, range(20))]
        left = [(rng.choice(keys), rng.choice([None, 0, 1]), rng.choice([None, "", "a"])) for _ in range(200)]
        right = [r if rng.random() > .05 else (r[0], 7 if r[2] else None, r[2]) for r in left if rng.random() > .03]
        one, two = pair(left, right, levels=2)
        assert rows_of(differing_rows(spark, one, two)) == brute(left, right)
    # a value that moved to the next column is another row
    one, two = pair([("k", None, "1")], [("k", 1, None)])
    assert differing_rows(spark, one, two).count() == 2


def test_more_differences_than_the_driver_follows(spark, pair):
    left = [(str(i), 0, "x") for i in range(600)]
    one, two = pair(left, [(k, 1, n) for k, _, n in left])
    found = differing_ranges(spark, one, two, most=16)
    assert found.looked_at == (16, 256) and found.ranges == ((0, (1 << 63) - 1), (-(1 << 63), -1))
    assert differing_rows(spark, one, two, most=16).count() == 1200


def test_empty_tables_and_refusals(spark, frame, pair, tmp_path):
    one, two = pair([], [("a", 1, "b")])
    assert rows_of(differing_rows(spark, one, two)) == [("a", 1, "b", 0, 1)]
    assert differing_rows(spark, *pair([], [])).count() == 0
    deep = str(tmp_path / "deep")
    write_summed(frame([("a", 1, "b")], SCHEMA), deep, ["k"], 4)
    with pytest.raises(ValueError, match="depth"):
        differing_ranges(spark, two, deep)
    with pytest.raises(ValueError, match="positions"):
        write_summed(frame([("a", 1)], "k string, _at int"), str(tmp_path / "x"), ["k"])
    other = str(tmp_path / "other")
    write_summed(frame([("a", 1.5)], "k string, v double"), other, ["k"], 3)
    with pytest.raises(ValueError, match="columns"):
        differing_rows(spark, two, other)


def test_ranges_reach_the_scan(spark, pair):
    one, two = pair([(str(i), 0, "x") for i in range(50)], [(str(i), 0, "x") for i in range(49)])
    plan = read_ranges(spark, one, differing_ranges(spark, one, two).ranges)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_at" in plan.split("PushedFilters")[1]


# --- sketches ---------------------------------------------------------------

DAY = [dt.date(2026, 1, i) for i in range(1, 16)]


def test_spans_of_sketches_stay_in_their_bound(spark, frame, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice(DAY), rng.choice("ab"), rng.randrange(6000) if rng.random() > .01 else None) for _ in range(20000)]
    rows.append((DAY[3], "none", None))
    root = str(tmp_path / "sketch")
    df = stored(frame(rows, "date date, kind string, user int"), "rows")
    sketches.sketch_days(df, root, ["kind"], "user", DAY[:9])
    sketches.sketch_days(df, root, ["kind"], "user", DAY[8:])      # one day again, the rest new
    args = {"span": 7, "first": DAY[2], "last": DAY[-1]}
    guess = {(r.until, r.kind): r.n_distinct for r in sketches.rolling_distinct(spark, root, ["kind"], **args).collect()}
    exact = {(r.until, r.kind): r.n_distinct for r in sketches.rolling_exact(df, ["kind"], "user", **args).collect()}
    want = {}
    for end in DAY[2:]:
        for kind in ("a", "b", "none"):
            inside = [u for d, k, u in rows if k == kind and end - dt.timedelta(days=6) <= d <= end]
            if inside:
                want[end, kind] = len({u for u in inside if u is not None})
    assert exact == want and guess.keys() == want.keys()
    assert all(abs(guess[k] - n) <= n * sketches.error_bound(sigmas=4) for k, n in want.items())
    assert max(abs(guess[k] - n) / n for k, n in want.items() if n) > 0         # an estimate, and its error measured
    assert sketches.rolling_distinct(spark, str(tmp_path / "no"), ["kind"], **args) is None


def test_a_span_reads_its_days_alone(spark, frame, tmp_path):
    root = str(tmp_path / "sketch")
    sketches.sketch_days(frame([(d, 1.5) for d in DAY], "date date, x double"), root, [], "x", DAY)
    out = sketches.rolling_distinct(spark, root, [], 2, DAY[5], DAY[6])
    assert rows_of(out, "until", "n_distinct") == [(DAY[5], 1), (DAY[6], 1)]
    assert len({os.path.dirname(f) for f in out.inputFiles()}) == 3


# --- footers ----------------------------------------------------------------

def test_bounds_come_from_footers(spark, frame, tmp_path):
    path, empty = str(tmp_path / "t"), str(tmp_path / "e")
    frame([(DAY[3], 5, "x"), (None, 2, "y"), (DAY[1], None, None)], "day date, n int, s string").repartition(3).write.parquet(path)
    frame([], "day date").write.parquet(empty)
    out = footer_bounds(spark, {"t": (path, "day"), "n": (path, "n"), "e": (empty, "day"), "c": (path, None)})
    assert rows_of(out) == [("c", None, None, 3), ("e", None, None, 0), ("n", "2", "5", 3), ("t", str(DAY[1]), str(DAY[3]), 3)]
    plan = footer_bounds(spark, {"t": (path, "day")})._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(day), MAX(day)]" in plan
    with pytest.raises(ValueError, match="bounds"):
        footer_bounds(spark, {"t": (path, "s")})


def test_the_callers_settings_stay(spark):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    side = footer_session(spark)
    assert "parquet" not in side.conf.get("spark.sql.sources.useV1SourceList")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


# --- scratch ----------------------------------------------------------------

def test_scratch_is_empty_after_a_result_is_written(spark, tmp_path):
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as made:
            QUERIES["upsert_plan"](spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "out"))
            QUERIES["localised_diff"](spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "diff"))
            assert made and set(os.listdir(folder)) - before
        assert outer == made and set(os.listdir(folder)) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        stored(spark.range(3), "failed")
        1 / 0
    assert set(os.listdir(folder)) == before


def test_sweep_takes_old_scratch_only(spark):
    folder = shared_dir(spark).removeprefix("file:")
    old, new = (scratch_path(spark, n) for n in ("old", "new"))
    own = f"{folder}/kept-by-a-user"
    for p in (old, new, own):
        os.makedirs(p.removeprefix("file:"), exist_ok=True)
    for p in (old, own):
        os.utime(p.removeprefix("file:"), (1, 1))
    assert old.rpartition("/")[2] in (swept := sweep_scratch(spark, 24)) and new.rpartition("/")[2] not in swept
    assert os.path.isdir(own) and os.path.isdir(new.removeprefix("file:")) and not os.path.isdir(old.removeprefix("file:"))

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions.cells import SinkField
from tidemark.operators.sync import (apply_plan, create_missing, dropped_fields, duplicate_counts,
                                     duplicate_diff, fetched, fit_to_sink, replace_stats, split_duplicates,
                                     sync_key, sync_stats, upsert_plan)
from tidemark.plans import dashboard
from tidemark.plans.dashboard import grid_records, sync_records
from tidemark.sources import tables

from .conftest import rows_of

SOURCE = "source_order bigint, k string, a string, n bigint"
TARGET = "id string, seq bigint, k string, a string, n bigint, extra string"


def test_key_is_trimmed_lowered_and_flat(frame):
    df = frame([(" Ab ", ["X", "y"], None, 1e7)], "a string, l array<string>, z string, d double")
    got = df.select(sync_key(df, ["a", "l", "z", "d", "absent"]).alias("k")).first().k
    assert tuple(got) == ("ab", "x,y", "", "10000000.0", "")


def test_split_keeps_the_last_in_fetch_order(frame):
    target = frame([("r1", 1, "A", 1), ("r2", 2, "a ", 2), ("r3", 3, "b", 3), ("r4", 4, " a", 4)],
                   "id string, seq bigint, k string, v int")
    kept, extra = split_duplicates(target, ["k"])
    assert rows_of(kept, "id") == [("r3",), ("r4",)] and rows_of(extra, "id") == [("r1",), ("r2",)]
    assert tuple(duplicate_counts(target, ["k"]).first()) == (4, 2, 2, 2)


def test_order_columns_are_required(frame):
    with pytest.raises(ValueError, match="lacks"):
        upsert_plan(frame([("x",)], "k string"), frame([("r", 1, "x")], "id string, seq int, k string"), ["k"])


def test_null_never_clears_and_text_is_compared(frame):
    target = frame([("r1", 1, "x", "old", 1, "e"), ("r2", 2, "y", None, None, "e"), ("r3", 3, "z", "same ", 5, "e")],
                   TARGET)
    source = frame([(1, "X ", None, None), (2, "y", "set", None), (3, "z", "same", 5)], SOURCE)
    plan = upsert_plan(source, target, ["k"])
    got = {r.source_order: r.action for r in plan.collect()}
    assert got == {1: "update", 2: "update", 3: "skip"}       # the key field itself differs for 1
    after = {r.id: (r.k, r.a, r.n, r.extra) for r in apply_plan(target, plan).collect()}
    assert after == {"r1": ("X ", "old", 1, "e"), "r2": ("y", "set", None, "e"), "r3": ("z", "same ", 5, "e")}


def test_long_and_double_show_different_text(frame):
    source = frame([(1, "x", 1)], "source_order bigint, k string, v bigint")
    target = frame([("r", 1, "x", 1.0)], "id string, seq bigint, k string, v double")
    assert upsert_plan(source, target, ["k"]).first().action == "update"
    big = frame([(1, "x", "10000000.0")], "source_order bigint, k string, v string")
    full = frame([("r", 1, "x", 1e7)], "id string, seq bigint, k string, v double")
    assert upsert_plan(big, full, ["k"]).first().action == "skip"


def brute(source, target):
    """One pass over the records, as a sync with a dictionary would do it."""
    def key(k):
        return (k or "").strip().lower()
    kept, extra = {}, []
    for rec in sorted(target, key=lambda r: r[1]):
        if key(rec[2]) in kept:
            extra.append(kept[key(rec[2])][0])
        kept[key(rec[2])] = rec
    actions = []
    for order, *fields in sorted(source):
        match = kept.pop(key(fields[0]), None)
        if match is None:
            actions.append(("create", None, order))
            continue
        changed = any(v is not None and (old is None or str(v).strip() != str(old).strip())
                      for v, old in zip(fields, match[2:5]))
        actions.append(("update" if changed else "skip", match[0], order))
    actions += [("stale", rec[0], None) for rec in kept.values()]
    actions += [("duplicate", i, None) for i in extra]
    return sorted(actions, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_plan_against_brute_force(frame, seed):
    rnd = random.Random(seed)
    names = [None, "", "a", " A", "b", "B ", "c", "d", "e"]
    source = [(i, rnd.choice(names), rnd.choice([None, "x", "x ", "y"]), rnd.choice([None, 1, 2]))
              for i in rnd.sample(range(1000), 60)]
    target = [(f"r{i}", i, rnd.choice(names), rnd.choice([None, "x", "y"]), rnd.choice([None, 1, 2]), "e")
              for i in rnd.sample(range(1000), 30)]
    plan = upsert_plan(frame(source, SOURCE), frame(target, TARGET), ["k"])
    want = brute(source, target)
    assert rows_of(plan, "action", "id", "source_order") == want
    counts = Counter(a for a, *_ in want)
    stats = sync_stats(plan, prune=True, dedupe=True).first()
    assert tuple(stats) == (60, counts["create"], counts["update"], counts["skip"],
                            counts["duplicate"], counts["stale"])
    assert stats.created + stats.updated + stats.skipped == stats.rows_read
    # every mix of prune and dedupe leaves the right records
    for prune in (False, True):
        for dedupe in (False, True):
            after = apply_plan(frame(target, TARGET), plan, prune, dedupe, run_id="n")
            gone = {i for a, i, _ in want if (a == "stale" and prune) or (a == "duplicate" and dedupe)}
            made = {f"n:{o}" for a, _, o in want if a == "create"}
            assert {r.id for r in after.collect()} == ({r[0] for r in target} - gone) | made


def test_a_hot_key_is_planned_whole(spark):
    source = spark.range(3000).select(F.col("id").alias("source_order"), F.lit("").alias("k"), F.lit("v").alias("a"))
    target = spark.range(2000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"),
                                      F.col("id").alias("seq"), F.lit(" ").alias("k"), F.lit("v").alias("a"))
    stats = sync_stats(upsert_plan(source, target, ["k"]), dedupe=True).first()
    assert tuple(stats) == (3000, 2999, 0, 1, 1999, 0) or tuple(stats) == (3000, 2999, 1, 0, 1999, 0)


def test_wide_records_plan_quickly(spark):
    """Many fields must not blow up the optimizer."""
    cols = [F.col("id").cast("string").alias(f"c{i}") for i in range(30)]
    source = spark.range(5).select(F.col("id").alias("source_order"), *cols)
    target = spark.range(5).select(F.col("id").cast("string").alias("id"), F.col("id").alias("seq"), *cols)
    plan = upsert_plan(source, target, ["c0"])
    assert apply_plan(target, plan, True, True).count() == 5


def test_duplicate_diff(frame):
    target = frame([("r1", 1, "k", "x", 1, "t1"), ("r2", 2, "k", "y", 1, "t2"), ("r3", 3, "K", "x", None, "t3"),
                    ("r4", 4, "k", "x", 2, "t4"), ("r5", 5, "z", "q", 9, "t5")],
                   "id string, seq bigint, k string, a string, n bigint, created_time string")
    got = rows_of(duplicate_diff(target, ["k"]))
    assert got == sorted([("a", 1, "k", "y", "x"), ("k", 1, "k", "K", "k"), ("n", 3, "k", "1", "2")], key=str)


def test_sink_schema(frame):
    schema = [SinkField("a", "text"), SinkField("n", "number")]
    df = frame([(1, "x", 2, "u")], "source_order bigint, a string, n int, unknown string")
    assert fit_to_sink(df, schema, ["n"], ["source_order"]).columns == ["source_order", "a"]
    assert dropped_fields(df, schema, ["source_order"]) == ["unknown"]
    wider, fields = create_missing(df, schema, {"n": 0, "v": 1, "w": 0})
    assert [f.name for f in fields] == ["a", "n", "v", "w"]
    assert dict(wider.dtypes)["v"] == "double" and dict(wider.dtypes)["w"] == "bigint"


def test_grid_sync(frame):
    grid = frame([(1, " 1,000 ", "45%", "3/5/2026", "12"), (2, "2", "$3", "soon", "")],
                 "source_order bigint, key string, rate string, day string, note string")
    schema = [SinkField("key", "number"), SinkField("rate", "number", 2), SinkField("day", "date"), SinkField("note", "text")]
    got = [tuple(r) for r in grid_records(grid, schema).orderBy("source_order").collect()]
    assert got == [(1, 1000, 0.45, "2026-03-05", "12"), (2, 2, 3.0, "soon", None)]
    target = frame([("r", 1, 1000, 0.45, "2026-03-05", "12")],
                   "id string, seq bigint, key bigint, rate double, day string, note string")
    done = sync_records(grid_records(grid, schema), target, ["key"], schema)
    assert tuple(done.stats.first()) == (2, 1, 0, 1, 0, 0)


def test_replace_and_pointers(spark, frame, tmp_path):
    root = str(tmp_path / "copy")
    assert tables.current(spark, root) is None
    tables.replace(frame([(1,), (2,)], "v int"), root, "1")
    tables.replace(tables.current(spark, root).filter("v = 2"), root, "2")
    assert rows_of(tables.current(spark, root)) == [(2,)]
    stats = replace_stats(frame([(1,), (2,)], "v int"), frame([(3,)], "v int")).first()
    assert stats.asDict() == {"rows_read": 1, "deleted": 2, "created": 1}


@pytest.mark.parametrize("parts", [1, 7, 211])
def test_order_numbers_do_not_depend_on_partitions(spark, frame, parts):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, "x", "Y"]), rng.randrange(4)) for _ in range(120)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = frame(rows, "k string, a string, n bigint").repartition(parts)
        got = {(r.source_order, r.k, r.a, r.n) for r in dashboard.ordered(df, ["n", "k"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")

    def nulls_first(v):
        return (v is not None, v or "")
    want = sorted(rows, key=lambda r: (r[2], nulls_first(r[0]), nulls_first(r[1])))
    assert got == {(i, *r) for i, r in enumerate(want)}


def test_created_records_are_fetched_in_the_order_of_their_numbers(frame):
    snapshot = frame([("t1", 5), ("new:9", None), ("new:10", None), ("t2", 2)], "id string, seq bigint")
    assert rows_of(fetched(snapshot), "id", "seq") == [("new:10", 16), ("new:9", 15), ("t1", 5), ("t2", 2)]
    kept, _ = split_duplicates(fetched(snapshot).withColumn("k", F.lit("same")), ["k"])
    assert rows_of(kept, "id") == [("new:10",)]
    assert fetched(frame([("new:0", None)], "id string, seq bigint")).first().seq == 0

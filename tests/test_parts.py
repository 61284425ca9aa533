"""Stored parts: incremental snapshots and daily rebuilds equal the full ones and read only what changed."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.sources import parts
from tidemark.sources.parts import (changed_days, current_parts, expire_days, merge_latest, read_parts,
                                    rebuild_days, replace_parts, vacuum_parts)

from .conftest import rows_of

LOG = "k string, t int, v string"


def test_random_batches_give_the_full_snapshot(frame, spark, tmp_path):
    rng = random.Random(6)
    every, root = [], str(tmp_path / "snap")
    for _ in range(4):
        batch = [(rng.choice(["a", "b", "c", None, *map(str, range(60))]), rng.randrange(9), rng.choice("xyz")) for _ in range(25)]
        every += batch
        before = current_parts(spark, root)[0]
        done = merge_latest(frame(batch, LOG), root, ["k"], ["t"], ["v"], buckets=16)
        after = current_parts(spark, root)[0]
        # only buckets with a key of the batch are read and written
        hit = {str(r.b) for r in frame(batch, LOG).select(parts.bucket_of(["k"], 16).alias("b")).distinct().collect()}
        assert set(done.buckets) == hit and set(done.read) == {before[b] for b in hit if b in before}
        assert all(after[b] == before[b] for b in before if b not in hit) and all(after[b] != before.get(b) for b in hit)
        full = latest_per_key(frame(every, LOG), ["k"], ["t"], ["v"])
        assert rows_of(read_parts(spark, root), "k", "t", "v") == rows_of(full, "k", "t", "v")
    one = merge_latest(frame([("a", 99, "z")], LOG), root, ["k"], ["t"], ["v"], buckets=16)
    assert len(one.buckets) == len(one.read) == 1
    assert merge_latest(frame([], LOG), root, ["k"], ["t"], ["v"], buckets=16).buckets == ()
    assert rows_of(read_parts(spark, root, one.buckets).where("k = 'a'"), "t") == [(99,)]
    with pytest.raises(ValueError, match="batch"):
        merge_latest(frame([("a", 1)], "k string, t int"), root, ["k"], ["t"])


def test_a_dead_write_changes_nothing_and_is_swept(frame, spark, tmp_path, monkeypatch):
    root = str(tmp_path / "snap")
    merge_latest(frame([("a", 1, "x"), ("b", 1, "x")], LOG), root, ["k"], ["t"], buckets=4)

    def die(*_):
        raise SystemExit("killed")
    with monkeypatch.context() as m:
        m.setattr(parts, "publish", die)
        with pytest.raises(SystemExit):
            merge_latest(frame([("a", 2, "y")], LOG), root, ["k"], ["t"], buckets=4)
    assert rows_of(read_parts(spark, root), "k", "t") == [("a", 1), ("b", 1)]
    merge_latest(frame([("a", 3, "z")], LOG), root, ["k"], ["t"], buckets=4)
    assert len(vacuum_parts(spark, root)) == 2           # the dead write, and the bucket that was replaced
    assert rows_of(read_parts(spark, root), "k", "t") == [("a", 3), ("b", 1)]
    assert vacuum_parts(spark, root) == []


def days_model(calls):
    def build(sales):
        calls.append(sales)
        return sales.groupBy("date", "shop").agg(F.sum("n").alias("n"))
    return build


def test_only_changed_days_are_built_again(frame, spark, tmp_path):
    day = [dt.date(2026, 1, i) for i in range(1, 9)]
    rng = random.Random(2)
    rows = [(rng.choice(day), rng.choice("ab"), rng.randrange(9)) for _ in range(200)]
    path, root, calls = str(tmp_path / "sales"), str(tmp_path / "model"), []
    schema = "date date, shop string, n int"
    frame(rows, schema).write.partitionBy("date").parquet(path)

    def source():
        return {"sales": spark.read.schema("shop string, n int, date date").parquet(path)}
    rebuild_days(days_model(calls), source(), day, root)
    before = current_parts(spark, root)[0]
    # two days are delivered again, one of them without rows
    late = frame([(day[2], "c", 100)], schema)
    late.write.mode("append").partitionBy("date").parquet(path)
    changed = changed_days([late])
    assert changed == [day[2]] and changed_days([late.limit(0)]) == []
    rebuild_days(days_model(calls), source(), changed, root)
    after = current_parts(spark, root)[0]
    assert [d for d in after if after[d] != before.get(d)] == [str(day[2])]
    full = days_model([])(**source())
    assert rows_of(read_parts(spark, root), "date", "shop", "n") == rows_of(full, "date", "shop", "n")
    # the scan reads the partition of that day alone
    plan = calls[-1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2026-01-03" in plan
    # a day of which nothing is left
    none = {"sales": source()["sales"].where(F.col("date") != F.lit(day[4]))}
    rebuild_days(days_model(calls), none, [day[4]], root)
    assert read_parts(spark, root).where(F.col("date") == F.lit(day[4])).count() == 0
    assert expire_days(spark, root, day[3]) == [str(x) for x in day[:3]]
    assert read_parts(spark, root).agg(F.min("date")).first()[0] == day[3]
    assert rebuild_days(days_model(calls), source(), [], root) == []


def test_parts_before_the_first_commit(frame, spark, tmp_path):
    root = str(tmp_path / "none")
    assert read_parts(spark, root) is None and current_parts(spark, root) == ({}, None) and vacuum_parts(spark, root) == []
    replace_parts(frame([], "d string, n int"), root, F.col("d"), ["x"])
    assert read_parts(spark, root).count() == 0

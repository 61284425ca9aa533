"""Dense numbers and running values do not depend on partitions, and a hot key is cut."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordering import dense_numbers, running, sorted_parts
from tidemark.session import discard, stored


@pytest.fixture
def numbers(frame):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(50)) for _ in range(400)] + [("hot", 7)] * 300
    rng.shuffle(rows)
    return frame(rows, "k string, v int")


@pytest.mark.parametrize("parts", [1, 7, 211])
def test_numbers_are_those_of_the_order(spark, numbers, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = dense_numbers(numbers.repartition(parts), ["k", "v"], "n").orderBy("n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert [r.n for r in got] == list(range(700))
    want = sorted(((r.k, r.v) for r in numbers.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r.k, r.v) for r in got] == want


def test_empty_tables_and_start(frame):
    assert dense_numbers(frame([], "v int"), ["v"], "n").collect() == []
    assert [r.n for r in dense_numbers(frame([(5,), (6,)], "v int"), [F.col("v").desc()], "n", 1).orderBy("v").collect()] == [2, 1]


def test_equal_rows_are_cut_between_partitions(spark, frame):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        sizes = [r["count"] for r in sorted_parts(frame([(1, "x")] * 800, "a int, b string"), ["a", "b"]).groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(sizes) > 4 and max(sizes) < 400


@pytest.mark.parametrize("parts", [1, 16])
def test_running_values_cross_partitions(spark, frame, parts):
    rng = random.Random(5)
    rows = [(k, i, rng.randrange(1 << 40)) for k in ("a", "b") for i in range(30)] + [("hot", i, rng.randrange(1 << 40)) for i in range(900)]
    df = frame(rows, "k string, i int, v bigint")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = running(df, ["k"], ["i"], {"n": ("count", "v"), "s": ("sum", "v"), "x": ("bit_xor", "v")}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(got) == len(rows)
    state = {}
    want = {}
    for k, i, v in sorted(rows):
        n, s, x = state.get(k, (0, 0, 0))
        state[k] = want[k, i] = (n + 1, s + v, x ^ v)
    assert {(r.k, r.i): (r.n, r.s, r.x) for r in got} == want


def test_discard_removes_a_stored_frame(frame):
    import os
    kept = stored(frame([(1,)], "v int"), "kept")
    path = kept.stored_at.removeprefix("file:")
    assert os.path.isdir(path)
    discard(kept, frame([(1,)], "v int"))
    assert not os.path.exists(path)

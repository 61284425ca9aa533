"""The prefix trie and tree contraction against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import contraction, prefixes

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_totals(rows):
    """rows: (node, parent, a, b)"""
    parent = {r[0]: r[1] for r in rows}
    out = {r[0]: [0, 0] for r in rows}
    for node, _, a, b in rows:
        at = node
        while at is not None:
            out[at][0] += a
            out[at][1] += b
            at = parent[at]
    return {(n, *v) for n, v in out.items()}


def shapes():
    rng = random.Random(9)
    yield "chain", [(i, i - 1 if i else None, 1, i) for i in range(70)]
    yield "star", [(i, 0 if i else None, 1, i) for i in range(120)]
    yield "random", [(i, rng.randrange(i) if i else None, rng.randrange(9), 1) for i in range(300)]
    yield "late", [(i, max(0, i - 1 - rng.randrange(3)) if i else None, 1, rng.randrange(5)) for i in range(250)]
    yield "forest", [(1, None, 5, 6), (2, None, 7, 8), (3, 2, 1, 1)]
    yield "one", [(1, None, 5, 6)]


@pytest.mark.parametrize("rows", [r for _, r in shapes()], ids=[n for n, _ in shapes()])
def test_subtree_totals(frame, rows):
    shuffled = random.Random(1).sample(rows, len(rows))
    got = contraction.subtree_totals(frame(shuffled, "node bigint, parent bigint, a bigint, b bigint"), ["a", "b"]).collect()
    assert {tuple(r) for r in got} == brute_totals(rows) and len(got) == len(rows)


def test_a_chain_takes_one_round(frame, monkeypatch):
    """Pointer doubling takes the whole chain out at once, with a number of joins that grows as the logarithm."""
    steps = []
    stored = contraction.stored
    monkeypatch.setattr(contraction, "stored", lambda df, name: (steps.append(name), stored(df, name))[1])
    rows = [(i, i - 1 if i else None, 1, 1) for i in range(400)]
    contraction.subtree_totals(frame(rows, "node bigint, parent bigint, a bigint, b bigint"), ["a", "b"]).collect()
    assert Counter(steps)["state"] == 1 and Counter(steps)["ways"] <= 11


def test_no_tree(frame):
    assert contraction.subtree_totals(frame([], "node bigint, parent bigint, a bigint"), ["a"]).collect() == []


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs[c].append((role or "", text or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = (convs[c - c % 20][:h] if c - c % 20 in convs else []) + convs[c][h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
        ends[tuple(rebuilt)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * words
    return Counter((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def found(df):
    assert set(COLUMNS) <= set(df.columns)
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


def test_random_conversations(spark, frame):
    rng = random.Random(4)
    rows = [(rng.randrange(70), rng.choice([None, *range(9)]), rng.choice([None, "user", "assistant"]),
             rng.choice([None, "", "hi", "a  b\tc", "ä b"])) for _ in range(500)]
    rows += [(c, t, "user", "same text") for c in range(100, 140) for t in range(6)]          # a group of copies
    rows += [(201, t, "user", f"long {t}") for t in range(150)]                            # one long conversation
    rows += [(None, 0, "user", "nobody's")]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        df = frame(rows, TURNS).withColumn("node", F.lit("clash")).withColumn("place", F.lit(1)).repartition(5)
        assert found(prefixes.conversation_trie(df)) == brute_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_turnless_and_empty(frame):
    short = next(c for c in range(20, 200) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20)
    rows = [(short, 0, "user", "gone"), (short, 0, "user", "gone")]          # repeated rows; no donor: nothing is left
    assert found(prefixes.conversation_trie(frame(rows, TURNS))) == brute_trie(rows) == Counter(
        [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())])
    assert prefixes.conversation_trie(frame([], TURNS)).collect() == []
    assert prefixes.conversation_trie(frame([(None, 1, "user", "x")], TURNS)).collect() == []


def test_long_texts_and_negative_ids(frame):
    rows = [(-7, 0, "user", "w " * 200_000), (-7, 1, "assistant", None), (-27, 0, "user", "x"), (0, 0, None, "start")]
    got = found(prefixes.conversation_trie(frame(rows, TURNS)))
    assert sum(n for r, n in got.items() if r[1] == 0) == 1
    root = next(r for r in got if r[1] == 0)
    assert root[0] == -27 and root[3] == 3


def test_digests_of_many_ids(frame, monkeypatch):
    monkeypatch.setattr(prefixes, "CHUNK_IDS", 7)
    ends = frame([(c,) for c in range(1000)], "conv_id bigint").select(
        prefixes._key(F.lit(1), (F.col("conv_id") % 2).cast("bigint"), F.lit(3).cast("bigint")).alias("node"), "conv_id")
    got = {r.node.one: r.ends_sha256 for r in prefixes.ends_digests(ends.repartition(9)).collect()}
    assert got == {k: hashlib.sha256(",".join(str(c) for c in range(k, 1000, 2)).encode()).hexdigest() for k in (0, 1)}

"""SimHash near duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for gap in "\t\n\v\f\r":
        words = words.replace(gap, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """Smallest position reachable, over all pairs."""
    values = np.array(fps, dtype=np.uint64)
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3).tolist():
            a, b = root(i), root(j)
            label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_query_is_brute_force_on_the_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    ids = sorted(docs)
    fps = [plain_fingerprint(docs[i]) for i in ids]
    comps = plain_components(fps)
    want = {(i, f"{f:016x}", ids[c]) for i, f, c in zip(ids, fps, comps)}
    rows = QUERIES["op13_simhash_near_dedup"](spark, FOLDER).collect()
    assert {tuple(r) for r in rows} == want and len(rows) == len(ids)


def test_spark_hashes_the_shingles_alike(spark, frame):
    texts = ["a b c", "é ü ß", "x" * 40 + " y " + "z" * 33, "one"]
    native = [r.h % (1 << 64) for r in frame([(t,) for t in texts], "t string").select(F.xxhash64("t").alias("h")).collect()]
    assert native == [int(simhash.shingle_hashes(t.encode())[0]) for t in texts]


@pytest.mark.parametrize("large", [2, 8, 2048])
def test_links_of_crowded_balls(spark, frame, large):
    """Near copies by the hundred around a few centres; buckets are cut down to their last bits."""
    rng = random.Random(11)
    fps = set()
    for centre in [rng.getrandbits(64) for _ in range(4)] + [0]:
        for _ in range(150):
            f = centre
            for k in rng.sample(range(64), rng.randrange(0, 7)):
                f ^= 1 << k
            fps.add(f)
    fps |= {rng.getrandbits(32) << 32 | 77 for _ in range(60)}          # one half in common, far apart in the other
    fps = sorted(fps)
    rng.shuffle(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = [tuple(r) for r in simhash.fingerprint_links(frame([(s,) for s in signed], "fp bigint"), large).collect()]
    assert all(bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3 for a, b in links)
    place = {s: i for i, s in enumerate(signed)}
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        x, y = root(place[a]), root(place[b])
        label[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(fps))] == plain_components(fps)


def test_a_crowded_bucket_gives_links_in_proportion():
    values = np.array([1 << i | 1 << j for i in range(32) for j in range(i)], dtype=np.uint64)
    a, b = simhash.spanning_links(np.append(values, np.uint64(0)))
    assert len(a) == len(values)
    assert (np.bitwise_count(a ^ b) <= 3).all()


def test_odd_rows(spark, frame):
    long = " ".join(f"w{i % 997}" for i in range(300_000))
    rows = [(1, None, "x"), (2, "", "y"), (3, " \n", None), (4, "A  b\tC", "s"), (4, "a b c", "s"), (None, "a b c", "t"),
            (5, long, "u"), (6, long + " end", "u"), (7, "two words", "u")]
    docs = frame(rows, "doc_id bigint, text string, fp string").withColumn("component_id", F.lit("clash"))
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    found = sorted(((r.doc_id, r.component_id) for r in got.collect()), key=str)
    assert found == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (None, 4), (5, 5), (6, 5), (7, 7)], key=str)
    assert {r.fingerprint for r in got.where("doc_id < 4").collect()} == {"0" * 16}
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    alone = simhash.near_duplicates(frame([(None, "a b c d", 1)], "doc_id bigint, text string, z int")).collect()
    assert [r.component_id for r in alone] == [None]
    kept = simhash.fingerprints(docs.withColumn("simhash", F.lit("old")))
    assert kept.columns == [*docs.columns, "simhash"] and dict(kept.dtypes)["simhash"] == "bigint"

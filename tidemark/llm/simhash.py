"""SimHash near duplicates by multi-index hashing.

A fingerprint has a bit for each of the 64 bits of the shingles' hashes: 1 if it is set in over half of them.
Two fingerprints link at ``RADIUS`` = 3 or fewer differing bits.  Of two linked fingerprints one
half of 32 bits differs in at most one bit, so each fingerprint is entered in a table under the
value of either half, and asks for all values in the ball of radius one around it.  One of
two values a bit apart has a 0 where the other has a 1: only zeros are flipped in asking.
What meets under a value is a bucket; full distances are verified inside it.

A bucket gives a spanning forest of its links, not all of them: components are the same and a
group of near copies costs no more links than it has members.  A bucket of more than
``LARGE`` fingerprints is cut by the same rule on the half that may still differ: one of its halves
differs in at most one bit.  Again and again, until the part left free is too narrow for many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import extended
from .components import connected_components

WIDTH = 3
SEED = 42
RADIUS = 3
BITS = 64
LARGE = 2048                    # fingerprints of a bucket that are compared in one task; larger ones are cut first
CHUNK = 1 << 14                 # hashes whose bits are counted at a time

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes) -> np.ndarray:
    """XXH64 of every run of three words, joined with single spaces; the whole sequence if there are fewer."""
    words = text.translate(_LOWER).split()          # splits at 0x20 and 0x09-0x0D, as the words are defined
    joined = b" ".join(words)
    n = max(len(words) - WIDTH + 1, min(len(words), 1))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = (stops - lengths)[:n].tolist()
    last = stops[min(len(words), WIDTH) - 1:][:n].tolist() if n else []
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, last)), dtype=np.uint64, count=n)


def simhash(text: bytes) -> int:
    """The fingerprint of a text as a signed 64-bit number; 0 without words."""
    hashes = shingle_hashes(text)
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), CHUNK):
        some = np.ascontiguousarray(hashes[k:k + CHUNK], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``simhash``, a bigint; a column of that name is replaced.

    Null and empty texts and texts without words have fingerprint zero.  Every row has its own, repeated rows too.
    """
    docs = docs.drop("simhash").withColumn("_raw", F.coalesce("text", F.lit("")).cast("binary"))
    kept = [c for c in docs.columns if c != "_raw"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([simhash(t.as_py()) for t in b.column("_raw")], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), found], [*kept, "simhash"])

    return docs.mapInArrow(run, extended(docs.drop("_raw"), "simhash bigint"))


def as_hex(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _field(at: Column, width: int) -> Column:
    """The bits [at, at + width) of ``fp``."""
    return F.call_function("shiftrightunsigned", F.col("fp"), at.cast("int")).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _placed(rows: DataFrame, width: int) -> DataFrame:
    """Entries and questions of both halves of the free part: ``fp``, ``key``, ``at`` (where its other half is), ``entry``.

    ``rows`` have ``fp``, ``key`` (of the bucket so far) and ``at`` (the free part's first bit); the
    free part is two halves of ``width`` bits.
    """
    halves = rows.select("fp", "key", F.explode(F.array(
        F.struct(F.col("at").alias("own"), (F.col("at") + width).alias("at")),
        F.struct((F.col("at") + width).alias("own"), F.col("at").alias("at")))).alias("h")).select("fp", "key", "h.*")
    value = _field(F.col("own"), width)
    ball = F.filter(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.col("value").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), k))),
                    lambda v: v != F.col("value"))
    asked = halves.withColumn("value", value).select(
        "fp", "key", "own", "at", F.posexplode(F.concat(F.array("value"), ball)).alias("nth", "value"))
    # collisions of these keys only bring more pairs together, which are verified
    return asked.select("fp", F.xxhash64("key", "own", "value").alias("key"), "at", (F.col("nth") == 0).alias("entry"))


def _buckets(rows: DataFrame, width: int) -> DataFrame:
    """Members of buckets of two or more: ``fp``, ``key``, ``at``, ``size``."""
    placed = _placed(rows, width)
    entries = placed.where("entry").drop("entry")
    known = entries.select("key").distinct()
    hits = placed.where("not entry").drop("entry").join(known, "key", "left_semi")
    members = stored(entries.unionByName(hits.select("fp", "key", "at")), "buckets")
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return members.join(sizes, "key")


def spanning_links(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what all links within ``RADIUS`` connect; a member is reached once."""
    if len(values) == 2:
        near = np.bitwise_count(values[0] ^ values[1]) <= RADIUS
        return (values[:1], values[1:]) if near else (values[:0], values[:0])
    left, ones, others = np.unique(values), [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            now = queue.pop()
            near = np.bitwise_count(left ^ now) <= RADIUS
            if near.any():
                found, left = left[near], left[~near]
                ones.append(np.full(len(found), now))
                others.append(found)
                queue.extend(found)
    if not ones:
        return values[:0], values[:0]
    return np.concatenate(ones), np.concatenate(others)


def _links_inside(members: DataFrame) -> DataFrame:
    """Spanning links (a, b) of buckets that come as sorted streams, one bucket held at a time."""
    rows = members.select("key", "fp").repartition("key").sortWithinPartitions("key")

    def batch(found):
        a, b = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.uint64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64), pa.int64()) for x in (a, b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, values = np.empty(0, np.int64), np.empty(0, np.uint64)

        def solved(key, values):
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            for part in np.split(values, starts[1:]):
                one = spanning_links(part)
                if len(one[0]):
                    yield one

        for b in batches:
            key = np.concatenate((key, b.column("key").to_numpy()))
            values = np.concatenate((values, b.column("fp").to_numpy().view(np.uint64)))
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0         # the last bucket may go on
            if last:
                yield batch(list(solved(key[:last], values[:last])))
                key, values = key[last:], values[last:]
        if len(key):
            yield batch(list(solved(key, values)))

    return rows.mapInArrow(run, "a bigint, b bigint")


def fingerprint_links(known: DataFrame, large: int = LARGE) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp``, enough to connect all that are linked.

    Every link has a distance of at most ``RADIUS``.  ``large`` only decides which buckets are cut further.
    """
    rows = known.select("fp", F.lit(0).cast("bigint").alias("key"), F.lit(0).alias("at"))
    width, parts = BITS // 2, []
    while True:
        members = _buckets(rows, width)
        if width <= 2:                                  # at most 16 values are left free
            parts.append(stored(_links_inside(members).distinct(), "links"))
            break
        parts.append(stored(_links_inside(members.where(F.col("size") <= large)).distinct(), "links"))
        over = stored(members.where(F.col("size") > large).select("fp", "key", "at"), "large")
        if over.isEmpty():
            break
        rows, width = over, width // 2
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def near_duplicates(docs: DataFrame, large: int = LARGE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits), ``component_id`` of every row.

    ``component_id`` is the smallest ``doc_id`` reachable by links, its own included; documents with equal
    fingerprints are linked.  Null and empty texts have fingerprint zero and are linked like any
    other.  Repeated rows get a row each.  A row without an id has the component of those it
    reaches, null if none of them has one.  An empty table gives none; other columns are not read.
    """
    own = stored(fingerprints(docs.select("doc_id", "text")).select("doc_id", F.col("simhash").alias("fp")), "fingerprints")
    known = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "known")
    links = fingerprint_links(known, large)
    labels = connected_components(links)
    named = known.join(labels.toDF("fp", "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    firsts = named.groupBy("component").agg(F.min("least").alias("component_id"))
    groups = named.select("fp", "component").join(firsts, "component").select("fp", "component_id")
    return own.join(groups, "fp").select("doc_id", as_hex("fp").alias("fingerprint"), "component_id")

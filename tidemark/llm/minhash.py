"""Document fingerprints: MinHash over five-word shingles.

Every shingle hash goes through many multiply-add-shift hashes at once; the
smallest value of each over a text is one lane of its signature.  The share of
equal lanes estimates the Jaccard similarity of two texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended
from .shingles import chunks, mix, shingle_hashes

LANES = 128
BANDS = 32                      # of four lanes: a pair at 0.8 is missed with probability 5e-8
SIMILARITY = 0.8


def permutations(lanes: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the universal hashes."""
    with np.errstate(over="ignore"):
        draws = mix(np.arange(1, 2 * lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    return draws[:lanes] | np.uint64(1), draws[lanes:]


def signatures(texts: Sequence[bytes], lanes: int = LANES) -> np.ndarray:
    """One row of 16-bit lanes per text; a text without words has all lanes at the top."""
    out = np.full((len(texts), lanes), 0xFFFF, dtype=np.uint16)
    a, b = permutations(lanes)
    for start, stop in chunks(texts):
        hashes, per = shingle_hashes(texts[start:stop])
        full = np.flatnonzero(per)
        if not len(full):
            continue
        first = (np.cumsum(per) - per)[full]
        with np.errstate(over="ignore"):
            for k in range(lanes):
                # the smallest 64-bit value, of which 16 scattered bits are kept
                least = np.minimum.reduceat(hashes * a[k] + b[k], first)
                out[start + full, k] = mix(least) >> np.uint64(48)
    return out


def likeness(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Share of equal lanes of the signatures, row by row."""
    return (one == two).mean(axis=1) if len(one) else np.zeros(0)


def as_text(signature: np.ndarray) -> list[str]:
    raw = signature.astype(">u2").tobytes().hex()
    width = signature.shape[1] * 4
    return [raw[i:i + width] for i in range(0, len(raw), width)]


def fingerprints(docs: DataFrame, lanes: int = LANES) -> DataFrame:
    """``docs`` plus ``fingerprint``: the signature of ``text`` as hexadecimal text.

    Null or empty text, and text without words: all lanes ``ffff``.  A column
    of that name is replaced; rows stay as they are, repeated ones too.
    """
    docs = docs.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(as_text(signatures(texts, lanes)), pa.string())],
                                             [*b.schema.names, "fingerprint"])

    return docs.mapInArrow(run, extended(docs, "fingerprint string"))


def similar_documents(docs: DataFrame, similarity: float = SIMILARITY, lanes: int = LANES,
                      bands: int = BANDS) -> DataFrame:
    """Pairs (``a``, ``b``, ``jaccard``) of different texts at ``similarity`` or more.

    ``a`` and ``b`` are the smallest ``doc_id`` of their texts, a < b; copies are not
    expanded.  All texts that share a band are compared, unless their numbers of shingles
    rule the pair out; Jaccard is then verified on the shingle sets.  A group of n near copies
    has up to n squared pairs, and all of them are returned.  Rows without id or words are in no pair.
    Only ``doc_id`` and ``text`` are read; an empty table has no pair.
    """
    from .shingles import shingle_sets
    rows = lanes // bands

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            sets = shingle_sets(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(as_text(signatures(texts, lanes)), pa.string()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc_id", "sig", "shingles"])

    known = (docs.where("doc_id is not null").select("doc_id", "text")
             .mapInArrow(prepare, "doc_id bigint, sig string, shingles array<bigint>")
             .where(F.size("shingles") > 0))
    nodes = known.groupBy("shingles").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"))
    banded = nodes.select("doc_id", F.size("shingles").alias("n"), F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda k: F.substring("sig", k * F.lit(4 * rows) + 1, F.lit(4 * rows)))).alias("band", "value"))
    pairs = (banded.withColumnsRenamed({"doc_id": "a", "n": "n_a"}).join(banded.withColumnsRenamed({"doc_id": "b", "n": "n_b"}), ["band", "value"])
             .where((F.col("a") < F.col("b")) & (F.least("n_a", "n_b") / F.greatest("n_a", "n_b") >= similarity))
             .select("a", "b").distinct())
    left = nodes.select(F.col("doc_id").alias("a"), F.col("shingles").alias("one"))
    right = nodes.select(F.col("doc_id").alias("b"), F.col("shingles").alias("two"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("one", "two"))
    return (both.select("a", "b", (shared / (F.size("one") + F.size("two") - shared)).alias("jaccard"))
            .where(F.col("jaccard") >= similarity))


NEXT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def edit_with_next(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, lanes: int = LANES) -> DataFrame:
    """Fingerprints of every text, of its text edited with the next document's, and their likeness.

    The order is by ``doc_id`` (null first), then text; after the last document
    comes the first.  Ids are cut into ranges of equal size, one task each; the first
    document of a range is also sent to the range before, so that texts are moved
    once and nobody holds more than a chunk of them.  The driver sees one id
    per task.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = -(1 << 63)
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(lowest)).alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    ids = keyed.select("at")
    cuts = ids.agg(F.percentile_approx("at", [k / tasks for k in range(1, tasks)] or [0.5], 100 * tasks)).first()[0] or []
    cuts = sorted(set(cuts)) if tasks > 1 else []

    def long(value: int):
        return F.lit(value).cast("bigint")

    def part(at):
        return F.size(F.filter(F.array(*map(long, cuts)), lambda c: c <= at)) if cuts else F.lit(0)

    firsts = sorted((r["part"], r["at"]) for r in ids.groupBy(part(F.col("at")).alias("part"))
                    .agg(F.min("at").alias("at")).collect())
    before = {at: firsts[k - 1][0] for k, (_, at) in enumerate(firsts)}     # the first: to the last range
    halo = F.create_map(*(c for i, p in before.items() for c in (long(i), F.lit(p))))[F.col("at")] if before else F.lit(None).cast("int")
    dealt = (keyed.select("doc_id", "at", "text", F.explode(F.filter(F.array(
                F.struct(part(F.col("at")).alias("part"), F.lit(False).alias("halo")),
                F.struct(halo.alias("part"), F.lit(True).alias("halo"))), lambda s: s["part"].isNotNull())).alias("to"))
             .select("doc_id", "at", "text", "to.part", "to.halo")
             .repartitionById(tasks, F.col("part"))
             .sortWithinPartitions("part", "halo", "at", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_, texts = [], []          # rows not yet answered, in order
        size, part_now, ended = 0, None, False

        def answer():
            n = len(texts) - 1
            edited = [edit_with_next(texts[i], texts[i + 1]) for i in range(n)]
            raw = [e.encode() for e in edited]
            own = signatures([t.encode() for t in texts], lanes)
            new = signatures(raw, lanes)
            return pa.RecordBatch.from_arrays([
                pa.array(ids_[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()),
                pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                pa.array(as_text(own[:n]), pa.string()), pa.array(as_text(new), pa.string()),
                pa.array(likeness(own[:n], new), pa.float64()), pa.array(likeness(own[:n], own[1:]), pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        for b in batches:
            for i, t, p, h in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "part", "halo"))):
                if p != part_now:
                    ids_, texts, size, part_now, ended = [], [], 0, p, False
                if ended:
                    continue                    # only the first row after a range is its next one
                ids_.append(i)
                texts.append(t)
                size += len(t)
                if len(texts) > 1 and (h or size > 1 << 22):
                    yield answer()
                    ids_, texts, size = ids_[-1:], texts[-1:], len(texts[-1])
                ended = h

    return dealt.mapInArrow(run, NEXT)

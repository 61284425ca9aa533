"""N-gram Jaccard join with signature trees.

A text is the set of its five-word shingles; two texts are linked at a Jaccard
similarity of 0.8 or more, and linked texts form components.  Equal sets are one node.

Blocks.  In any fixed order of the shingles, linked sets share one of their first
n - ceil(0.8 n) + 1.  Shingles that very many documents have come last in the
order used here, so blocks of a shingle's holders stay small; which those are only
changes the blocks, never the result.

Signatures.  A set has a bitmap of four to eight bits a shingle, 2048 at least; each
shingle sets one.  At most (common bits + the lesser surplus of shingles over bits)
shingles can be common to two sets, so pairs well below the threshold are ruled out
without their shingles.  The longer of two bitmaps is folded to the other's length.

Trees.  First each member of a block is tried with the block's smallest member; that
joins a group of near copies without all its pairs.  What remains are pairs of
one block in different components.  They are found by a signature tree per block (a sweep
over the sizes where it is small): nodes
hold the OR of their bitmaps and the range of their sizes and components; two
trees are walked together, and a pair of nodes goes on only while the largest overlap
possible could make a link.  Large blocks are cut into pieces walked pair by pair.
Pairs that stay are verified on their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.latest import first_ranked, row_fingerprint
from ..operators.ordering import dense_numbers
from ..session import stored
from .components import connected_components
from .shingles import chunks, mix, shingle_hashes

NEED, OF = 80, 100              # linked: OF * common >= NEED * union
BITS = 2048                     # of a tree's bitmaps, and the least of a set's
COUNTERS = 1 << 21              # shingles are counted by 21 bits of their hash, to find frequent ones
SLICE = 1 << 14                 # counters of a row
SIGMAS, ABOVE = 3, 8            # frequent: this far above the mean of the counters
SMALL = 64                      # members of a block whose pairs are found by size alone
PIECE = 512                     # members of a larger block's piece
FAN = 8
BROADCAST_IDS = 300_000         # ids that are broadcast at most; beyond it, a shuffled join

_U = np.uint64


def _distinct_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    for start, stop in chunks(texts):
        hashes, per = shingle_hashes(texts[start:stop])
        end = 0
        for n in per.tolist():
            yield np.unique(hashes[end:end + n])
            end += n


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode() for t in batch.column("text").to_pylist()]


def _counter(s: np.ndarray) -> np.ndarray:
    return (s >> _U(65 - COUNTERS.bit_length())).astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that few texts are held beside their hashes."""
    for b in batches:
        for start in range(0, b.num_rows, rows):
            yield b.slice(start, rows)


def _digest(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return int(mix(s).sum().astype(np.int64)), int(mix(s ^ _U(0xA5A5A5A55A5A5A5A)).sum().astype(np.int64))


def signature(s: np.ndarray) -> bytes:
    """The bitmap of a set: a power of two of bits, more than four times its size."""
    size = max(BITS, 1 << (4 * len(s)).bit_length())
    bits = np.zeros(size, dtype=np.uint8)
    bits[(s & _U(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def folded(bitmap: bytes, size: int) -> np.ndarray:
    """A bitmap of ``size`` bits, from one of as many or more."""
    return np.bitwise_or.reduce(np.frombuffer(bitmap, np.uint64).reshape(-1, size // 64), axis=0)


def set_digests(docs: DataFrame) -> DataFrame:
    """A row per document (``doc_id, n, d1, d2``), and rows with the counters of each task (``slice, counts``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        names = ["doc_id", "n", "d1", "d2", "slice", "counts"]
        for b in _parts(batches):
            sets, digests, pending, size = [], [], [], 0
            for s in _distinct_sets(_texts(b)):
                sets.append(len(s))
                digests.append(_digest(s))
                pending.append(_counter(s))
                size += len(s)
                if size > 1 << 20:
                    total += np.bincount(np.concatenate(pending), minlength=COUNTERS)
                    pending, size = [], 0
            if pending:
                total += np.bincount(np.concatenate(pending), minlength=COUNTERS)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(sets, pa.int64()),
                                              pa.array([d[0] for d in digests], pa.int64()),
                                              pa.array([d[1] for d in digests], pa.int64()),
                                              pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
        if total.any():
            rows = np.minimum(total, 0xFFFF).astype(np.uint16).reshape(-1, SLICE)
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(np.arange(len(rows)), pa.int32()),
                                              pa.array([r.tobytes() for r in rows], pa.binary())], names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, d1 bigint, d2 bigint, slice int, counts binary")


def frequent_counters(told: DataFrame) -> np.ndarray:
    """Which counters are far above the mean, of all tasks together.

    The counters of a slice are summed as a stream; the driver gets a bit of each.
    """
    slices = (told.where("slice is not null").select("slice", "counts").repartition("slice").sortWithinPartitions("slice"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def bits():
            mean = total.mean()
            often = total > mean + SIGMAS * np.sqrt(mean) + ABOVE
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(often).tobytes()], pa.binary())], ["slice", "bits"])

        for b in batches:
            for k, counts in zip(b.column("slice").to_pylist(), b.column("counts").to_pylist()):
                if k != now:
                    if now is not None:
                        yield bits()
                    now, total = k, np.zeros(SLICE, dtype=np.int64)
                total += np.frombuffer(counts, np.uint16)
        if now is not None:
            yield bits()

    out = np.zeros((COUNTERS // SLICE, SLICE), dtype=bool)
    for r in slices.mapInArrow(run, "slice int, bits binary").collect():
        out[r["slice"]] = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
    return out.ravel()


def set_nodes(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """One row per different set that isn't empty: its smallest id ``node``, ``n, d1, d2, bitmap, prefix``."""
    flags = docs.sparkSession.sparkContext.broadcast(np.packbits(frequent))         # COUNTERS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent_bits = np.unpackbits(flags.value).astype(bool)
        for b in _parts(batches):
            n, digests, bitmaps, prefixes = [], [], [], []
            for s in _distinct_sets(_texts(b)):
                often = frequent_bits[_counter(s)]
                first = len(s) - -(-NEED * len(s) // OF) + 1 if len(s) else 0
                n.append(len(s))
                digests.append(_digest(s))
                bitmaps.append(signature(s))
                prefixes.append(np.concatenate((s[~often], s[often]))[:first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                 pa.array([d[1] for d in digests], pa.int64()), pa.array(bitmaps, pa.binary()),
                 pa.array(prefixes, pa.list_(pa.int64()))], ["doc_id", "n", "d1", "d2", "bitmap", "prefix"])

    sets = docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(
        run, "doc_id bigint, n bigint, d1 bigint, d2 bigint, bitmap binary, prefix array<bigint>")
    return (sets.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), F.any_value("n").alias("n"),
                                                       F.any_value("bitmap").alias("bitmap"), F.any_value("prefix").alias("prefix")))


def block_members(nodes: DataFrame) -> DataFrame:
    """Members of each block beside its smallest one: ``token, first, node, n, fits``.

    ``fits`` says that the two sizes allow a link.  Blocks of two come without a token, and only
    if they fit: there is no other pair in them.  Blocks pass as sorted streams; of a
    block, whatever its size, its first two members are held.
    """
    rows = (nodes.select(F.explode("prefix").alias("token"), "node", "n")
            .repartition("token").sortWithinPartitions("token", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple | None = None             # token, first member and its size of a block of three or more
        token, node, size = (np.empty(0, np.int64) for _ in range(3))   # members of a block of fewer so far

        def batch(t, first, of_first, v, n, in_block):
            fits = (first != v) & (OF * np.minimum(of_first, n) >= NEED * np.maximum(of_first, n))
            kept = fits | in_block
            return pa.RecordBatch.from_arrays(
                [pa.array(t[kept], pa.int64(), mask=~in_block[kept]), pa.array(first[kept], pa.int64()), pa.array(v[kept], pa.int64()),
                 pa.array(n[kept], pa.int64()), pa.array(fits[kept], pa.bool_())], ["token", "first", "node", "n", "fits"])

        def closed(t, v, n):
            starts = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            sizes = np.diff(np.append(starts, len(t)))
            return batch(t, np.repeat(v[starts], sizes), np.repeat(n[starts], sizes), v, n, np.repeat(sizes >= 3, sizes))

        for b in batches:
            t, v, n = (b.column(c).to_numpy() for c in ("token", "node", "n"))
            if opened and len(t):
                more = int(np.searchsorted(t != opened[0], True))
                if more:
                    yield batch(t[:more], np.full(more, opened[1]), np.full(more, opened[2]), v[:more], n[:more], np.ones(more, dtype=bool))
                    t, v, n = t[more:], v[more:], n[more:]
                if len(t):
                    opened = None
            token, node, size = np.concatenate((token, t)), np.concatenate((node, v)), np.concatenate((size, n))
            if not len(token):
                continue
            last = int(np.searchsorted(token == token[-1], True)) if not opened else 0
            if len(token) - last >= 3:
                opened, last = (int(token[-1]), int(node[last]), int(size[last])), len(token)
            if last:
                yield closed(token[:last], node[:last], size[:last])
            token, node, size = token[last:], node[last:], size[last:]
        if len(token):
            yield closed(token, node, size)

    return rows.mapInArrow(run, "token bigint, first bigint, node bigint, n bigint, fits boolean")


def may_link(n1, n2, common_bits, surplus) -> np.ndarray:
    """Whether sets of these sizes (or of at least, in nodes) can be linked."""
    return (OF + NEED) * np.minimum(common_bits + surplus, np.minimum(n1[1], n2[1])) >= NEED * (n1[0] + n2[0])


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a & b).sum(axis=1, dtype=np.int64)


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures allow a link."""
    info = nodes.select("node", "n", "bitmap")
    both = (pairs.join(info.toDF("a", "n_a", "bits_a"), "a").join(info.toDF("b", "n_b", "bits_b"), "b")
            .where(f"{OF} * least(n_a, n_b) >= {NEED} * greatest(n_a, n_b)"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            good = []
            for n, m, x, y in zip(*(b.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))):
                least = 8 * min(len(x), len(y))
                x, y = folded(x, least), folded(y, least)
                surplus = min(n - int(np.bitwise_count(x).sum(dtype=np.int64)), m - int(np.bitwise_count(y).sum(dtype=np.int64)))
                good.append(bool(may_link((n, n), (m, m), int(np.bitwise_count(x & y).sum(dtype=np.int64)), surplus)))
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, by their shingles, which only documents in a pair send."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    asked = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            sets = [s.view(np.int64) for s in _distinct_sets(_texts(b))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "s"])

    sets = stored(docs.select("doc_id", "text").join(asked, "doc_id", "left_semi").select("doc_id", "text")
                  .mapInArrow(shingles, "doc_id bigint, s array<bigint>"), "shingles")
    both = pairs.join(sets.toDF("b", "two"), "b").join(sets.toDF("a", "one"), "a").select("a", "b", "one", "two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one, two = b.column("one"), b.column("two")
            good = []
            for i in range(b.num_rows):
                x, y = one[i].values.to_numpy(), two[i].values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(OF * common >= NEED * (len(x) + len(y) - common))
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


class Tree:
    """Levels of nodes over a block's members, from the members up; children are runs of ``FAN``."""

    def __init__(self, size: np.ndarray, bits: np.ndarray, comp: np.ndarray, item: np.ndarray):
        often = np.isin(comp, [c for c, k in zip(*np.unique(comp, return_counts=True)) if k >= FAN])
        order = np.lexsort((item, size, np.where(often, comp, np.iinfo(np.int64).min)))
        size, bits, comp = size[order], bits[order], comp[order]
        self.item = item[order]
        surplus = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        level = (size, size, bits, surplus, comp, comp)
        self.levels = [level]
        while len(level[0]) > 1:
            at = np.arange(0, len(level[0]), FAN)
            level = tuple(f.reduceat(x, at) for f, x in zip(
                (np.minimum, np.maximum, np.bitwise_or, np.maximum, np.minimum, np.maximum), level))
            self.levels.append(level)


def walk(x: Tree, y: Tree) -> list[tuple[int, int]]:
    """Member pairs of two trees (or of one with itself) that may link and differ in component."""
    same = x is y
    depth = max(len(x.levels), len(y.levels))
    i = j = np.zeros(1, dtype=np.int64)
    for level in range(depth - 1, -1, -1):
        # the lower tree stays at its root until the other is as low
        kx, ky = min(level, len(x.levels) - 1), min(level, len(y.levels) - 1)
        if level < depth - 1:
            i, j = _children(i, j, level < len(x.levels) - 1, level < len(y.levels) - 1, len(x.levels[kx][0]), len(y.levels[ky][0]))
            if same:
                i, j = i[i <= j], j[i <= j]
        keep = []
        for k in range(0, len(i), 4096):        # a few MB of bitmaps at a time
            a, b = (tuple(c[z[k:k + 4096]] for c in t.levels[h]) for t, h, z in ((x, kx, i), (y, ky, j)))
            apart = OF * np.minimum(a[1], b[1]) < NEED * np.maximum(a[0], b[0])
            one = (a[4] == a[5]) & (b[4] == b[5]) & (a[4] == b[4])
            keep.append(~apart & ~one & may_link((a[0], a[1]), (b[0], b[1]), _common(a[2], b[2]), np.minimum(a[3], b[3])))
        keep = np.concatenate(keep) if keep else np.zeros(0, dtype=bool)
        i, j = i[keep], j[keep]
    if same:
        i, j = i[i < j], j[i < j]
    return list(zip(x.item[i].tolist(), y.item[j].tolist()))


def _children(i, j, down_x, down_y, width_x, width_y):
    fx, fy = FAN if down_x else 1, FAN if down_y else 1
    di, dj = (z.ravel() for z in np.meshgrid(np.arange(fx), np.arange(fy), indexing="ij"))
    a = (i[:, None] * fx + di).ravel()
    b = (j[:, None] * fy + dj).ravel()
    inside = (a < width_x) & (b < width_y)
    return a[inside], b[inside]


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str], values: list[str]) -> Iterator[tuple | None]:
    """(key, rows) of each group in a stream sorted by its keys; None after every batch."""
    now, held = None, []
    for b in batches:
        for key, row in zip(zip(*(b.column(c).to_pylist() for c in keys)), zip(*(b.column(c).to_pylist() for c in values))):
            if key != now:
                if held:
                    yield now, held
                now, held = key, []
            held.append(row)
        yield None
    if held:
        yield now, held


def _pair_batches(groups: Iterator[tuple | None], pairs) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b), a < b, that ``pairs(key, rows)`` finds; once per input batch."""
    def batch(found):
        found = sorted({(min(p), max(p)) for p in found})
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    found = []
    for group in groups:
        if group is None:
            yield batch(found)
            found = []
        else:
            found += pairs(*group)
    if found:
        yield batch(found)


def fitting_pairs(size: np.ndarray, comp: np.ndarray, item: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a small block whose sizes allow a link and whose components differ, by a sweep over the sizes."""
    order = np.lexsort((item, size))
    size, comp, item = size[order], comp[order], item[order]
    stops = np.searchsorted(size, OF * size // NEED, side="right")
    return [(int(item[i]), int(item[j])) for i, stop in enumerate(stops) for j in range(i + 1, stop) if comp[i] != comp[j]]


def remaining_pairs(members: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of one block whose components differ and that sizes and trees don't rule out.

    Blocks with the same members count once.  In a block of up to ``SMALL`` members a sweep over the
    sizes is enough, and no bitmap is moved.  A larger block falls into the component of its
    first member and the others; both are cut into pieces, and a signature tree of each piece
    is walked with those it has to be compared with, so no task holds more than two pieces.
    """
    marked = (members.select("token", "node", "n").join(labels.toDF("node", "component"), "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    blocks = marked.groupBy("token").agg(
        F.min(F.struct("node", "component")).alias("least"), F.count("*").alias("size"),
        F.max("component").alias("most"), F.min("component").alias("fewest"),
        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("sum"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("mixed"))
    blocks = (blocks.where("most <> fewest").groupBy("size", "sum", "mixed", "least")
              .agg(F.min("token").alias("token")).select("token", "size", F.col("least.component").alias("main")))
    rows = stored(marked.join(blocks, "token").withColumn("other", F.col("component") != F.col("main")), "blocks")
    return _small_blocks(rows.where(F.col("size") <= SMALL)).unionByName(_large_blocks(rows.where(F.col("size") > SMALL), nodes)).distinct()


def _small_blocks(rows: DataFrame) -> DataFrame:
    dealt = rows.select("token", "node", "n", "component").repartition("token").sortWithinPartitions("token")

    def pairs(_, held):
        return fitting_pairs(*(np.array(c, dtype=np.int64) for c in zip(*held)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pair_batches(_grouped(batches, ["token"], ["n", "component", "node"]), pairs)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _large_blocks(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    sizes = rows.groupBy("token").agg(F.count_if(~F.col("other")).alias("mains"), F.count_if("other").alias("others"))
    rows = rows.join(sizes, "token")
    k_main = F.ceil(F.col("mains") / PIECE).cast("int")
    k_other = F.ceil(F.col("others") / PIECE).cast("int")

    def numbers(k):
        return F.sequence(F.lit(0), k - 1)

    own = F.pmod(F.xxhash64("node"), F.when(F.col("other"), k_other).otherwise(k_main)).cast("int")
    # (kind, one piece, other piece, side): kind 0 main with others, kind 1 others with others
    cross = F.when(F.col("other"), F.transform(numbers(k_main), lambda m: F.struct(F.lit(0).alias("kind"), m.alias("p"), F.col("own").alias("q"), F.lit(1).alias("side")))) \
        .otherwise(F.transform(numbers(k_other), lambda o: F.struct(F.lit(0).alias("kind"), F.col("own").alias("p"), o.alias("q"), F.lit(0).alias("side"))))
    inner = F.transform(numbers(k_other), lambda o: F.struct(F.lit(1).alias("kind"), F.least(o, "own").alias("p"), F.greatest(o, "own").alias("q"),
                                                             (F.col("own") > o).cast("int").alias("side")))
    none = F.array().cast("array<struct<kind:int,p:int,q:int,side:int>>")
    groups = F.concat(cross, F.when(F.col("other") & (F.col("others") > 1), inner).otherwise(none))
    dealt = (rows.withColumn("own", own).select("token", "node", "n", "component", F.explode(groups).alias("g"))
             .select("token", "node", "n", "component", "g.*")
             .join(nodes.select("node", "bitmap"), "node")
             .repartition("token", "kind", "p", "q").sortWithinPartitions("token", "kind", "p", "q", "side", "node"))

    def pairs(key, held):
        side, size, comp, item = (np.array([h[k] for h in held], dtype=np.int64) for k in (0, 1, 3, 4))
        bits = np.stack([folded(h[2], BITS) for h in held])
        trees = [Tree(size[side == s], bits[side == s], comp[side == s], item[side == s]) for s in (0, 1) if (side == s).any()]
        if len(trees) == 2:
            return walk(*trees)
        return walk(trees[0], trees[0]) if key[1] == 1 and key[2] == key[3] else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pair_batches(_grouped(batches, ["token", "kind", "p", "q"], ["side", "n", "bitmap", "component", "node"]), pairs)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs in different components, with these."""
    for side in "ab":
        pairs = pairs.join(labels.toDF(side, f"of_{side}"), side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    return pairs.where("of_a <> of_b")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links (a, b)."""
    between = _apart(links, labels).select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    joined = connected_components(between).toDF("component", "to")
    moved = labels.join(joined, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    # components of one node had no label
    alone = joined.join(labels.select(F.col("node").alias("component")), "component", "left_anti").select(
        F.col("component").alias("node"), F.col("to").alias("component"))
    return stored(moved.unionByName(alone), "labels")


def similar_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    ``component_id`` is the smallest ``doc_id`` reachable by links, its own included.  Null
    texts are empty; without words ``n_shingles`` is 0 and nothing is linked.  Repeated rows
    get a row each; rows that share an id are one document to others.  A row
    without an id has the component of an equal set with one, else null.
    """
    told = stored(set_digests(docs), "sets")
    nodes = stored(set_nodes(docs, frequent_counters(told)), "nodes")
    members = stored(block_members(nodes), "members")

    star = members.where("fits").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    star = stored(plausible(star, nodes), "star")
    nearest = star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    labels = connected_components(stored(verified(nearest, docs), "links"))
    labels = _merged(labels, stored(verified(stored(
        _apart(star.join(nearest, ["a", "b"], "left_anti"), labels).select("a", "b"), "pairs"), docs), "links"))
    rest = remaining_pairs(members.where("token is not null"), labels, nodes)
    rest = stored(plausible(_untried(rest, star), nodes), "pairs")
    labels = _merged(labels, stored(verified(rest, docs), "links"))

    own = nodes.select("d1", "d2", "node").join(labels, "node", "left").select("d1", "d2", F.coalesce("component", "node").alias("component"))
    every = told.where("slice is null").drop("slice", "counts").join(own, ["d1", "d2"], "left")
    shared = F.when(F.col("n") > 0, F.col("component"))
    return every.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(shared, "doc_id").alias("component_id"))


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    return pairs.join(tried, ["a", "b"], "left_anti")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: of the smallest id, and of its rows the first by text.

    Rows that share an id and have different texts are documents of their own: both stay unless they are linked.  Rows
    alike in id and text are one document; the one with the smallest hash of the whole row stays.  Rows without
    an id, which nobody can name, stay.  Null texts are empty; texts without words are linked with
    nothing.  An empty table stays empty; other columns pass through under any name.
    """
    known = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    hashed = F.xxhash64("text")
    shared = known.groupBy("doc_id").agg(F.min(hashed).alias("least"), F.max(hashed).alias("most")).where("least <> most")
    if not shared.isEmpty():
        # numbers in the order of id and text take the place of the ids
        numbers = dense_numbers(known.distinct(), ["doc_id", "text"], "number")
        d, n = docs.alias("d"), numbers.alias("n")
        own = d.join(n, (F.col("d.doc_id") == F.col("n.doc_id")) & (F.coalesce("d.text", F.lit("")) == F.col("n.text")), "left")
        packed = own.select(F.col("n.number").alias("doc_id"), F.col("d.text").alias("text"),
                            F.struct(*[F.col(f"d.`{c}`") for c in docs.columns]).alias("row"))
        return keep_one(stored(packed, "numbered")).select("row.*")

    found = similar_components(docs)
    kept = stored(found.where("doc_id is null or doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("_rows")), "kept")
    out = docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
    if kept.where("doc_id is not null and _rows > 1").isEmpty():
        return out
    again = first_ranked(out.where("doc_id is not null"), ["doc_id"], [row_fingerprint(out)], 1)
    return again.unionByName(out.where("doc_id is null"))

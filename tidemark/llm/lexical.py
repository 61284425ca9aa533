"""Ranked lexical search with Block-Max MaxScore over an inverted index.

Index.  A task cuts the documents it reads into segments of about ``SEGMENT_BYTES`` of text.  A segment has one row
with its documents, and for each of its terms rows with up to ``BLOCK`` postings: the first and last
document of the block, the largest gain of any of its postings (a term's score without its weight) and the postings,
compressed.  A document's norm needs the number of documents and terms, which a first pass counts.

Search.  The rows of the items' terms are brought together by segment.  For an item, lists are sorted by the
most that each can add; those which together cannot reach the tenth best score so far are not essential:
a document that is in none of the others cannot get into the result.  Essential lists are added up.
For the others, in turn, a candidate whose score so far plus the largest gain of its block, plus what lists still to come
can add, is too low is dropped; only blocks with a candidate left are decompressed.  Every
task keeps the best ten per item over all its segments; these heaps are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.latest import first_ranked
from ..operators.ordering import running
from ..session import stored
from .shingles import chunks, word_hashes

TOP = 10
BLOCK = 64                      # postings of a block
SEGMENT_BYTES = 8 << 20         # text of a segment; a longer text is a segment of its own
ITEM_BYTES = 8 << 20            # text of the items that are searched for together

# terms are runs of letters, digits and bytes above 0x7F; everything else becomes a space
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

INDEX = ("segment bigint, term bigint, first int, last int, n int, top int, postings binary, "
         "ids array<bigint>, norms array<bigint>")


def term_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every term of the texts, and the number of terms of each."""
    plain = [t.translate(_TERMS) for t in texts]
    found = [word_hashes(plain[a:b]) for a, b in chunks(plain)]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def n_terms(text: bytes) -> int:
    gap = np.frombuffer(text.translate(_TERMS) + b" ", np.uint8) == 32
    return int(np.count_nonzero(~gap[:-1] & gap[1:]))


def gains(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norm)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, the last of each below 128; and the number of bytes of each."""
    size = np.ones(len(values), dtype=np.int64)
    for k in range(1, 5):
        size += values >= 1 << 7 * k
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for k in range(5):
        has = size > k
        more = np.where(size[has] > k + 1, 128, 0)
        out[ends[has] - size[has] + k] = (values[has] >> 7 * k & 127) + more
    return out, size


def unpacked(data: np.ndarray) -> np.ndarray:
    stops = np.flatnonzero(data < 128)
    if not len(stops):
        return np.empty(0, np.int64)
    starts = np.concatenate(([0], stops[:-1] + 1))
    within = np.arange(len(data)) - np.repeat(starts, stops - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * within, starts)


def corpus_counts(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = terms = 0
        for b in batches:
            for t in b.column("raw"):
                n = n_terms(t.as_py())
                some += n > 0
                terms += n
        yield pa.RecordBatch.from_arrays([pa.array([some], pa.int64()), pa.array([terms], pa.int64())], ["some", "terms"])

    raw = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    one = raw.mapInArrow(run, "some bigint, terms bigint").agg(F.sum("some"), F.sum("terms")).first()
    return int(one[0] or 0), int(one[1] or 0)


def segment_rows(segment: int, ids: Sequence, texts: Sequence[bytes], documents: int, terms: int) -> pa.RecordBatch:
    """The rows of one segment, by term; the first one, without a term, has its documents."""
    hashes, per = term_hashes(texts)
    norms = 25 + (75 * per * documents) // max(terms, 1)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), per)
    order = np.argsort(hashes, kind="stable")
    hashes, doc = hashes[order], doc[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(fresh)
    tf = np.diff(np.append(at, len(hashes)))
    hashes, doc = hashes[at], doc[at]
    # blocks of a list's postings
    head = np.ones(len(hashes), dtype=bool)
    head[1:] = hashes[1:] != hashes[:-1]
    starts = np.flatnonzero(head)
    place = np.arange(len(hashes)) - np.repeat(starts, np.diff(np.append(starts, len(hashes))))
    begins = np.flatnonzero(place % BLOCK == 0)
    n = np.diff(np.append(begins, len(hashes)))
    steps = np.diff(doc, prepend=0)
    steps[begins] = 0
    data, size = packed(np.stack((steps, tf), axis=1).ravel())
    ends = np.cumsum(size)[2 * np.cumsum(n) - 1] if len(n) else np.empty(0, np.int64)
    tops = np.maximum.reduceat(gains(tf, norms[doc]), begins) if len(n) else n
    rows = len(n)
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def column(values, kind):
        return pa.concat_arrays([pa.nulls(1, kind), pa.array(values, kind)])

    def lists(values, kind):
        return pa.concat_arrays([pa.array([values], pa.list_(kind)), pa.nulls(rows, pa.list_(kind))])

    last = begins + n - 1
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(rows + 1, segment), pa.int64()), column(hashes[begins].view(np.int64), pa.int64()), column(doc[begins], pa.int32()),
        column(doc[last], pa.int32()), column(n, pa.int32()), column(tops, pa.int32()), pa.concat_arrays([pa.nulls(1, pa.binary()), blobs]),
        lists(ids, pa.int64()), lists(norms.tolist(), pa.int64())],
        ["segment", "term", "first", "last", "n", "top", "postings", "ids", "norms"])


def build_index(docs: DataFrame, documents: int, terms: int, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The stored index of all rows of ``docs`` (``doc_id``, ``text``); see :func:`corpus_counts` for the two counts.

    Null texts are empty; a row without terms is in no list.  Repeated rows are documents of their own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("raw")):
                t = t.as_py()
                if texts and size + len(t) > segment_bytes:
                    yield segment_rows(segment, ids, texts, documents, terms)
                    segment, ids, texts, size = segment + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if texts:
            yield segment_rows(segment, ids, texts, documents, terms)

    raw = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    return stored(raw.mapInArrow(run, INDEX), "index")


class Segment:
    """Lists of one segment; blocks are decompressed when first asked for."""

    def __init__(self, ids: list, norms: list):
        self.ids, self.norms = ids, np.array(norms, dtype=np.int64)
        self.rows: list[tuple] = []
        self.read = 0               # blocks decompressed

    def close(self) -> None:
        term, first, last, n, top, postings = zip(*self.rows) if self.rows else ([],) * 6
        self.first, self.last, self.n, self.top = (np.array(x, dtype=np.int64) for x in (first, last, n, top))
        self.postings = postings
        self.begin = np.concatenate(([0], np.cumsum(self.n)))
        self.doc = np.zeros(int(self.begin[-1]), dtype=np.int64)
        self.gain = np.zeros(int(self.begin[-1]), dtype=np.int64)
        self.open = np.zeros(len(self.n), dtype=bool)
        term = np.array(term, dtype=np.int64)
        heads = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.empty(0, np.int64)
        stops = np.append(heads[1:], len(term))
        self.lists = {t: (a, b) for t, a, b in zip(term[heads].tolist(), heads.tolist(), stops.tolist())}
        self.most = {t: int(self.top[a:b].max()) for t, (a, b) in self.lists.items()}

    def decompress(self, blocks: np.ndarray) -> None:
        blocks = blocks[~self.open[blocks]]
        if not len(blocks):
            return
        values = unpacked(np.frombuffer(b"".join([self.postings[k] for k in blocks.tolist()]), np.uint8))
        steps, tf = values[0::2], values[1::2]
        n = self.n[blocks]
        heads = np.cumsum(n) - n
        total = np.cumsum(steps)
        doc = total - np.repeat(total[heads], n) + np.repeat(self.first[blocks], n)
        to = np.arange(len(steps)) - np.repeat(heads, n) + np.repeat(self.begin[blocks], n)
        self.doc[to] = doc
        self.gain[to] = gains(tf, self.norms[doc])
        self.open[blocks] = True
        self.read += len(blocks)

    def spread(self, blocks: np.ndarray, out: np.ndarray, by: int) -> None:
        """Add what the postings of the blocks of one list give to their documents."""
        self.decompress(blocks)
        if len(blocks) and blocks[-1] - blocks[0] + 1 == len(blocks):
            at = slice(self.begin[blocks[0]], self.begin[blocks[-1] + 1])
            out[self.doc[at]] += by * self.gain[at]
            return
        for k in blocks.tolist():
            at = slice(self.begin[k], self.begin[k + 1])
            out[self.doc[at]] += by * self.gain[at]


def search_segment(segment: Segment, query: list[tuple[int, int]], heap: list[tuple], top: int = TOP) -> list[tuple]:
    """The ``top`` best (-score, no id, id) of ``heap`` and of a segment, for a query of (term, weight)."""
    lists = sorted((w * segment.most[t], w, t) for t, w in query if t in segment.lists and w > 0)
    enough = -heap[-1][0] if len(heap) == top else 1
    reach = np.cumsum([m for m, _, _ in lists])
    if not len(reach) or reach[-1] < enough:
        return heap
    essential = int(np.searchsorted(reach, enough))         # lists before it cannot reach ``enough`` together
    score = np.zeros(len(segment.ids), dtype=np.int64)
    for _, w, t in lists[essential:]:
        segment.spread(np.arange(*segment.lists[t]), score, w)
    left = np.flatnonzero(score)
    for k in range(essential - 1, -1, -1):
        most, w, t = lists[k]
        if len(left) >= top:
            enough = max(enough, int(np.partition(score[left], len(left) - top)[len(left) - top]))
        left = left[score[left] + reach[k] >= enough]
        a, b = segment.lists[t]
        block = a + np.searchsorted(segment.last[a:b], left)
        inside = block < b
        inside[inside] = segment.first[block[inside]] <= left[inside]
        gain = np.zeros(len(left), dtype=np.int64)
        gain[inside] = w * segment.top[block[inside]]
        kept = score[left] + gain + (reach[k] - most) >= enough
        left, wanted = left[kept], np.unique(block[kept & inside])
        more = np.zeros(len(score), dtype=np.int64)
        segment.spread(wanted, more, w)
        score[left] += more[left]
    left = left[score[left] >= enough]
    if len(left) > top:
        least = np.partition(score[left], len(left) - top)[len(left) - top]
        left = left[score[left] >= least]
    found = [(-int(score[d]), segment.ids[d] is None, segment.ids[d] or 0) for d in left.tolist()]
    return sorted(heap + found)[:top]


def _numbered_items(items: DataFrame) -> DataFrame:
    """Distinct items with terms' text: ``item`` (number), ``block``, ``item_id``, ``text``."""
    once = items.select("item_id", "text").where("text is not null").distinct()
    sized = once.withColumns({"all": F.lit(0), "bytes": F.octet_length("text").cast("bigint")})
    placed = running(sized, ["all"], ["item_id", "text"], {"item": ("count", "bytes"), "upto": ("sum", "bytes")})
    return placed.select("item", F.floor(F.col("upto") / ITEM_BYTES).alias("block"), "item_id", "text")


def _block_terms(items: DataFrame) -> DataFrame:
    """``item``, ``term``, ``times`` of the items' terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, per = term_hashes([t.as_py() for t in b.column("raw")])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("item").to_numpy(), per), pa.int64()),
                                              pa.array(hashes.view(np.int64), pa.int64())], ["item", "term"])

    found = items.select("item", F.col("text").cast("binary").alias("raw")).mapInArrow(run, "item bigint, term bigint")
    return found.groupBy("item", "term").agg(F.count("*").alias("times"))


def _search_block(index: DataFrame, terms: DataFrame, documents: int, top: int) -> DataFrame:
    """Heaps (``item``, ``doc_id``, ``score``) of all tasks for one block of items."""
    wanted = terms.select("term").distinct()
    hits = stored(index.where("term is not null").join(F.broadcast(wanted), "term").select(*index.columns), "hits")
    held = {r["term"]: r["df"] for r in hits.groupBy("term").agg(F.sum("n").alias("df")).collect()}
    queries: dict[int, list[tuple[int, int]]] = {}
    for r in terms.collect():
        if r["term"] in held:
            queries.setdefault(r["item"], []).append((r["term"], r["times"] * weight(documents, held[r["term"]])))
    told = index.sparkSession.sparkContext.broadcast(queries)
    asked = hits.select("segment").distinct()
    documents_of = index.where("term is null").join(asked, "segment", "left_semi").select(*index.columns)
    rows = (documents_of.unionByName(hits).repartition("segment")
            .sortWithinPartitions("segment", F.col("term").asc_nulls_first(), "first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple]] = {}
        segment = None

        def search():
            segment.close()
            for item, query in told.value.items():
                heaps[item] = search_segment(segment, query, heaps.get(item, []), top)

        for b in batches:
            cols = [b.column(c) for c in ("term", "first", "last", "n", "top", "postings")]
            # a row without a term begins a segment, which may go on in the next batch
            begins = b.column("term").is_null().to_numpy(zero_copy_only=False)
            cuts = sorted({0, b.num_rows, *np.flatnonzero(begins).tolist()})
            for a, z in zip(cuts, cuts[1:]):
                if begins[a]:
                    if segment is not None:
                        search()
                    segment = Segment(b.column("ids")[a].as_py(), b.column("norms")[a].as_py())
                    a += 1
                segment.rows.extend(zip(*(c.slice(a, z - a).to_pylist() for c in cols)))
        if segment is not None:
            search()
        found = [(item, None if no_id else i, -s) for item, heap in heaps.items() for s, no_id, i in heap]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["item", "doc_id", "score"])

    return stored(rows.mapInArrow(run, "item bigint, doc_id bigint, score bigint"), "heaps")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank`` (int, from 1), ``doc_id``, ``score`` of the ``top`` best documents of each item.

    Only scores above 0 count; equal ones are ranked by ascending ``doc_id``, documents without an id
    last.  Null texts have no terms.  Repeated rows of ``docs`` are documents of their own; items
    alike in id and text count once, items that share an id are ranked apart.  Items come in
    blocks of ``ITEM_BYTES`` of text, so that neither a task nor the driver holds more; no item or
    document is left out.  Empty tables give no rows; other columns are not read.
    """
    documents, terms = corpus_counts(docs)
    index = build_index(docs, documents, terms)
    numbered = stored(_numbered_items(items), "items")
    heaps = []
    for r in numbered.select("block").distinct().orderBy("block").toLocalIterator():
        block = stored(_block_terms(numbered.where(F.col("block") == r["block"])), "terms")
        heaps.append(_search_block(index, block, documents, top))
    if not heaps:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    best = first_ranked(reduce(DataFrame.unionByName, heaps), ["item"], order, top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

"""Line dedup by pairwise alignment.

A run is a stretch of lines that has enough words and would not without its last line, or
not without its first.  Every block of enough words is made up of its runs, and each run
links all later documents to the earliest that has it: whichever earlier document shares
a block, all its runs are found, however frequent they or their lines are.  A document is
aligned with each earlier one it is linked to, by patience diff: the common runs (a repeated
run counts with the number of its occurrence) are cut down to a longest increasing
run, and neighbouring anchors are joined to a block where rolling hashes show
that all lines between them are equal too.  Moved passages are joined likewise.  Blocks
are deleted from the later document.

Only places and hashes of runs are moved for the links, and a document's links come
together in one row, at most two for each of its lines.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shingles import mix

LEAST_WORDS = 30                # of a block that is deleted

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_BACK = pow(_BASE, -1, 1 << 64)

# the document (id with null as the largest, hash of the text), first and last line of the
# run, rolling hash before it; key: run and occurrence
RUN = "late boolean, doc bigint, body bigint, first int, last int, before bigint, key bigint"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _document_runs(text: str, least_words: int) -> tuple[np.ndarray, ...]:
    """First and last line, rolling hash before it and key of every run."""
    import xxhash
    lines = [x.strip() for x in text.split("\n")]
    words = np.array([len(x.split()) for x in lines], dtype=np.int64)
    own = np.flatnonzero(words)
    after = np.cumsum(words[own])
    if not len(own) or after[-1] < least_words:
        return tuple(np.empty(0, t) for t in (np.int32, np.int32, np.uint64, np.uint64))
    hashes = np.array([xxhash.xxh3_64_intdigest(x.encode()) if x else 0 for x in lines], dtype=np.uint64)
    before, n = after - words[own], np.arange(len(own))
    # from each line to the first that makes it enough, and to each line from the last that does
    i = np.concatenate((n, np.searchsorted(before, after - least_words, "right") - 1))
    j = np.concatenate((np.searchsorted(after, before + least_words), n))
    place = np.unique((i * len(own) + j)[(i >= 0) & (j < len(own))])
    first, last = own[place // len(own)], own[place % len(own)]
    with np.errstate(over="ignore"):
        power, back = (np.full(len(lines), np.uint64(b)) for b in (_BASE, _BACK))
        power[0] = back[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(back, out=back)
        rolled = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * power)))
        runs = (rolled[last + 1] - rolled[first]) * back[first]
        order = np.argsort(runs, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], runs[order][1:] != runs[order][:-1])))
        nth = np.empty(len(runs), np.uint64)
        nth[order] = np.arange(len(runs)) - np.repeat(starts, np.diff(np.append(starts, len(runs))))
        keys = mix(runs + nth * np.uint64(_BASE))
    return first.astype(np.int32), last.astype(np.int32), rolled[first], keys


def document_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per run, as in ``RUN``."""
    least = max(least_words, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RUN.split(", ")]
        for b in batches:
            late, doc, body = (b.column(c).to_pylist() for c in ("late", "doc", "body"))
            texts = b.column("text").to_pylist()
            for start in range(0, len(texts), 512):
                rows = [_document_runs(t, least) for t in texts[start:start + 512]]
                per = [len(r[0]) for r in rows]
                first, last, before, key = (np.concatenate([r[k] for r in rows]) for k in range(4))
                who = start + np.repeat(np.arange(len(rows)), per)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(late, dtype=bool)[who]), pa.array(np.array(doc, dtype=np.int64)[who]),
                    pa.array(np.array(body, dtype=np.int64)[who]), pa.array(first), pa.array(last), _signed(before),
                    _signed(key)], names)

    return docs.select(*_key(docs), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, RUN)


def _key(docs: DataFrame) -> list[Column]:
    """A document is its id and text: rows alike in both are one document."""
    return [F.col("doc_id").isNull().alias("late"), F.coalesce("doc_id", F.lit(0)).alias("doc"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("body")]


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Indices of a longest strictly increasing run, by patience sorting."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
            ends.append(i)
        else:
            tails[k], ends[k] = v, i
        back[i] = ends[k - 1] if k else -1
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def common_blocks(anchors: Sequence[dict]) -> list[tuple[int, int]]:
    """Line ranges (first, last) of one document that stand in another, earlier one.

    ``anchors`` are their common runs, in order of ``first``, each with place and rolling
    hashes in the later document and ``o_first``, ``o_before`` in the other.
    The longest increasing run is the alignment.  A passage that was moved is not in it;
    so all anchors are joined along their diagonals too.
    """
    chain = [anchors[i] for i in longest_increasing([a["o_first"] for a in anchors])]
    moved: dict[int, list[dict]] = defaultdict(list)
    for a in anchors:
        moved[a["first"] - a["o_first"]].append(a)
    return sorted({b for own in (chain, *moved.values()) for b in _joined(own)})


def _joined(chain: Sequence[dict]) -> list[tuple[int, int]]:
    """Blocks of anchors that increase in both documents."""
    blocks: list[list[dict]] = []
    for a in chain:
        last = blocks[-1][-1] if blocks else None
        if last and a["first"] - last["first"] == a["o_first"] - last["o_first"] and _same_between(last, a):
            blocks[-1].append(a)
        else:
            blocks.append([a])
    return [(b[0]["first"], max(a["last"] for a in b)) for b in blocks]


def _same_between(a: dict, b: dict) -> bool:
    """Whether the lines between two anchors are the same in both documents."""
    if b["first"] <= a["last"] + 1:
        return True
    shift = pow(_BASE, b["o_first"], 1 << 64) * pow(_BACK, b["first"], 1 << 64)
    return (b["before"] - a["before"]) * shift & _MASK == (b["o_before"] - a["o_before"]) & _MASK


def duplicate_blocks(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document that repeats a block of an earlier one: ``late, doc, body, blocks``.

    Blocks are (first, last) line numbers from 0, merged and in order.  Earlier is the
    smaller ``doc_id``; a null id is later than all others; of equal ids the hash of
    the text decides.  Rows alike in id and text count once, and neither goes.
    """
    runs = document_runs(docs, least_words)
    who = F.struct("late", "doc", "body")
    owners = (runs.groupBy("key").agg(F.min(F.struct("late", "doc", "body", "first", "before")).alias("o"), F.max(who).alias("other"))
              .where(F.struct("o.late", "o.doc", "o.body") != F.col("other")).select("key", "o"))
    linked = (runs.join(owners, "key")
              .where((F.col("doc") != F.col("o.doc")) | (F.col("body") != F.col("o.body")) | (F.col("late") != F.col("o.late"))))
    anchors = F.struct("first", "last", "before", F.col("o.late").alias("o_late"),
                       F.col("o.doc").alias("o_doc"), F.col("o.body").alias("o_body"), F.col("o.first").alias("o_first"),
                       F.col("o.before").alias("o_before"))
    gathered = linked.groupBy("late", "doc", "body").agg(F.collect_set(anchors).alias("anchors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for b in batches:
            out = []
            for row in b.column("anchors"):
                by: dict[tuple, list[dict]] = defaultdict(list)
                for a in sorted(row.as_py(), key=lambda a: (a["first"], a["last"])):
                    by[a["o_late"], a["o_doc"], a["o_body"]].append(a)
                merged: list[list[int]] = []
                for first, last in sorted(x for own in by.values() for x in common_blocks(own)):
                    if merged and first <= merged[-1][1] + 1:
                        merged[-1][1] = max(merged[-1][1], last)
                    else:
                        merged.append([first, last])
                out.append([{"first": f, "last": x} for f, x in merged])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("late", "doc", "body")), pa.array(out, kind)],
                                             ["late", "doc", "body", "blocks"])

    return gathered.mapInArrow(run, "late boolean, doc bigint, body bigint, blocks array<struct<first:bigint,last:bigint>>").where(F.size("blocks") > 0)


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the repeated blocks taken out of ``text``, plus ``n_lines`` and ``removed_blocks``.

    ``text`` stays as it is, null too, where nothing was deleted.  ``n_lines`` counts lines
    before (an empty or null text has one, empty line).  Columns of those names are replaced.
    """
    docs = docs.drop("n_lines", "removed_blocks")
    keys = ["_late", "_doc", "_body"]
    blocks = duplicate_blocks(docs, least_words).toDF(*keys, "removed_blocks")
    keyed = docs.select("*", *(c.alias(k) for c, k in zip(_key(docs), keys)))
    joined = keyed.join(blocks, keys, "left").drop(*keys)
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.exists("removed_blocks", lambda r: (r["first"] <= i) & (i <= r["last"])))
    none = F.array().cast("array<struct<first:bigint,last:bigint>>")
    return (joined.withColumn("n_lines", F.size(lines).cast("bigint"))
            .withColumn("text", F.when(F.col("removed_blocks").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
            .withColumn("removed_blocks", F.coalesce("removed_blocks", none)))

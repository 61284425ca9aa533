"""Prefix trie of conversations that share their first turns.

A node is a sequence of first turns.  It is known by its depth and two 64-bit values, each the XOR of hashes of its
turns with their place, so the node of every turn is a running XOR along its conversation; that is
worked out partition by partition, and a conversation of any length is never gathered.
Members are counted with map-side combining, subtree totals come by tree contraction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import running
from ..session import stored
from .contraction import subtree_totals

HEADS, GROUP = 4, 20            # of a conversation: up to three turns, those of the first conversation of its twenty
WORD = r"[^\x20\x09-\x0D]+"
CHUNK_IDS = 1 << 14             # ids of a node that make one row on their way to the digest


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 0), ``role``, ``text`` of every turn.

    The order is by turn, null first, then by role and text.  Null roles and texts are empty.  Rows
    without ``conv_id`` are in no conversation.
    """
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = running(turns.withColumn("one", F.lit(1)), ["conv_id"], ["turn", "role", "text"], {"place": ("count", "one")})
    return placed.select("conv_id", (F.col("place") - 1).alias("place"), "role", "text")


def rebuilt_turns(turns: DataFrame, heads: int = HEADS, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """The turns (``conv_id``, ``place``, ``role``, ``text``) of rebuilt conversations, and (``conv_id``, ``n_turns``) of each.

    Conversation c has the first h turns of conversation c - c % group (all of them if it
    has fewer, none if it isn't there), then its own turns after its first h; h is the unsigned crc32 of
    the decimal c, modulo ``heads``.  The remainder has the sign of c.  Only the first h turns of a conversation are copied.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    asked = sizes.select("conv_id", "own", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
                         (F.col("conv_id") - F.col("conv_id") % group).alias("donor"))
    asked = asked.join(sizes.select(F.col("conv_id").alias("donor"), F.col("own").alias("given")), "donor", "left")
    plan = stored(asked.select("conv_id", "donor", "h", "own", F.least("h", F.coalesce("given", F.lit(0))).alias("n_heads")), "rebuilt")
    first = turns.where(F.col("place") < heads - 1).select(F.col("conv_id").alias("donor"), "place", "role", "text")
    copied = plan.select("conv_id", "donor", "n_heads").join(first, "donor").where("place < n_heads").select("conv_id", "place", "role", "text")
    kept = (turns.join(plan.select("conv_id", "h", "n_heads"), "conv_id").where("place >= h")
            .select("conv_id", (F.col("place") - F.col("h") + F.col("n_heads")).alias("place"), "role", "text"))
    return copied.unionByName(kept), plan.select("conv_id", (F.col("n_heads") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))


def _key(depth: Column, one: Column, two: Column) -> Column:
    return F.struct(depth.cast("bigint").alias("depth"), one.alias("one"), two.alias("two"))


def placed_nodes(turns: DataFrame) -> DataFrame:
    """A row per turn: ``conv_id``, ``node``, ``parent`` (keys) and ``words`` of its text."""
    known = turns.select("conv_id", "place", F.xxhash64(F.lit(1), "place", "role", "text").alias("a"),
                         F.xxhash64(F.lit(2), "text", "role", "place").alias("b"), n_words(F.col("text")).alias("words"))
    rows = running(known, ["conv_id"], ["place"], {"one": ("bit_xor", "a"), "two": ("bit_xor", "b")})
    depth = F.col("place") + 1
    return rows.select("conv_id", _key(depth, F.col("one"), F.col("two")).alias("node"),
                       _key(F.col("place"), F.col("one").bitwiseXOR(F.col("a")), F.col("two").bitwiseXOR(F.col("b"))).alias("parent"), "words")


def ends_digests(ends: DataFrame) -> DataFrame:
    """``node``, ``ends_sha256``: SHA-256 of its decimal ``conv_id``, ascending, with commas between.

    Ids are sorted over all tasks and joined to rows of up to ``CHUNK_IDS`` where they are; one task then
    passes the few rows of a node through one hash state.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def out():
            return pa.RecordBatch.from_arrays([
                pa.array([node], KEY), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["node", "first", "ids"])

        for b in batches:
            for k, c in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist()):
                if ids and (k != node or len(ids) >= CHUNK_IDS):
                    yield out()
                    ids = []
                node = k
                ids.append(c)
        if ids:
            yield out()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def out(done):
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], KEY), pa.array([s for _, s in done], pa.string())], ["node", "ends_sha256"])

        for b in batches:
            done = []
            for k, text in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
                if k == node:
                    state.update(b"," + text.encode())
                else:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = k, hashlib.sha256(text.encode())
            yield out(done)
        if state is not None:
            yield out([(node, state.hexdigest())])

    KEY = pa.struct([("depth", pa.int64()), ("one", pa.int64()), ("two", pa.int64())])
    kind = "struct<depth:bigint,one:bigint,two:bigint>"
    rows = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = rows.mapInArrow(joined, f"node {kind}, first bigint, ids string")
    return (chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digested, f"node {kind}, ends_sha256 string"))


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations in ``sizes`` (``conv_id``, ``n_turns``; unique ids).

    ``turns`` has ``conv_id``, ``place`` (0 to n_turns - 1), ``role``, ``text``, without nulls.  The columns:
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.  A conversation without turns is a member of
    the root alone.  Without conversations there are no nodes.
    """
    none = _key(F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
    placed = stored(placed_nodes(turns), "placed")
    inner = placed.groupBy("node").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                                       F.min("parent").alias("parent"), F.max("words").alias("words"))
    root = (sizes.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
            .select(none.alias("node"), "n_convs", "conv_id", F.lit(None).cast(inner.schema["parent"].dataType).alias("parent"),
                    F.lit(0).cast("bigint").alias("words")))
    nodes = stored(inner.unionByName(root), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes_with = stored(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    totals = subtree_totals(nodes_with.select("node", "parent", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
                                              ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    ends = (placed.join(sizes, "conv_id").where(F.col("node.depth") == F.col("n_turns")).select("node", "conv_id")
            .unionByName(sizes.where("n_turns = 0").select(none.alias("node"), "conv_id")))
    digests = stored(ends_digests(ends), "ends")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes_with.join(totals, "node").join(digests, "node", "left").join(above, "parent", "left")
    return out.select("conv_id", F.col("node.depth").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt conversations of a table of turns (``conv_id, turn, role, text``).

    Nulls, ties and rows without an id as in :func:`ordered_turns`; repeated rows are turns of their own;
    empty texts are turns without words; other columns are not read.
    """
    turns = stored(ordered_turns(conversations), "turns")
    rebuilt, sizes = rebuilt_turns(turns)
    return prefix_trie(rebuilt, sizes)

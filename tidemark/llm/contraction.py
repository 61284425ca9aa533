"""Subtree totals of a forest held in a table, by parallel tree contraction.

Rounds alternate two steps.  *Compress*: a chain of nodes with one child each is taken out as a whole; its
nodes find the chain's end by pointer doubling, one join a step, and add up what they pass.  *Rake*:
all leaves are taken out and added to their parents, a map-side combined sum.  After a compress
every node left is a leaf or has two children at least, so a round halves the tree
at least; whatever a node's children or a chain's length are, no task gets them all.

Then the contracted nodes are expanded again, last round first: a node of a chain has the
sum of its way plus the total of the chain's end.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, stored


def _sums(names: Sequence[str], left: str, right: str) -> Column:
    return F.struct(*[(F.col(f"{left}.{n}") + F.col(f"{right}.{n}")).alias(n) for n in names])


def _total(names: Sequence[str], of: str) -> Column:
    return F.struct(*[F.sum(f"{of}.{n}").alias(n) for n in names])


def _children(live: DataFrame) -> DataFrame:
    """The nodes with ``kids``, and of an only child ``child`` and its ``on_way``."""
    kids = (live.where("parent is not null").groupBy(F.col("parent").alias("node"))
            .agg(F.count("*").alias("kids"), F.max_by(F.struct("node", "carry"), "node").alias("only")))
    return live.join(kids, "node", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))


def _chains(single: DataFrame, names: Sequence[str]) -> DataFrame:
    """Of each node with an only child: ``node``, ``to`` (its chain's end), ``way`` (sums up to it, without its total), ``hops``."""
    ways = stored(single.select("node", F.col("only.node").alias("to"), _sums(names, "acc", "only.carry").alias("way"),
                                F.lit(1).cast("bigint").alias("hops")), "ways")
    while True:
        ahead = ways.select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("way").alias("more"), F.col("hops").alias("steps"))
        new = stored(ways.join(ahead, "to", "left").select(
            "node", F.coalesce("next", "to").alias("to"),
            F.when(F.col("next").isNull(), F.col("way")).otherwise(_sums(names, "way", "more")).alias("way"),
            (F.col("hops") + F.coalesce("steps", F.lit(0))).alias("hops"), F.col("next").isNotNull().alias("moved")), "ways")
        discard(ways)
        ways = new.drop("moved")
        ways.stored_at = new.stored_at
        if new.where("moved").isEmpty():
            return ways


def subtree_totals(tree: DataFrame, names: Sequence[str]) -> DataFrame:
    """``node`` and for each of ``names`` (bigint columns) the sum over the node's subtree, itself included.

    ``tree`` has ``node`` (any type that joins, unique, not null), ``parent`` (null for a root) and the columns; every
    parent is a node and there are no circles.  An empty tree gives no rows.
    """
    nothing = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in names])
    live = stored(tree.select("node", "parent", F.struct(*[F.col(n).cast("bigint").alias(n) for n in names]).alias("acc"),
                              nothing.alias("carry")), "live")
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    while not live.isEmpty():
        state = stored(_children(live), "state")
        discard(live)
        single = state.where("kids = 1")
        ends = state.where("kids <> 1").select("node", "parent", "acc", "carry", "kids")
        ways = None
        if not single.isEmpty():
            # compress: a chain's end hangs on the parent of its top
            ways = _chains(single, names)
            tops = ways.join(single.select("node", F.col("parent").alias("above"), F.col("carry").alias("rest")), "node")
            tops = tops.groupBy(F.col("to").alias("node")).agg(F.max_by(F.struct("above", "way", "rest"), "hops").alias("top"))
            # between it and its new parent lie the whole way and what lay above the top
            ends = ends.join(tops, "node", "left").select(
                "node", F.when(F.col("top").isNull(), F.col("parent")).otherwise(F.col("top.above")).alias("parent"), "acc",
                F.when(F.col("top").isNull(), F.col("carry")).otherwise(_sums(names, "top.way", "top.rest")).alias("carry"), "kids")
        ends = stored(ends, "ends")
        # rake: leaves are done and add to their parents
        leaves = stored(ends.where("kids = 0").select("node", F.col("acc").alias("total")), "leaves")
        given = (ends.where("kids = 0 and parent is not null").select(F.col("parent").alias("node"), _sums(names, "acc", "carry").alias("all"))
                 .groupBy("node").agg(_total(names, "all").alias("all")))
        live = stored(ends.where("kids > 0").join(given, "node", "left").select(
            "node", "parent", F.when(F.col("all").isNull(), F.col("acc")).otherwise(_sums(names, "acc", "all")).alias("acc"), "carry"), "live")
        discard(state, ends)
        rounds.append((leaves, ways))
    discard(live)
    return _expanded(rounds, names, tree)


def _expanded(rounds: list[tuple[DataFrame, DataFrame | None]], names: Sequence[str], tree: DataFrame) -> DataFrame:
    done: list[DataFrame] = []
    for leaves, ways in reversed(rounds):
        done.append(leaves)
        if ways is not None:
            known = reduce(DataFrame.unionByName, done)
            done.append(stored(ways.join(known.select(F.col("node").alias("to"), "total"), "to")
                               .select("node", _sums(names, "way", "total").alias("total")), "expanded"))
            discard(ways)
    if not done:
        return tree.select("node", *[F.col(n).cast("bigint").alias(n) for n in names])
    return reduce(DataFrame.unionByName, done).select("node", *[F.col(f"total.{n}").alias(n) for n in names])

"""Two stored tables compared by a tree of checksums, so that only ranges that differ are read.

A row's position is the hash of its key, a signed 64-bit number.  Rows are stored in the order of their positions; a node
of the tree is a range of positions, sixteen to a parent, with the number of its rows and sums of their
hashes.  Two tables are compared from the top: children are looked at only below nodes that differ.  The
ranges found are filters on the position that reach the Parquet statistics of both tables, and their rows are compared
by value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AT, ROW = "_at", "_row"
BITS = 4                        # of the position per level: sixteen children
LEVELS = 4                      # 65,536 leaves
MOST_RANGES = 256               # nodes the driver follows; beyond them the level above decides
_SUMS = ["rows", "low", "middle", "high"]
_MODULUS = 1 << 40


def _told_apart(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Inputs of a hash that tell a NULL from the lack of a column's share; nested values count by their JSON."""
    out = []
    for name in columns:
        c = F.col(f"`{name}`")
        if not isinstance(df.schema[name].dataType, T.AtomicType):
            c = F.to_json(F.struct(c), {"ignoreNullFields": "false"})
        out += [c.isNull(), c]
    return out


def write_summed(df: DataFrame, root: str, keys: Sequence[str], levels: int = LEVELS) -> None:
    """Store a table in the order of its positions (``rows``) and its tree (``sums``).

    Rows of one key, however many, may lie in several files.  Keys may be NULL and need not be unique.
    """
    taken = {AT, ROW} & set(df.columns)
    if taken:
        raise ValueError(f"columns are kept for positions: {sorted(taken)}")
    if not 1 <= levels <= 5:
        raise ValueError("a tree has one to five levels")
    placed = df.withColumns({AT: F.xxhash64(*_told_apart(df, keys)), ROW: F.xxhash64(*_told_apart(df, sorted(df.columns)))})
    root = root.rstrip("/")
    placed.repartitionByRange(AT, ROW).sortWithinPartitions(AT, ROW).write.mode("errorifexists").parquet(f"{root}/rows")
    rows = df.sparkSession.read.schema(placed.schema).parquet(f"{root}/rows")
    # shares of 22, 21 and 21 bits: their sums hold 2^41 rows of one node
    shares = rows.select(
        F.shiftrightunsigned(AT, 64 - BITS * levels).alias("leaf"), F.lit(1).cast("bigint").alias("rows"),
        F.col(ROW).bitwiseAND((1 << 22) - 1).alias("low"),
        F.shiftrightunsigned(ROW, 22).bitwiseAND((1 << 21) - 1).alias("middle"), F.shiftrightunsigned(ROW, 43).alias("high"))
    leaves = shares.groupBy("leaf").agg(*[F.pmod(F.sum(c), F.lit(_MODULUS)).alias(c) for c in _SUMS])
    # a node's place among those of its level: the leading bits of its leaves
    above = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.shiftrightunsigned("leaf", BITS * (levels - n)).alias("node"))
                                for n in range(1, levels + 1)]))
    nodes = (leaves.select(above.alias("n"), *_SUMS).groupBy("n.level", "n.node")
             .agg(*[F.pmod(F.sum(c), F.lit(_MODULUS)).alias(c) for c in _SUMS]))
    nodes.repartition("level").sortWithinPartitions("node").write.partitionBy("level").mode("errorifexists").parquet(f"{root}/sums")
    # an empty table has no node, but its depth is known
    df.sparkSession.createDataFrame([(levels,)], "levels int").coalesce(1).write.mode("errorifexists").parquet(f"{root}/shape")


@dataclass(frozen=True)
class Descent:
    """The nodes looked at per level, and the ranges of positions (first, last) that may hold differences."""

    looked_at: tuple[int, ...]
    ranges: tuple[tuple[int, int], ...]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _as_ranges(nodes: Sequence[int], level: int) -> tuple[tuple[int, int], ...]:
    """Nodes of a level as ranges of signed positions, neighbours joined; none reaches over the sign."""
    shift, out = 64 - BITS * level, []
    for n in sorted(nodes):
        first, last = _signed(n << shift), _signed(((n + 1) << shift) - 1)
        if out and out[-1][1] + 1 == first:
            out[-1] = (out[-1][0], last)
        else:
            out.append((first, last))
    return tuple(out)


def differing_ranges(spark: SparkSession, left: str, right: str, most: int = MOST_RANGES) -> Descent:
    """Where two tables of :func:`write_summed` may differ; at most ``most`` nodes of a level come to the driver.

    Where more differ, the ranges are those of the level above: larger, but none is left out.
    """
    depths = {spark.read.schema("levels int").parquet(f"{r.rstrip('/')}/shape").first()[0] for r in (left, right)}
    if len(depths) > 1:
        raise ValueError(f"trees of different depth: {sorted(depths)}")
    schema = ", ".join(["node bigint", *[f"{c} bigint" for c in _SUMS], "level int"])

    def nodes(root: str, level: int, parents: list[int] | None) -> DataFrame:
        found = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/sums").where(F.col("level") == level)
        return found if parents is None else found.where(F.shiftrightunsigned("node", BITS).isin(parents))

    parents, level_of, looked = None, 0, []
    for level in range(1, depths.pop() + 1):
        one, two = (nodes(r, level, parents).alias(a) for r, a in ((left, "l"), (right, "r")))
        same = F.lit(True)
        for c in _SUMS:
            same &= F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
        unlike = (one.join(two, F.col("l.node") == F.col("r.node"), "full_outer").where(~same)
                  .select(F.coalesce("l.node", "r.node").alias("node")).limit(max(most, 1 << BITS) + 1).collect())
        looked.append((1 << BITS) if parents is None else len(parents) << BITS)
        if not unlike:
            return Descent(tuple(looked), ())
        if len(unlike) > max(most, 1 << BITS):
            break
        parents, level_of = [r["node"] for r in unlike], level
    return Descent(tuple(looked), _as_ranges(parents, level_of))


def read_ranges(spark: SparkSession, root: str, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """The rows at some ranges of positions; files and row groups without any are skipped by their statistics."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/rows")
    inside = F.lit(False)
    for first, last in ranges:
        inside |= F.col(AT).between(first, last)
    return rows.where(inside).drop(AT, ROW)


def differing_rows(spark: SparkSession, left: str, right: str, most: int = MOST_RANGES) -> DataFrame:
    """Rows that one table has more often than the other: their columns, ``n_left`` and ``n_right``.

    A changed row is there twice, as it was and as it is.  The tables need the same columns, none of them a
    map.  NULL equals NULL.  Tables alike give no rows and none of their rows is read.
    """
    ranges = differing_ranges(spark, left, right, most).ranges
    one, two = (read_ranges(spark, r, ranges) for r in (left, right))
    if sorted(one.dtypes) != sorted(two.dtypes):
        raise ValueError(f"different columns: {sorted(set(one.dtypes) ^ set(two.dtypes))}")
    columns = one.columns
    none, each = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    both = one.select("*", each.alias("n_left"), none.alias("n_right")).unionByName(
        two.select("*", none.alias("n_left"), each.alias("n_right")))
    return (both.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
            .where(F.col("n_left") != F.col("n_right")))

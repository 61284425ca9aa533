"""Dense numbers and running values along an order, without a task that sees all rows of a key.

Two passes.  Rows are range-partitioned, sorted and stored with their partition and their place
in it; a partition's share of a count or sum is then known, and what the partitions
before it add up to is a table with a few rows per partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

PART, AT = "_part", "_at"
_PLACE = "_place"
_IN_PART = 33                   # low bits of an increasing id: the place in the partition


def sorted_parts(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """The rows, stored in order, with their partition (``_part``) and their place in it (``_at``).

    Rows alike in ``order_by`` may be cut between partitions, so none grows with the number of equal rows.
    """
    order = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_by]
    dealt = df.withColumn(_PLACE, F.monotonically_increasing_id()).repartitionByRange(*order, _PLACE)
    rows = dealt.sortWithinPartitions(*order, _PLACE).drop(_PLACE).withColumn(_PLACE, F.monotonically_increasing_id())
    rows = stored(rows, "sorted")
    return rows.withColumns({PART: F.shiftright(_PLACE, _IN_PART), AT: F.col(_PLACE).bitwiseAND((1 << _IN_PART) - 1)}).drop(_PLACE)


def dense_numbers(df: DataFrame, order_by: Sequence[str | Column], name: str, start: int = 0) -> DataFrame:
    """``df`` with ``name``: the place of each row in the order, from ``start`` on, without gaps.

    The numbers depend on the order alone and not on partitions, if ``order_by`` tells
    different rows apart.  An empty table stays empty.
    """
    rows = sorted_parts(df, order_by)
    sizes = rows.groupBy(PART).agg((F.max(AT) + 1).alias("_size"))
    # one row per partition
    before = sizes.select(PART, (F.sum("_size").over(Window.orderBy(PART)) - F.col("_size")).alias("_before"))
    return rows.join(before, PART).withColumn(name, F.col("_before") + F.col(AT) + start).drop(PART, AT, "_before")


_MERGED = {"count": F.sum, "sum": F.sum, "bit_xor": F.bit_xor}
_OWN = {"count": F.count, "sum": F.sum, "bit_xor": F.bit_xor}


def _combined(kind: str, a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b) if kind == "bit_xor" else a + b


def running(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
            values: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``df`` with running values inside each key, up to and with the row itself.

    ``values`` maps a new column to (``count``, ``sum`` or ``bit_xor``, column); the column must not hold nulls,
    nor may the keys.  A key of any size is worked on partition by partition.  Rows equal
    in ``order_by`` come in any order.
    """
    rows = sorted_parts(df, [*keys, *order_by])
    inside = Window.partitionBy(PART, *keys).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumns({n: _OWN[k](F.col(c)).over(inside) for n, (k, c) in values.items()})
    shares = rows.groupBy(*keys, PART).agg(*[_OWN[k](c).alias(n) for n, (k, c) in values.items()])
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # a key has a row here for each partition it reaches into; only those after its first have something before
    before = (shares.select(*keys, PART, *[_MERGED[k](F.col(n)).over(earlier).alias(f"_{n}") for n, (k, _) in values.items()])
              .where(F.col(f"_{next(iter(values))}").isNotNull()))
    joined = own.join(before, [*keys, PART], "left")
    return joined.withColumns({n: F.when(F.col(f"_{n}").isNull(), F.col(n)).otherwise(_combined(k, F.col(n), F.col(f"_{n}")))
                               for n, (k, _) in values.items()}).drop(PART, AT, *[f"_{n}" for n in values])

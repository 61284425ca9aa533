"""One row per key out of a log that delivers the same entity again and again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "_rank_in_key"
_TASK = "_input_task"


def row_fingerprint(df: DataFrame) -> Column:
    """Hash of the whole row, the default tie-break between equally new rows."""
    usable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in usable])


def first_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each key.

    A single row per key: Spark limits each key below the shuffle, so every map
    task sends one row of it.  More rows: each input task's share of a key is ranked by
    itself first, whatever n is, and only its first n rows are ranked together;
    a key that holds a third of the table is never gathered.
    """
    if n > 1:
        df = df.withColumn(_TASK, F.spark_partition_id())
        own = F.row_number().over(Window.partitionBy(*keys, _TASK).orderBy(*order))
        df = df.withColumn(_RANK, own).filter(F.col(_RANK) <= n).drop(_RANK, _TASK)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) <= n).drop(_RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                   tie_break: Sequence[str] | None = None, ascending: bool = False) -> DataFrame:
    """The newest (or, ascending, the oldest) row of each key; NULL keys form one key.

    ``tie_break`` columns sort in the same direction as ``order_by`` and must
    tell equally new rows of a key apart.  Without them the row fingerprint does,
    so the result never depends on the order in which rows arrive; it reads every
    column, which named columns avoid.
    """
    names = [*order_by, *(tie_break or [])]
    order = [F.col(c).asc() if ascending else F.col(c).desc() for c in names]
    last = [] if tie_break else [row_fingerprint(df)]
    return first_ranked(df, keys, [*order, *last], 1)

"""Stored tables of which only the parts that change are written again.

A part is a bucket of keys or a day.  New contents of some parts are written in one job to a folder of their own and become
visible together, by one commit (see :mod:`commits`); other parts stay where they are and are not read.  The newest
folder of a part counts.  The driver sees one line per part.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.latest import latest_per_key
from ..operators.shape import align
from ..session import stored
from .commits import LOAD, commits, exists, folder_of, publish
from .tables import _file_system

_PART = "_part"
BUCKETS = 64


def current_parts(spark: SparkSession, root: str) -> tuple[dict[str, str], T.StructType | None]:
    """The folder of each part that has rows, and the table's schema."""
    done = commits(spark, root)
    if done is None:
        return {}, None
    last = done.where(F.col("table").isNotNull()).groupBy("table").agg(
        F.max_by(F.struct("folder", "schema", "number"), "number").alias("last")).select("table", "last.*").collect()
    schemas = [(r["number"], r["schema"]) for r in last]
    schema = T.StructType.fromJson(json.loads(max(schemas)[1])) if schemas else None
    return {r["table"]: r["folder"] for r in last if r["folder"]}, schema


def read_parts(spark: SparkSession, root: str, parts: Iterable | None = None) -> DataFrame | None:
    """The table, or some of its parts; None before the first commit."""
    folders, schema = current_parts(spark, root)
    if schema is None:
        return None
    chosen = sorted(folders.values()) if parts is None else sorted(folders[p] for p in map(str, parts) if p in folders)
    return spark.read.schema(schema).parquet(*chosen) if chosen else spark.createDataFrame([], schema)


def replace_parts(df: DataFrame, root: str, part: Column, parts: Iterable) -> list[str]:
    """Make ``df`` the whole content of ``parts``; a part of which it has no rows is empty from then on.

    ``part`` is the part of a row; rows of other parts are an error of the caller.  A part with many rows is written by several tasks.
    """
    spark, load = df.sparkSession, uuid.uuid4().hex
    folder = folder_of(root, load)
    rows = df.withColumn(_PART, part.cast("string"))
    rows.hint("rebalance", F.col(_PART)).write.partitionBy(_PART).mode("errorifexists").parquet(folder)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    names = sorted({str(p) for p in parts})
    publish(spark, root, load, [(p, at if exists(spark, at := f"{folder}/{_PART}={p}") else None, schema) for p in names])
    return names


def vacuum_parts(spark: SparkSession, root: str) -> list[str]:
    """Remove what no part points to: replaced contents and writes that were never finished.  No reader may hold an old version."""
    kept = set(current_parts(spark, root)[0].values())
    removed = []
    jroot, fs = _file_system(spark, root)
    for load in fs.listStatus(jroot) if fs.exists(jroot) else []:
        name = load.getPath().getName()
        if not name.startswith(LOAD):
            continue
        inner = [s.getPath().getName() for s in fs.listStatus(load.getPath()) if s.isDirectory()]
        old = [x for x in inner if x.startswith(f"{_PART}=") and f"{root.rstrip('/')}/{name}/{x}" not in kept]
        if len(old) == len(inner):
            fs.delete(load.getPath(), True)
        else:
            for x in old:
                fs.delete(_file_system(spark, f"{root.rstrip('/')}/{name}/{x}")[0], True)
        removed += [f"{name}/{x}" for x in old]
    return removed


# --- newest row of each key, kept up to date -------------------------------

@dataclass(frozen=True)
class Merged:
    """What a merge did: the buckets it wrote, and the folders it read for them."""

    buckets: tuple[str, ...]
    read: tuple[str, ...]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets))


def merge_latest(batch: DataFrame, root: str, keys: Sequence[str], order_by: Sequence[str],
                 tie_break: Sequence[str] | None = None, buckets: int = BUCKETS) -> Merged:
    """Bring a snapshot of the newest row per key up to date with new rows, in any order of delivery.

    The result is that of ``latest_per_key`` over all rows ever merged.  Only buckets that hold a key of the batch
    are read and written.  ``buckets`` must not change over a table's life.  The batch must have
    the columns of the table.
    """
    spark = batch.sparkSession
    folders, schema = current_parts(spark, root)
    if schema is not None and set(schema.fieldNames()) != set(batch.columns):
        raise ValueError(f"the table has {schema.fieldNames()}, the batch {batch.columns}")
    rows = batch if schema is None else align(batch, schema)
    newest = stored(latest_per_key(rows, keys, order_by, tie_break), "batch")
    touched = sorted(str(r["b"]) for r in newest.select(bucket_of(keys, buckets).alias("b")).distinct().collect())
    old = [folders[b] for b in touched if b in folders]
    if not touched:
        return Merged((), ())
    if old:
        newest = latest_per_key(newest.unionByName(spark.read.schema(schema).parquet(*old)), keys, order_by, tie_break)
    replace_parts(newest, root, bucket_of(keys, buckets), touched)
    return Merged(tuple(touched), tuple(old))


# --- a model of days, of which changed ones are built again ----------------

def changed_days(deliveries: Iterable[DataFrame], date_col: str = "date") -> list[date]:
    """The days that new deliveries have rows of; at most as many as the calendar has."""
    found: set[date] = set()
    for df in deliveries:
        found |= {r[0] for r in df.select(F.col(date_col).cast("date")).where(F.col(date_col).isNotNull()).distinct().collect()}
    return sorted(found)


def rebuild_days(build: Callable[..., DataFrame], sources: Mapping[str, DataFrame], days: Sequence[date], root: str,
                 date_col: str = "date") -> list[str]:
    """Build a model again for some days only and put them in the place of the stored ones.

    ``build`` gets the sources cut to the days, a filter that reaches their scans, and must make each day of that day's rows
    alone.  A day that has no rows any more is removed.
    """
    if not days:
        return []
    wanted = [F.lit(d) for d in days]
    model = build(**{name: df.where(F.col(date_col).isin(wanted)) for name, df in sources.items()})
    return replace_parts(model, root, F.col(date_col), days)


def expire_days(spark: SparkSession, root: str, first: date) -> list[str]:
    """Take days before ``first`` out of the table; their files go with the next :func:`vacuum_parts`."""
    folders, schema = current_parts(spark, root)
    gone = sorted(p for p in folders if p < str(first))
    if gone:
        publish(spark, root, uuid.uuid4().hex, [(p, None, schema) for p in gone])
    return gone

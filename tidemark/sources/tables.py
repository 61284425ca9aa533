"""Declared tables, loading, and writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import prepare


@dataclass(frozen=True)
class Source:
    """One declared table: where it lies, its schema if fixed, and what it holds."""

    name: str
    path: str
    schema: T.StructType | None = None
    description: str = ""
    fmt: str = "parquet"


class Catalogue:
    """Name → source."""

    def __init__(self, sources: Sequence[Source]):
        self.sources = {s.name: s for s in sources}

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        s = self.sources[name]
        reader = spark.read.format(s.fmt)
        if s.schema is not None:
            reader = reader.schema(s.schema)
        return with_instants(reader.load(s.path))

    def load_all(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: self.load(spark, name) for name in self.sources}


def with_instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become instants of the session zone (UTC)."""
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table as stored: zone-less timestamps stay, so filters on them reach the scan."""
    prepare(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Full rebuild of a table model; returns the stored table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, root: str) -> DataFrame | None:
    path = f"{root.rstrip('/')}/_pointers"
    jpath, fs = _file_system(spark, path)
    return spark.read.schema("version string, number bigint").parquet(path) if fs.exists(jpath) else None


def replace(df: DataFrame, root: str, version: str) -> DataFrame:
    """Replace a whole table: write a new version beside the old one, then point to it.

    Readers of :func:`current` see the old rows or the new ones, never a table
    that is half deleted.  The frame may read the version it replaces.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    # one row naming the current version, with a number above all before; written last
    last = _pointers(spark, root)
    number = 1 if last is None else last.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
    pointer = spark.range(1).select(F.lit(version).alias("version"), F.lit(number).cast("bigint").alias("number"))
    pointer.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/_pointers")
    return spark.read.parquet(path)


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The version :func:`replace` pointed to last; None before the first one."""
    pointers = _pointers(spark, root)
    if pointers is None:
        return None
    newest = pointers.orderBy(F.col("number").desc()).first()
    return spark.read.parquet(f"{root.rstrip('/')}/version={newest['version']}")


def read_grid(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """A grid whose first row is the header, all cells text; empty is an error."""
    grid = spark.read.option("header", True).option("multiLine", True).csv(path)
    if not grid.columns or grid.isEmpty():
        raise ValueError(f"{path} is empty")
    return grid.limit(limit) if limit else grid


def as_catalogue(folder: str, names: Sequence[str],
                 notes: Mapping[str, str] | None = None) -> Catalogue:
    return Catalogue([Source(n, f"{folder.rstrip('/')}/{n}.parquet",
                             description=(notes or {}).get(n, "")) for n in names])

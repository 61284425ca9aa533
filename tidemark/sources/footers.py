"""Row counts and newest days of Parquet tables from file footers, without reading a row."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import prepare

# Parquet keeps usable bounds for these; Spark asks for no others, timestamps and texts among them
_BOUNDED = (T.DateType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType)
_SETTINGS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which min, max and count are answered by footers.

    Settings of the caller's session stay as they are.
    """
    side = prepare(spark.newSession())
    for name, value in _SETTINGS.items():
        side.conf.set(name, value)
    return side


def footer_bounds(spark: SparkSession, tables: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """(table, min_value, max_value, row_count), the bounds as text, of (path, column) per table.

    Tables whose column has no bounds in a footer (text, timestamps) are refused; without a column only rows are counted.
    A table without rows has NULL bounds.
    """
    side = footer_session(spark)

    def one(name: str, path: str, column: str | None) -> DataFrame:
        df = side.read.parquet(path)
        if column is not None and not isinstance(df.schema[column].dataType, _BOUNDED):
            raise ValueError(f"footers hold no bounds of {name}.{column}: {df.schema[column].dataType.simpleString()}")
        ends = [F.min(column).alias("lo"), F.max(column).alias("hi")] if column is not None else []
        found = df.agg(F.count("*").alias("row_count"), *ends)
        lo, hi = (F.col(c).cast("string") if ends else F.lit(None).cast("string") for c in ("lo", "hi"))
        # A table without row groups has no footer that says 0, and Spark, which takes a count for never NULL, drops a
        # plain coalesce; nullif brings the NULL back.
        return found.select(F.lit(name).alias("table"), lo.alias("min_value"), hi.alias("max_value"),
                            F.coalesce(F.nullif(F.col("row_count"), F.lit(-1)), F.lit(0)).cast("bigint").alias("row_count"))
    return reduce(lambda a, b: a.unionByName(b), [one(n, p, c) for n, (p, c) in tables.items()])

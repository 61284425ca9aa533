"""The registry itself and helpers for SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that gives the same rows."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load_table(spark, folder, name)


def cents(col: str | Column) -> Column:
    """Money as whole cents: sums of doubles depend on their order, sums of longs do not."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * 100).cast("bigint")


def sql_cents(expr: str) -> str:
    return f"CAST(round({expr} * 100) AS BIGINT)"


def sql_round(expr: str, digits: int) -> str:
    """Rounding of the shown decimal value, half away from zero, as Spark does it."""
    shown = f"CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(round({shown}, {digits}) AS DOUBLE)"


_SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "int": "INTEGER"}


def sql_columns(schema: T.StructType, given: dict[str, str]) -> str:
    """Select list in schema order; columns that are not given are typed NULLs."""
    unknown = set(given) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    return ",\n  ".join(
        f"CAST({given.get(f.name, 'NULL')} AS {_SQL_TYPES[f.dataType.simpleString()]}) "
        f'AS "{f.name}"' for f in schema.fields)

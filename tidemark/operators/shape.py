"""Schema alignment, unions and row filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import day_literal


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to ``schema``, pad missing columns with typed NULLs, order the columns."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in schema.fields:
        name, kind = f"`{field.name}`", field.dataType.simpleString()
        if have.get(field.name) == field.dataType:
            out.append(name)
        else:
            value = name if field.name in have else "NULL"
            out.append(f"CAST({value} AS {kind}) AS {name}")
    return df.selectExpr(*out)


def aligned_union(dfs: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """UNION ALL by name; a column no branch knows is an error, not a shifted metric."""
    wanted = set(schema.fieldNames())
    for df in dfs:
        unknown = [c for c in df.columns if c not in wanted]
        if unknown:
            raise ValueError(f"columns outside the union schema: {unknown}")
    return reduce(lambda a, b: a.unionByName(b), [align(df, schema) for df in dfs])


def rolling_window(df: DataFrame, date_col: str, days: int, as_of: date | str | Column,
                   limit: int | None = None, order_by: Sequence[Column] = ()) -> DataFrame:
    """Rows dated from ``as_of - days`` on, optionally ordered and cut to a row limit."""
    out = df.filter(F.col(date_col) >= F.date_sub(day_literal(as_of), days))
    if order_by:
        out = out.orderBy(*order_by)
    return out.limit(limit) if limit else out


def ordered_scan(df: DataFrame, order_by: Sequence[Column], limit: int | None = None) -> DataFrame:
    """The whole table in order, or its first rows; an empty table is an error."""
    if df.isEmpty():
        raise ValueError("the table is empty")
    out = df.orderBy(*order_by)
    return out.limit(limit) if limit else out


def zone_date(instant: Column, zone: str) -> Column:
    """Calendar date of an instant in a time zone, e.g. the ``as_of`` of a site."""
    return F.from_utc_timestamp(instant, zone).cast("date")


def not_deleted(flag: Column) -> Column:
    """Soft delete; an unset flag means the row is alive."""
    return ~F.coalesce(flag, F.lit(False))


def differs_from(col: Column, value: str) -> Column:
    """Exclude one category; rows without a category stay."""
    return F.coalesce(col, F.lit("")) != value


# Fixed value: the name a load gets when no real report file came back.
FALLBACK_NAME = r"^[a-z0-9_]+_[0-9]{8}_[0-9]{6}[.]csv$"


def real_loads(df: DataFrame, count_col: str = "record_count",
               name_col: str = "_source_filename") -> DataFrame:
    """Loads with a believable count and a real file name.

    A NULL count or a NULL file name is dropped as well.
    """
    return df.filter((F.col(count_col) > 1) & ~F.col(name_col).rlike(FALLBACK_NAME))


def latest_day_rows(df: DataFrame, date_col: str, before: Column | None = None) -> DataFrame:
    """Rows of the newest day, or of the newest day before a given one."""
    days = df if before is None else df.filter(F.col(date_col) < before)
    newest = days.agg(F.max(date_col).alias("_newest"))
    # one row by construction
    return df.join(F.broadcast(newest), F.col(date_col) == F.col("_newest")).drop("_newest")

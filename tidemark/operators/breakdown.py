"""Breakdowns of daily metrics: top-N with an "other" bucket, value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .latest import _RANK, first_ranked


def _is_exact(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.IntegralType, T.DecimalType))


def topn_other(df: DataFrame, group: Sequence[str], type_col: str, value: str, metric: str,
               n_by_type: Mapping[str, int], sums: Sequence[str],
               other: str = "(other)") -> DataFrame:
    """Sum measures per (group, type, value), keeping the top N values of each type.

    Rows are ranked inside (group, type) by ``metric`` descending, then by value.
    Rows below rank N are summed under ``other``; a type without an N keeps all
    its values.  A real value called ``other`` joins the bucket.  A sum over no
    non-NULL value is NULL.

    No group is ever gathered in one task, whatever N is.  The bucket is the group
    total minus the kept rows: totals combine on the map side, and the rows of each
    input task are ranked before what is left of them is ranked together.
    Subtraction is exact only for integers and decimals, so other measure types
    are refused.  The input is read twice: store it first where it is costly.
    """
    inexact = [c for c in sums if not _is_exact(df.schema[c].dataType)]
    if inexact:
        raise ValueError(f"sums need integer or decimal measures, not {inexact}")

    keys = [*group, type_col]
    rows = df.select(*keys, F.col(value).alias(value), *[F.col(c) for c in sums],
                     *([] if metric in sums else [F.col(metric)]))
    capped = F.col(type_col).isin(list(n_by_type))

    def signed(sign: Column, label: Column) -> list[Column]:
        measures = [(F.col(c) * sign).alias(c) for c in sums]
        present = [F.when(F.col(c).isNotNull(), sign).otherwise(0).alias(f"_n_{c}") for c in sums]
        return [*[F.col(k) for k in keys], label.alias(value), *measures, *present,
                sign.cast("bigint").alias("_rows")]

    plus = F.lit(1)
    bulk = rows.select(*signed(plus, F.when(capped, F.lit(other)).otherwise(F.col(value))))
    parts = bulk
    if n_by_type:
        limits = F.create_map(*[F.lit(x) for x in chain.from_iterable(n_by_type.items())])
        order = [F.col(metric).desc(), F.col(value).asc(), *[F.col(c).desc() for c in sums]]
        few = first_ranked(rows.filter(capped), keys, order, max(n_by_type.values()))
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        top = few.withColumn(_RANK, rank).filter(F.col(_RANK) <= limits[F.col(type_col)])
        moves = F.explode(F.array(
            F.struct(F.lit(1).alias("sign"), F.col(value).alias("label")),
            F.struct(F.lit(-1).alias("sign"), F.lit(other).alias("label"))))
        moved = top.withColumn("_move", moves)
        parts = bulk.unionByName(
            moved.select(*signed(F.col("_move.sign"), F.col("_move.label"))))

    totals = parts.groupBy(*keys, value).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.sum(f"_n_{c}").alias(f"_n_{c}") for c in sums],
        F.sum("_rows").alias("_rows"))
    return totals.filter(F.col("_rows") > 0).select(
        *keys, value, *[F.when(F.col(f"_n_{c}") > 0, F.col(c)).alias(c) for c in sums])


def breakdown(df: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count of each trimmed non-blank value per field: (by, field, value, n).

    Fields the table does not have are skipped.
    """
    present = [f for f in fields if f in df.columns]
    if not present:
        raise ValueError(f"none of {list(fields)} is a column")
    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.trim(F.col(f).cast("string")).alias("value"))
        for f in present]))
    return (df.select(*by, pairs.alias("_pair"))
            .select(*by, "_pair.field", "_pair.value")
            .filter(F.col("value") != "")
            .groupBy(*by, "field", "value").agg(F.count("*").alias("n")))


MOST_VALUES = 100_000           # distinct values of one field of one load, whose counts make one text


def crowded(values: DataFrame, by: Sequence[str], most: int = MOST_VALUES) -> DataFrame:
    """(by, field, n_values) of loads whose field has more than ``most`` values in a :func:`breakdown`: no category."""
    return values.groupBy(*by, "field").agg(F.count("*").alias("n_values")).filter(F.col("n_values") > most)


def summary_rows(counted: DataFrame, values: DataFrame, fields: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The loads of ``counted`` (by, record_count) with a ``<field>_counts`` JSON of ``values``, a :func:`breakdown`."""
    entries = F.array_sort(F.collect_list(F.struct("value", "n")))
    texts = values.groupBy(*by, "field").agg(F.to_json(F.map_from_entries(entries)).alias("_json"))
    wide = texts.groupBy(*by).agg(*[
        F.max(F.when(F.col("field") == f, F.col("_json"))).alias(f"{f}_counts") for f in fields])
    matched = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
    joined = counted.alias("l").join(wide.alias("r"), matched, "left")
    return joined.select(*[F.col(f"l.{c}").alias(c) for c in by], "record_count",
                         *[F.col(f"{f}_counts") for f in fields])


def daily_summary(df: DataFrame, fields: Sequence[str], by: Sequence[str], most: int = MOST_VALUES) -> DataFrame:
    """One row per load: record count and one ``<field>_counts`` JSON per field.

    The JSON has sorted keys and one entry per distinct value of the field, so the fields must
    be categories: more than ``most`` values of one field in one load are an error, found before any
    text is built.  A load's texts only meet in its row.
    """
    present = [f for f in fields if f in df.columns]
    counted = df.groupBy(*by).agg(F.count("*").alias("record_count"))
    if not present:
        return counted
    values = breakdown(df, present, by)
    sizes = values.groupBy(*by, "field").agg(F.count("*").alias("_values"))
    matched = [F.col(f"v.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*by, "field"]]
    few = F.when(F.col("s._values") <= most, True).otherwise(
        F.raise_error(F.concat(F.lit("a field of more values than a category has: "), F.col("s.field"))))
    checked = values.alias("v").join(sizes.alias("s"), matched).filter(few).select("v.*")
    return summary_rows(counted, checked, present, by)

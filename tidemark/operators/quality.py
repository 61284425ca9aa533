"""Data-quality jobs: freshness, duplicates, comparison, fill, profile, tests."""

from __future__ import annotations

import re
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import signed_percent
from ..session import stored

_TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def business_date(df: DataFrame, synced_mark: str = "_fivetran") -> str | None:
    """First date-like column that is not one of the loader's own."""
    for field in df.schema.fields:
        if isinstance(field.dataType, _TIME_TYPES) and synced_mark not in field.name.lower():
            return field.name
    return None


def freshness(tables: Mapping[str, DataFrame], synced: str = "_fivetran_synced",
              by: str | None = None) -> DataFrame:
    """Newest date, newest sync and rows per table (optionally per group).

    The date column is picked from the schema; one aggregate per table.
    """
    def profile(name: str, df: DataFrame) -> DataFrame:
        picked = business_date(df)
        newest = F.max(F.col(picked).cast("date")) if picked else F.lit(None).cast("date")
        last = F.max(F.col(synced).cast("timestamp")) if synced in df.columns \
            else F.lit(None).cast("timestamp")
        group = [F.col(by).cast("string").alias("group")] if by else []
        return df.groupBy(*group).agg(
            newest.alias("max_date"), last.alias("max_synced"), F.count("*").alias("row_count")
        ).select(F.lit(name).alias("table"), *(["group"] if by else []),
                 "max_date", "max_synced", "row_count")
    return reduce(lambda a, b: a.unionByName(b), [profile(n, d) for n, d in tables.items()])


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, columns, rows): the catalogue joined to its sizes."""
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table"), F.lit(len(df.columns)).cast("bigint").alias("columns"),
            "row_count")
    return reduce(lambda a, b: a.unionByName(b), [one(n, d) for n, d in tables.items()])


# --- duplicates -----------------------------------------------------------

def key_duplicates(df: DataFrame, keys: Sequence[str], top: int | None = None) -> DataFrame:
    """Keys that occur more than once; with ``top`` only the largest, in order."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    if top is None:
        return groups
    return groups.orderBy(F.col("n").desc(), *[F.col(k).asc_nulls_first() for k in keys]).limit(top)


def key_duplicate_summary(df: DataFrame, keys: Sequence[str],
                          blank_is_missing: bool = False) -> DataFrame:
    """One row: total, distinct keys, duplicate groups, extra rows, keys and rows with a gap.

    With ``blank_is_missing`` an empty text counts as a missing part, and keys
    with a missing part are not counted as duplicates.
    """
    def gap(k: str) -> Column:
        return F.col(k).isNull() | (F.col(k).cast("string") == "") if blank_is_missing \
            else F.col(k).isNull()
    missing = reduce(lambda a, b: a | b, [gap(k) for k in keys])
    groups = df.groupBy(*keys).agg(F.count("*").alias("n")).withColumn(
        "_missing", F.coalesce(missing, F.lit(True)))
    dup = (F.col("n") > 1) & (~F.col("_missing") if blank_is_missing else F.lit(True))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return groups.agg(
        total.alias("total_rows"), F.count("*").alias("distinct_keys"),
        F.count_if(dup).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(dup, F.col("n") - 1)), F.lit(0)).alias("extra_rows"),
        F.count_if("_missing").alias("keys_with_gap"),
        F.coalesce(F.sum(F.when(F.col("_missing"), F.col("n"))), F.lit(0)).alias("rows_with_gap"))


def mark_duplicates(df: DataFrame, keys: Sequence[str], mark: str = "n") -> DataFrame:
    """Every row with the size of its key group.

    Sizes come from a map-side combined count and return by a join: a window
    would gather a hot key in one task, the join side of a hot key is split by
    AQE.  Only keys that repeat take part in the join.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_size")).filter(F.col("_size") > 1)
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return df.alias("l").join(sizes.alias("r"), same, "left").select(
        "l.*", F.coalesce("r._size", F.lit(1)).cast("bigint").alias(mark))


def duplicate_days(df: DataFrame, date_col: str, keys: Sequence[str], value: str,
                   sums: Sequence[str]) -> DataFrame:
    """Per day: rows, distinct values, rows whose (day, keys, value) repeats, sums.

    Two aggregations; the row-level window the definition suggests is not needed.
    """
    groups = df.groupBy(date_col, *keys, value).agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(c) for c in sums])
    return groups.groupBy(date_col).agg(
        F.sum("_n").alias("rows"), F.count_distinct(value).alias("distinct_values"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("dup_rows"),
        *[F.sum(c).alias(c) for c in sums])


# --- comparison -----------------------------------------------------------

def compare_full(old: DataFrame, new: DataFrame, keys: Sequence[str],
                 measures: Sequence[str]) -> DataFrame:
    """Old against new per key group: rows and summed measures on both sides."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count("*").alias(f"{name}_rows"),
            *[F.sum(m).alias(f"{name}_{m}") for m in measures])
    return side(new, "new").join(side(old, "old"), list(keys), "full_outer")


def reconcile(mart: DataFrame, raw: DataFrame, keys: Sequence[str], measure: str,
              per: Sequence[str]) -> DataFrame:
    """Per group: keys found on both sides and how many of them disagree on the sum."""
    m = mart.groupBy(*keys).agg(F.sum(measure).alias("_mart"))
    r = raw.groupBy(*keys).agg(F.sum(measure).alias("_raw"))
    return m.join(r, list(keys)).groupBy(*per).agg(
        F.count("*").alias("compared"),
        F.count_if(F.col("_mart") != F.col("_raw")).alias("mismatched"))


def versus_truth(truth: DataFrame, actuals: Mapping[str, DataFrame], key: Sequence[str],
                 pairs: Mapping[str, str], digits: int | None = None) -> DataFrame:
    """Known figures beside measured ones, with the signed difference in percent.

    ``pairs`` maps a truth column to the measured column.  The percentage is
    NULL where a side is missing or the truth is 0.
    """
    out = truth
    for name, actual in actuals.items():
        out = out.join(actual.select(*key, *[F.col(a).alias(f"{name}_{a}")
                                             for a in pairs.values()]), list(key), "left")
    return out.withColumns({
        f"{name}_{a}_pct": signed_percent(F.col(f"{name}_{a}"), F.col(t), digits)
        for name in actuals for t, a in pairs.items()})


def truth_totals(compared: DataFrame, name: str, pairs: Mapping[str, str],
                 digits: int | None = None) -> DataFrame:
    """Totals of :func:`versus_truth` over the keys the measured side has."""
    first = next(iter(pairs.values()))
    sums = compared.filter(F.col(f"{name}_{first}").isNotNull()).agg(
        F.count("*").alias("days"),
        *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in pairs],
        *[F.coalesce(F.sum(f"{name}_{a}"), F.lit(0)).alias(a) for a in pairs.values()])
    return sums.withColumns({f"{a}_pct": signed_percent(F.col(a), F.col(t), digits)
                             for t, a in pairs.items()})


# --- fill and profile -----------------------------------------------------

def _long_form(wide: DataFrame, by: Sequence[str], fields: Sequence[str],
               columns: Mapping[str, str]) -> DataFrame:
    """Turn one aggregate row per group into one row per field; ``columns``: name -> suffix."""
    entries = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"),
                 *[F.col(f"`{f}{suffix}`").alias(name) for name, suffix in columns.items()])
        for f in fields]))
    return wide.select(*by, entries.alias("_e")).select(*by, "_e.*")


def fill_rate(df: DataFrame, by: Sequence[str] = (),
              fields: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value per field: (by, field, filled); fields never filled are left out.

    One wide aggregate; only its small result is turned to long form.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = [f for f in (fields or df.columns) if f not in by]

    def filled(name: str) -> Column:
        col = F.col(f"`{name}`")
        test = col.isNotNull()
        return test & (col != "") if isinstance(types[name], T.StringType) else test
    wide = df.groupBy(*by).agg(*[F.count_if(filled(f)).alias(f"{f}_filled") for f in names])
    return _long_form(wide, by, names, {"filled": "_filled"}).filter(F.col("filled") > 0)


# Rank error of the sketch is below 1/ACCURACY; the bracket is four times as wide.
_ACCURACY = 20000
_BINS = 4096
_BROADCAST_BOUNDS = 10_000          # (group, field) rows that are broadcast at most


def numeric_profile(df: DataFrame, by: Sequence[str],
                    fields: Sequence[str] | None = None) -> DataFrame:
    """Minimum, exact upper median, maximum and count per field and group.

    The upper median is element floor(n/2) of the sorted values.  No group is
    sorted in one task: a sketch brackets the median, the bracket is cut into
    equal bins, rows are counted per bin, and only the distinct values of the
    bin that holds the median are ranked.  All counts are exact and bins keep
    the order of the values, so the sketch steers the work and not the result.

    Whole numbers stay whole where all fields are; else values are doubles.
    The few rows of bounds are broadcast up to a checked number; rows are then read three times and only
    counts per bin and the values of one bin are shuffled.  Beyond that number the bounds are joined by
    key with counts of distinct values, which are stored.
    """
    names = list(fields) if fields else [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in by]
    kinds = [df.schema[f].dataType for f in names]
    kind = "bigint" if all(isinstance(k, T.IntegralType) for k in kinds) else "double"
    values = df.select(*by, *[F.col(f"`{f}`").cast(kind).alias(f) for f in names])
    width = 4.0 / _ACCURACY
    wide = values.groupBy(*by).agg(*[agg for f in names for agg in (
        F.min(f).alias(f"{f}_min"), F.max(f).alias(f"{f}_max"), F.count(f).alias(f"{f}_n"),
        F.percentile_approx(f, [0.5 - width, 0.5 + width], _ACCURACY).alias(f"{f}_cut"))])
    stats = _long_form(wide, by, names, {"min": "_min", "max": "_max", "n": "_n", "cut": "_cut"}) \
        .filter(F.col("n") > 0)

    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in names]))
    long = values.select(*by, pairs.alias("_p")).select(*by, "_p.*").filter(F.col("value").isNotNull())
    stats = stored(stats, "bounds")
    few = stats.count() <= _BROADCAST_BOUNDS
    counted = long.withColumn("_c", F.lit(1).cast("bigint")) if few else stored(
        long.groupBy(*by, "field", "value").agg(F.count("*").alias("_c")), "counted")
    keys = [*by, "field"]

    def small(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if few else rows

    def finite(c: Column) -> Column:
        """Half the value, infinities as the largest double: differences stay finite."""
        return F.greatest(F.least(c.cast("double"), F.lit(sys.float_info.max)), F.lit(-sys.float_info.max)) / 2

    low, high = F.col("s.cut")[0], F.col("s.cut")[1]
    value = F.col("v.value")
    share = (finite(value) - finite(low)) / (finite(high) - finite(low))
    inside = F.least(F.floor(share * _BINS), F.lit(_BINS - 1))
    # -1: below the bracket; _BINS: above it
    place = (F.when(value < low, -1).when(value > high, _BINS)
             .when(finite(high) > finite(low), inside).otherwise(0).cast("int"))
    placed = (counted.alias("v").join(small(stats).alias("s"), _same("v", "s", keys))
              .select(*[F.col(f"s.{k}").alias(k) for k in keys], "s.min", "s.max", "s.n",
                      place.alias("_bin"), value.alias("_value"), "v._c"))

    def holding_target(rows: DataFrame, order: str, before: Column) -> DataFrame:
        """Per key, the row in whose range of ranks the median lies."""
        w = Window.partitionBy(*keys).orderBy(order)
        upto = before + F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))
        target = F.floor(F.col("n") / 2) + 1
        return rows.withColumn("_upto", upto).filter(
            (F.col("_upto") >= target) & (F.col("_upto") - F.col("_c") < target))

    bins = placed.groupBy(*keys, "n", "_bin").agg(F.sum("_c").alias("_c"))
    chosen = holding_target(bins, "_bin", F.lit(0)).select(
        *keys, "_bin", (F.col("_upto") - F.col("_c")).alias("_before"))
    finalists = placed.alias("p").join(
        small(chosen).alias("b"), _same("p", "b", [*keys, "_bin"])).select("p.*", "b._before")
    if few:
        finalists = finalists.groupBy(*keys, "min", "max", "n", "_before", "_value").agg(F.sum("_c").alias("_c"))
    found = holding_target(finalists, "_value", F.col("_before"))
    return found.select(*by, "field", "min", F.col("_value").alias("median"), "max", "n")


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [
        F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def metric_coverage(df: DataFrame, words: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and, per column whose name has one of the words, rows with a non-zero value."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in df.columns if any(w in c.lower() for w in words) and c not in by]

    def non_zero(name: str) -> Column:
        col = F.col(f"`{name}`")
        # 0 and 0.0 are both zero; text is compared as written
        return col != 0 if isinstance(types[name], T.NumericType) else col.cast("string") != "0"
    return df.groupBy(*by).agg(F.count("*").alias("rows_total"), *[
        F.count_if(non_zero(c)).alias(c) for c in cols])


def value_counts(df: DataFrame, cols: Sequence[str], top: int | None = None) -> DataFrame:
    """Most common values first."""
    counted = df.groupBy(*cols).agg(F.count("*").alias("n"))
    if top is None:
        return counted
    return counted.orderBy(F.col("n").desc(), *[F.col(c).asc_nulls_first() for c in cols]).limit(top)


def month_counts(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.date_format(date_col, "yyyy-MM").alias("month")).agg(
        F.count("*").alias("n"))


# --- schema ---------------------------------------------------------------

def schema_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The columns of all tables as rows: (table, position, column, type)."""
    def one(name: str, df: DataFrame) -> DataFrame:
        rows = F.array(*[
            F.struct(F.lit(i).cast("bigint").alias("position"), F.lit(f.name).alias("column"),
                     F.lit(f.dataType.simpleString()).alias("type"))
            for i, f in enumerate(df.schema.fields, 1)])
        # the schema is known here; one row of any session carries it
        return df.sparkSession.range(1).select(F.lit(name).alias("table"),
                                               F.explode(rows).alias("_r")).select("table", "_r.*")
    return reduce(lambda a, b: a.unionByName(b), [one(n, d) for n, d in tables.items()])


def find_columns(tables: Mapping[str, DataFrame], pattern: str,
                 numeric: bool = True) -> dict[str, list[str]]:
    """Columns whose lower-cased name matches, per table; tables without one are left out."""
    found = {}
    for name, df in tables.items():
        cols = [f.name for f in df.schema.fields
                if re.search(pattern, f.name.lower())
                and (not numeric or isinstance(f.dataType, T.NumericType))]
        if cols:
            found[name] = cols
    return found


def found_column_profile(tables: Mapping[str, DataFrame], pattern: str,
                         date_columns: Sequence[str] = ()) -> DataFrame:
    """Per table with matching columns: their names, rows, first and last date."""
    def one(name: str, cols: list[str]) -> DataFrame:
        df = tables[name]
        dated = next((c for c in date_columns if c in df.columns), None)
        first = F.min(F.col(dated).cast("date")) if dated else F.lit(None).cast("date")
        last = F.max(F.col(dated).cast("date")) if dated else F.lit(None).cast("date")
        return df.agg(F.count("*").alias("row_count"), first.alias("first_date"),
                      last.alias("last_date")).select(
            F.lit(name).alias("table"), F.lit(", ".join(cols)).alias("columns"),
            F.lit(dated).cast("string").alias("dated_by"), "row_count", "first_date", "last_date")
    found = find_columns(tables, pattern)
    if not found:
        raise ValueError(f"no numeric column matches {pattern!r}")
    return reduce(lambda a, b: a.unionByName(b), [one(n, c) for n, c in found.items()])


def found_column_samples(tables: Mapping[str, DataFrame], pattern: str, date_columns: Sequence[str] = (),
                         n: int = 5) -> DataFrame:
    """The newest rows behind :func:`found_column_profile`, as (table, position, day, values).

    ``values`` is JSON of the matched columns; equally new rows are ordered by them.
    Tables without a date column have no newest rows and are left out.
    """
    def one(name: str, cols: list[str]) -> DataFrame | None:
        df = tables[name]
        dated = next((c for c in date_columns if c in df.columns), None)
        if dated is None:
            return None
        rows = df.select(F.col(dated).cast("date").alias("day"), *[F.col(f"`{c}`") for c in cols])
        order = [F.col("day").desc_nulls_last(), *[F.col(f"`{c}`").desc() for c in cols]]
        newest = rows.orderBy(*order).limit(n)
        place = F.row_number().over(Window.partitionBy(F.lit(name)).orderBy(*order))
        return newest.select(F.lit(name).alias("table"), place.cast("bigint").alias("position"), "day",
                             F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols])).alias("values"))
    found = [one(name, cols) for name, cols in find_columns(tables, pattern).items()]
    return reduce(lambda a, b: a.unionByName(b), [f for f in found if f is not None])


def newest_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The n newest rows by the business date (or the given columns)."""
    picked = business_date(df)
    names = list(order_by) or ([picked] if picked else [])
    return (df.orderBy(*[F.col(c).desc() for c in names]) if names else df).limit(n)


# --- declared tests -------------------------------------------------------

@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Accepted:
    """NULL is not a failure here; :class:`NotNull` covers it."""

    column: str
    values: tuple


def run_tests(df: DataFrame, tests: Sequence[NotNull | Accepted]) -> DataFrame:
    """(test, column, failures) of all tests, in one pass over the table."""
    def failed(test) -> Column:
        col = F.col(f"`{test.column}`")
        if isinstance(test, NotNull):
            return col.isNull()
        return col.isNotNull() & ~col.isin(list(test.values))
    kinds = {NotNull: "not_null", Accepted: "accepted_values"}
    counts = df.agg(*[F.count_if(failed(t)).alias(f"_t{i}") for i, t in enumerate(tests)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(kinds[type(t)]).alias("test"), F.lit(t.column).alias("column"),
                 F.col(f"_t{i}").alias("failures")) for i, t in enumerate(tests)]))
    return counts.select(rows.alias("_r")).select("_r.*")


def expect_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return run_tests(df, [NotNull(c) for c in cols])


def expect_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return run_tests(df, [Accepted(col, tuple(values))])

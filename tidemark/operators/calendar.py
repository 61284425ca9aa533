"""Day coverage: missing ranges, coverage reports, runs of one value.

Windows in this module run over distinct days of one source.  Their size is the
length of the calendar, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_literal
from .latest import latest_per_key


def present_days(df: DataFrame, date_col: str, by: Sequence[str]) -> DataFrame:
    return (df.select(*by, F.col(date_col).cast("date").alias("day"))
            .filter(F.col("day").isNotNull()).distinct())


def calendar_days(df: DataFrame, by: Sequence[str], start: date | str | Column,
                  end: date | str | Column) -> DataFrame:
    """Every day from start to end for every source: (by, day)."""
    return df.select(*by).distinct().withColumn(
        "day", F.explode(F.sequence(day_literal(start), day_literal(end))))


def missing_days(df: DataFrame, date_col: str, by: Sequence[str], start: date | str | Column,
                 end: date | str | Column) -> DataFrame:
    """Calendar days without a row, per source."""
    return calendar_days(df, by, start, end).join(
        present_days(df, date_col, by), [*by, "day"], "left_anti")


def missing_ranges(df: DataFrame, date_col: str, by: Sequence[str], start: date | str | Column,
                   end: date | str | Column) -> DataFrame:
    """Missing days as ranges: (by, range_start, range_end, days).

    A range lies between two neighbouring present days; the day before the
    calendar and the day after it close the ends.  So only present days are
    shuffled, and no calendar is built.
    """
    first, last = day_literal(start), day_literal(end)
    days = present_days(df, date_col, by)
    inside = days.filter(F.col("day").between(first, last))
    edges = days.select(*by).distinct().withColumn("day", F.date_sub(first, 1))
    after = F.lead("day", 1).over(Window.partitionBy(*by).orderBy("day"))
    follow = F.coalesce(after, F.date_add(last, 1))
    return (inside.unionByName(edges).withColumn("_next", follow)
            .filter(F.datediff("_next", "day") > 1)
            .select(*by, F.date_add("day", 1).alias("range_start"),
                    F.date_sub("_next", 1).alias("range_end"),
                    (F.datediff("_next", "day") - 1).cast("bigint").alias("days")))


def day_ranges(days: DataFrame, by: Sequence[str], day: str = "day") -> DataFrame:
    """Consecutive days collapsed to ranges: (by, range_start, range_end, days)."""
    number = F.row_number().over(Window.partitionBy(*by).orderBy(day))
    islands = days.select(*by, day).distinct().withColumn("_island", F.date_sub(F.col(day), number))
    return (islands.groupBy(*by, "_island")
            .agg(F.min(day).alias("range_start"), F.max(day).alias("range_end"),
                 F.count("*").alias("days")).drop("_island"))


def range_text(start: str = "range_start", end: str = "range_end", days: str = "days") -> Column:
    return F.concat(F.col(start).cast("string"), F.lit(".."), F.col(end).cast("string"),
                    F.lit(" ("), F.col(days).cast("string"), F.lit("d)"))


def coverage(df: DataFrame, date_col: str, by: Sequence[str], start: date | str | Column,
             end: date | str | Column) -> DataFrame:
    """Per source: days present and missing, first and last date, missing ranges as text."""
    first, last = day_literal(start), day_literal(end)
    total = (F.datediff(last, first) + 1).cast("bigint")
    days = present_days(df, date_col, by)
    seen = days.groupBy(*by).agg(
        F.count_if(F.col("day").between(first, last)).alias("days_present"),
        F.min("day").alias("first_date"), F.max("day").alias("last_date"))
    texts = (missing_ranges(df, date_col, by, start, end)
             .withColumn("_text", range_text())
             .groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("_text")), ", ")
                               .alias("missing_ranges")))
    matched = [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in by]
    return seen.alias("s").join(texts.alias("t"), matched, "left").select(
        *[F.col(f"s.{c}").alias(c) for c in by], "days_present",
        (total - F.col("days_present")).alias("days_missing"),
        "first_date", "last_date", "missing_ranges")


def delivery_gaps(loaded: DataFrame, delivered: DataFrame, by: Sequence[str],
                  start: date | str | Column, end: date | str | Column,
                  loaded_day: str = "day", delivered_day: str = "day",
                  processed: str = "processed") -> DataFrame:
    """Missing days per source, told apart by what was delivered that day.

    (by, day, delivered, processed): ``processed`` marks a day whose delivery
    was marked as done although no usable row exists.
    """
    missing = missing_days(loaded, loaded_day, by, start, end)
    arrivals = (delivered.select(*by, F.col(delivered_day).cast("date").alias("day"),
                                 F.col(processed).alias("_done"))
                .groupBy(*by, "day").agg(F.max("_done").alias("_done")))
    return missing.join(arrivals.withColumn("_arrived", F.lit(True)), [*by, "day"], "left").select(
        *by, "day", F.coalesce("_arrived", F.lit(False)).alias("delivered"),
        F.coalesce("_done", F.lit(False)).alias("processed"))


def gap_summary(loaded: DataFrame, delivered: DataFrame, by: Sequence[str],
                start: date | str | Column, end: date | str | Column, loaded_day: str = "day",
                delivered_day: str = "day", processed: str = "processed") -> DataFrame:
    """Per source: days missing, with and without a delivery, processed but missing.

    Counts alone need no calendar: missing is the length of the span minus the days
    present, and only deliveries of days that are not present are counted.
    """
    first, last = day_literal(start), day_literal(end)
    days = present_days(loaded, loaded_day, by)
    total = (F.datediff(last, first) + 1).cast("bigint")
    seen = days.groupBy(*by).agg((total - F.count_if(F.col("day").between(first, last))).alias("days_missing"))
    arrivals = (delivered.select(*by, F.col(delivered_day).cast("date").alias("day"), F.col(processed).alias("_done"))
                .filter(F.col("day").between(first, last)).groupBy(*by, "day").agg(F.max("_done").alias("_done")))
    lone = arrivals.alias("a").join(days.alias("d"), _matched("a", "d", [*by, "day"]), "left_anti")
    counts = lone.groupBy(*by).agg(F.count("*").alias("_with"), F.count_if("_done").alias("_done"))
    joined = seen.filter(F.col("days_missing") > 0).alias("s").join(counts.alias("c"), _matched("s", "c", by), "left")
    arrived = F.coalesce(F.col("_with"), F.lit(0))
    return joined.select(
        *[F.col(f"s.{c}").alias(c) for c in by], "days_missing", arrived.alias("missing_with_delivery"),
        (F.col("days_missing") - arrived).alias("missing_without_delivery"),
        F.coalesce(F.col("c._done"), F.lit(0)).alias("processed_but_missing"))


def _matched(left: str, right: str, by: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in by])


def value_runs(df: DataFrame, by: Sequence[str], date_col: str, value: str,
               loaded_on: str | None = None, file: str | None = None,
               newest_by: Sequence[str] = (), flag_days: int = 2) -> DataFrame:
    """Neighbouring observations with one value, as runs.

    Only observations are compared, so a run may span days without one; its
    length counts calendar days.  Runs longer than ``flag_days`` are flagged.
    Several observations of a day are first reduced to the newest one.
    """
    daily = latest_per_key(df.withColumn("_day", F.col(date_col).cast("date")),
                           [*by, "_day"], list(newest_by) or [value])
    w = Window.partitionBy(*by).orderBy("_day")
    starts = (F.row_number().over(w) == 1) | ~F.col(value).eqNullSafe(F.lag(value).over(w))
    numbered = daily.withColumn("_starts", starts).withColumn(
        "_run", F.sum(F.col("_starts").cast("int")).over(w))
    extras = []
    if loaded_on:
        extras += [F.min(loaded_on).alias("loaded_from"), F.max(loaded_on).alias("loaded_to")]
    if file:
        extras += [F.count_distinct(file).alias("files"), F.min(file).alias("example_file")]
    runs = numbered.groupBy(*by, "_run").agg(
        F.min("_day").alias("run_start"), F.max("_day").alias("run_end"),
        F.first(value).alias(value), *extras)
    days = (F.datediff("run_end", "run_start") + 1).cast("bigint")
    return runs.select(*by, "run_start", "run_end", value, days.alias("days"), (days > flag_days).alias("same_value"),
                       *[c for c in ("loaded_from", "loaded_to", "files", "example_file") if c in runs.columns])


def copy_days(copy: DataFrame, date_col: str, by: Sequence[str], start: date | str | Column,
              end: date | str | Column) -> DataFrame:
    """Days a copy has per source and month, against the calendar: (by, month, have, missing).

    The days of a month inside the span are known, so only months are listed per source.
    """
    first, last = day_literal(start), day_literal(end)
    days = present_days(copy, date_col, by)
    have = (days.filter(F.col("day").between(first, last))
            .groupBy(*by, F.trunc("day", "MM").alias("_month")).agg(F.count("*").alias("_have")))
    months = days.select(*by).distinct().withColumn("_month", F.explode(F.sequence(
        F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))))
    joined = months.alias("m").join(have.alias("h"), _matched("m", "h", [*by, "_month"]), "left")
    month = F.col("m._month")
    length = F.datediff(F.least(F.last_day(month), last), F.greatest(month, first)) + 1
    count = F.coalesce(F.col("h._have"), F.lit(0))
    return joined.select(*[F.col(f"m.{c}").alias(c) for c in by], F.date_format(month, "yyyy-MM").alias("month"),
                         count.alias("have"), (length - count).cast("bigint").alias("missing"))


def copy_report(copy: DataFrame, date_col: str, by: Sequence[str], start: date | str | Column,
                end: date | str | Column) -> DataFrame:
    """Per source of a copy: records, days and missing days, first and last day, missing ranges,
    and days with more than one record."""
    days = coverage(copy, date_col, by, start, end)
    sizes = (copy.select(*by, F.col(date_col).cast("date").alias("_on")).filter(F.col("_on").isNotNull())
             .groupBy(*by, "_on").agg(F.count("*").alias("_n")))
    records = sizes.groupBy(*by).agg(F.sum("_n").alias("records"), F.count_if(F.col("_n") > 1).alias("repeated_days"),
                                     F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).alias("extra_records"))
    joined = days.alias("d").join(records.alias("r"), _matched("d", "r", by))
    return joined.select(*[F.col(f"d.{c}").alias(c) for c in by], "days_present", "days_missing", "first_date",
                         "last_date", "missing_ranges", "records", "repeated_days", "extra_records")

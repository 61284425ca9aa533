"""Date expressions.  "Today" is always an explicit ``as_of``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text shapes; a parser only runs on text of its own shape, so bad text costs
# a regex test and not an exception per row.
SLASH_SHORT_YEAR = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$"
SLASH_LONG_YEAR = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
ISO_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
YEAR_FIRST_SLASH = r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$"
SLASH_STAMP = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\s*[AaPp][Mm]$"
ISO_STAMP = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


def day_literal(as_of: date | str | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def shaped_date(text: Column, shape: str, fmt: str) -> Column:
    return F.when(text.rlike(shape), F.try_to_date(text, fmt))


def century_fixed(day: Column) -> Column:
    """Two-digit years 69-99 belong to 1969-1999; Spark reads them as 2069-2099."""
    return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)


def short_year_date(text: Column) -> Column:
    # 2000 is a leap year and 1900 is not, but 29 February of 69-99 keeps its
    # leap years under a shift of 100 years (72, 76 ... 96), so add_months is exact.
    return century_fixed(shaped_date(text, SLASH_SHORT_YEAR, "M/d/yy"))


def parse_mixed_date(col: Column) -> Column:
    """M/D/YY, then M/D/YYYY, then ISO; NULL when none fits."""
    text = col.cast("string")
    return F.coalesce(
        short_year_date(text),
        shaped_date(text, SLASH_LONG_YEAR, "M/d/yyyy"),
        shaped_date(text, ISO_DAY, "yyyy-M-d"),
    )


def parse_day(col: Column) -> Column:
    """Lenient day: M/D/YYYY, or an ISO day possibly followed by a time."""
    text = F.trim(col.cast("string"))
    return F.coalesce(
        shaped_date(text, SLASH_LONG_YEAR, "M/d/yyyy"),
        shaped_date(F.left(text, F.lit(10)), ISO_DAY, "yyyy-M-d"),
    )


def parse_timestamp_text(col: Column) -> Column:
    """``M/D/YYYY h:m:s AM`` or ``YYYY-MM-DD HH:MM:SS``; NULL otherwise."""
    text = F.regexp_replace(F.upper(col), r"\s*([AP]M)$", " $1")
    text = F.regexp_replace(text, r"\s+", " ")
    return F.coalesce(
        F.when(col.rlike(SLASH_STAMP), F.try_to_timestamp(text, F.lit("M/d/yyyy h:m:s a"))),
        F.when(col.rlike(ISO_STAMP), F.try_to_timestamp(col, F.lit("yyyy-M-d H:m:s"))),
    )


def iso_text(col: Column, kind: str) -> Column:
    """ISO-8601 text of a date or timestamp column; other columns pass through."""
    if kind == "date":
        return F.date_format(col, "yyyy-MM-dd")
    if kind in ("timestamp", "timestamp_ntz"):
        micros = F.date_format(col, "SSSSSS")
        offset = F.lit("+00:00") if kind == "timestamp" else F.lit("")
        return F.concat(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss"),
                        F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""),
                        offset)
    return col


def date_parts(df: DataFrame, col: str, as_of: date | str | Column) -> DataFrame:
    """Append year, month, ISO week, names and the distance to ``as_of``."""
    day = F.col(col)
    return df.withColumns({
        "year": F.year(day).cast("bigint"),
        "month": F.month(day).cast("bigint"),
        "week_of_year": F.weekofyear(day).cast("bigint"),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_week": F.date_format(day, "EEEE"),
        "days_ago": F.datediff(day_literal(as_of), day).cast("bigint"),
    })

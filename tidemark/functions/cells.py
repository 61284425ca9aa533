"""Coercion of spreadsheet cells and of fields with a declared type."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dates
from .numbers import round_to_long
from .text import squash

_DIGITS = r"[0-9]+(?:_[0-9]+)*"
INTEGER_TEXT = rf"^[+-]?{_DIGITS}$"
FLOAT_TEXT = (rf"(?i)^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
              r"|nan|inf|infinity)$")
SLASH_DATE = r"^[0-9]{1,2}/[0-9]{1,2}/(?:[0-9]{2}|[0-9]{4})$"


_FLOAT_BODY = FLOAT_TEXT.removeprefix("(?i)^").removesuffix("$")
PERCENT_TEXT = rf"(?i)^\s*{_FLOAT_BODY}\s*%$"
DOLLAR_TEXT = rf"(?i)^\$\s*{_FLOAT_BODY}$"


def _double(text: Column) -> Column:
    digits = squash(F.replace(text, F.lit(","), F.lit("")))
    return F.when(digits.rlike(FLOAT_TEXT),
                  F.replace(digits, F.lit("_"), F.lit("")).try_cast("double"))


def coerce_cell(col: Column) -> Column:
    """One untyped cell as ``struct<kind, long_value, double_value, iso_date, text_value>``.

    In order: blank, percentage (divided by 100), dollars, integer, number,
    M/D/YYYY or D/M/YYYY or M/D/YY date, plain text.  Exactly one value field
    is filled, the one ``kind`` names.
    """
    text = squash(col.cast("string"))
    bare = F.translate(text, ",", "")
    digits = F.translate(text, ",_$% \t", "")
    number, whole = digits.try_cast("double"), digits.try_cast("bigint")
    day = F.coalesce(
        dates.shaped_date(text, dates.SLASH_LONG_YEAR, "M/d/yyyy"),
        dates.shaped_date(text, dates.SLASH_LONG_YEAR, "d/M/yyyy"),
        dates.short_year_date(text))

    def cell(kind: str, **value: Column) -> Column:
        fields = {"long_value": "bigint", "double_value": "double",
                  "iso_date": "string", "text_value": "string"}
        return F.struct(F.lit(kind).alias("kind"), *[
            value.get(name, F.lit(None)).cast(dtype).alias(name)
            for name, dtype in fields.items()])

    return (F.when(text.isNull() | (text == ""), cell("blank"))
            .when(bare.rlike(PERCENT_TEXT), cell("percent", double_value=number / 100.0))
            .when(bare.rlike(DOLLAR_TEXT), cell("currency", double_value=number))
            .when(bare.rlike(INTEGER_TEXT) & whole.isNotNull(), cell("integer", long_value=whole))
            .when(bare.rlike(FLOAT_TEXT), cell("number", double_value=number))
            .when(text.rlike(SLASH_DATE) & day.isNotNull(),
                  cell("date", iso_date=F.date_format(day, "yyyy-MM-dd")))
            .otherwise(cell("text", text_value=text)))


@dataclass(frozen=True)
class SinkField:
    """A declared field of a target: kind is ``date``, ``number`` or ``text``."""

    name: str
    kind: str
    precision: int = 0

    @property
    def spark_type(self) -> T.DataType:
        if self.kind == "number":
            return T.LongType() if self.precision == 0 else T.DoubleType()
        return T.StringType()


def _typed_date(text: Column) -> Column:
    day = F.coalesce(
        dates.shaped_date(text, dates.ISO_DAY, "yyyy-M-d"),
        dates.shaped_date(text, dates.SLASH_LONG_YEAR, "M/d/yyyy"),
        dates.shaped_date(text, dates.SLASH_LONG_YEAR, "d/M/yyyy"),
        dates.shaped_date(text, dates.YEAR_FIRST_SLASH, "yyyy/M/d"),
    )
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), text)


def coerce_typed(df: DataFrame, schema: Sequence[SinkField]) -> DataFrame:
    """Fit columns to declared fields; undeclared columns are dropped.

    A date that cannot be read keeps its text; a bad number becomes NULL.
    Numbers with a point may carry an exponent, whole numbers may not.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in schema:
        if field.name not in types:
            continue
        dtype, col = types[field.name], F.col(field.name)
        if field.kind == "date":
            value = _typed_date(F.when(col != "", col)) if isinstance(dtype, T.StringType) \
                else dates.iso_text(col, dtype.simpleString())
        elif field.kind == "number":
            if isinstance(dtype, T.StringType):
                text = squash(F.replace(col, F.lit(","), F.lit("")))
                value = F.when(text.contains("."), _double(text)).otherwise(
                    F.when(text.rlike(INTEGER_TEXT), _double(text)))
            elif isinstance(dtype, T.NumericType):
                value = col
            else:
                value = F.lit(None)
            value = round_to_long(value.cast("double")) if field.precision == 0 \
                and not isinstance(dtype, T.IntegralType) else value
            value = value.cast(field.spark_type)
        else:
            value = F.when(col.cast("string") != "", col.cast("string"))
        out.append(value.alias(field.name))
    return df.select(*out)

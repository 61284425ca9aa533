"""String expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed value: the characters that count as white space at the ends of a text.
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
               "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def squash(col: Column) -> Column:
    """Strip every kind of white space at both ends."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(squash(col), F.lit(""))


def clip(col: Column, n: int) -> Column:
    """The first n characters."""
    return F.left(col, F.lit(n))


def extract_or_null(col: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group; NULL (not '') when the pattern does not match."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def translated(col: Column, mapping: Mapping[str, str]) -> Column:
    """Dictionary lookup; values without an entry pass through."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(table[col], col)


def plain_text(col: Column, dtype: T.DataType) -> Column:
    """The text form used in keys and comparisons.

    Lists are joined with commas.  Doubles are written out in full where
    Spark would switch to an exponent (from 1e7 on, and below 1e-3), so a
    double column and a text column that show the same number agree.
    """
    if isinstance(dtype, T.ArrayType):
        return F.array_join(F.transform(col, lambda x: plain_text(x, dtype.elementType)), ",")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        shown = col.cast("string")
        size = F.abs(col)
        full = F.regexp_replace(shown.try_cast("decimal(38,22)").cast("string"), "0+$", "")
        full = F.regexp_replace(full, r"\.$", ".0")
        wide = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
        return F.when(wide, full).otherwise(shown)
    return col.cast("string")

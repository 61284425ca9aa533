"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def extended(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of a frame and further columns."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])

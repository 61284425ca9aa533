"""CSV text to typed columns: reading, inference, coercion, schema merge, metadata."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import FLOAT_TEXT
from ..functions.dates import (ISO_DAY, SLASH_LONG_YEAR, parse_timestamp_text, shaped_date,
                               short_year_date)
from ..functions.text import blank_to_null
from ..operators.latest import first_ranked
from .reports import normalise_headers

# What a column's text must look like to get a type.
# The number shape is tested after commas are removed.
NUMBER_SHAPE = r"^-?\$?[0-9]*\.?[0-9]+%?$"
STAMP_SHAPE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}\s+[0-9]{1,2}:[0-9]{2}:[0-9]{2}\s*[AaPp][Mm]$"
DAY_SHAPE = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4})$"

# Columns every load adds.
METADATA = T.StructType([
    T.StructField("_import_timestamp", T.TimestampType()),
    T.StructField("_source_filename", T.StringType()),
    T.StructField("_email_date", T.StringType()),
    T.StructField("_gmail_message_id", T.StringType()),
])

ROW_INDEX = "_row_index"


def _later_wins(headers: Sequence[str]) -> list[tuple[int, str]]:
    """Positions to keep when two headers normalise alike: the value of the later
    column, at the place of the first."""
    last = {name: i for i, name in enumerate(headers)}
    return [(last[name], name) for name in dict.fromkeys(headers)]


def plain_path(col: Column) -> Column:
    """One spelling of a local path: ``file:///a`` and ``/a`` mean the same file."""
    return F.regexp_replace(col, "^file:/+", "/")


def file_heads(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Per file that has a line with text: (path, head), its first one without byte order mark.

    ``paths`` are files or folders.  Lines are read where they lie; of each file only
    those of its first block are looked at, and one is kept.
    """
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths)).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("_block"),
        F.regexp_replace("value", r"^\x{FEFF}|\r$", "").alias("value"))
    text = lines.filter((F.col("_block") == 0) & (F.trim("value") != "")).withColumn("_at", F.monotonically_increasing_id())
    return text.groupBy("path").agg(F.min_by("value", "_at").alias("head"))


def header_cells(head: str) -> list[str]:
    return next(csv.reader([head]), [])


def read_cells(spark: SparkSession, paths: str | Sequence[str], width: int) -> DataFrame:
    """The rows of CSV files below their header as text cells c0, c1 ... and ``_file``.

    Short rows are padded, surplus cells ignored, blank cells NULL.  A quoted cell may
    hold line breaks, so a file is read by one task, as a stream.
    """
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    raw = (spark.read.option("multiLine", True).option("escape", '"').option("header", True).schema(schema)
           .csv([paths] if isinstance(paths, str) else list(paths)))
    return raw.select(*[blank_to_null(F.col(c)).alias(c) for c in raw.columns],
                      plain_path(F.col("_metadata.file_path")).alias("_file"))


def named_cells(cells: DataFrame, header: Sequence[str]) -> DataFrame:
    """Cells under the clean names of a header, and ``_file``."""
    kept = _later_wins(normalise_headers(header))
    return cells.select(*[F.col(f"c{i}").alias(name) for i, name in kept], "_file")


def head_names(head: Column, width: int) -> Column:
    """The clean names of a header line's cells, as an array; as :func:`normalise_headers` gives them.

    ``width`` is the largest number of cells; commas of the line give an upper bound for it.
    """
    cells = F.from_csv(head, F.lit(", ".join(f"c{i} string" for i in range(width))), {"escape": '"'})
    n = F.size(F.split(F.regexp_replace(head, '"[^"]*"', ""), ",", -1))

    def clean(cell: Column) -> Column:
        bare = F.regexp_replace(F.lower(F.coalesce(cell, F.lit(""))), "[^a-z0-9]+", "_")
        name = F.regexp_replace(bare, "^_+|_+$", "")
        return F.when(name == "", "col").when(name.rlike("^[0-9]"), F.concat(F.lit("_"), name)).otherwise(name)
    return F.transform(F.slice(F.array(*[cells[f"c{i}"] for i in range(width)]), F.lit(1), F.least(n, F.lit(width))), clean)


def read_csv_report(spark: SparkSession, paths: str | Sequence[str],
                    header: Sequence[str] | None = None) -> DataFrame:
    """CSV files of one header as trimmed text columns with clean names.

    The header is read from the files unless it is given; files of different headers are
    refused, as their cells would get each other's names.
    """
    if header is None:
        heads = [r["head"] for r in file_heads(spark, paths).select("head").distinct().limit(2).collect()]
        if not heads:
            raise ValueError(f"{paths} is empty")
        if len(heads) > 1:
            raise ValueError(f"files of different headers: {heads[0]!r}, {heads[1]!r}")
        header = header_cells(heads[0])
    return named_cells(read_cells(spark, paths, len(header)), header)


def infer_types(df: DataFrame, sample: int | None = None,
                index_col: str | None = None) -> DataFrame:
    """(column, type) of text columns: double, timestamp, date or string.

    All non-blank values decide, in one aggregate.  With ``sample`` only the
    first n non-blank values of each column do, in the order of ``index_col``.
    """
    cols = [c for c in df.columns if c != index_col]
    if sample is not None:
        if index_col is None:
            raise ValueError("a sample needs an index column: file order is not row order")
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), blank_to_null(F.col(f"`{c}`")).alias("value"))
            for c in cols]))
        long = (df.select(index_col, pairs.alias("_p")).select(index_col, "_p.*")
                .filter(F.col("value").isNotNull()))
        values = first_ranked(long, ["column"], [F.col(index_col).asc()], sample)
        seen = values.groupBy("column").agg(_shape(F.col("value")).alias("type"))
        names = df.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))
        return names.join(seen, "column", "left").select(
            "column", F.coalesce("type", F.lit("string")).alias("type"))
    # trimmed in a projection of their own, so that each cell is trimmed once
    wide = trimmed(df.select(*[F.col(f"`{c}`") for c in cols])).agg(*[
        _shape(F.col(f"`{c}`")).alias(f"_t{i}") for i, c in enumerate(cols)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_t{i}").alias("type"))
        for i, c in enumerate(cols)]))
    return wide.select(rows.alias("_r")).select("_r.*")


def shape_kind(value: Column) -> Column:
    """1 a number, 2 a day, 3 a time stamp, 0 any other text; NULL for NULL.  No text has two of the shapes."""
    bare = F.replace(value, F.lit(","), F.lit(""))
    return F.when(value.isNotNull(), F.when(bare.rlike(NUMBER_SHAPE), 1)
                  .when(value.rlike(DAY_SHAPE), 2).when(value.rlike(STAMP_SHAPE), 3).otherwise(0))


def type_of_kinds(low: Column, high: Column) -> Column:
    """A column has a type when all its values agree, else it is text."""
    return (F.when(low.isNull() | (low != high) | (low == 0), "string")
            .when(low == 1, "double").when(low == 2, "date").otherwise("timestamp"))


def _shape(value: Column) -> Column:
    """Aggregate: the type all non-NULL values fit."""
    kind = shape_kind(value)
    return type_of_kinds(F.min(kind), F.max(kind))


def inferred(df: DataFrame, sample: int | None = None,
             index_col: str | None = None) -> dict[str, str]:
    """:func:`infer_types` as a dict; one small row per column reaches the driver."""
    return {r["column"]: r["type"] for r in infer_types(df, sample, index_col).collect()}


def trimmed(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns without space around them, blank ones NULL."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)} - set(keep)
    return df.select(*[
        (blank_to_null(F.col(f"`{c}`")) if c in text else F.col(f"`{c}`")).alias(c)
        for c in df.columns])


def coerced(value: Column, kind: str) -> Column:
    """Trimmed text to a type; NULL when it does not fit.  A trailing % is only dropped."""
    if kind == "double":
        bare = F.regexp_replace(F.regexp_replace(value, "[,$]", ""), "%+$", "")
        return F.when(bare.rlike(FLOAT_TEXT), F.replace(bare, F.lit("_"), F.lit(""))
                      .try_cast("double"))
    if kind == "timestamp":
        return parse_timestamp_text(value)
    if kind == "date":
        return F.coalesce(shaped_date(value, ISO_DAY, "yyyy-M-d"), short_year_date(value),
                          shaped_date(value, SLASH_LONG_YEAR, "M/d/yyyy"))
    return value.cast(kind) if kind == "string" else value.try_cast(kind)


def coerce(df: DataFrame, types: Mapping[str, str],
           keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(typed, rejects): rejects lists every non-blank value that became NULL.

    ``rejects`` has (column, value, rows).
    """
    df = trimmed(df, keep)
    typed = df.select(*[
        (coerced(F.col(f"`{c}`"), types.get(c, "string")) if c not in keep else F.col(f"`{c}`"))
        .alias(c) for c in df.columns])
    risky = [c for c in df.columns if c not in keep and types.get(c, "string") != "string"]
    if not risky:
        empty = df.limit(0).select(F.lit("").alias("column"), F.lit("").alias("value"),
                                   F.lit(0).cast("bigint").alias("rows"))
        return typed, empty
    lost = F.explode(F.array_compact(F.array(*[
        F.when(F.col(f"`{c}`").isNotNull()
               & coerced(F.col(f"`{c}`"), types[c]).isNull(),
               F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")))
        for c in risky])))
    rejects = (df.select(lost.alias("_l")).select("_l.*")
               .groupBy("column", "value").agg(F.count("*").alias("rows")))
    return typed, rejects


def merge_schema(existing: T.StructType, incoming: T.StructType) -> T.StructType:
    """Existing columns keep name, type and place; new ones are appended."""
    have = set(existing.fieldNames())
    return T.StructType([*existing.fields, *[f for f in incoming.fields if f.name not in have]])


def types_of(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def with_load_metadata(df: DataFrame, loaded_at: Column, filename: Column, received: Column,
                       message_id: Column) -> DataFrame:
    """Stamp a load; all rows of one load share one ``_import_timestamp``."""
    values = (loaded_at, filename, received, message_id)
    return df.withColumns({
        f.name: v.cast(f.dataType) for f, v in zip(METADATA.fields, values)})

"""Report files to typed, append-only raw tables, with a ledger of finished messages."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.breakdown import MOST_VALUES, breakdown, crowded, summary_rows
from ..operators.shape import align
from ..session import stored
from .commits import exists, folder_of, publish, read_ledger_loads, read_loads, table_folders, tie_ledger
from .reports import ReportConfig, is_html, received_at, resolve_filename, select_reports
from .typed import (METADATA, coerced, file_heads, head_names, merge_schema, plain_path, read_cells,
                    shape_kind, type_of_kinds, types_of, with_load_metadata)

log = logging.getLogger(__name__)

LEDGER = T.StructType([T.StructField("message_id", T.StringType()),
                       T.StructField("report", T.StringType())])


def read_raw(spark: SparkSession, path: str) -> DataFrame | None:
    """A raw table whose loads may have different columns; None before the first load."""
    return read_loads(spark, path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_ledger_loads(spark, path, LEDGER)


@dataclass(frozen=True)
class Columns:
    """Of one report: names in the order in which headers bring them, and what their values look like."""

    names: tuple[str, ...]
    types: dict[str, str]


def report_columns(cells: DataFrame, heads: DataFrame, width: int) -> dict[str, Columns]:
    """Columns and types of every report, over the files of all its headers, in one job.

    ``cells`` has c0, c1 ..., ``report`` and ``head_id``; ``heads`` has report, head_id and ``names``.  Where a
    header repeats a name, the later column counts.  The driver gets one line per column of a report.
    """
    kinds = cells.groupBy("report", "head_id").agg(F.array(*[
        F.struct(F.min(shape_kind(F.col(f"c{i}"))).alias("low"), F.max(shape_kind(F.col(f"c{i}"))).alias("high"))
        for i in range(width)]).alias("kinds"))
    each = (heads.join(kinds, ["report", "head_id"], "left").select("report", "names", "kinds", F.posexplode("names").alias("at", "name"))
            .withColumn("last", F.size("names") - F.array_position(F.reverse("names"), F.col("name"))))
    own = F.get(F.col("kinds"), F.col("last").cast("int"))
    found = each.groupBy("report", "name").agg(F.min("at").alias("at"), F.min(own["low"]).alias("low"), F.max(own["high"]).alias("high"))
    rows = found.select("report", "name", type_of_kinds(F.col("low"), F.col("high")).alias("type")).orderBy("at", "name")
    out: dict[str, Columns] = {}
    for r in sorted(found.join(rows, ["report", "name"]).collect(), key=lambda r: (r["at"], r["name"])):
        before = out.get(r["report"], Columns((), {}))
        out[r["report"]] = Columns((*before.names, r["name"]), {**before.types, r["name"]: r["type"]})
    return out


def _named(cells: DataFrame, heads: DataFrame, names: Sequence[str], width: int) -> DataFrame:
    """The cells under ``names``, whatever place the header of their file has them in; NULL where it lacks them."""
    place = F.transform(F.array(*[F.lit(n) for n in names]), lambda n: F.array_position(F.reverse("names"), n))
    at = F.transform(place, lambda p: F.when(p > 0, (F.size("names") - p).cast("int")))
    placed = cells.join(heads.select("report", "head_id", at.alias("_at")), ["report", "head_id"])
    row = F.array(*[F.col(f"c{i}") for i in range(width)])
    return placed.withColumn("_row", row).select("_file", *[F.get("_row", F.col("_at")[k]).alias(n) for k, n in enumerate(names)])


def load_report(cells: DataFrame, heads: DataFrame, width: int, columns: Columns, config: ReportConfig, files: DataFrame,
                existing: T.StructType | None, path: str, now: Column, most: int) -> tuple[T.StructType, DataFrame | None]:
    """Write one report's files, whatever headers they have, to a folder of the load.

    ``cells`` and ``heads`` are of this report; ``files`` has path, message_id, filename and received_at.  Returns the
    schema the table then has, and of a summary report the files whose fields are no categories (_file, field); these are left out.
    """
    about = files.select(F.col("path").alias("_file"), "message_id", "filename", "received_at")
    refused = None
    if config.summary_only:
        fields = [f for f in config.summary_fields if f in columns.names]
        rows = _named(cells, heads, fields, width)
        summary = rows.groupBy("_file").agg(F.count("*").alias("record_count"))
        if fields:
            values = stored(breakdown(rows, fields, ["_file"]), "values")
            refused = stored(crowded(values, ["_file"], most), "crowded")
            bad = refused.select("_file").distinct()
            summary = summary_rows(summary.join(bad, "_file", "left_anti"), values.join(bad, "_file", "left_anti"), fields, ["_file"])
        stamped = summary.join(about, "_file").withColumn("report_date", F.col("received_at").cast("date"))
        wanted = ["report_date", "record_count", *[f"{f}_counts" for f in fields]]
    else:
        known = types_of(existing) if existing is not None else {}
        rows = _named(cells, heads, columns.names, width)
        typed = rows.select("_file", *[coerced(F.col(f"`{c}`"), known.get(c, columns.types[c])).alias(c) for c in columns.names])
        stamped, wanted = typed.join(about, "_file"), list(columns.names)
    loaded = with_load_metadata(
        stamped, now, F.col("filename"),
        F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"), F.col("message_id"))
    out = loaded.select(*wanted, *METADATA.fieldNames())
    schema = out.schema if existing is None else merge_schema(existing, out.schema)
    align(out, schema).write.mode("errorifexists").parquet(path)
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]), refused


def ingest(spark: SparkSession, messages: DataFrame, configs: Sequence[ReportConfig],
           raw_root: str, ledger_path: str, now: Column, mode: str = "all",
           sender: str | None = None, most_values: int = MOST_VALUES) -> DataFrame:
    """Load the fetched reports of a message log; returns one outcome row per message.

    ``messages``: message_id, sender, subject, internal_date_ms, path, and
    optionally content_type, disposition, url of the fetched file.  Web pages and
    empty files are errors and stay unprocessed; a report that fails does not
    stop the others.  Rows and ledger become visible together, by one commit: a run
    that dies before it has loaded nothing.  A field of a summary report with more than ``most_values`` values in a file
    is no category; that file is an error.

    The listing stays a table: the folders of its files are read and joined with it.  The
    driver sees folders, and one line per column of a report.  Files are parsed once, in one job for all their
    headers; a column's type is judged over all files of the run.
    """
    load = uuid.uuid4().hex
    have = set(messages.columns)

    def given(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")
    chosen = select_reports(messages, configs, read_ledger(spark, ledger_path), mode, sender)
    files = stored(chosen.select(
        "message_id", "report", plain_path(F.col("path")).alias("path"),
        given("content_type").alias("content_type"),
        received_at(F.col("internal_date_ms"), now).alias("received_at"),
        resolve_filename(given("disposition"), given("url"), F.col("report"), now)
        .alias("filename")), "files")
    folders = sorted(r[0] for r in files.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect())
    folders = [f for f in folders if exists(spark, f)]
    if not folders:
        return _finish(files.select("message_id", "report", F.lit(0).cast("bigint").alias("rows_loaded"),
                                    F.lit("no file").alias("error")), raw_root, ledger_path, load, [])
    paths = files.select("path").distinct()
    heads = file_heads(spark, folders).join(paths, "path", "left_semi")
    page = is_html(F.col("head")) | F.coalesce(F.lower("content_type").contains("text/html"), F.lit(False))
    # a file without a line of text has no head: whether it is there at all tells its listing
    there = spark.read.format("binaryFile").load(folders).select(plain_path(F.col("path")).alias("path"), F.lit(True).alias("_there"))
    judged = stored(files.join(heads, "path", "left").join(there, "path", "left").withColumn(
        "error", F.when(F.col("_there").isNull(), "no file").when(page, "web page, not a report")
        .when(F.col("head").isNull(), "empty file")).drop("_there"), "judged")
    good = judged.filter(F.col("error").isNull())
    width = good.agg(F.max(F.size(F.split("head", ",", -1)))).first()[0]
    if width is None:
        return _finish(judged.select("message_id", "report", F.lit(0).cast("bigint").alias("rows_loaded"), "error"),
                       raw_root, ledger_path, load, [])

    good = good.withColumn("head_id", F.xxhash64("head"))
    heads = stored(good.select("report", "head_id", "head").distinct()
                   .select("report", "head_id", head_names(F.col("head"), width).alias("names")), "heads")
    cells = read_cells(spark, folders, width)
    cells = stored(cells.join(good.select(F.col("path").alias("_file"), "report", "head_id").distinct(), "_file"), "cells")
    columns = report_columns(cells, heads, width)
    written, failures, refused = [], [], []
    for part, config in enumerate(configs):
        if config.report not in columns:
            continue
        mine = F.col("report") == config.report
        try:
            # of this load, if another report went to the same table
            known = {table: schema for table, _, schema in written}
            existing = known.get(config.table, table_folders(spark, raw_root, config.table)[1])
            folder = folder_of(f"{raw_root.rstrip('/')}/{config.table}", load, part)
            schema, over = load_report(cells.filter(mine), heads.filter(mine), width, columns[config.report], config,
                                       good.filter(mine), existing, folder, now, most_values)
            written.append((config.table, folder, schema))
            refused += [] if over is None else [over]
        except Exception as exc:
            log.exception("report %s failed", config.report)
            failures.append((config.report, str(exc)))

    failed = spark.createDataFrame(failures, "report string, _failed string")
    sizes = cells.groupBy(F.col("_file").alias("path"), "report").agg(F.count("*").alias("_rows"))
    crowd = spark.createDataFrame([], "_file string, field string, n_values bigint")
    for over in refused:
        crowd = crowd.unionByName(over)
    crowd = crowd.groupBy(F.col("_file").alias("path")).agg(
        F.concat(F.lit("too many values for a category: "), F.min("field")).alias("_crowded"))
    summaries = [c.report for c in configs if c.summary_only]
    rows = F.when(F.col("report").isin(summaries), F.least(F.col("_rows"), F.lit(1))).otherwise(F.col("_rows"))
    error = F.coalesce("error", "_failed", F.when(F.col("report").isin(summaries), F.col("_crowded")), F.when(F.col("_rows").isNull(), "empty file"))
    outcome = (judged.join(sizes, ["path", "report"], "left").join(crowd, "path", "left").join(failed, "report", "left")
               .select("message_id", "report", F.when(error.isNull(), rows).otherwise(0).cast("bigint").alias("rows_loaded"),
                       error.alias("error")))
    return _finish(outcome, raw_root, ledger_path, load, written)


def _finish(outcome: DataFrame, raw_root: str, ledger_path: str, load: str, written: list) -> DataFrame:
    """The stored outcome; what went well is entered in the ledger, and the load published with it."""
    spark = outcome.sparkSession
    result = stored(outcome, "outcome")
    tie_ledger(spark, ledger_path, raw_root)
    (result.filter(F.col("error").isNull()).select("message_id", "report")
     .write.mode("errorifexists").parquet(folder_of(ledger_path, load)))
    publish(spark, raw_root, load, written)
    return result

"""From a message log to report files: selection, routing, attachments, names."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import extract_or_null


@dataclass(frozen=True)
class ReportConfig:
    """One kind of report: how to recognise it, where it goes, how often it comes.

    With ``summary_fields`` only a daily summary row is stored, not the rows.
    """

    report: str
    subject: str
    filename_pattern: str
    table: str
    schedule: str
    summary_fields: tuple[str, ...] = ()

    @property
    def summary_only(self) -> bool:
        return bool(self.summary_fields)


def configs_for(configs: Sequence[ReportConfig], mode: str) -> list[ReportConfig]:
    """Reports of a schedule, or all of them."""
    return [c for c in configs if mode == "all" or c.schedule == mode]


def messages(df: DataFrame, sender: str, subject: str, with_attachment: bool = False) -> DataFrame:
    """Messages of one sender whose subject has the phrase, whatever the case."""
    out = df.filter((F.lower("sender") == sender.lower())
                    & F.lower("subject").contains(subject.lower()))
    return out.filter(F.size("parts") > 0) if with_attachment else out


def matched_reports(subject: Column, configs: Sequence[ReportConfig]) -> Column:
    """Names of the reports a subject belongs to; the config is short, so no join."""
    return F.array_compact(F.array(*[
        F.when(F.lower(subject).contains(c.subject.lower()), F.lit(c.report)) for c in configs]))


def attribute(report: Column, configs: Sequence[ReportConfig], name: str) -> Column:
    """A config attribute as a column expression."""
    out = F.lit(None).cast("string")
    for c in configs:
        out = F.when(report == c.report, F.lit(getattr(c, name))).otherwise(out)
    return out


def select_reports(log: DataFrame, configs: Sequence[ReportConfig], ledger: DataFrame,
                   mode: str = "all", sender: str | None = None) -> DataFrame:
    """Unprocessed messages with the report they carry, its table and schedule.

    ``ledger`` lists the processed message ids.
    """
    chosen = configs_for(configs, mode)
    rows = log if sender is None else log.filter(F.lower("sender") == sender.lower())
    if not chosen:
        return rows.limit(0).select("*", *[F.lit("").alias(c) for c in
                                           ("report", "table", "schedule")])
    routed = rows.withColumn("report", F.explode(matched_reports(F.col("subject"), chosen)))
    report = F.col("report")
    return (routed.join(ledger.select("message_id").distinct(), "message_id", "left_anti")
            .withColumns({"table": attribute(report, chosen, "table"),
                          "schedule": attribute(report, chosen, "schedule")}))


def pick_attachment(parts: Column, pattern: str) -> Column:
    """First part whose file name starts with the pattern, any case; NULL without one."""
    anchored = F.lit(f"(?i)^(?:{pattern})")
    fitting = F.filter(parts, lambda p: F.rlike(p["filename"], anchored) & p["body"].isNotNull())
    return F.get(fitting, F.lit(0))


def pick_report_attachment(parts: Column, report: Column,
                           configs: Sequence[ReportConfig]) -> Column:
    out = F.lit(None)
    for c in configs:
        out = F.when(report == c.report, pick_attachment(parts, c.filename_pattern)).otherwise(out)
    return out


def received_at(epoch_ms: Column, now: Column) -> Column:
    """Instant of receipt; 0 or NULL means unknown and gives ``now``."""
    return F.coalesce(F.when(epoch_ms != 0, F.timestamp_millis(epoch_ms)), now)


# Fixed value: file name inside a Content-Disposition header.
_DISPOSITION = r"""filename[*]?=["']?([^"';]+)"""


def resolve_filename(disposition: Column, url: Column, report: Column, now: Column) -> Column:
    """Name of a delivered file: header, else .csv base name of the address, else
    ``<report>_<YYYYMMDD_HHMMSS>.csv``, the name that marks a doubtful load."""
    named = F.trim(extract_or_null(disposition, _DISPOSITION))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    base = F.substring_index(path, "/", -1)
    stamped = F.concat(report, F.lit("_"), F.date_format(now, "yyyyMMdd_HHmmss"), F.lit(".csv"))
    return F.coalesce(F.when(named != "", named), F.when(base.endswith(".csv"), base), stamped)


def body_head(body: Column, n: int = 512) -> Column:
    """First characters of a body without byte order mark and leading space, lower-cased."""
    head = F.left(body.cast("string"), F.lit(n))
    return F.lower(F.regexp_replace(head, r"^\x{FEFF}*\s*", ""))


def is_html(body: Column, content_type: Column | None = None) -> Column:
    head = body_head(body)
    test = head.startswith("<!doctype") | head.startswith("<html")
    if content_type is not None:
        test = test | F.lower(content_type).contains("text/html")
    return F.coalesce(test, F.lit(False))


def looks_csv(body: Column) -> Column:
    head = F.left(body.cast("string"), F.lit(200))
    return head.contains(",") & ~F.lower(head).contains("<html")


def judged(df: DataFrame, body_col: str, content_type_col: str | None = None) -> DataFrame:
    """Bodies with a ``verdict``, in one pass: web pages delivered in place of a report are ``rejected``."""
    ctype = F.col(content_type_col) if content_type_col else None
    return df.withColumn("verdict", F.when(is_html(F.col(body_col), ctype), "rejected").otherwise("accepted"))


def quarantine(df: DataFrame, body_col: str,
               content_type_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of :func:`judged`, for writing them to two places."""
    rows = judged(df, body_col, content_type_col)
    return tuple(rows.filter(F.col("verdict") == v).drop("verdict") for v in ("accepted", "rejected"))


def run_summary(outcomes: DataFrame, configs: Sequence[ReportConfig]) -> DataFrame:
    """Per report: messages found, rows loaded, errors, status.

    ``outcomes`` has one row per message: report, rows_loaded, error (NULL when good).
    """
    known = F.array(*[F.lit(c.report) for c in configs])
    names = outcomes.sparkSession.range(1).select(F.explode(known).alias("report"))
    got = outcomes.groupBy("report").agg(
        F.count("*").alias("found"), F.sum("rows_loaded").alias("loaded"),
        F.count("error").alias("errors"))
    return names.join(got, "report", "left").select(
        "report", F.coalesce("found", F.lit(0)).alias("emails_found"),
        F.coalesce("loaded", F.lit(0)).alias("rows_loaded"),
        F.coalesce("errors", F.lit(0)).alias("errors"),
        F.when(F.coalesce("errors", F.lit(0)) == 0, "OK").otherwise("ERRORS").alias("status"))


def normalise_headers(names: Sequence[str]) -> list[str]:
    """Column names: lower case, other characters to ``_``, squeezed; ``_`` before a digit."""
    out = []
    for raw in names:
        name = re.sub("[^a-z0-9]+", "_", (raw or "").strip().lower()).strip("_")
        out.append(f"_{name}" if name[:1].isdigit() else name or "col")
    return out

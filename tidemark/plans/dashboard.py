"""Downstream copies: the dashboard mapping and the four syncs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import SinkField, coerce_cell, coerce_typed
from ..functions.dates import day_literal, iso_text
from ..functions.numbers import null_as_zero_sum, safe_ratio
from ..functions.text import translated
from ..operators.ordering import dense_numbers
from ..operators.shape import align, rolling_window
from ..operators.sync import (apply_plan, create_missing, dropped_fields, fit_to_sink,
                              replace_stats, sync_stats, upsert_plan)
from ..schemas import DASHBOARD
from ..session import stored

# Display names of the channel groups.
CHANNEL_NAMES = {
    "Social": "Social Media",
    "Web": "Website",
    "Email": "Email Marketing",
    "Forms": "Forms & Actions",
}

# Number fields a dashboard may lack, with their precision.
ADDED_NUMBERS = {
    "engagements": 0,
    "website_users": 0,
    "website_new_users": 0,
    "key_events": 0,
    "avg_engagement_seconds": 1,
    "impressions": 0,
    "likes": 0,
    "comments": 0,
    "shares": 0,
    "saves": 0,
    "clicks": 0,
    "video_views": 0,
    "avg_watch_time_seconds": 1,
}

# Declared fields of the web copy.
WEB_FIELDS = [
    SinkField("date", "date"),
    SinkField("dimension_type", "text"),
    SinkField("dimension_value", "text"),
    SinkField("users", "number", 0),
    SinkField("new_users", "number", 0),
    SinkField("sessions", "number", 0),
    SinkField("engagement_rate", "number", 8),
    SinkField("key_events", "number", 0),
    SinkField("user_engagement_duration", "number", 0),
    SinkField("year", "number", 0),
    SinkField("month", "number", 0),
    SinkField("week_of_year", "number", 0),
    SinkField("month_name", "text"),
    SinkField("day_of_week", "text"),
    SinkField("days_ago", "number", 0),
]

# Default windows and keys of the syncs.
DAYS_BACK = 180
DASHBOARD_KEYS = ["channel", "subchannel", "date", "content_name"]
SOCIAL_KEYS = ["platform", "post_id"]


def dashboard_records(items: DataFrame, as_of: date | str | Column) -> DataFrame:
    """Cross-channel items in the 29 fields of the dashboard."""
    audience = null_as_zero_sum(F.col("new_followers"), F.col("new_contacts"))
    social = F.col("channel_group") == "Social"
    return align(items.select(
        iso_text(F.col("date"), "date").alias("date"),
        translated(F.col("channel_group"), CHANNEL_NAMES).alias("channel"),
        F.coalesce(F.nullif(F.col("ga4_dimension_type"), F.lit("")), "channel").alias("subchannel"),
        F.col("item_name").alias("content_name"), F.col("reach_or_impressions").alias("reach"),
        F.nullif(audience, F.lit(0)).alias("new_followers_contacts"),
        F.col("website_sessions").alias("sessions"), "website_users",
        F.col("engagement_rate").alias("engagement_rate_pct"),
        F.col("clicks").alias("action_takers"), F.col("engagement").alias("engagements"),
        "video_views", "avg_watch_time_seconds", F.col("social_impressions").alias("impressions"),
        "likes", "comments", "shares", "saves", F.when(social, F.col("clicks")).alias("clicks"),
        "website_new_users", F.col("website_key_events").alias("key_events"),
        safe_ratio(F.col("website_engagement_seconds"), F.col("website_users"), 1)
        .alias("avg_engagement_seconds"),
        "contributions", F.col("revenue").alias("amount_raised"), "year", "month", "month_name",
        F.datediff(day_literal(as_of), F.col("date")).cast("bigint").alias("days_ago"),
        safe_ratio(F.col("revenue"), F.col("contributions")).alias("avg_contribution"),
    ), DASHBOARD)


@dataclass(frozen=True)
class SyncResult:
    """Lazy results of a sync: the plan, the new target snapshot, one row of counts, the numbered records."""

    plan: DataFrame | None
    snapshot: DataFrame
    stats: DataFrame
    dropped: tuple[str, ...] = ()
    records: DataFrame | None = None


def sync_records(records: DataFrame, target: DataFrame, keys: Sequence[str],
                 schema: Sequence[SinkField], source_order: str = "source_order",
                 prune: bool = False, dedupe: bool = False, run_id: str = "new",
                 exclude: Sequence[str] = (),
                 add_numbers: Mapping[str, int] | None = None) -> SyncResult:
    """Upsert records into a target that knows the fields of ``schema``."""
    if add_numbers:
        target, schema = create_missing(target, schema, add_numbers)
    dropped = dropped_fields(records, schema, [source_order])
    fitted = fit_to_sink(records, schema, exclude, [source_order])
    # stored: applying and counting read the decisions, they do not make them again
    plan = stored(upsert_plan(fitted, target, keys, source_order), "plan")
    return SyncResult(plan, apply_plan(target, plan, prune, dedupe, run_id, source_order),
                      sync_stats(plan, prune, dedupe), tuple(dropped), records)


def ordered(df: DataFrame, order_by: Sequence[str],
            source_order: str = "source_order") -> DataFrame:
    """Store records with their place in the order, from 0 on and without gaps.

    The order is by ``order_by``, then by all other columns, NULLs first, so the numbers are the same
    however the rows are partitioned.  They come from two distributed passes; no
    task sees all rows.  The stored table fixes them: a plan reads its source more than once.
    """
    return dense_numbers(df, [*order_by, *[c for c in df.columns if c not in order_by]], source_order)


def sync_dashboard(items: DataFrame, target: DataFrame, schema: Sequence[SinkField],
                   as_of: date | str | Column, days: int = DAYS_BACK, records: DataFrame | None = None, **options) -> SyncResult:
    """Recent cross-channel items to the dashboard copy, stale records pruned.

    ``records`` are those that an earlier sync of the same items, day and window has numbered.
    """
    if records is None:
        recent = rolling_window(items, "date", days, as_of)
        records = ordered(dashboard_records(recent, as_of), DASHBOARD_KEYS)
    return sync_records(records, target, DASHBOARD_KEYS, schema, prune=True,
                        **{"add_numbers": ADDED_NUMBERS, **options})


def sync_social(posts: DataFrame, target: DataFrame, schema: Sequence[SinkField],
                as_of: date | str | Column, days: int = DAYS_BACK, records: DataFrame | None = None, **options) -> SyncResult:
    """Recent posts to the social copy, keyed by platform and post.

    ``records`` are those that an earlier sync of the same posts, day and window has numbered.
    """
    if records is None:
        recent = rolling_window(posts, "date", days, as_of)
        texts = {f.name: iso_text(F.col(f.name), f.dataType.simpleString())
                 for f in recent.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType))}
        records = ordered(recent.withColumns(texts), SOCIAL_KEYS)
    return sync_records(records, target, SOCIAL_KEYS, schema, prune=True, **options)


def sync_web(breakdown: DataFrame, target: DataFrame) -> SyncResult:
    """The whole web breakdown replaces the web copy."""
    records = coerce_typed(breakdown, WEB_FIELDS)
    return SyncResult(None, records, replace_stats(target, records))


def grid_records(grid: DataFrame, schema: Sequence[SinkField]) -> DataFrame:
    """Untyped cells resolved to the declared type of their field.

    A text field gets the cell as written, a number field the number the cell
    shows (percentages divided by 100), a date field the ISO day.
    """
    kinds = {f.name: f for f in schema}

    def resolved(name: str) -> Column:
        raw = F.col(f"`{name}`")
        if name not in kinds:
            return raw
        cell, field = coerce_cell(raw), kinds[name]
        if field.kind == "number":
            number = F.coalesce(cell["long_value"].cast("double"), cell["double_value"])
            return F.round(number).cast("bigint") if field.precision == 0 else number
        if field.kind == "date":
            return F.coalesce(cell["iso_date"], cell["text_value"])
        return F.coalesce(cell["iso_date"], cell["text_value"],
                          F.when(cell["kind"] != "blank", F.trim(raw)))
    return grid.select(*[resolved(c).alias(c) for c in grid.columns])


def sync_grid(grid: DataFrame, target: DataFrame, keys: Sequence[str],
              schema: Sequence[SinkField], source_order: str = "source_order",
              **options) -> SyncResult:
    """A spreadsheet grid to its copy: coerce, drop unknown fields, upsert."""
    records = grid_records(grid, schema)
    return sync_records(records, target, keys, schema, source_order, **options)

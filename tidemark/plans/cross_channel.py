"""All channels in one table: a row per post, web breakdown value, e-mail and form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_mixed_date
from ..functions.numbers import round_to_long
from ..functions.text import clip
from ..operators.latest import latest_per_key
from ..operators.shape import align, aligned_union
from ..schemas import CROSS_CHANNEL
from .campaigns import LOADED


def _month_parts(day: Column) -> dict[str, Column]:
    return {"year": F.year(day).cast("bigint"), "month": F.month(day).cast("bigint"),
            "month_name": F.date_format(day, "MMMM")}


def _items(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return align(df.select(*[c.alias(n) for n, c in columns.items()]), CROSS_CHANNEL)


def _whole(name: str) -> Column:
    """A count that may be text, double or whole; NULL when it cannot be read."""
    return round_to_long(F.col(name).try_cast("double"))


def web_items(breakdown: DataFrame, site_url: str) -> DataFrame:
    """Web breakdown rows; pages get an address.  The rate is in percent here."""
    zero = F.lit(0)
    page_url = F.when(F.col("dimension_type") == "Page",
                      F.concat(F.lit(site_url), F.col("dimension_value")))
    return _items(breakdown.filter(F.col("date").isNotNull()), {
        "date": F.col("date"), "channel": F.lit("Website"), "channel_group": F.lit("Web"),
        "item_type": F.col("dimension_type"), "item_url": page_url,
        "item_name": F.col("dimension_value"),
        "year": F.col("year"), "month": F.col("month"), "month_name": F.col("month_name"),
        "reach_or_impressions": F.coalesce("users", zero),
        "engagement": F.coalesce("sessions", zero),
        "engagement_rate": F.round(F.col("engagement_rate") * 100, 2),
        "clicks": F.coalesce("key_events", zero),
        "website_users": F.col("users"), "website_new_users": F.col("new_users"),
        "website_sessions": F.col("sessions"),
        "website_engagement_rate": F.col("engagement_rate"),
        "website_key_events": F.col("key_events"),
        "website_engagement_seconds": F.col("user_engagement_duration"),
        "ga4_dimension_type": F.col("dimension_type")})


def social_items(posts: DataFrame) -> DataFrame:
    """Social posts; the audience is the first figure the platform still reports."""
    zero = F.lit(0)
    same = ["content_type", "year", "month", "month_name", "engagement_rate", "likes", "comments",
            "shares", "saves", "video_views", "new_followers", "total_followers",
            "avg_watch_time_seconds", "completion_rate_pct", "peak_retention_pct"]
    return _items(posts.filter(F.col("date").isNotNull()), {
        "date": F.col("date"), "channel": F.col("platform"), "channel_group": F.lit("Social"),
        "item_type": F.lit("Post"), "item_id": F.col("post_id"), "item_url": F.col("post_url"),
        "item_name": clip(F.col("content"), 500),
        "reach_or_impressions": F.coalesce("reach", "impressions", "media_views", zero),
        "engagement": F.coalesce("total_engagement", zero),
        "clicks": F.coalesce("clicks", zero), "social_impressions": F.col("impressions"),
        **{c: F.col(c) for c in same}})


def email_items(report: DataFrame) -> DataFrame:
    """Newest dated snapshot of each e-mail; opens and clicks = recipients × rate.

    A date that cannot be read is NULL and stops no other row.
    """
    day = parse_mixed_date(F.col("last_sent_date"))
    df = latest_per_key(report.filter(F.col("last_sent_date").isNotNull()),
                        ["email_name"], [LOADED])
    people = F.coalesce(F.col("recipients").try_cast("double"), F.lit(0.0))

    def reached(rate: str) -> Column:
        return round_to_long(people * F.coalesce(rate, F.lit(0.0)))
    return _items(df, {
        "date": day, "channel": F.lit("Email"), "channel_group": F.lit("Email"),
        "item_type": F.lit("Email"), "item_name": F.col("email_name"), **_month_parts(day),
        "reach_or_impressions": _whole("recipients"), "engagement": reached("unique_open_rate"),
        "engagement_rate": F.col("unique_open_rate"), "clicks": reached("unique_click_rate"),
        "revenue": F.coalesce("amount_raised", F.lit(0.0)),
        "contributions": F.coalesce("total_contributions", F.lit(0.0)),
        "recipients": _whole("recipients"), "open_rate": F.col("unique_open_rate"),
        "click_rate": F.col("unique_click_rate"),
        **{c: F.col(c) for c in ("bounce_rate", "unsubscribe_rate", "recipient_list",
                                 "excluded_list")}})


def form_items(report: DataFrame) -> DataFrame:
    """Newest dated snapshot of each form."""
    day = parse_mixed_date(F.col("last_submission_date"))
    df = latest_per_key(report.filter(F.col("last_submission_date").isNotNull()),
                        ["form_name"], [LOADED])
    return _items(df, {
        "date": day, "channel": F.lit("Forms"), "channel_group": F.lit("Forms"),
        "item_type": F.lit("Form"), "item_name": F.col("form_name"),
        "content_type": F.col("form_type"), **_month_parts(day),
        "reach_or_impressions": _whole("number_of_views"),
        "engagement": _whole("number_of_submissions"),
        "engagement_rate": F.col("conversion_rate"),
        "revenue": F.coalesce("total_contribution_amount", F.lit(0.0)),
        "contributions": F.coalesce("number_of_contributions", F.lit(0.0)),
        "form_submissions": _whole("number_of_submissions"),
        "form_views": _whole("number_of_views"), "form_conversion_rate": F.col("conversion_rate"),
        "new_contacts": _whole("number_of_new_contacts"),
        "recurring_commitments": _whole("number_of_recurring_commitments"),
        "form_type": F.col("form_type"), "form_status": F.col("form_status")})


def cross_channel_items(social: DataFrame, web: DataFrame, emails: DataFrame,
                        forms: DataFrame) -> DataFrame:
    """The four item tables as one, 49 columns, matched by name."""
    return aligned_union([social, web, emails, forms], CROSS_CHANNEL)

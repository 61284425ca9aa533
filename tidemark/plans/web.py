"""Web analytics: daily reports by device, city, page and campaign in one breakdown."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_parts
from ..functions.numbers import recovered_sessions, round_to_long, safe_ratio
from ..operators.breakdown import topn_other
from ..operators.shape import align, aligned_union, rolling_window
from ..schemas import WEB_BREAKDOWN, layout
from ..session import stored
from ..sources.parts import read_parts, rebuild_days

# How many values of a day stay before the rest is "(other)".
TOP_VALUES = {"Page": 40, "Location": 25, "Campaign": 25}

_UNIFIED = layout("""
date date
dimension_type string
dimension_value string
users bigint
new_users bigint
engaged_sessions bigint
sessions bigint
key_events bigint
user_engagement_duration bigint
""")

_MEASURES = ["users", "new_users", "engaged_sessions", "sessions", "key_events",
             "user_engagement_duration"]


def _report(df: DataFrame, kind: str, value: Column, measures: Mapping[str, Column]) -> DataFrame:
    return df.select("date", F.lit(kind).alias("dimension_type"), value.alias("dimension_value"),
                     *[round_to_long(col).alias(name) for name, col in measures.items()])


def device_rows(df: DataFrame) -> DataFrame:
    return _rated(df, "Device", "device_category")


def city_rows(df: DataFrame) -> DataFrame:
    return _rated(df, "Location", "city")


def _rated(df: DataFrame, kind: str, dimension: str) -> DataFrame:
    """A report with a rate but no sessions column."""
    return _report(df, kind, F.col(dimension), {
        "users": F.col("total_users"), "new_users": F.col("new_users"),
        "engaged_sessions": F.col("engaged_sessions"),
        "sessions": recovered_sessions(F.col("engaged_sessions"), F.col("engagement_rate")),
        "key_events": F.col("key_events")})


def page_rows(df: DataFrame) -> DataFrame:
    return _report(df, "Page", F.col("page_path"), {
        "users": F.col("total_users"), "new_users": F.col("new_users"),
        "key_events": F.col("key_events"),
        "user_engagement_duration": F.col("user_engagement_duration")})


def campaign_rows(df: DataFrame) -> DataFrame:
    return _report(df, "Campaign", F.col("session_campaign_name"), {
        "users": F.col("total_users"), "engaged_sessions": F.col("engaged_sessions"),
        "sessions": F.col("sessions"), "key_events": F.col("key_events"),
        "user_engagement_duration": F.col("user_engagement_duration")})


def site_rows(df: DataFrame) -> DataFrame:
    return _report(df, "Site Total", F.lit("All traffic"), {
        "users": F.coalesce("active_users", "total_users"), "new_users": F.col("new_users"),
        "engaged_sessions": F.col("engagement_rate") * F.col("sessions"),
        "sessions": F.col("sessions"),
        "user_engagement_duration": F.col("user_engagement_duration")})


def bucketed_days(rows: DataFrame, as_of: date | str | Column, days: int = 365,
                  n_by_type: Mapping[str, int] = TOP_VALUES) -> DataFrame:
    """Unified rows to the stored breakdown: window, top-N with other, rate, date parts."""
    # read twice below: the reports behind it are built once
    recent = stored(rolling_window(rows, "date", days, as_of), "unified")
    totals = topn_other(recent, ["date"], "dimension_type", "dimension_value", "users",
                        n_by_type, _MEASURES)
    rated = totals.withColumn(
        "engagement_rate", safe_ratio(F.col("engaged_sessions"), F.col("sessions"), 4))
    return align(date_parts(rated, "date", as_of), WEB_BREAKDOWN)


def web_breakdown(device: DataFrame, city: DataFrame, page: DataFrame, campaign: DataFrame,
                  site: DataFrame, as_of: date | str | Column, days: int = 365,
                  n_by_type: Mapping[str, int] = TOP_VALUES) -> DataFrame:
    """One row per date, dimension type and value.

    Each type is a full breakdown of the same traffic: never sum across types.
    """
    rows = aligned_union([site_rows(site), device_rows(device), city_rows(city),
                          page_rows(page), campaign_rows(campaign)], _UNIFIED)
    return bucketed_days(rows, as_of, days, n_by_type)


def rebuild_breakdown(sources: Mapping[str, DataFrame], days: Sequence[date], root: str,
                      n_by_type: Mapping[str, int] = TOP_VALUES) -> list[str]:
    """Build the stored breakdown again for the days of new deliveries only.

    ``sources`` are the whole reports by name (device, city, page, campaign, site); of each only those days are scanned.
    """
    def build(**reports: DataFrame) -> DataFrame:
        rows = aligned_union([site_rows(reports["site"]), device_rows(reports["device"]), city_rows(reports["city"]),
                              page_rows(reports["page"]), campaign_rows(reports["campaign"])], _UNIFIED)
        return bucketed_days(rows, max(days), (max(days) - min(days)).days, n_by_type)
    return rebuild_days(build, sources, days, root)


def stored_breakdown(spark: SparkSession, root: str, as_of: date | str | Column, days: int = 365) -> DataFrame | None:
    """The stored days of the window, with their age as of a day."""
    table = read_parts(spark, root)
    return None if table is None else align(date_parts(rolling_window(table, "date", days, as_of), "date", as_of), WEB_BREAKDOWN)


def unified_schema() -> T.StructType:
    return _UNIFIED

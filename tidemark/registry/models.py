"""The stored models over raw tables derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.breakdown import daily_summary
from ..plans import campaigns, cross_channel, dashboard, social, web
from ..schemas import CAMPAIGN_ITEMS, CROSS_CHANNEL, DASHBOARD, SOCIAL_POSTS, WEB_BREAKDOWN
from . import raw
from .base import query, sql_columns, sql_round, table

AS_OF = "2025-01-10"
SITE_URL = "https://site.example"


def newest(sql: str, keys: str, order: str, where: str = "true") -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
      ORDER BY {order} DESC NULLS LAST) AS rn FROM ({sql}) WHERE {where}) WHERE rn = 1)"""


# --- e-mails and forms ----------------------------------------------------

def sql_date(text: str) -> str:
    return f"""coalesce(CAST(try_strptime({text}, '%m/%d/%y') AS DATE),
      CAST(try_strptime({text}, '%m/%d/%Y') AS DATE), TRY_CAST({text} AS DATE))"""


def sql_whole(expr: str) -> str:
    return f"CAST(round({expr}) AS BIGINT)"


def _dated(first: str, last: str) -> dict[str, str]:
    start, end = sql_date(first), sql_date(last)
    return {"first_date": start, "last_date": end, "days_active": f"{end} - {start}",
            "year": f"year({start})", "month": f"month({start})", "month_name": f"monthname({start})"}


STAGED_EMAILS = "SELECT " + sql_columns(CAMPAIGN_ITEMS, {
    "type": "'Email'", "name": "coalesce(email_name, '(Unnamed Email)')",
    **_dated("first_sent_date", "last_sent_date"), "recipients": sql_whole("recipients"),
    **{c: c for c in ("unique_open_rate", "unique_click_rate", "bounce_rate", "unsubscribe_rate",
                      "amount_raised", "avg_contribution_amount", "conversion_rate",
                      "recipient_list", "excluded_list")},
    "total_contributions": sql_whole("total_contributions"),
    "engagement_rate": sql_round("unique_open_rate + unique_click_rate", 4),
}) + f" FROM {newest(raw.EMAILS, 'email_name', '_import_timestamp')}"

STAGED_FORMS = "SELECT " + sql_columns(CAMPAIGN_ITEMS, {
    "type": "'Form'", "name": "coalesce(form_name, '(Unnamed Form)')",
    **_dated("first_submission_date", "last_submission_date"),
    "submissions": sql_whole("number_of_submissions"), "views": sql_whole("number_of_views"),
    "form_type": "form_type", "form_status": "form_status", "conversion_rate": "conversion_rate",
    "engagement_rate": "conversion_rate",
    "total_contributions": sql_whole("number_of_contributions"),
    "amount_raised": "total_contribution_amount",
    "avg_contribution_amount": "average_contribution_amount",
    "recurring_commitments": sql_whole("number_of_recurring_commitments"),
    "new_contacts": sql_whole("number_of_new_contacts"),
}) + f" FROM {newest(raw.FORMS, 'form_name', '_import_timestamp')}"


def campaign_marts(spark, d):
    return campaigns.campaign_items(raw.emails(spark, d), raw.forms(spark, d))


query("campaign_marts", f"{STAGED_EMAILS}\nUNION ALL\n{STAGED_FORMS}")(campaign_marts)


@query("campaign_tests", f"""
WITH m AS ({STAGED_EMAILS} UNION ALL {STAGED_FORMS})
SELECT 'not_null' AS test, 'type' AS "column", count(*) FILTER (type IS NULL) AS failures FROM m
UNION ALL SELECT 'accepted_values', 'type', count(*) FILTER (type NOT IN ('Email', 'Form')) FROM m
UNION ALL SELECT 'not_null', 'name', count(*) FILTER (name IS NULL) FROM m""")
def campaign_tests(spark, d):
    return q.run_tests(campaign_marts(spark, d), campaigns.CAMPAIGN_TESTS)


def _staged_tests_sql(name: str, sql: str) -> str:
    return " UNION ALL ".join(f"""
SELECT '{name}' AS model, 'not_null' AS test, '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS failures FROM ({sql})"""
                              for c in ("type", "name"))


@query("staged_tests", f"{_staged_tests_sql('emails', STAGED_EMAILS)} UNION ALL {_staged_tests_sql('forms', STAGED_FORMS)}")
def staged_tests(spark, d):
    """Both staged tables need a type and a name."""
    staged = {"emails": campaigns.staged_emails(raw.emails(spark, d)),
              "forms": campaigns.staged_forms(raw.forms(spark, d))}
    parts = [q.run_tests(df, campaigns.STAGED_TESTS).select(F.lit(n).alias("model"), "*") for n, df in staged.items()]
    return parts[0].unionByName(parts[1])


# --- mailing lists --------------------------------------------------------

# Per list: which users it holds, and which load times its deliveries have.
_LISTS = {"full_list": "true", "recent_list": "user_id % 3 <> 0", "donors": "event_type <> 'error'"}

_STATUS_SQL = """CASE event_type WHEN 'purchase' THEN 'Subscribed' WHEN 'signup' THEN 'Subscribed'
  WHEN 'error' THEN 'Unsubscribed' WHEN 'click' THEN 'Pending' END"""


def _list_sql(name: str, where: str) -> str:
    return f"""
SELECT '{name}' AS source_table, day, half, max(ts) AS _import_timestamp, count(*) AS record_count,
       count(*) FILTER (status = 'Subscribed') AS subscribed,
       count(*) FILTER (status = 'Unsubscribed') AS unsubscribed
FROM (SELECT CAST(ts AS DATE) AS day, hour(ts) >= 12 AS half, ts, {_STATUS_SQL} AS status
      FROM events WHERE {where})
GROUP BY day, half"""


_TOTALS_BASE = " UNION ALL ".join(_list_sql(n, w) for n, w in _LISTS.items())


def _pct_sql(col: str) -> str:
    return sql_round(f"CAST({col} AS DOUBLE) / CAST(record_count AS DOUBLE) * 100", 2)


_TOTALS_SELECT = f"""SELECT day AS _email_date, source_table, record_count AS total_records, subscribed,
  unsubscribed, record_count - subscribed - unsubscribed AS status_unknown,
  {_pct_sql('subscribed')} AS pct_subscribed, {_pct_sql('unsubscribed')} AS pct_unsubscribed"""

# half-day deliveries; those of the 5th day of a month carry the fallback name
_TOTALS_KEPT = f"(SELECT * FROM ({_TOTALS_BASE}) WHERE record_count > 1 AND day(day) <> 5)"


def list_reports(spark, d):
    """Two summary loads a day and list, as the ingest would store them."""
    status = (F.when(F.col("event_type").isin("purchase", "signup"), "Subscribed")
              .when(F.col("event_type") == "error", "Unsubscribed")
              .when(F.col("event_type") == "click", "Pending"))
    events = table(spark, d, "events").select(
        "ts", "user_id", "event_type", F.col("ts").cast("date").alias("day"),
        (F.hour("ts") >= 12).alias("half"), status.alias("subscription_status"))
    chosen = {"full_list": F.lit(True), "recent_list": F.col("user_id") % 3 != 0,
              "donors": F.col("event_type") != "error"}
    out = {}
    for name, where in chosen.items():
        rows = events.filter(where)
        keys = ["day", "half"]
        summary = daily_summary(rows, ["subscription_status"], keys)
        loaded = rows.groupBy(*keys).agg(F.max("ts").alias("_import_timestamp"))
        file = F.when(F.dayofmonth("day") == 5,
                      F.concat(F.lit("list_"), F.date_format("day", "yyyyMMdd"), F.lit("_120000.csv"))) \
            .otherwise(F.concat(F.lit("Daily_List_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv")))
        received = F.concat(F.date_format("day", "yyyy-MM-dd"),
                            F.when(F.col("half"), "T18:00:00+00:00").otherwise("T06:00:00+00:00"))
        out[name] = summary.join(loaded, keys).withColumns(
            {"_source_filename": file, "_email_date": received})
    return out


@query("daily_totals", f"{_TOTALS_SELECT} FROM {_TOTALS_KEPT}")
def daily_totals(spark, d):
    """Totals per delivery: two deliveries of one day both count."""
    return campaigns.daily_totals(list_reports(spark, d))


@query("daily_totals_by_day", f"""{_TOTALS_SELECT} FROM (
  SELECT *, row_number() OVER (PARTITION BY day, source_table ORDER BY _import_timestamp DESC) AS rn
  FROM {_TOTALS_KEPT}) WHERE rn = 1""")
def daily_totals_by_day(spark, d):
    return campaigns.daily_totals(list_reports(spark, d), grain="day")


@query("daily_totals_tests", f"""
WITH t AS ({_TOTALS_SELECT} FROM {_TOTALS_KEPT})
SELECT 'not_null' AS test, '_email_date' AS "column", count(*) FILTER (_email_date IS NULL) AS failures FROM t
UNION ALL SELECT 'not_null', 'source_table', count(*) FILTER (source_table IS NULL) FROM t
UNION ALL SELECT 'accepted_values', 'source_table', count(*) FILTER (source_table NOT IN ('full_list', 'donors')) FROM t
UNION ALL SELECT 'not_null', 'total_records', count(*) FILTER (total_records IS NULL) FROM t""")
def daily_totals_tests(spark, d):
    """The declared tests of the totals; one list is not declared here, so its rows fail."""
    return q.run_tests(daily_totals(spark, d), campaigns.daily_totals_tests(["full_list", "donors"]))


# --- web ------------------------------------------------------------------

def _web_sql(kind: str, value: str, sql: str, **given: str) -> str:
    cols = ["users", "new_users", "engaged_sessions", "sessions", "key_events",
            "user_engagement_duration"]
    return (f"SELECT date, '{kind}' AS dimension_type, {value} AS dimension_value, "
            + ", ".join(f"CAST(round({given.get(c, 'NULL::DOUBLE')}) AS BIGINT) AS {c}" for c in cols)
            + f" FROM ({sql})")


_RECOVERED = "CAST(engaged_sessions AS DOUBLE) / nullif(engagement_rate, 0)"
_UNIFIED = "\nUNION ALL\n".join([
    _web_sql("Site Total", "'All traffic'", raw.SITE, users="coalesce(active_users, total_users)",
             new_users="new_users", engaged_sessions="engagement_rate * sessions", sessions="sessions",
             user_engagement_duration="user_engagement_duration"),
    _web_sql("Device", "device_category", raw.DEVICE, users="total_users", new_users="new_users",
             engaged_sessions="engaged_sessions", sessions=_RECOVERED, key_events="key_events"),
    _web_sql("Location", "city", raw.CITY, users="total_users", new_users="new_users",
             engaged_sessions="engaged_sessions", sessions=_RECOVERED, key_events="key_events"),
    _web_sql("Page", "page_path", raw.PAGE, users="total_users", new_users="new_users",
             key_events="key_events", user_engagement_duration="user_engagement_duration"),
    _web_sql("Campaign", "session_campaign_name", raw.CAMPAIGN, users="total_users",
             engaged_sessions="engaged_sessions", sessions="sessions", key_events="key_events",
             user_engagement_duration="user_engagement_duration")])

_SUMS = ["users", "new_users", "engaged_sessions", "sessions", "key_events",
         "user_engagement_duration"]
_BY = ", ".join(f"{c} DESC NULLS LAST" for c in _SUMS)
BREAKDOWN = "SELECT " + sql_columns(WEB_BREAKDOWN, {
    **{c: c for c in ("date", "dimension_type", "dimension_value", "users", "new_users", "sessions",
                      "key_events", "user_engagement_duration")},
    "engagement_rate": sql_round("CAST(engaged_sessions AS DOUBLE) / nullif(sessions, 0)", 4),
    "year": "year(date)", "month": "month(date)", "week_of_year": "weekofyear(date)",
    "month_name": "monthname(date)", "day_of_week": "dayname(date)",
    "days_ago": f"DATE '{AS_OF}' - date",
}) + f""" FROM (
  SELECT date, dimension_type,
         CASE WHEN rank_in_day > CASE dimension_type WHEN 'Page' THEN 40 WHEN 'Location' THEN 25
                                                     WHEN 'Campaign' THEN 25 ELSE 1000000000 END
              THEN '(other)' ELSE dimension_value END AS dimension_value,
         {', '.join(f'sum({c}) AS {c}' for c in _SUMS)}
  FROM (SELECT *, row_number() OVER (PARTITION BY date, dimension_type ORDER BY users DESC NULLS LAST,
                                     dimension_value ASC NULLS FIRST, {_BY}) AS rank_in_day
        FROM ({_UNIFIED}) WHERE date >= DATE '{AS_OF}' - 365)
  GROUP BY 1, 2, 3)"""


def breakdown_365d(spark, d):
    """Five web reports in one breakdown of the last 365 days."""
    return web.web_breakdown(raw.device(spark, d), raw.city(spark, d), raw.page(spark, d),
                             raw.campaign(spark, d), raw.site(spark, d), AS_OF)


query("breakdown_365d", BREAKDOWN)(breakdown_365d)


# --- social ---------------------------------------------------------------

def _post_sql(given: dict[str, str], frm: str) -> str:
    return "SELECT " + sql_columns(SOCIAL_POSTS, {
        **given, "year": "NULL", "total_engagement": "NULL"}) + f" FROM {frm}"


_FACEBOOK = _post_sql({
    "date": "created_timestamp", "platform": "'Facebook'", "content_type": "'Post'",
    "account_name": "page_name", "page_id": "page_id", "post_id": "post_id",
    "content": "post_message", "post_url": "post_url", "post_created_at": "created_timestamp",
    "likes": "likes", "clicks": "clicks", "impressions": "impressions",
    "media_views": "media_views", "video_views": "video_views",
    "avg_watch_time_seconds": "video_avg_time_watched",
    "is_most_recent_record": "is_most_recent_record", "source_relation": "source_relation",
}, newest(raw.FACEBOOK, "page_id, post_id", "date_day"))

_KIND = "CASE WHEN m.media_product_type = 'REELS' THEN 'REEL' ELSE m.media_type END"
_MEDIA = newest(raw.MEDIA, "id", "_fivetran_synced", "coalesce(media_product_type, '') <> 'STORY'")
_INSTAGRAM = _post_sql({
    "date": "CAST(m.created_time AS DATE)", "platform": "'Instagram'",
    "content_type": f"CASE WHEN {_KIND} IN ('VIDEO', 'REEL') THEN 'Video' "
                    f"WHEN {_KIND} = 'CAROUSEL_ALBUM' THEN 'Carousel' "
                    f"WHEN {_KIND} = 'IMAGE' THEN 'Image' ELSE 'Unknown' END",
    "account_name": "m.username", "page_id": "m.user_id", "post_id": "m.id",
    "content": "m.caption", "post_url": "m.permalink",
    "post_created_at": "CAST(m.created_time AS DATE)", "likes": "i.like_count",
    "comments": "i.comment_count",
    "impressions": "coalesce(i.carousel_album_impressions, i.story_impressions, i.video_photo_impressions)",
    "reach": "coalesce(i.reel_reach, i.carousel_album_reach, i.video_photo_reach)",
    "video_views": "coalesce(i.video_photo_views, i.reel_views, i.carousel_album_views)",
}, f"{_MEDIA} m LEFT JOIN {newest(raw.INSIGHTS, 'id', '_fivetran_synced')} i ON i.id = m.id")

_ACCOUNT = "nullif(regexp_extract(share_url, '@([^/]+)/video', 1), '')"
_CREATED = "CAST(make_timestamp(create_time * 1000000) AS DATE)"
_TIKTOK = _post_sql({
    "date": _CREATED, "platform": "'TikTok'", "content_type": "'Video'", "account_name": _ACCOUNT,
    "page_id": _ACCOUNT, "post_id": "id", "content": "caption", "post_url": "share_url",
    "post_created_at": _CREATED, "likes": "likes",
    "clicks": "coalesce(website_clicks, 0) + coalesce(app_download_clicks, 0) + coalesce(email_clicks, 0)"
              " + coalesce(phone_number_clicks, 0) + coalesce(address_clicks, 0)",
    "comments": "comments", "shares": "shares", "saves": "favorites", "impressions": "reach",
    "video_views": "video_views", "avg_watch_time_seconds": "average_time_watched",
}, f"({raw.VIDEOS}) WHERE coalesce(_fivetran_deleted, false) = false")

_TOTAL = ("coalesce(likes, 0) + coalesce(comments, 0) + coalesce(shares, 0) + coalesce(clicks, 0)"
          " + coalesce(saves, 0)")
POSTS = f"""SELECT * REPLACE (year(date) AS year, month(date) AS month, monthname(date) AS month_name,
  {_TOTAL} AS total_engagement,
  CASE WHEN impressions <> 0 THEN CAST({_TOTAL} AS DOUBLE) / CAST(impressions AS DOUBLE) END AS engagement_rate)
FROM ({_FACEBOOK} UNION ALL {_INSTAGRAM} UNION ALL {_TIKTOK})"""


def social_posts(spark, d):
    """Post versions of three platforms reduced to one row per post."""
    return social.social_posts(raw.facebook(spark, d), raw.media(spark, d), raw.insights(spark, d),
                               raw.videos(spark, d))


query("social_posts", POSTS)(social_posts)


# --- all channels ---------------------------------------------------------

def _item_sql(given: dict[str, str], frm: str) -> str:
    return "SELECT " + sql_columns(CROSS_CHANNEL, given) + f" FROM {frm}"


_WEB_ITEMS = _item_sql({
    "date": "date", "channel": "'Website'", "channel_group": "'Web'", "item_type": "dimension_type",
    "item_url": f"CASE WHEN dimension_type = 'Page' THEN '{SITE_URL}' || dimension_value END",
    "item_name": "dimension_value", "year": "year", "month": "month", "month_name": "month_name",
    "reach_or_impressions": "coalesce(users, 0)", "engagement": "coalesce(sessions, 0)",
    "engagement_rate": sql_round("engagement_rate * 100", 2), "clicks": "coalesce(key_events, 0)",
    "website_users": "users", "website_new_users": "new_users", "website_sessions": "sessions",
    "website_engagement_rate": "engagement_rate", "website_key_events": "key_events",
    "website_engagement_seconds": "user_engagement_duration",
    "ga4_dimension_type": "dimension_type"}, f"({BREAKDOWN})")

_SOCIAL_ITEMS = _item_sql({
    "date": "date", "channel": "platform", "channel_group": "'Social'", "item_type": "'Post'",
    "item_id": "post_id", "item_url": "post_url", "item_name": "left(content, 500)",
    "reach_or_impressions": "coalesce(reach, impressions, media_views, 0)",
    "engagement": "coalesce(total_engagement, 0)", "clicks": "coalesce(clicks, 0)",
    "social_impressions": "impressions",
    **{c: c for c in ("content_type", "year", "month", "month_name", "engagement_rate", "likes",
                      "comments", "shares", "saves", "video_views", "new_followers",
                      "total_followers", "avg_watch_time_seconds", "completion_rate_pct",
                      "peak_retention_pct")}}, f"({POSTS}) WHERE date IS NOT NULL")

_DAY = "CAST({} AS DATE)"


def _parts(day: str) -> dict[str, str]:
    return {"year": f"year({day})", "month": f"month({day})", "month_name": f"monthname({day})"}


_SENT = _DAY.format("last_sent_date")
_EMAIL_ITEMS = _item_sql({
    "date": _SENT, "channel": "'Email'", "channel_group": "'Email'", "item_type": "'Email'",
    "item_name": "email_name", **_parts(_SENT), "reach_or_impressions": sql_whole("recipients"),
    "engagement": sql_whole("recipients * unique_open_rate"), "engagement_rate": "unique_open_rate",
    "clicks": sql_whole("recipients * unique_click_rate"), "revenue": "coalesce(amount_raised, 0)",
    "contributions": "coalesce(total_contributions, 0)", "recipients": sql_whole("recipients"),
    "open_rate": "unique_open_rate", "click_rate": "unique_click_rate",
    **{c: c for c in ("bounce_rate", "unsubscribe_rate", "recipient_list", "excluded_list")},
}, newest(raw.EMAILS, "email_name", "_import_timestamp", "last_sent_date IS NOT NULL"))

_SUBMITTED = _DAY.format("last_submission_date")
_FORM_ITEMS = _item_sql({
    "date": _SUBMITTED, "channel": "'Forms'", "channel_group": "'Forms'", "item_type": "'Form'",
    "item_name": "form_name", "content_type": "form_type", **_parts(_SUBMITTED),
    "reach_or_impressions": sql_whole("number_of_views"),
    "engagement": sql_whole("number_of_submissions"), "engagement_rate": "conversion_rate",
    "revenue": "coalesce(total_contribution_amount, 0)",
    "contributions": "coalesce(number_of_contributions, 0)",
    "form_submissions": sql_whole("number_of_submissions"),
    "form_views": sql_whole("number_of_views"), "form_conversion_rate": "conversion_rate",
    "new_contacts": sql_whole("number_of_new_contacts"),
    "recurring_commitments": sql_whole("number_of_recurring_commitments"),
    "form_type": "form_type", "form_status": "form_status",
}, newest(raw.FORMS, "form_name", "_import_timestamp", "last_submission_date IS NOT NULL"))

ITEMS = "\nUNION ALL\n".join([_SOCIAL_ITEMS, _WEB_ITEMS, _EMAIL_ITEMS, _FORM_ITEMS])


def all_items(spark, d):
    return items_of(spark, d, social_posts(spark, d), breakdown_365d(spark, d))


def items_of(spark, d, posts: DataFrame, breakdown: DataFrame) -> DataFrame:
    """Items of all channels, from posts and a web breakdown that are there already."""
    return cross_channel.cross_channel_items(
        cross_channel.social_items(posts),
        cross_channel.web_items(breakdown, SITE_URL),
        cross_channel.email_items(raw.emails(spark, d)),
        cross_channel.form_items(raw.forms(spark, d)))


query("cross_channel", ITEMS)(all_items)


def mapped_sql(as_of: str) -> str:
    return "SELECT " + sql_columns(DASHBOARD, {
        "date": "strftime(date, '%Y-%m-%d')",
        "channel": "CASE channel_group WHEN 'Social' THEN 'Social Media' WHEN 'Web' THEN 'Website' "
                   "WHEN 'Email' THEN 'Email Marketing' WHEN 'Forms' THEN 'Forms & Actions' "
                   "ELSE channel_group END",
        "subchannel": "coalesce(nullif(ga4_dimension_type, ''), channel)", "content_name": "item_name",
        "reach": "reach_or_impressions",
        "new_followers_contacts": "nullif(coalesce(new_followers, 0) + coalesce(new_contacts, 0), 0)",
        "sessions": "website_sessions", "website_users": "website_users",
        "engagement_rate_pct": "engagement_rate", "action_takers": "clicks", "engagements": "engagement",
        "impressions": "social_impressions",
        "clicks": "CASE WHEN channel_group = 'Social' THEN clicks END",
        "website_new_users": "website_new_users", "key_events": "website_key_events",
        "avg_engagement_seconds": sql_round(
            "CAST(website_engagement_seconds AS DOUBLE) / nullif(website_users, 0)", 1),
        "amount_raised": "revenue", "days_ago": f"DATE '{as_of}' - date",
        "avg_contribution": "revenue / nullif(contributions, 0)",
        **{c: c for c in ("video_views", "avg_watch_time_seconds", "likes", "comments", "shares",
                          "saves", "contributions", "year", "month", "month_name")},
    }) + f" FROM ({ITEMS})"


@query("mapped_dashboard", mapped_sql(AS_OF))
def mapped_dashboard(spark, d):
    """Cross-channel items in the fields of the dashboard."""
    return dashboard.dashboard_records(all_items(spark, d), AS_OF)

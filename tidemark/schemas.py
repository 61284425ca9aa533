"""Column layouts of the stored models."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
}


def layout(text: str) -> T.StructType:
    """``name type`` per line to a schema."""
    pairs = [line.split() for line in text.strip().splitlines() if line.strip()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Names, order and types of the output columns.

CAMPAIGN_ITEMS = layout("""
type string
name string
first_date date
last_date date
days_active bigint
year bigint
month bigint
month_name string
conversion_rate double
engagement_rate double
total_contributions bigint
amount_raised double
avg_contribution_amount double
recipients bigint
unique_open_rate double
unique_click_rate double
bounce_rate double
unsubscribe_rate double
submissions bigint
views bigint
form_type string
form_status string
recurring_commitments bigint
new_contacts bigint
recipient_list string
excluded_list string
""")

DAILY_TOTALS = layout("""
_email_date date
source_table string
total_records bigint
subscribed bigint
unsubscribed bigint
status_unknown bigint
pct_subscribed double
pct_unsubscribed double
""")

SOCIAL_POSTS = layout("""
date date
platform string
content_type string
account_name string
page_id string
post_id string
content string
post_url string
post_created_at date
year bigint
month bigint
month_name string
likes bigint
clicks bigint
comments bigint
shares bigint
saves bigint
impressions bigint
reach bigint
media_views bigint
video_views bigint
total_engagement bigint
engagement_rate double
avg_watch_time_seconds double
completion_rate_pct double
peak_retention_pct double
new_followers bigint
total_followers bigint
is_most_recent_record boolean
source_relation string
""")

WEB_BREAKDOWN = layout("""
date date
dimension_type string
dimension_value string
users bigint
new_users bigint
sessions bigint
engagement_rate double
key_events bigint
user_engagement_duration bigint
year bigint
month bigint
week_of_year bigint
month_name string
day_of_week string
days_ago bigint
""")

CROSS_CHANNEL = layout("""
date date
channel string
channel_group string
item_type string
item_id string
item_url string
item_name string
content_type string
year bigint
month bigint
month_name string
reach_or_impressions bigint
engagement bigint
engagement_rate double
clicks bigint
revenue double
contributions double
likes bigint
comments bigint
shares bigint
saves bigint
video_views bigint
social_impressions bigint
new_followers bigint
total_followers bigint
avg_watch_time_seconds double
completion_rate_pct double
peak_retention_pct double
website_users bigint
website_new_users bigint
website_sessions bigint
website_engagement_rate double
website_key_events bigint
website_engagement_seconds bigint
ga4_dimension_type string
recipients bigint
open_rate double
click_rate double
bounce_rate double
unsubscribe_rate double
recipient_list string
excluded_list string
form_submissions bigint
form_views bigint
form_conversion_rate double
new_contacts bigint
recurring_commitments bigint
form_type string
form_status string
""")

DASHBOARD = layout("""
date string
channel string
subchannel string
content_name string
reach bigint
new_followers_contacts bigint
sessions bigint
website_users bigint
engagement_rate_pct double
action_takers bigint
engagements bigint
video_views bigint
avg_watch_time_seconds double
impressions bigint
likes bigint
comments bigint
shares bigint
saves bigint
clicks bigint
website_new_users bigint
key_events bigint
avg_engagement_seconds double
contributions double
amount_raised double
year bigint
month bigint
month_name string
days_ago bigint
avg_contribution double
""")

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import run_tests
from tidemark.plans import campaigns, cross_channel, dashboard, social, web
from tidemark.schemas import CAMPAIGN_ITEMS, CROSS_CHANNEL, DASHBOARD, SOCIAL_POSTS, WEB_BREAKDOWN

from .conftest import rows_of

D, TS = dt.date, dt.datetime


def same_layout(df, schema):
    return df.dtypes == [(f.name, f.dataType.simpleString()) for f in schema.fields]

EMAIL = ("email_name string, first_sent_date string, last_sent_date string, recipients double, "
         "unique_open_rate double, unique_click_rate double, bounce_rate double, unsubscribe_rate double, "
         "total_contributions double, amount_raised double, avg_contribution_amount double, "
         "conversion_rate double, recipient_list string, excluded_list string, "
         "_import_timestamp timestamp, _source_filename string")


def email(name, last="2026-03-05", load=1, recipients=5.0, rate=0.5, amount=None):
    return (name, "3/1/26", last, recipients, rate, 0.1, 0.0, 0.0, None, amount, None, 0.2, "l", None,
            TS(2026, 4, load), "f.csv")


@pytest.fixture
def emails(frame):
    return frame([email("a", load=1), email("a", load=2, recipients=7.0), email(None), email(None, load=2),
                  email("b", last=None), email("c", rate=None, amount=9.0)], EMAIL)


FORM = ("form_name string, first_submission_date string, last_submission_date string, "
        "number_of_submissions double, number_of_views double, form_type string, form_status string, "
        "conversion_rate double, number_of_contributions double, total_contribution_amount double, "
        "average_contribution_amount double, number_of_recurring_commitments double, "
        "number_of_new_contacts double, _import_timestamp timestamp, _source_filename string")


@pytest.fixture
def forms(frame):
    row = ("f", "3/1/2026", "2026-03-09", 4.0, 8.0, "Petition", "Active", 0.5, None, None, None, 1.0, 3.0)
    return frame([(*row, TS(2026, 4, 1), "x"), ("g", None, None, *row[3:], TS(2026, 4, 1), "x")], FORM)


def test_campaign_items(emails, forms):
    got = campaigns.campaign_items(emails, forms)
    assert same_layout(got, CAMPAIGN_ITEMS) and len(got.columns) == 26
    rows = {(r.type, r.name): r for r in got.collect()}
    assert len(rows) == 6
    a = rows[("Email", "a")]
    assert (a.recipients, a.days_active, a.month_name, a.engagement_rate) == (7, 4, "March", 0.6)
    assert ("Email", "(Unnamed Email)") in rows and rows[("Email", "b")].last_date is None
    f = rows[("Form", "f")]
    assert (f.engagement_rate, f.submissions, f.recipients, f.days_active) == (0.5, 4, None, 8)
    assert {r.failures for r in run_tests(got, campaigns.CAMPAIGN_TESTS).collect()} == {0}


LIST = ("report_date date, record_count bigint, subscription_status_counts string, _import_timestamp timestamp, "
        "_source_filename string, _email_date string")


@pytest.fixture
def lists(frame):
    day = D(2026, 3, 20)

    def row(n, counts, load, at, file="Daily_List_1.csv"):
        return (day, n, counts, TS(2026, 3, 21, load), file, f"2026-03-20T{at}:00:00+00:00")
    return {"list_one": frame([
        row(10, '{"Subscribed": 6, "Unsubscribed": 1}', 1, "06"), row(20, '{"Subscribed": 9}', 2, "06"),
        row(3, None, 3, "18"), row(1, None, 4, "19"), row(None, None, 4, "20"), row(9, "{}", 5, "21", None),
        row(9, "{}", 5, "22", "list_one_20260821_101010.csv")], LIST),
        "list_two": frame([row(4, '{"Subscribed": "x", "Unsubscribed": 4}', 1, "06"), row(7, "broken", 1, "07")], LIST)}


def test_daily_totals_both_grains(lists):
    got = rows_of(campaigns.daily_totals(lists))
    day = D(2026, 3, 20)
    assert got == sorted([
        (day, "list_one", 20, 9, 0, 11, 45.0, 0.0), (day, "list_one", 3, 0, 0, 3, 0.0, 0.0),
        (day, "list_two", 4, 0, 4, 0, 0.0, 100.0), (day, "list_two", 7, 0, 0, 7, 0.0, 0.0)], key=str)
    by_day = campaigns.daily_totals({"list_one": lists["list_one"]}, grain="day")
    assert rows_of(by_day, "total_records") == [(3,)]
    assert rows_of(campaigns.unreadable_counts(lists)) == [("list_one", 0), ("list_two", 1)]
    tests = campaigns.daily_totals_tests(["list_one", "list_two"])
    assert {r.failures for r in run_tests(campaigns.daily_totals(lists), tests).collect()} == {0}
    with pytest.raises(ValueError, match="grain"):
        campaigns.daily_totals(lists, grain="week")


def web_reports(frame):
    rated = "date date, property string, {} string, total_users bigint, new_users bigint, engaged_sessions bigint, " \
            "engagement_rate double, key_events double"
    d, old, edge = D(2026, 1, 5), D(2025, 1, 4), D(2025, 1, 5)
    device = frame([(d, "p", "mobile", 5, 1, 10, 0.4, 1.5), (d, "p", "tv", 1, 1, 3, 0.0, 0.0),
                    (old, "p", "mobile", 9, 9, 9, 1.0, 9.0), (edge, "p", "mobile", 2, 2, 2, 1.0, 0.0)],
                   rated.format("device_category"))
    city = frame([(d, "p", f"c{i:02d}", i, 1, 1, 0.5, 0.0) for i in range(30)] + [
        (d, "p", None, 100, 1, 1, 0.5, 0.0), (d, "p", "(other)", 50, 1, 1, 0.5, 0.0)], rated.format("city"))
    page = frame([(d, "p", f"/{i}", 1, 1, 0.0, 60) for i in range(45)],
                 "date date, property string, page_path string, total_users bigint, new_users bigint, "
                 "key_events double, user_engagement_duration bigint")
    campaign = frame([(d, "p", "x", 1, 2, 4, 0.0, 9)],
                     "date date, property string, session_campaign_name string, total_users bigint, "
                     "engaged_sessions bigint, sessions bigint, key_events double, user_engagement_duration bigint")
    site = frame([(d, None, 40, 4, 9, 0.5, 90.0), (edge, 30, 40, 4, 8, 0.5, 90.0)],
                 "date date, active_users bigint, total_users bigint, new_users bigint, sessions bigint, "
                 "engagement_rate double, user_engagement_duration double")
    return device, city, page, campaign, site


def test_web_breakdown(frame):
    got = web.web_breakdown(*web_reports(frame), as_of="2026-01-05")
    assert same_layout(got, WEB_BREAKDOWN) and len(got.columns) == 15
    rows = {(r.date, r.dimension_type, r.dimension_value): r for r in got.collect()}
    d, edge = D(2026, 1, 5), D(2025, 1, 5)
    assert (D(2025, 1, 4), "Device", "mobile") not in rows and (edge, "Device", "mobile") in rows
    tv = rows[(d, "Device", "tv")]
    assert (tv.sessions, tv.engagement_rate) == (None, None)
    mobile = rows[(d, "Device", "mobile")]
    assert (mobile.sessions, mobile.engagement_rate, mobile.key_events, mobile.days_ago) == (25, 0.4, 2, 0)
    cities = {k[2]: r.users for k, r in rows.items() if k[1] == "Location"}
    # 32 values, 25 kept by users; the real "(other)" is one of them and joins the bucket
    assert len(cities) == 25 and cities[None] == 100 and cities["(other)"] == 50 + sum(range(7))
    assert sum(cities.values()) == sum(range(30)) + 150
    pages = {k[2]: r for k, r in rows.items() if k[1] == "Page"}
    assert len(pages) == 41 and pages["(other)"].users == 5 and pages["/0"].sessions is None
    site = rows[(d, "Site Total", "All traffic")]
    assert (site.users, site.engagement_rate, site.week_of_year) == (40, round(5 / 9, 4), 2)
    assert rows[(edge, "Site Total", "All traffic")].users == 30


def social_sources(frame):
    fb = ("date_day date, created_timestamp timestamp, page_name string, page_id bigint, post_id string, "
          "post_message string, post_url string, likes bigint, clicks bigint, impressions bigint, media_views bigint, "
          "video_views bigint, video_avg_time_watched double, is_most_recent_record boolean, source_relation string")
    at = TS(2026, 1, 1, 23)
    facebook = frame([(D(2026, 1, d), at, "P", p, "x", "é" * 600, "u", d, 1, imp, 70, 3, 1.5, True, "s")
                      for d, p, imp in ((1, 1, 10), (3, 1, 0), (2, 1, 10), (2, 2, None))], fb)
    media = frame([(1, TS(2026, 1, 2), "REELS", "VIDEO", "n", 9, "old", "l", TS(2026, 1, 2)),
                   (1, TS(2026, 1, 2), "REELS", "VIDEO", "n", 9, "new", "l", TS(2026, 1, 3)),
                   (2, TS(2026, 1, 2), "STORY", "IMAGE", "n", 9, "c", "l", TS(2026, 1, 2)),
                   (3, TS(2026, 1, 2), None, "CAROUSEL_ALBUM", "n", 9, "c", "l", TS(2026, 1, 2)),
                   (4, TS(2026, 1, 2), "FEED", "OTHER", "n", 9, "c", "l", TS(2026, 1, 2))],
                  "id bigint, created_time timestamp, media_product_type string, media_type string, username string, "
                  "user_id bigint, caption string, permalink string, _fivetran_synced timestamp")
    names = ["like_count", "comment_count", "carousel_album_impressions", "story_impressions",
             "video_photo_impressions", "video_photo_views", "reel_views", "carousel_album_views", "reel_reach",
             "carousel_album_reach", "video_photo_reach"]

    def insight(i, load, **v):
        return (i, *[v.get(n) for n in names], TS(2026, 1, load))
    insights = frame([insight(1, 1, like_count=1), insight(1, 2, like_count=4, reel_views=8, reel_reach=20),
                      insight(3, 1, like_count=2, carousel_album_impressions=5, carousel_album_reach=6)],
                     "id bigint, " + ", ".join(f"{n} bigint" for n in names) + ", _fivetran_synced timestamp")
    clicks = ["website_clicks", "app_download_clicks", "email_clicks", "phone_number_clicks", "address_clicks"]
    videos = frame([(i, 1767312000, url, "cap", 1, 2, 3, 4, reach, 6, *c, 1.0, deleted)
                    for i, url, reach, c, deleted in (
                        (1, "https://t/@me/video/1", 100, (None,) * 5, None), (2, "https://t/v/2", None, (1, 2, 3, 4, 5), False),
                        (3, "https://t/@me/video/3", 1, (None,) * 5, True))],
                   "id bigint, create_time bigint, share_url string, caption string, likes bigint, comments bigint, "
                   "shares bigint, favorites bigint, reach bigint, video_views bigint, "
                   + ", ".join(f"{c} bigint" for c in clicks) + ", average_time_watched double, _fivetran_deleted boolean")
    return facebook, media, insights, videos


def test_social_posts(frame):
    got = social.social_posts(*social_sources(frame))
    assert same_layout(got, SOCIAL_POSTS) and len(got.columns) == 30
    rows = {(r.platform, r.page_id, r.post_id): r for r in got.collect()}
    assert len(rows) == 2 + 3 + 2
    fb = rows[("Facebook", "1", "x")]
    assert (fb.likes, fb.engagement_rate, fb.total_engagement, fb.date) == (3, None, 4, D(2026, 1, 1))
    reel = rows[("Instagram", "9", "1")]
    assert (reel.content, reel.content_type, reel.likes, reel.video_views, reel.reach) == ("new", "Video", 4, 8, 20)
    assert rows[("Instagram", "9", "3")].content_type == "Carousel" and rows[("Instagram", "9", "4")].content_type == "Unknown"
    assert rows[("Instagram", "9", "4")].likes is None and rows[("Instagram", "9", "4")].total_engagement == 0
    tt = rows[("TikTok", "me", "1")]
    assert (tt.account_name, tt.clicks, tt.total_engagement, tt.engagement_rate, tt.month_name) == ("me", 0, 10, 0.1, "January")
    assert rows[("TikTok", None, "2")].clicks == 15


def test_instagram_join_adds_no_exchange(frame):
    _, media, insights, _ = social_sources(frame)
    plan = social.instagram_posts(media, insights)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def all_items(frame, emails, forms):
    posts = social.social_posts(*social_sources(frame))
    site = web.web_breakdown(*web_reports(frame), as_of="2026-01-05")
    return cross_channel.cross_channel_items(
        cross_channel.social_items(posts), cross_channel.web_items(site, "https://s.example"),
        cross_channel.email_items(emails), cross_channel.form_items(forms))


def test_cross_channel_and_dashboard(frame, emails, forms):
    items = all_items(frame, emails, forms)
    assert same_layout(items, CROSS_CHANNEL) and len(items.columns) == 49
    rows = items.collect()
    one = {(r.channel, r.item_type, r.item_name): r for r in rows}
    page = one[("Website", "Page", "/0")]
    assert (page.item_url, page.engagement, page.clicks) == ("https://s.example/0", 0, 0)
    assert one[("Website", "Device", "mobile")].engagement_rate in (40.0, 100.0)
    assert one[("Website", "Device", "mobile")].item_url is None
    a = one[("Email", "Email", "a")]
    assert (a.engagement, a.clicks, a.revenue, a.contributions) == (4, 1, 0.0, 0.0)   # 7 × 0.5 rounds to 4
    assert ("Email", "Email", None) in one and ("Email", "Email", "b") not in one
    assert one[("Email", "Email", "c")].engagement == 0 and one[("Email", "Email", "c")].revenue == 9.0
    assert [r.item_name for r in rows if r.channel == "Forms"] == ["f"]
    assert {len(r.item_name) for r in rows if r.channel == "Facebook"} == {500}
    assert {r.reach_or_impressions for r in rows if r.channel == "Facebook"} == {0, 70}

    mapped = dashboard.dashboard_records(items, "2026-03-10")
    assert same_layout(mapped, DASHBOARD) and len(mapped.columns) == 29
    shown = {(r.channel, r.subchannel, r.content_name): r for r in mapped.collect()}
    form = shown[("Forms & Actions", "Forms", "f")]
    assert (form.new_followers_contacts, form.clicks, form.action_takers, form.days_ago, form.avg_contribution) == (
        3, None, None, 1, None)
    assert shown[("Website", "Page", "/0")].avg_engagement_seconds == 60.0
    assert shown[("Social Media", "TikTok", "cap")].clicks in (0, 15)
    assert shown[("Social Media", "TikTok", "cap")].new_followers_contacts is None


def test_syncs_end_to_end(spark, frame, emails, forms):
    from pyspark.sql import types as T
    from tidemark.registry.copies import sink_of
    items = all_items(frame, emails, forms)
    ids = [T.StructField("id", T.StringType()), T.StructField("seq", T.LongType())]
    empty = spark.createDataFrame([], T.StructType([*ids, *DASHBOARD.fields]))
    first = dashboard.sync_dashboard(items, empty, sink_of(empty), "2026-03-10", run_id="one")
    n = items.filter("date >= date'2025-09-11'").count()
    assert tuple(first.stats.first()) == (n, n, 0, 0, 0, 0)
    # numbered in fetch order, then a later window: aged-out records are pruned
    from pyspark.sql import Window
    target = first.snapshot.withColumn("seq", F.row_number().over(Window.orderBy("id")).cast("bigint"))
    later = dashboard.sync_dashboard(items, target, sink_of(empty), "2026-08-30", run_id="two")
    kept = items.filter("date >= date'2026-03-03'").count()
    stats = later.stats.first()
    assert stats.rows_read == kept and stats.created == 0 and stats.pruned > 0
    assert later.snapshot.filter("channel = 'Website'").count() == 0

    posts = social.social_posts(*social_sources(frame))
    texts = posts.withColumns({c: F.col(c).cast("string") for c in ("date", "post_created_at")})
    none = spark.createDataFrame([], T.StructType([*ids, *texts.schema.fields]))
    assert dashboard.sync_social(posts, none, sink_of(texts), "2026-01-31").stats.first().created == 7
    site = web.web_breakdown(*web_reports(frame), as_of="2026-01-05")
    replaced = dashboard.sync_web(site, site)
    assert replaced.stats.first().created == site.count()
    assert dict(replaced.snapshot.dtypes)["date"] == "string"


def test_null_items_need_a_date(frame, emails):
    assert rows_of(cross_channel.email_items(emails.filter("email_name = 'b'"))) == []

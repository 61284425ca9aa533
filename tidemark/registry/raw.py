"""Raw report tables derived from the whole benchmark tables, in Spark and in SQL.

Orders play the e-mail report, lineitem the form report, events the social
histories and the web reports.  Every function reads its table in full.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .base import cents, sql_cents, table

C = sql_cents("value")


def when_mod(col: str, n: int, rest: int, value):
    return F.when(F.col(col) % n == rest, value)


# --- e-mail and form reports ----------------------------------------------

EMAILS = f"""
SELECT CASE WHEN o_custkey % 40 <> 0 THEN 'Mail ' || o_custkey END AS email_name,
       o_orderdate AS _import_timestamp, 'Email_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS _source_filename,
       strftime(CAST(o_orderdate AS DATE) - 10, '%-m/%-d/%y') AS first_sent_date,
       CASE WHEN min(o_orderkey) % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS last_sent_date,
       CAST(count(*) * 1000 + min(o_orderkey) % 1000 AS DOUBLE) AS recipients,
       (min(o_orderkey) % 100) / 100.0::DOUBLE AS unique_open_rate,
       (max(o_orderkey) % 50) / 100.0::DOUBLE AS unique_click_rate,
       (count(*) % 10) / 100.0::DOUBLE AS bounce_rate, 0.0::DOUBLE AS unsubscribe_rate,
       CASE WHEN count(*) > 1 THEN CAST(count(*) AS DOUBLE) END AS total_contributions,
       CASE WHEN min(o_orderkey) % 3 <> 0 THEN CAST(sum({sql_cents('o_totalprice')}) AS BIGINT) / 100.0::DOUBLE END
         AS amount_raised,
       max({sql_cents('o_totalprice')}) / 100.0::DOUBLE AS avg_contribution_amount,
       (max(o_orderkey) % 7) / 100.0::DOUBLE AS conversion_rate,
       chr(max(ascii(o_orderpriority))) AS recipient_list, chr(min(ascii(o_orderstatus))) AS excluded_list
FROM orders GROUP BY CASE WHEN o_custkey % 40 <> 0 THEN 'Mail ' || o_custkey END, o_orderdate"""


def emails(spark, d):
    orders = table(spark, d, "orders").withColumn(
        "email_name", F.when(F.col("o_custkey") % 40 != 0,
                             F.concat(F.lit("Mail "), F.col("o_custkey").cast("string"))))
    day = F.col("o_orderdate").cast("date")
    first, last, n = F.min("o_orderkey"), F.max("o_orderkey"), F.count("*")
    return orders.groupBy("email_name", "o_orderdate").agg(
        F.when(first % 11 != 0, F.date_format(day, "yyyy-MM-dd")).alias("last_sent_date"),
        (n * 1000 + first % 1000).cast("double").alias("recipients"),
        (first % 100 / 100.0).alias("unique_open_rate"),
        (last % 50 / 100.0).alias("unique_click_rate"), (n % 10 / 100.0).alias("bounce_rate"),
        F.lit(0.0).alias("unsubscribe_rate"),
        F.when(n > 1, n.cast("double")).alias("total_contributions"),
        F.when(first % 3 != 0, F.sum(cents("o_totalprice")) / 100.0).alias("amount_raised"),
        (F.max(cents("o_totalprice")) / 100.0).alias("avg_contribution_amount"),
        (last % 7 / 100.0).alias("conversion_rate"),
        F.char(F.max(F.ascii("o_orderpriority"))).alias("recipient_list"),
        F.char(F.min(F.ascii("o_orderstatus"))).alias("excluded_list"),
    ).withColumns({
        "_import_timestamp": F.col("o_orderdate"),
        "_source_filename": F.concat(F.lit("Email_"), F.date_format(day, "yyyyMMdd"), F.lit(".csv")),
        "first_sent_date": F.date_format(F.date_sub(day, 10), "M/d/yy")}).drop("o_orderdate")


FORMS = f"""
SELECT 'Form ' || l_suppkey AS form_name, l_shipdate AS _import_timestamp,
       'Forms_' || strftime(l_shipdate, '%Y%m%d') || '.csv' AS _source_filename,
       strftime(CAST(l_shipdate AS DATE) - 3, '%m/%d/%Y') AS first_submission_date,
       CASE WHEN min(l_orderkey) % 13 <> 0 THEN strftime(l_shipdate, '%Y-%m-%d') END AS last_submission_date,
       CAST(count(*) AS DOUBLE) AS number_of_submissions,
       CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS DOUBLE) AS number_of_views,
       chr(max(ascii(l_returnflag))) AS form_type, chr(max(ascii(l_linestatus))) AS form_status,
       (min(l_orderkey) % 100) / 100.0::DOUBLE AS conversion_rate,
       CASE WHEN chr(max(ascii(l_returnflag))) <> 'N' THEN CAST(sum(l_linenumber) AS DOUBLE) END AS number_of_contributions,
       CASE WHEN chr(max(ascii(l_returnflag))) <> 'R' THEN CAST(sum({sql_cents('l_extendedprice')}) AS BIGINT) / 100.0::DOUBLE END
         AS total_contribution_amount,
       max({sql_cents('l_extendedprice')}) / 100.0::DOUBLE AS average_contribution_amount,
       CAST(count(*) % 3 AS DOUBLE) AS number_of_recurring_commitments,
       CAST(max(l_linenumber) AS DOUBLE) AS number_of_new_contacts
FROM lineitem GROUP BY l_suppkey, l_shipdate"""


def forms(spark, d):
    day = F.col("l_shipdate").cast("date")
    first, n = F.min("l_orderkey"), F.count("*")
    price = cents("l_extendedprice")
    # numbers, not strings, inside the aggregate keep it a hash aggregate
    flag = F.char(F.max(F.ascii("l_returnflag")))
    return table(spark, d, "lineitem").groupBy("l_suppkey", "l_shipdate").agg(
        F.when(first % 13 != 0, F.date_format(day, "yyyy-MM-dd")).alias("last_submission_date"),
        n.cast("double").alias("number_of_submissions"),
        F.sum(F.round("l_quantity").cast("bigint")).cast("double").alias("number_of_views"),
        flag.alias("form_type"), F.char(F.max(F.ascii("l_linestatus"))).alias("form_status"),
        (first % 100 / 100.0).alias("conversion_rate"),
        F.when(flag != "N", F.sum("l_linenumber").cast("double"))
        .alias("number_of_contributions"),
        F.when(flag != "R", F.sum(price) / 100.0)
        .alias("total_contribution_amount"),
        (F.max(price) / 100.0).alias("average_contribution_amount"),
        (n % 3).cast("double").alias("number_of_recurring_commitments"),
        F.max("l_linenumber").cast("double").alias("number_of_new_contacts"),
    ).withColumns({
        "form_name": F.concat(F.lit("Form "), F.col("l_suppkey").cast("string")),
        "_import_timestamp": F.col("l_shipdate"),
        "_source_filename": F.concat(F.lit("Forms_"), F.date_format(day, "yyyyMMdd"), F.lit(".csv")),
        "first_submission_date": F.date_format(F.date_sub(day, 3), "MM/dd/yyyy"),
    }).drop("l_suppkey", "l_shipdate")


# --- social histories -----------------------------------------------------

FACEBOOK = f"""
SELECT CAST(ts AS DATE) AS date_day, DATE '2024-01-01' + CAST(user_id % 28 AS INTEGER) AS created_timestamp,
       'Page ' || event_type AS page_name, CASE WHEN event_type = 'view' THEN 1 ELSE 2 END AS page_id,
       CAST(user_id AS VARCHAR) AS post_id, repeat('añb ', CAST(100 + user_id % 50 AS INTEGER)) AS post_message,
       'https://fb.example/' || user_id AS post_url, count(*) AS likes,
       CAST(sum({C}) AS BIGINT) % 1000 AS clicks,
       CASE user_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE CAST(sum({C}) AS BIGINT) END AS impressions,
       count(*) * 10 AS media_views, count(*) * 3 AS video_views,
       max({C}) / 100.0::DOUBLE AS video_avg_time_watched, count(*) % 2 = 0 AS is_most_recent_record,
       'fb' AS source_relation
FROM events WHERE event_type IN ('view', 'click') GROUP BY event_type, user_id, CAST(ts AS DATE)"""


def _events(spark, d):
    return table(spark, d, "events").withColumns({
        "day": F.col("ts").cast("date"), "c": cents("value")})


def facebook(spark, d):
    n, total = F.count("*"), F.sum("c")
    text = F.col("user_id").cast("string")
    return (_events(spark, d).filter(F.col("event_type").isin("view", "click"))
            .groupBy("event_type", "user_id", "day").agg(
        n.alias("likes"), (total % 1000).alias("clicks"),
        F.when(F.col("user_id") % 3 == 1, 0).when(F.col("user_id") % 3 == 2, total)
        .alias("impressions"),
        (n * 10).alias("media_views"), (n * 3).alias("video_views"),
        (F.max("c") / 100.0).alias("video_avg_time_watched"),
        (n % 2 == 0).alias("is_most_recent_record"))
        .withColumns({
            "date_day": F.col("day"),
            "created_timestamp": F.date_add(F.lit("2024-01-01").cast("date"),
                                            (F.col("user_id") % 28).cast("int")),
            "page_name": F.concat(F.lit("Page "), "event_type"),
            "page_id": F.when(F.col("event_type") == "view", 1).otherwise(2), "post_id": text,
            "post_message": F.repeat(F.lit("añb "), (F.col("user_id") % 50 + 100).cast("int")),
            "post_url": F.concat(F.lit("https://fb.example/"), text),
            "source_relation": F.lit("fb")}).drop("day", "event_type", "user_id"))


MEDIA = """
SELECT user_id AS id, min(ts) AS created_time,
       CASE user_id % 4 WHEN 0 THEN 'REELS' WHEN 1 THEN 'STORY' WHEN 3 THEN 'FEED' END AS media_product_type,
       CASE count(*) % 4 WHEN 0 THEN 'VIDEO' WHEN 1 THEN 'CAROUSEL_ALBUM' WHEN 2 THEN 'IMAGE' ELSE 'OTHER' END
         AS media_type,
       'user' || user_id % 10 AS username, user_id, 'caption ' || count(*) AS caption,
       'https://ig.example/p/' || user_id AS permalink, CAST(ts AS DATE) AS _fivetran_synced
FROM events WHERE event_type = 'purchase' GROUP BY user_id, CAST(ts AS DATE)"""


def media(spark, d):
    n, text = F.count("*"), F.col("user_id").cast("string")
    return (_events(spark, d).filter(F.col("event_type") == "purchase").groupBy("user_id", "day").agg(
        F.min("ts").alias("created_time"),
        F.when(n % 4 == 0, "VIDEO").when(n % 4 == 1, "CAROUSEL_ALBUM").when(n % 4 == 2, "IMAGE")
        .otherwise("OTHER").alias("media_type"),
        F.concat(F.lit("caption "), n.cast("string")).alias("caption"))
        .withColumns({
            "id": F.col("user_id"), "_fivetran_synced": F.col("day"),
            "media_product_type": when_mod("user_id", 4, 0, "REELS").when(
                F.col("user_id") % 4 == 1, "STORY").when(F.col("user_id") % 4 == 3, "FEED"),
            "username": F.concat(F.lit("user"), (F.col("user_id") % 10).cast("string")),
            "permalink": F.concat(F.lit("https://ig.example/p/"), text)}).drop("day"))


INSIGHTS = f"""
SELECT user_id AS id, count(*) AS like_count, CAST(sum({C}) AS BIGINT) % 100 AS comment_count,
       CASE WHEN user_id % 3 = 0 THEN CAST(sum({C}) AS BIGINT) END AS carousel_album_impressions,
       CASE WHEN user_id % 3 = 1 THEN count(*) END AS story_impressions,
       CASE WHEN user_id % 2 = 0 THEN max({C}) END AS video_photo_impressions,
       CASE WHEN user_id % 5 = 0 THEN count(*) * 2 END AS video_photo_views,
       CASE WHEN user_id % 5 = 1 THEN count(*) * 3 END AS reel_views,
       CASE WHEN user_id % 5 = 2 THEN count(*) * 4 END AS carousel_album_views,
       CASE WHEN user_id % 4 = 0 THEN min({C}) END AS reel_reach,
       CASE WHEN user_id % 4 = 2 THEN max({C}) END AS carousel_album_reach,
       CASE WHEN user_id % 7 = 0 THEN count(*) END AS video_photo_reach,
       CAST(ts AS DATE) AS _fivetran_synced
FROM events WHERE event_type = 'signup' GROUP BY user_id, CAST(ts AS DATE)"""


def insights(spark, d):
    n, total = F.count("*"), F.sum("c")
    return (_events(spark, d).filter(F.col("event_type") == "signup").groupBy("user_id", "day").agg(
        n.alias("like_count"), (total % 100).alias("comment_count"),
        when_mod("user_id", 3, 0, total).alias("carousel_album_impressions"),
        when_mod("user_id", 3, 1, n).alias("story_impressions"),
        when_mod("user_id", 2, 0, F.max("c")).alias("video_photo_impressions"),
        when_mod("user_id", 5, 0, n * 2).alias("video_photo_views"),
        when_mod("user_id", 5, 1, n * 3).alias("reel_views"),
        when_mod("user_id", 5, 2, n * 4).alias("carousel_album_views"),
        when_mod("user_id", 4, 0, F.min("c")).alias("reel_reach"),
        when_mod("user_id", 4, 2, F.max("c")).alias("carousel_album_reach"),
        when_mod("user_id", 7, 0, n).alias("video_photo_reach"))
        .withColumnsRenamed({"user_id": "id", "day": "_fivetran_synced"}))


VIDEOS = f"""
SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS create_time,
       CASE WHEN user_id % 5 = 0 THEN 'https://tt.example/v/' || event_id
            ELSE 'https://tt.example/@user' || user_id || '/video/' || event_id END AS share_url,
       props AS caption, {C} % 100 AS likes, {C} % 10 AS comments, {C} % 3 AS shares, {C} % 4 AS favorites,
       CASE WHEN user_id % 6 <> 0 THEN {C} % 500 END AS reach, {C} AS video_views,
       CASE WHEN user_id % 2 = 0 THEN {C} % 7 END AS website_clicks,
       CASE WHEN user_id % 3 = 0 THEN {C} % 5 END AS email_clicks, NULL::BIGINT AS app_download_clicks,
       NULL::BIGINT AS phone_number_clicks, NULL::BIGINT AS address_clicks,
       value AS average_time_watched,
       CASE WHEN value > 45 THEN true WHEN value < 10 THEN NULL ELSE false END AS _fivetran_deleted
FROM events WHERE event_type = 'error'"""


def videos(spark, d):
    c, user, event = F.col("c"), F.col("user_id").cast("string"), F.col("event_id").cast("string")
    none = F.lit(None).cast("bigint")
    return _events(spark, d).filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("id"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("create_time"),
        when_mod("user_id", 5, 0, F.concat(F.lit("https://tt.example/v/"), event)).otherwise(
            F.concat(F.lit("https://tt.example/@user"), user, F.lit("/video/"), event))
        .alias("share_url"),
        F.col("props").alias("caption"), (c % 100).alias("likes"), (c % 10).alias("comments"),
        (c % 3).alias("shares"), (c % 4).alias("favorites"),
        F.when(F.col("user_id") % 6 != 0, c % 500).alias("reach"), c.alias("video_views"),
        when_mod("user_id", 2, 0, c % 7).alias("website_clicks"),
        when_mod("user_id", 3, 0, c % 5).alias("email_clicks"), none.alias("app_download_clicks"),
        none.alias("phone_number_clicks"), none.alias("address_clicks"),
        F.col("value").alias("average_time_watched"),
        F.when(F.col("value") > 45, True).when(F.col("value") < 10, F.lit(None)).otherwise(False)
        .alias("_fivetran_deleted"))


# --- web reports ----------------------------------------------------------

_RATED = f"""count(DISTINCT user_id) AS total_users, count(*) AS new_users,
       count(*) FILTER (value > 10) AS engaged_sessions,
       CAST(sum({C}) AS BIGINT) / 100.0::DOUBLE AS key_events"""
_RATE = "CAST(count(*) FILTER (value > 10) AS DOUBLE) / CAST(count(*) AS DOUBLE)"

DEVICE = f"""
SELECT CAST(ts AS DATE) AS date, event_type AS device_category, {_RATED},
       CASE WHEN event_type = 'error' THEN 0.0 ELSE {_RATE} END AS engagement_rate
FROM events GROUP BY CAST(ts AS DATE), event_type"""

CITY = f"""
SELECT CAST(ts AS DATE) AS date,
       CASE WHEN user_id % 50 = 0 THEN NULL WHEN user_id = 5 THEN '(other)' ELSE 'City ' || user_id END AS city,
       {_RATED}, {_RATE} AS engagement_rate
FROM events GROUP BY CAST(ts AS DATE), user_id"""

PAGE = f"""
SELECT CAST(ts AS DATE) AS date, '/' || json_extract_string(props, '$.k') AS page_path,
       count(DISTINCT user_id) AS total_users, count(*) AS new_users, CAST(sum({C}) AS BIGINT) / 100.0::DOUBLE AS key_events,
       CAST(max({C}) AS DOUBLE) AS user_engagement_duration
FROM events GROUP BY 1, 2"""

CAMPAIGN = f"""
SELECT CAST(ts AS DATE) AS date, event_type || ' ' || hour(ts) AS session_campaign_name,
       count(DISTINCT user_id) AS total_users, count(*) FILTER (value > 10) AS engaged_sessions,
       count(*) AS sessions, CAST(sum({C}) AS BIGINT) / 100.0::DOUBLE AS key_events,
       CAST(max({C}) AS DOUBLE) AS user_engagement_duration
FROM events GROUP BY 1, 2"""

SITE = f"""
SELECT CAST(ts AS DATE) AS date,
       CASE WHEN day(ts) % 3 <> 0 THEN count(DISTINCT user_id) END AS active_users,
       count(DISTINCT user_id) + 1 AS total_users, count(*) AS new_users, count(*) AS sessions,
       {_RATE} AS engagement_rate, CAST(max({C}) AS DOUBLE) AS user_engagement_duration
FROM events GROUP BY CAST(ts AS DATE), day(ts)"""


def _rate():
    return F.count_if(F.col("value") > 10).cast("double") / F.count("*").cast("double")


def _rated():
    return [F.count_distinct("user_id").alias("total_users"), F.count("*").alias("new_users"),
            F.count_if(F.col("value") > 10).alias("engaged_sessions"),
            (F.sum("c") / 100.0).alias("key_events")]


def device(spark, d):
    return _events(spark, d).groupBy(F.col("day").alias("date"),
                                     F.col("event_type").alias("device_category")).agg(
        *_rated(), F.when(F.col("event_type") == "error", 0.0).otherwise(_rate())
        .alias("engagement_rate"))


def city(spark, d):
    name = (when_mod("user_id", 50, 0, F.lit(None)).when(F.col("user_id") == 5, "(other)")
            .otherwise(F.concat(F.lit("City "), F.col("user_id").cast("string"))))
    # one row per user and day: the distinct count of users is one
    return _events(spark, d).groupBy(F.col("day").alias("date"), "user_id").agg(
        F.lit(1).cast("bigint").alias("total_users"), *_rated()[1:],
        _rate().alias("engagement_rate")).withColumn("city", name).drop("user_id")


def page(spark, d):
    path = F.concat(F.lit("/"), F.get_json_object("props", "$.k"))
    return _events(spark, d).groupBy(F.col("day").alias("date"), path.alias("page_path")).agg(
        F.count_distinct("user_id").alias("total_users"), F.count("*").alias("new_users"),
        (F.sum("c") / 100.0).alias("key_events"),
        F.max("c").cast("double").alias("user_engagement_duration"))


def campaign(spark, d):
    name = F.concat("event_type", F.lit(" "), F.hour("ts").cast("string"))
    return _events(spark, d).groupBy(F.col("day").alias("date"), name.alias("session_campaign_name")).agg(
        F.count_distinct("user_id").alias("total_users"),
        F.count_if(F.col("value") > 10).alias("engaged_sessions"), F.count("*").alias("sessions"),
        (F.sum("c") / 100.0).alias("key_events"),
        F.max("c").cast("double").alias("user_engagement_duration"))


def site(spark, d):
    users = F.count_distinct("user_id")
    return _events(spark, d).groupBy(F.col("day").alias("date")).agg(
        F.when(F.dayofmonth("day") % 3 != 0, users).alias("active_users"),
        (users + 1).alias("total_users"), F.count("*").alias("new_users"),
        F.count("*").alias("sessions"), _rate().alias("engagement_rate"),
        F.max("c").cast("double").alias("user_engagement_duration"))

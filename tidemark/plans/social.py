"""Social posts of three platforms in one table, one row per post."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import null_as_zero_sum, round_to_long, safe_ratio
from ..functions.text import extract_or_null
from ..operators.latest import latest_per_key
from ..operators.shape import aligned_union, align, differs_from, not_deleted
from ..schemas import SOCIAL_POSTS

# Fixed value: account name in a video address.
VIDEO_ACCOUNT = r"@([^/]+)/video"


def instagram_posts(media: DataFrame, insights: DataFrame) -> DataFrame:
    """Newest version of each post with its newest insights; stories are left out.

    Both sides are reduced before the join, else versions would multiply, and
    both are then partitioned by id, so the join adds no exchange.
    """
    posts = latest_per_key(media.filter(differs_from(F.col("media_product_type"), "STORY")),
                           ["id"], ["_fivetran_synced"])
    figures = latest_per_key(insights, ["id"], ["_fivetran_synced"])
    m, i = posts.alias("m"), figures.alias("i")
    kind = F.when(F.col("m.media_product_type") == "REELS", "REEL").otherwise(F.col("m.media_type"))
    return m.join(i, F.col("m.id") == F.col("i.id"), "left").select(
        F.col("m.created_time").alias("created_timestamp"), kind.alias("media_type"),
        F.col("m.username").alias("account_name"), "m.user_id", F.col("m.id").alias("post_id"),
        F.col("m.caption").alias("post_caption"), F.col("m.permalink").alias("post_url"),
        "i.like_count", "i.comment_count", "i.carousel_album_impressions", "i.story_impressions",
        "i.video_photo_impressions", "i.video_photo_views", "i.reel_views",
        F.col("i.carousel_album_views").alias("carousel_album_video_views"),
        F.coalesce("i.reel_reach", "i.carousel_album_reach", "i.video_photo_reach").alias("reach"),
        F.lit(None).cast("string").alias("source_relation"))


def _facebook(report: DataFrame) -> DataFrame:
    newest = latest_per_key(report, ["page_id", "post_id"], ["date_day"])
    created = F.col("created_timestamp").cast("date")
    return newest.select(
        created.alias("date"), F.lit("Facebook").alias("platform"),
        F.lit("Post").alias("content_type"), F.col("page_name").alias("account_name"),
        "page_id", "post_id", F.col("post_message").alias("content"), "post_url",
        created.alias("post_created_at"), "likes", "clicks", "impressions", "media_views",
        "video_views", F.col("video_avg_time_watched").alias("avg_watch_time_seconds"),
        "is_most_recent_record", "source_relation")


def _instagram(posts: DataFrame) -> DataFrame:
    created = F.col("created_timestamp").cast("date")
    kind = (F.when(F.col("media_type").isin("VIDEO", "REEL"), "Video")
            .when(F.col("media_type") == "CAROUSEL_ALBUM", "Carousel")
            .when(F.col("media_type") == "IMAGE", "Image").otherwise("Unknown"))
    return posts.select(
        created.alias("date"), F.lit("Instagram").alias("platform"), kind.alias("content_type"),
        "account_name", F.col("user_id").alias("page_id"), "post_id",
        F.col("post_caption").alias("content"), "post_url", created.alias("post_created_at"),
        F.col("like_count").alias("likes"), F.col("comment_count").alias("comments"),
        F.coalesce("carousel_album_impressions", "story_impressions",
                   "video_photo_impressions").alias("impressions"), "reach",
        F.coalesce("video_photo_views", "reel_views",
                   "carousel_album_video_views").alias("video_views"), "source_relation")


def _tiktok(videos: DataFrame) -> DataFrame:
    created = F.timestamp_seconds("create_time").cast("date")
    account = extract_or_null(F.col("share_url"), VIDEO_ACCOUNT)
    clicks = null_as_zero_sum(*[F.col(c) for c in (
        "website_clicks", "app_download_clicks", "email_clicks", "phone_number_clicks",
        "address_clicks")])
    return videos.filter(not_deleted(F.col("_fivetran_deleted"))).select(
        created.alias("date"), F.lit("TikTok").alias("platform"),
        F.lit("Video").alias("content_type"), account.alias("account_name"),
        account.alias("page_id"), F.col("id").alias("post_id"),
        F.col("caption").alias("content"), F.col("share_url").alias("post_url"),
        created.alias("post_created_at"), "likes", clicks.alias("clicks"), "comments", "shares",
        F.col("favorites").alias("saves"), F.col("reach").alias("impressions"), "video_views",
        F.col("average_time_watched").alias("avg_watch_time_seconds"))


def enriched_posts(posts: DataFrame) -> DataFrame:
    """Date parts, total engagement and engagement rate."""
    total = null_as_zero_sum(*[F.col(c) for c in ("likes", "comments", "shares", "clicks", "saves")])
    whole = posts.withColumns({
        "year": F.year("date").cast("bigint"), "month": F.month("date").cast("bigint"),
        "month_name": F.date_format("date", "MMMM"), "total_engagement": total})
    return whole.withColumn("engagement_rate",
                            safe_ratio(F.col("total_engagement"), F.col("impressions")))


def _whole_counts(df: DataFrame) -> DataFrame:
    """Counts that arrive as doubles are rounded, never truncated."""
    target = {f.name: f.dataType.simpleString() for f in SOCIAL_POSTS.fields}
    doubles = [f.name for f in df.schema.fields
               if f.dataType.simpleString() in ("double", "float")
               and target.get(f.name) == "bigint"]
    return df.withColumns({c: round_to_long(F.col(c)) for c in doubles}) if doubles else df


def social_posts(facebook: DataFrame, media: DataFrame, insights: DataFrame,
                 videos: DataFrame) -> DataFrame:
    """One row per post on any platform, 30 columns."""
    branches = [_facebook(facebook), _instagram(instagram_posts(media, insights)), _tiktok(videos)]
    union = aligned_union([_whole_counts(b) for b in branches], SOCIAL_POSTS)
    return align(enriched_posts(union), SOCIAL_POSTS)

"""Organic post feeds to `cdm_organic_daily`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediatide.functions.dates import unix_day
from mediatide.functions.numbers import ratio, round_exact
from mediatide.operators.fields import Feed, RunStamp
from mediatide.schemas import CDM_ORGANIC

# Sources, and how a missing reach is estimated from plays or from the score.
INSTAGRAM_SOURCE = "instagram_graph_api_v19"
TIKTOK_SOURCE = "tiktok_display_api_v2"
REDDIT_SOURCE = "reddit_api_v1"
TIKTOK_REACH_PER_PLAY = 0.72
REDDIT_REACH_PER_POINT = 4



def _finish(
    rows: DataFrame,
    platform: str,
    source: str,
    interactions: tuple[str, ...],
    per: str,
    stamp: RunStamp | None,
) -> DataFrame:
    """Adds what all platforms share.  `per` is the denominator of the blended rate."""
    total = reduce(lambda a, b: a + b, (F.col(c) for c in interactions))
    rows = rows.withColumn("engagements", total)
    rate = F.when(F.col(per) > 0, round_exact(ratio(F.col("engagements"), F.col(per)), 5))
    rows = rows.withColumns(
        {
            "platform": F.lit(platform),
            "channel_type": F.lit("organic"),
            "blended_engagement_rate": F.coalesce(rate, F.lit(0.0)),
            "raw_source": F.lit(source),
        }
    )
    return rows.select("*", *(stamp or RunStamp()).columns())


def instagram_posts(raw: DataFrame, stamp: RunStamp | None = None) -> DataFrame:
    """Watch time arrives in milliseconds and leaves in seconds; no completion or native rate."""
    f = Feed(raw)
    rows = raw.select(
        f.day("timestamp").alias("date"),
        f.text("media_id", "id").alias("post_id"),
        f.text("media_type").alias("content_type"),
        f.text("topic").alias("topic"),
        f.flag("is_viral").alias("is_viral"),
        f.long("reach").alias("reach"),
        f.long("impressions").alias("impressions"),
        f.long("like_count").alias("likes"),
        f.long("comments_count").alias("comments"),
        f.long("shares").alias("shares"),
        f.long("saved").alias("saves"),
        f.long("video_views").alias("video_views"),
        f.long("follows").alias("follower_delta"),
        f.long("website_clicks").alias("outbound_clicks"),
        f.long("profile_visits").alias("profile_visits"),
        round_exact(f.double("avg_watch_time_ms") / 1000, 1).alias("avg_watch_time_s"),
    )
    return _finish(
        rows, "instagram", INSTAGRAM_SOURCE, ("likes", "comments", "shares", "saves"), "reach", stamp
    )


def tiktok_posts(raw: DataFrame, stamp: RunStamp | None = None) -> DataFrame:
    """Plays stand for views and impressions and are the denominator of the blended rate."""
    f = Feed(raw)
    plays = raw.select("*", f.long("play_count", "view_count").alias("_plays"))
    estimated = (F.col("_plays") * TIKTOK_REACH_PER_PLAY).cast("bigint")
    rows = plays.select(
        unix_day(f.unix_seconds("create_time")).alias("date"),
        f.text("id", "video_id").alias("post_id"),
        f.text("content_type", default="Standard Video").alias("content_type"),
        f.text("topic").alias("topic"),
        f.flag("is_viral").alias("is_viral"),
        f.long("reach", default=estimated).alias("reach"),
        F.col("_plays").alias("impressions"),
        F.col("_plays").alias("video_views"),
        f.long("like_count").alias("likes"),
        f.long("comment_count").alias("comments"),
        f.long("share_count").alias("shares"),
        f.long("collect_count").alias("saves"),
        f.double("average_time_watched").alias("avg_watch_time_s"),
        f.double("full_video_watched_rate").alias("video_completion_rate"),
        f.double("engagement_rate").alias("platform_engagement_rate"),
        f.long("fans_delta").alias("follower_delta"),
        F.lit(0).cast("bigint").alias("outbound_clicks"),
        f.long("profile_visits").alias("profile_visits"),
    )
    return _finish(
        rows, "tiktok", TIKTOK_SOURCE, ("likes", "comments", "shares", "saves"), "video_views", stamp
    )


def reddit_posts(raw: DataFrame, stamp: RunStamp | None = None) -> DataFrame:
    """Likes are the net score and may be negative; awards are saves but no engagement."""
    f = Feed(raw)
    estimated = F.greatest(f.long("score") * REDDIT_REACH_PER_POINT, F.lit(1).cast("bigint"))
    scored = raw.select("*", f.long("unique_views", default=estimated).alias("_reach"))
    rows = scored.select(
        unix_day(f.unix_seconds("created_utc")).alias("date"),
        f.text("post_id", "id").alias("post_id"),
        f.text("post_type", default="Post").alias("content_type"),
        f.text("topic").alias("topic"),
        f.flag("is_viral").alias("is_viral"),
        F.col("_reach").alias("reach"),
        F.col("_reach").alias("impressions"),
        f.long("score").alias("likes"),
        f.long("num_comments").alias("comments"),
        f.long("num_shares").alias("shares"),
        f.long("awards_count").alias("saves"),
        f.long("video_views").alias("video_views"),
        f.long("subscriber_delta").alias("follower_delta"),
        f.long("outbound_clicks").alias("outbound_clicks"),
        F.lit(0).cast("bigint").alias("profile_visits"),
        f.double("upvote_ratio").alias("platform_engagement_rate"),
    )
    return _finish(rows, "reddit", REDDIT_SOURCE, ("likes", "comments", "shares"), "reach", stamp)


def combine_posts(frames: list[DataFrame]) -> DataFrame:
    """All platforms in the CDM's column order; a column a platform lacks is NULL."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    kinds = {f.name: f.dataType for f in CDM_ORGANIC.fields}

    def column(name: str) -> Column:
        present = F.col(name) if name in union.columns else F.lit(None)
        return present.cast(kinds[name]).alias(name)

    return union.select(*(column(name) for name in CDM_ORGANIC.names))


def sorted_posts(cdm: DataFrame) -> DataFrame:
    return cdm.orderBy("date", "platform")


def mixed_posts(raw: DataFrame) -> DataFrame:
    """The older single feed of all platforms, which keeps the source's own engagement rate."""
    f = Feed(raw)
    rows = raw.select(
        f.day("published_date").alias("date"),
        f.text("platform").alias("platform"),
        F.lit("organic").alias("channel_type"),
        f.text("post_id").alias("post_id"),
        f.text("content_type").alias("content_type"),
        f.text("topic").alias("topic"),
        f.flag("is_viral").alias("is_viral"),
        f.long("reach").alias("reach"),
        f.long("impressions").alias("impressions"),
        f.double("engagement_rate").alias("engagement_rate"),
        f.long("likes").alias("likes"),
        f.long("comments").alias("comments"),
        f.long("shares").alias("shares"),
        f.long("saves").alias("saves"),
        f.long("video_views", "total_play").alias("video_views"),
        f.double("avg_watch_time_s").alias("avg_watch_time_s"),
        f.double("completion_rate").alias("video_completion_rate"),
        f.long("profile_visits").alias("profile_visits"),
        f.long("follower_delta", "fans_delta", "subscriber_delta").alias("follower_delta"),
        f.long("outbound_clicks").alias("outbound_clicks"),
        F.concat(f.text("platform"), F.lit("_organic_api")).alias("raw_source"),
    )
    engagements = F.col("likes") + F.col("comments") + F.col("shares") + F.col("saves")
    return rows.withColumn("engagements", engagements)

"""Staging models over the CDM tables, and the older set of the same models.

Filters test the stored columns as they are, so they reach the Parquet scan.
The names and the order of each model's columns are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediatide.functions.metrics import cost_per_mille
from mediatide.functions.numbers import ratio, round_half_up, trimmed
from mediatide.functions.text import lower_trimmed, null_if_blank, upper_trimmed


def _long(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)


def _money(name: str) -> Column:
    return round_half_up(F.coalesce(F.col(name), F.lit(0)).cast("double"), 2).alias(name)


def _flag(name: str, default: bool = False) -> Column:
    return F.coalesce(F.col(name).cast("boolean"), F.lit(default)).alias(name)


def _trim(name: str) -> Column:
    return trimmed(F.col(name)).alias(name)


def _blank_to_null(name: str) -> Column:
    return null_if_blank(F.col(name)).alias(name)


def stg_paid_media(cdm: DataFrame) -> DataFrame:
    """Cleaned ads; the ratios come from the stored totals and are NULL where undefined."""
    c = F.col
    cost = F.coalesce(c("cost_usd"), F.lit(0)).cast("double")
    value = F.coalesce(c("conversion_value_usd"), F.lit(0)).cast("double")
    kept = cdm.where(c("date").isNotNull() & (c("cost_usd").isNull() | (c("cost_usd") >= 0)))
    return kept.select(
        c("date").cast("date").alias("date"),
        lower_trimmed(c("platform")).alias("platform"),
        "channel_type",
        _blank_to_null("campaign_id"),
        _blank_to_null("campaign_name"),
        lower_trimmed(c("objective")).alias("objective"),
        _blank_to_null("ad_group_id"),
        _blank_to_null("ad_group_name"),
        _blank_to_null("ad_id"),
        _blank_to_null("ad_name"),
        upper_trimmed(c("country")).alias("country"),
        _long("impressions"),
        _long("clicks"),
        _money("cost_usd"),
        _long("installs"),
        _long("conversions"),
        _money("conversion_value_usd"),
        _long("video_views"),
        _long("video_completions"),
        _long("engagements"),
        _long("likes"),
        _long("comments"),
        _long("shares"),
        cost_per_mille(cost, c("impressions")).alias("cpm"),
        ratio(cost, c("clicks")).alias("cpc"),
        ratio(c("clicks"), c("impressions")).alias("ctr"),
        ratio(cost, c("installs")).alias("cpi"),
        ratio(cost, c("conversions")).alias("cps"),
        ratio(value, cost).alias("roas"),
        "attribution_window",
        "raw_source",
        "_extracted_at",
        "_pipeline_version",
    )


def stg_installs(cdm: DataFrame) -> DataFrame:
    """Primary attributions only.  The filter sees the stored flag, so a NULL flag is dropped."""
    c = F.col
    kept = cdm.where(c("is_primary_attribution") & c("install_date").isNotNull())
    return kept.select(
        c("install_date").cast("date").alias("install_date"),
        _trim("appsflyer_id"),
        _blank_to_null("customer_user_id"),
        lower_trimmed(c("media_source")).alias("media_source"),
        _trim("channel"),
        _blank_to_null("campaign_id"),
        lower_trimmed(c("platform")).alias("platform"),
        upper_trimmed(c("country")).alias("country"),
        _trim("device_type"),
        _trim("att_status"),
        _flag("is_retargeting"),
        _flag("is_primary_attribution", default=True),
        _flag("is_skan"),
        _flag("registered"),
        _flag("first_activity"),
        _flag("paywall_viewed"),
        _flag("trial_started"),
        _flag("subscribed"),
        _blank_to_null("subscription_type"),
        _money("subscription_value_usd"),
        c("days_to_subscribe").cast("bigint").alias("days_to_subscribe"),
        "raw_source",
        "_extracted_at",
    )


def stg_organic(cdm: DataFrame) -> DataFrame:
    """Cleaned posts; the blended rate is recomputed over reach for every platform."""
    c = F.col
    zero = F.lit(0)
    interactions = (
        F.coalesce(c("likes"), zero) + F.coalesce(c("comments"), zero)
        + F.coalesce(c("shares"), zero) + F.coalesce(c("saves"), zero)
    )
    kept = cdm.where(c("date").isNotNull() & (c("reach").isNull() | (c("reach") >= 0)))
    return kept.select(
        c("date").cast("date").alias("date"),
        lower_trimmed(c("platform")).alias("platform"),
        "channel_type",
        _trim("post_id"),
        _trim("content_type"),
        _trim("topic"),
        _flag("is_viral"),
        _long("reach"),
        _long("impressions"),
        _long("likes"),
        _long("comments"),
        _long("shares"),
        _long("saves"),
        _long("engagements"),
        _long("video_views"),
        c("avg_watch_time_s").cast("double").alias("avg_watch_time_s"),
        c("video_completion_rate").cast("double").alias("video_completion_rate"),
        _long("follower_delta"),
        _long("outbound_clicks"),
        ratio(interactions.cast("double"), c("reach")).alias("blended_engagement_rate"),
        "platform_engagement_rate",
        "raw_source",
        "_extracted_at",
    )


# --- the older set ------------------------------------------------------------------------


def _as_day(cdm: DataFrame, name: str) -> Column:
    """A stored day stays as it is, so that filters on it reach the partitions."""
    if isinstance(cdm.schema[name].dataType, T.DateType):
        return F.col(name)
    return F.to_date(F.col(name).cast("string"), "yyyy-MM-dd").alias(name)


def _casts(kind: str, *names: str) -> list[Column]:
    return [F.col(n).cast(kind).alias(n) for n in names]


def _rounded(name: str, digits: int) -> Column:
    return round_half_up(F.col(name).cast("double"), digits).alias(name)


def stg_paid_media_old(cdm: DataFrame) -> DataFrame:
    """Casts only; rows without spend are dropped."""
    return cdm.where(F.col("date").isNotNull() & (F.col("cost_usd") > 0)).select(
        _as_day(cdm, "date"), "platform", "channel_type", "campaign_id", "campaign_name", "objective",
        "ad_group_id", "ad_group_name", "ad_id", "ad_name", "country",
        *_casts("bigint", "impressions", "clicks"),
        _rounded("cost_usd", 2),
        *_casts("bigint", "installs", "conversions"),
        _rounded("conversion_value_usd", 2),
        *_casts("bigint", "video_views", "video_completions", "engagements"),
        "attribution_window", "raw_source",
    )


def stg_organic_old(cdm: DataFrame) -> DataFrame:
    """Keeps the source's engagement rate, so it reads the older organic table."""
    return cdm.select(
        _as_day(cdm, "date"), "platform", "channel_type", "post_id", "content_type", "topic",
        *_casts("boolean", "is_viral"),
        *_casts("bigint", "reach", "impressions"),
        _rounded("engagement_rate", 5),
        *_casts("bigint", "likes", "comments", "shares", "saves", "video_views"),
        *_casts("double", "avg_watch_time_s", "video_completion_rate"),
        *_casts("bigint", "engagements", "follower_delta"),
        "raw_source",
    )


def stg_installs_old(cdm: DataFrame) -> DataFrame:
    """Casts only; no attribution filter."""
    return cdm.select(
        _as_day(cdm, "install_date"), "appsflyer_id", "customer_user_id", "media_source", "channel",
        "campaign_id", "platform", "country", "device_type",
        *_casts("boolean", "is_retargeting"),
        "att_status",
        *_casts("boolean", "registered", "first_activity", "paywall_viewed", "trial_started", "subscribed"),
        "subscription_type",
        _rounded("subscription_value_usd", 2),
        *_casts("bigint", "days_to_subscribe"),
    )

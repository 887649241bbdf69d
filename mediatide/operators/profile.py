"""Small summaries that a run shows after loading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediatide.functions.numbers import money_sum, round_frame


def _share(flag: str) -> Column:
    return F.avg(F.col(flag).cast("int"))


def channel_preview(cdm_installs: DataFrame) -> DataFrame:
    return cdm_installs.groupBy("channel").agg(
        F.count("appsflyer_id").alias("installs"),
        F.count_if("subscribed").alias("subscribed"),
        round_frame(money_sum(F.col("subscription_value_usd")), 3).alias("revenue_usd"),
        round_frame(_share("subscribed"), 3).alias("overall_cvr"),
    )


def group_sizes(df: DataFrame, *keys: str, name: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def skan_share(cdm_installs: DataFrame) -> DataFrame:
    return cdm_installs.agg(
        F.count_if("is_skan").alias("skan_installs"), _share("is_skan").alias("skan_pct")
    )


def status_rollup(cohorts: DataFrame) -> DataFrame:
    return cohorts.groupBy("funnel_status").agg(
        F.count("installs").alias("rows"),
        F.sum("installs").alias("installs"),
        money_sum(F.col("revenue_usd")).alias("revenue"),
    )


def paid_preview(cdm: DataFrame) -> DataFrame:
    """Spend also as whole dollars with separators, the way it is shown."""
    platforms = cdm.groupBy("platform").agg(
        F.count("campaign_id").alias("rows"),
        round_frame(money_sum(F.col("cost_usd")), 2).alias("spend_usd"),
        F.sum("impressions").alias("impressions"),
        F.sum("installs").alias("installs"),
        round_frame(F.avg("cpi"), 2).alias("avg_cpi"),
        round_frame(F.avg("ctr"), 2).alias("avg_ctr"),
    )
    return platforms.withColumn(
        "spend_text", F.concat(F.lit("$"), F.format_number(F.col("spend_usd"), 0))
    )


def organic_preview(cdm: DataFrame) -> DataFrame:
    return cdm.groupBy("platform").agg(
        F.count("post_id").alias("posts"),
        F.count_if("is_viral").alias("viral"),
        F.sum("reach").alias("total_reach"),
        F.sum("engagements").alias("total_eng"),
        round_frame(F.avg("blended_engagement_rate"), 4).alias("avg_eng_rate"),
        round_frame(F.avg("avg_watch_time_s"), 3).alias("avg_watch_s"),
        F.sum("follower_delta").alias("follower_growth"),
    )


def rate_check(cdm: DataFrame) -> DataFrame:
    """Blended against native rate, and watch time in seconds, per platform."""
    return cdm.groupBy("platform").agg(
        F.avg("blended_engagement_rate").alias("avg_blended"),
        F.avg("platform_engagement_rate").alias("avg_native"),
        F.avg("avg_watch_time_s").alias("avg_watch_s"),
    )


def date_range(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.min(column).alias("first_day"), F.max(column).alias("last_day"))


def null_counts(df: DataFrame) -> DataFrame:
    """Columns that hold NULLs, with how many; one pass for all columns."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    return counted.select(F.inline(F.array(*rows))).where("nulls > 0")


def empty_columns(
    cdm: DataFrame,
    columns: tuple[str, ...] = ("avg_watch_time_s", "video_completion_rate", "platform_engagement_rate"),
) -> DataFrame:
    """Per platform, the names of the columns that are NULL in every row."""
    counted = cdm.groupBy("platform").agg(*(F.count(c).alias(c) for c in columns))
    names = F.concat_ws(",", *(F.when(F.col(c) == 0, F.lit(c)) for c in columns))
    return counted.select("platform", names.alias("empty_columns"))

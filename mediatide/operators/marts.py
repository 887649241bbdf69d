"""Marts.  One aggregation each: totals first, ratios of the totals after it.

Sums, counts and averages all combine before the shuffle, so a key that holds a third of the
rows sends one row per map task, whatever the size of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediatide.functions.dates import month_start
from mediatide.functions.metrics import funnel_status, paid_efficiency
from mediatide.functions.numbers import money_sum, ratio

_MONEY = ("cost_usd", "conversion_value_usd")
_CAMPAIGN_DAY = ("date", "platform", "campaign_id", "campaign_name", "objective", "country")


def _loaded_at() -> Column:
    return F.current_timestamp().alias("_loaded_at")


def _campaign_days(staged: DataFrame, totals: tuple[str, ...]) -> DataFrame:
    """Totals per campaign and day, with the last attribution window in byte order.

    A maximum of text cannot live in a hash aggregation's buffer; Spark would sort all rows
    before combining any.  So a window is aggregated as its place among all windows in order, a number, and
    decoded afterwards: one aggregation, one shuffle.  The list of windows is a subquery over that one column, whose values
    are made distinct in every task first; it has as many entries as there are different windows, a few for each platform.
    """
    sums = [(money_sum(F.col(n)) if n in _MONEY else F.sum(n)).alias(n) for n in totals]
    window = F.col("attribution_window")
    different = staged.select("attribution_window").distinct()
    windows = different.select(F.sort_array(F.collect_list(window)).alias("windows")).scalar()
    # Places start at 1; a NULL window has none, and the maximum of none is NULL.
    place = F.when(window.isNotNull(), F.array_position(windows, window))
    days = staged.groupBy(*_CAMPAIGN_DAY).agg(*sums, F.max(place).alias("_place"))
    decoded = F.when(F.col("_place").isNotNull(), F.element_at(windows, F.col("_place").cast("int")))
    out = days.withColumn("attribution_window", decoded).drop("_place")
    return out.withColumnRenamed("conversion_value_usd", "revenue_usd")


def channel_performance_daily(staged: DataFrame) -> DataFrame:
    """Paid performance per campaign, objective, country and day."""
    c = F.col
    totals = (
        "impressions", "clicks", "cost_usd", "installs", "conversions", "conversion_value_usd",
        "video_views", "video_completions", "engagements",
    )
    days = _campaign_days(staged, totals)
    return days.select(
        *(n for n in days.columns if n != "attribution_window"),
        *paid_efficiency("cost_usd", "revenue_usd"),
        ratio(c("video_views"), c("impressions")).alias("video_view_rate"),
        ratio(c("video_completions"), c("video_views")).alias("video_completion_rate"),
        ratio(c("engagements"), c("impressions")).alias("engagement_rate"),
        "attribution_window",
        _loaded_at(),
    )


def channel_performance_daily_old(staged: DataFrame) -> DataFrame:
    """As above without completions."""
    c = F.col
    totals = (
        "impressions", "clicks", "cost_usd", "installs", "conversions", "conversion_value_usd",
        "video_views", "engagements",
    )
    days = _campaign_days(staged, totals)
    return days.select(
        *(n for n in days.columns if n != "attribution_window"),
        *paid_efficiency("cost_usd", "revenue_usd"),
        ratio(c("video_views"), c("impressions")).alias("video_view_rate"),
        ratio(c("engagements"), c("impressions")).alias("engagement_rate"),
        "attribution_window",
        _loaded_at(),
    )


def _stage_counts() -> list[Column]:
    days = F.when(F.col("subscribed"), F.col("days_to_subscribe").cast("double"))
    return [
        F.count("*").alias("installs"),
        F.count_if("registered").alias("registrations"),
        F.count_if("first_activity").alias("first_activities"),
        F.count_if("paywall_viewed").alias("paywall_views"),
        F.count_if("trial_started").alias("trials"),
        F.count_if("subscribed").alias("subscriptions"),
        money_sum(F.col("subscription_value_usd")).alias("revenue_usd"),
        F.avg(days).alias("avg_days_to_subscribe"),
    ]


def _stage_rates() -> list[Column]:
    c = F.col
    return [
        ratio(c("registrations"), c("installs")).alias("install_to_reg_rate"),
        ratio(c("first_activities"), c("registrations")).alias("reg_to_activation_rate"),
        ratio(c("paywall_views"), c("first_activities")).alias("activation_to_paywall_rate"),
        ratio(c("trials"), c("paywall_views")).alias("paywall_to_trial_rate"),
        ratio(c("subscriptions"), c("trials")).alias("trial_to_sub_rate"),
        ratio(c("subscriptions"), c("installs")).alias("overall_cvr"),
        ratio(c("revenue_usd"), c("installs")).alias("ltv_per_install"),
    ]


def _cohorts(staged: DataFrame, *keys: str):
    return staged.groupBy(month_start(F.col("install_date")).alias("cohort_month"), *keys)


def funnel_by_channel(staged: DataFrame) -> DataFrame:
    """Monthly install funnel per channel, platform and country."""
    c = F.col
    counts = _cohorts(staged, "channel", "platform", "country").agg(
        *_stage_counts(),
        F.count_if(c("att_status") == "authorized").alias("ios_att_authorized"),
        F.count_if(c("att_status") == "denied").alias("ios_att_denied"),
        F.count_if("is_skan").alias("skan_installs"),
    )
    answered = c("ios_att_authorized") + c("ios_att_denied")
    return counts.select("*", *_stage_rates()).select(
        "*",
        ratio(c("revenue_usd"), c("subscriptions")).alias("arpu"),
        ratio(c("ios_att_authorized"), answered).alias("ios_att_rate"),
        ratio(c("skan_installs"), c("installs")).alias("skan_pct"),
        funnel_status(c("overall_cvr")).alias("funnel_status"),
        _loaded_at(),
    )


def funnel_by_channel_old(staged: DataFrame) -> DataFrame:
    counts = _cohorts(staged, "channel", "platform", "country").agg(*_stage_counts())
    return counts.select("*", *_stage_rates(), _loaded_at())


def ltv_cohort(staged: DataFrame) -> DataFrame:
    """Monthly subscriber value per channel, platform and plan, with the mix of plans."""
    c = F.col
    plan = c("subscription_type")
    cohorts = staged.groupBy(
        month_start(c("install_date")).alias("cohort_month"),
        "channel",
        "platform",
        F.coalesce(plan, F.lit("unknown")).alias("plan"),
    ).agg(
        F.count("*").alias("installs"),
        F.count_if("subscribed").alias("subscribers"),
        money_sum(c("subscription_value_usd")).alias("cohort_revenue_usd"),
        F.avg(F.when(c("subscribed"), c("days_to_subscribe").cast("double"))).alias("avg_days_to_convert"),
        *(F.count_if(plan == p).alias(f"_{p}") for p in ("annual", "monthly", "family")),
    )
    return cohorts.select(
        "cohort_month",
        "channel",
        "platform",
        c("plan").alias("subscription_type"),
        "installs",
        "subscribers",
        "cohort_revenue_usd",
        ratio(c("subscribers"), c("installs")).alias("sub_rate"),
        ratio(c("cohort_revenue_usd"), c("subscribers")).alias("arpu"),
        ratio(c("cohort_revenue_usd"), c("installs")).alias("ltv_per_install"),
        "avg_days_to_convert",
        *(ratio(c(f"_{p}"), c("subscribers")).alias(f"{p}_mix") for p in ("annual", "monthly", "family")),
        _loaded_at(),
    )


def ltv_cohort_old(staged: DataFrame) -> DataFrame:
    """Three keys; a NULL plan is a group of its own."""
    c = F.col
    cohorts = _cohorts(staged, "channel", "subscription_type").agg(
        F.count("*").alias("installs"),
        F.count_if("subscribed").alias("subscribers"),
        money_sum(c("subscription_value_usd")).alias("cohort_revenue_usd"),
        F.avg(F.when(c("subscribed"), c("days_to_subscribe"))).alias("avg_days_to_convert"),
    )
    return cohorts.select(
        *(n for n in cohorts.columns if n != "avg_days_to_convert"),
        ratio(c("cohort_revenue_usd"), c("subscribers")).alias("arpu_subscribers"),
        ratio(c("cohort_revenue_usd"), c("installs")).alias("ltv_per_install"),
        "avg_days_to_convert",
        _loaded_at(),
    )


def _content_months(staged: DataFrame, *more: Column) -> DataFrame:
    month = month_start(F.col("date")).alias("month")
    return staged.groupBy(month, "platform", "content_type", "topic").agg(
        F.count("post_id").alias("posts"),
        F.count_if("is_viral").alias("viral_posts"),
        F.sum("reach").alias("total_reach"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("engagements").alias("total_engagements"),
        F.sum("video_views").alias("total_video_views"),
        F.sum("follower_delta").alias("net_follower_growth"),
        F.avg("avg_watch_time_s").alias("avg_watch_time_s"),
        F.avg("video_completion_rate").alias("avg_completion_rate"),
        *more,
    )


def organic_performance(staged: DataFrame) -> DataFrame:
    """Monthly posts per platform, content type and topic, with the reach uplift of viral ones."""
    c = F.col
    reach = c("reach").cast("double")
    months = _content_months(
        staged,
        F.sum("outbound_clicks").alias("total_outbound_clicks"),
        F.avg("blended_engagement_rate").alias("avg_engagement_rate"),
        F.avg(F.when(c("is_viral"), reach)).alias("_viral_reach"),
        F.avg(F.when(~c("is_viral"), reach)).alias("_other_reach"),
    )
    return months.select(
        *(n for n in months.columns if not n.startswith("_")),
        ratio(c("_viral_reach"), c("_other_reach")).alias("viral_reach_multiplier"),
        _loaded_at(),
    )


def organic_performance_old(staged: DataFrame) -> DataFrame:
    """Averages the source's own rate and adds the rate of the totals."""
    c = F.col
    months = _content_months(staged, F.avg("engagement_rate").alias("avg_engagement_rate"))
    return months.select(
        "*",
        ratio(c("total_engagements"), c("total_reach")).alias("blended_engagement_rate"),
        _loaded_at(),
    )

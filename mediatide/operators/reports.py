"""Reports over the marts.  Reports that follow the calendar take `as_of`, by default today."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediatide.functions.dates import as_of_day, month_start, months_back, week_start
from mediatide.functions.metrics import action_required, cost_per_mille, funnel_status
from mediatide.functions.numbers import money_sum, ratio


def _paid_totals() -> list[Column]:
    return [
        money_sum(F.col("cost_usd")).alias("total_spend"),
        F.sum("installs").alias("total_installs"),
        money_sum(F.col("revenue_usd")).alias("_revenue"),
        F.sum("impressions").alias("_impressions"),
        F.sum("conversions").alias("_conversions"),
    ]


def executive_summary(performance: DataFrame, staged_organic: DataFrame) -> DataFrame:
    """Weekly paid and organic figures side by side; either side may lack a week.

    Both sides are aggregated to weeks before they meet, so the join is of a few rows.
    """
    c = F.col
    week = week_start(c("date")).alias("week")
    paid = performance.groupBy(week).agg(*_paid_totals())
    organic = staged_organic.groupBy(week).agg(
        F.sum("reach").alias("organic_reach"),
        F.sum("engagements").alias("organic_engagements"),
        F.avg("blended_engagement_rate").alias("avg_organic_eng_rate"),
        F.sum("follower_delta").alias("follower_growth"),
    )
    seen = c("paid_impressions") + F.coalesce(c("organic_reach"), F.lit(0))
    return (
        paid.join(organic, "week", "full_outer")
        .select(
            "week",
            "total_spend",
            c("_impressions").alias("paid_impressions"),
            "total_installs",
            c("_conversions").alias("paid_subscriptions"),
            c("_revenue").alias("paid_revenue"),
            ratio(c("_revenue"), c("total_spend")).alias("blended_roas"),
            ratio(c("total_spend"), c("total_installs")).alias("blended_cpi"),
            "organic_reach",
            "organic_engagements",
            "avg_organic_eng_rate",
            "follower_growth",
            ratio(c("_revenue"), c("total_spend")).alias("paid_roas"),
        )
        .withColumn("blended_cpm_all_media", cost_per_mille(c("total_spend"), seen))
        .orderBy(c("week").desc_nulls_last())
    )


def executive_summary_old(performance: DataFrame) -> DataFrame:
    """Paid media only, oldest week first."""
    c = F.col
    weeks = performance.groupBy(week_start(c("date")).alias("week")).agg(*_paid_totals())
    return weeks.select(
        "week",
        "total_spend",
        c("_impressions").alias("total_impressions"),
        "total_installs",
        c("_conversions").alias("total_subscriptions"),
        c("_revenue").alias("total_revenue"),
        ratio(c("_revenue"), c("total_spend")).alias("blended_roas"),
        ratio(c("total_spend"), c("total_installs")).alias("blended_cpi"),
        ratio(c("total_spend"), c("_conversions")).alias("blended_cps"),
    ).orderBy(c("week").asc_nulls_last())


def _platform_averages() -> list[Column]:
    return [F.avg(n).alias(f"avg_{n}") for n in ("cpm", "ctr", "cpi", "roas")]


def platform_comparison(performance: DataFrame) -> DataFrame:
    """Platforms side by side: averages of the daily ratios next to the ratio of the totals.

    The two exact distinct counts run over rows already reduced to one per platform,
    campaign and day, with sums and counts carried along instead of averages.
    """
    c = F.col
    parts = ("cpm", "ctr", "cpi", "roas")
    totals = {
        "total_spend": "cost_usd",
        "total_impressions": "impressions",
        "total_installs": "installs",
        "total_conversions": "conversions",
        "total_revenue": "revenue_usd",
    }

    def add(total: str, name: str) -> Column:
        return money_sum(c(name)) if total in ("total_spend", "total_revenue") else F.sum(name)

    # The window is a key here, not a maximum of text, to keep this step a hash aggregation.
    reduced = performance.groupBy("platform", "campaign_id", "date", "attribution_window").agg(
        *(add(total, n).alias(total) for total, n in totals.items()),
        *(F.sum(n).alias(f"_{n}_sum") for n in parts),
        *(F.count(n).alias(f"_{n}_count") for n in parts),
    )
    platforms = reduced.groupBy("platform").agg(
        F.count_distinct("campaign_id").alias("campaigns"),
        F.count_distinct("date").alias("active_days"),
        *(add(total, total).alias(total) for total in totals),
        *(ratio(F.sum(f"_{n}_sum"), F.sum(f"_{n}_count")).alias(f"avg_{n}") for n in parts),
        F.max("attribution_window").alias("attribution_window"),
    )
    return platforms.select(
        *(n for n in platforms.columns if n != "attribution_window"),
        ratio(c("total_revenue"), c("total_spend")).alias("overall_roas"),
        ratio(c("total_installs"), c("total_impressions")).alias("install_rate"),
        "attribution_window",
    ).orderBy(c("total_spend").desc_nulls_last())


def platform_comparison_old(performance: DataFrame) -> DataFrame:
    c = F.col
    platforms = performance.groupBy("platform").agg(
        money_sum(F.col("cost_usd")).alias("total_spend"),
        F.sum("installs").alias("total_installs"),
        F.sum("conversions").alias("total_conversions"),
        money_sum(F.col("revenue_usd")).alias("total_revenue"),
        *_platform_averages(),
    )
    return platforms.select(
        "*", ratio(c("total_revenue"), c("total_spend")).alias("overall_roas")
    ).orderBy(c("total_spend").desc_nulls_last())


def funnel_health(funnel: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Cohorts of the current and the two previous months, with what to do about them.

    A channel has one row per platform and country, as the mart does.
    """
    c = F.col
    recent = funnel.where(c("cohort_month") >= months_back(as_of_day(as_of), 2))
    return recent.select(
        "cohort_month", "channel", "installs", "subscriptions", "overall_cvr", "ltv_per_install",
        "revenue_usd", "funnel_status",
        action_required(c("funnel_status"), c("installs")).alias("action_required"),
        "avg_days_to_subscribe", "ios_att_rate", "skan_pct",
    ).orderBy(c("cohort_month").desc_nulls_last(), c("installs").desc_nulls_last())


def funnel_health_old(funnel: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Cohorts of the current month only; the status is computed here."""
    c = F.col
    current = funnel.where(c("cohort_month") == month_start(as_of_day(as_of)))
    return current.select(
        "cohort_month", "channel", "installs", "subscriptions", "overall_cvr", "ltv_per_install",
        "revenue_usd", funnel_status(c("overall_cvr")).alias("funnel_status"),
    ).orderBy(c("installs").desc_nulls_last())


def top_cohorts(cohorts: DataFrame, count: int = 6) -> DataFrame:
    """Cohorts with the highest revenue; equal revenue is ordered by the cohort's keys."""
    keys = ("cohort_month", "channel", "subscription_type")
    return (
        cohorts.orderBy(F.col("revenue_usd").desc_nulls_last(), *keys)
        .limit(count)
        .select(*keys, "installs", "subscribers", "revenue_usd", "ltv_per_install", "funnel_status")
    )


def sample_rows(rows: DataFrame, order: list[str], count: int = 3) -> DataFrame:
    """First rows under a total order."""
    return rows.orderBy(*order).limit(count)

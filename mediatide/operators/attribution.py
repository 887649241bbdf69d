"""Mobile-attribution installs and in-app events, and the two summaries built from installs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediatide.functions.dates import month_start
from mediatide.functions.metrics import funnel_status
from mediatide.functions.numbers import (
    money_sum,
    parse_double,
    ratio_floor_one,
    ratio_or_zero,
    round_frame,
    truncate_long,
)
from mediatide.functions.text import has_text, is_exactly_true, json_fields, lookup, says_yes
from mediatide.operators.fields import Feed, RunStamp

# Media source to channel name, and the provenance of the reports.
CHANNEL_OF_SOURCE = {
    "tiktokglobal_int": "TikTok Ads",
    "facebook": "Meta Ads",
    "reddit_int": "Reddit Ads",
    "googleadwords_int": "Google UAC",
    "organic": "Organic",
    "apple_search_ads": "Apple Search Ads",
}
REPORT_SOURCE = "appsflyer_pull_api_v5"
REPORT_SOURCE_OLD = "appsflyer_pull_api"

_EVENT_FIELDS = [
    "value_usd", "revenue", "sport_type", "distance_km", "duration_min", "plan", "platform", "reason",
]


def channel_of(media_source: Column) -> Column:
    """A source that is not in the table is its own channel."""
    return lookup(CHANNEL_OF_SOURCE, media_source)


def installs(raw: DataFrame, stamp: RunStamp | None = None, primary_only: bool = True) -> DataFrame:
    """Install report to `cdm_installs`; only primary attributions unless told otherwise."""
    f = Feed(raw)

    def yes(name: str, default: str = "false") -> Column:
        return says_yes(f.text(name, default=default)).alias(name)

    source = f.text("media_source", default="unknown")
    rows = raw.select(
        f.text("appsflyer_id").alias("appsflyer_id"),
        f.text("customer_user_id").alias("customer_user_id"),
        f.text("app_id").alias("app_id"),
        f.day("install_time").alias("install_date"),
        f.text("install_time").alias("install_timestamp"),
        source.alias("media_source"),
        channel_of(source).alias("channel"),
        f.text("campaign_id").alias("campaign_id"),
        f.text("campaign").alias("campaign_name"),
        f.text("adset").alias("adset_id"),
        f.text("ad").alias("ad_id"),
        yes("is_retargeting"),
        yes("is_primary_attribution", default="true"),
        F.lower(f.text("platform")).alias("platform"),
        f.text("os_version").alias("os_version"),
        f.text("device_type").alias("device_type"),
        f.text("country_code").alias("country"),
        f.text("att_status", default="not_applicable").alias("att_status"),
        has_text(f.text("idfa")).alias("has_idfa"),
        has_text(f.text("skad_campaign_id")).alias("is_skan"),
        f.text("skad_campaign_id").alias("skad_campaign_id"),
        yes("registration").alias("registered"),
        yes("first_activity_uploaded").alias("first_activity"),
        yes("paywall_viewed"),
        yes("trial_started"),
        yes("subscribed"),
        f.text("subscription_type").alias("subscription_type"),
        f.double("subscription_value_usd").alias("subscription_value_usd"),
        f.long_or_null("days_to_subscribe").alias("days_to_subscribe"),
        F.lit(REPORT_SOURCE).alias("raw_source"),
        *(stamp or RunStamp()).columns(),
    )
    return rows.where("is_primary_attribution") if primary_only else rows


def installs_old(raw: DataFrame) -> DataFrame:
    """The older install table: flags are exactly `true`, the channel is taken as given."""
    f = Feed(raw)

    def same(name: str) -> Column:
        return is_exactly_true(f.text(name))

    return raw.select(
        f.day("install_time").alias("install_date"),
        f.text("appsflyer_id").alias("appsflyer_id"),
        f.text("customer_user_id").alias("customer_user_id"),
        f.text("media_source").alias("media_source"),
        f.text("channel").alias("channel"),
        f.text("campaign").alias("campaign_id"),
        F.lower(f.text("platform")).alias("platform"),
        f.text("country_code").alias("country"),
        f.text("device_type").alias("device_type"),
        f.text("app_version").alias("app_version"),
        same("is_retargeting").alias("is_retargeting"),
        f.text("att_status").alias("att_status"),
        same("registration_event").alias("registered"),
        same("first_activity_uploaded").alias("first_activity"),
        same("paywall_viewed").alias("paywall_viewed"),
        same("trial_started").alias("trial_started"),
        same("subscribed").alias("subscribed"),
        f.text("subscription_type").alias("subscription_type"),
        f.double("subscription_value_usd").alias("subscription_value_usd"),
        f.long_or_null("days_to_subscribe").alias("days_to_subscribe"),
        F.lit(REPORT_SOURCE_OLD).alias("raw_source"),
    )


def in_app_events(raw: DataFrame, stamp: RunStamp | None = None) -> DataFrame:
    """Event report to `cdm_funnel_events`; the JSON text is parsed once per row and also kept.

    A column `_event_id`, by which the event log tells repeated events, is passed on.
    """
    f = Feed(raw)
    payload = f.text("event_value", default="{}")
    parsed = raw.select("*", json_fields(payload, _EVENT_FIELDS).alias("_event"))
    e = lambda name: F.col("_event").getField(name)
    text = lambda name: F.coalesce(e(name), F.lit(""))
    number = lambda column: F.coalesce(parse_double(column), F.lit(0.0))
    source = f.text("media_source")
    return parsed.select(
        f.day("event_time").alias("event_date"),
        f.text("event_time").alias("event_timestamp"),
        f.text("appsflyer_id").alias("appsflyer_id"),
        f.text("customer_user_id").alias("customer_user_id"),
        f.text("app_id").alias("app_id"),
        f.text("event_name").alias("event_name"),
        number(F.coalesce(e("value_usd"), e("revenue"))).alias("revenue_usd"),
        text("sport_type").alias("sport_type"),
        number(e("distance_km")).alias("distance_km"),
        truncate_long(parse_double(e("duration_min"))).alias("duration_min"),
        text("plan").alias("subscription_plan"),
        text("platform").alias("share_platform"),
        text("reason").alias("cancel_reason"),
        payload.alias("event_properties"),
        F.lower(f.text("platform")).alias("platform"),
        f.text("country_code").alias("country"),
        source.alias("media_source"),
        channel_of(source).alias("channel"),
        F.lit(REPORT_SOURCE).alias("raw_source"),
        *(stamp or RunStamp()).columns(),
        *(["_event_id"] if "_event_id" in raw.columns else []),
    )


def app_events(raw: DataFrame) -> DataFrame:
    """The older app-event feed; properties stay JSON text."""
    f = Feed(raw)
    return raw.select(
        f.text("event_id").alias("event_id"),
        f.text("user_id").alias("user_id"),
        f.text("event_name").alias("event_name"),
        f.day("event_timestamp").alias("event_date"),
        f.text("event_timestamp").alias("event_timestamp"),
        F.lower(f.text("platform")).alias("platform"),
        f.text("app_version").alias("app_version"),
        f.text("session_id").alias("session_id"),
        f.text("properties").alias("properties"),
    )


def _funnel_counts() -> list[Column]:
    return [
        F.count("appsflyer_id").alias("installs"),
        F.count_if("registered").alias("registrations"),
        F.count_if("first_activity").alias("first_activities"),
        F.count_if("paywall_viewed").alias("paywall_views"),
        F.count_if("trial_started").alias("trials"),
        F.count_if("subscribed").alias("subscriptions"),
        money_sum(F.col("subscription_value_usd")).alias("revenue_usd"),
    ]


# Rate name -> numerator, denominator.
_DAILY_RATES = {
    "reg_rate": ("registrations", "installs"),
    "act_rate": ("first_activities", "registrations"),
    "paywall_rate": ("paywall_views", "first_activities"),
    "trial_rate": ("trials", "paywall_views"),
    "sub_rate": ("subscriptions", "trials"),
    "overall_cvr": ("subscriptions", "installs"),
}


def funnel_summary(cdm_installs: DataFrame, stamp: RunStamp | None = None) -> DataFrame:
    """Daily funnel by channel.  Rows without a day or channel take part in no group."""
    c = F.col
    counts = (
        cdm_installs.dropna(subset=["install_date", "channel"])
        .groupBy("install_date", "channel")
        .agg(
            *_funnel_counts(),
            F.count_if(c("att_status") == "authorized").alias("ios_att_authorized"),
            F.count_if(c("att_status") == "denied").alias("ios_att_denied"),
            F.count_if("is_skan").alias("skan_installs"),
        )
    )
    answered = c("ios_att_authorized") + c("ios_att_denied")
    rates = {name: ratio_or_zero(c(a), c(b)) for name, (a, b) in _DAILY_RATES.items()}
    rates["ios_att_rate"] = ratio_or_zero(c("ios_att_authorized"), answered)
    rates["skan_pct"] = ratio_or_zero(c("skan_installs"), c("installs"))
    money = {
        "ltv_per_install": ratio_or_zero(c("revenue_usd"), c("installs")),
        "arpu": ratio_or_zero(c("revenue_usd"), c("subscriptions")),
    }
    kept = [n for n in counts.columns if n != "revenue_usd"]
    return counts.select(
        *kept,
        round_frame(c("revenue_usd"), 2).alias("revenue_usd"),
        *(round_frame(v, 4).alias(n) for n, v in rates.items()),
        *(round_frame(v, 2).alias(n) for n, v in money.items()),
        *(stamp or RunStamp()).columns(),
    )


def funnel_summary_old(installs_table: DataFrame) -> DataFrame:
    """The older daily funnel: six rates, a zero denominator counts as one."""
    counts = (
        installs_table.dropna(subset=["install_date", "channel"])
        .groupBy("install_date", "channel")
        .agg(*_funnel_counts())
    )
    rates = (
        round_frame(ratio_floor_one(F.col(a), F.col(b)), 4).alias(name)
        for name, (a, b) in _DAILY_RATES.items()
    )
    return counts.select("*", *rates)


def ltv_cohort(cdm_installs: DataFrame, stamp: RunStamp | None = None) -> DataFrame:
    """Monthly cohort by channel and plan; the status follows the rounded subscription rate."""
    c = F.col
    cohorts = (
        cdm_installs.dropna(subset=["install_date", "channel", "subscription_type"])
        .groupBy(month_start(c("install_date")).alias("cohort_month"), "channel", "subscription_type")
        .agg(
            F.count("appsflyer_id").alias("installs"),
            F.count_if("subscribed").alias("subscribers"),
            money_sum(F.col("subscription_value_usd")).alias("revenue_usd"),
            F.avg(c("days_to_subscribe").try_cast("double")).alias("avg_days"),
        )
    )
    rates = cohorts.select(
        "cohort_month", "channel", "subscription_type", "installs", "subscribers", "revenue_usd",
        round_frame(c("avg_days"), 1).alias("avg_days_to_sub"),
        round_frame(ratio_or_zero(c("subscribers"), c("installs")), 4).alias("sub_rate"),
        round_frame(ratio_or_zero(c("revenue_usd"), c("subscribers")), 2).alias("arpu"),
        round_frame(ratio_or_zero(c("revenue_usd"), c("installs")), 2).alias("ltv_per_install"),
    )
    return rates.select(
        "*", funnel_status(c("sub_rate")).alias("funnel_status"), *(stamp or RunStamp()).columns()
    )

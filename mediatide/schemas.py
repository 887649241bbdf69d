"""Schemas of the landed feeds and of the common data model (CDM)."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def _struct(text: str) -> T.StructType:
    """`name type [NOT NULL], ...`; unlike the DDL parser this needs no running session."""
    fields = (item.split() for item in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], not rest) for name, kind, *rest in fields])


def _texts(names: str) -> str:
    return ", ".join(f"{name} string" for name in names.split())


# --- landed feeds -------------------------------------------------------------------------
# Field names are fixed by the platforms.  Values that may come as number or as text are
# read as text and parsed later, so one odd value never nulls a whole record.

TIKTOK_ADS = _struct(
    _texts(
        "stat_time_day campaign_id campaign_name objective_type adgroup_id adgroup_name ad_id "
        "ad_name country_code impressions clicks spend app_install conversion value "
        "video_play_actions video_views_p100 likes comments shares follows"
    )
)
META_ADS = _struct(
    _texts(
        "date_start campaign_id campaign_name objective adset_id adset_name ad_id ad_name country "
        "impressions link_clicks spend mobile_app_installs purchases purchase_roas video_views "
        "video_thruplay_watched_actions post_reactions post_comments post_shares post_saves"
    )
)
REDDIT_ADS = _struct(
    _texts(
        "date campaign_id campaign_name objective ad_group_id ad_group_name ad_id ad_name country "
        "impressions clicks spend_usd ecpm ecpc ctr app_installs upvotes comments shares video_views"
    )
)
INSTAGRAM_POSTS = _struct(
    _texts("media_id id media_type timestamp topic")
    + ", is_viral boolean, "
    + _texts(
        "reach impressions like_count comments_count saved shares video_views avg_watch_time_ms "
        "website_clicks follows profile_visits"
    )
)
TIKTOK_POSTS = _struct(
    _texts("id video_id create_time content_type topic")
    + ", is_viral boolean, "
    + _texts(
        "play_count view_count like_count comment_count share_count collect_count "
        "average_time_watched full_video_watched_rate engagement_rate reach fans_delta profile_visits"
    )
)
REDDIT_POSTS = _struct(
    _texts("post_id id created_utc post_type topic")
    + ", is_viral boolean, "
    + _texts(
        "score upvote_ratio num_comments num_shares unique_views awards_count video_views "
        "subscriber_delta outbound_clicks"
    )
)
MIXED_POSTS = _struct(
    _texts("post_id platform content_type topic published_date")
    + ", is_viral boolean, "
    + _texts(
        "reach impressions engagement_rate likes comments shares saves video_views total_play "
        "avg_watch_time_s completion_rate profile_visits follower_delta fans_delta "
        "subscriber_delta outbound_clicks"
    )
)
APP_EVENTS = _struct(
    _texts("event_id user_id event_name event_timestamp platform app_version session_id properties")
)
# Attribution reports are CSV with a header.
INSTALLS_REPORT = _struct(
    _texts(
        "appsflyer_id customer_user_id app_id install_time media_source campaign_id campaign adset "
        "ad is_retargeting is_primary_attribution platform os_version device_type country_code "
        "att_status idfa skad_campaign_id registration first_activity_uploaded paywall_viewed "
        "trial_started subscribed subscription_type subscription_value_usd days_to_subscribe"
    )
)
IN_APP_EVENTS_REPORT = _struct(
    _texts(
        "event_time appsflyer_id customer_user_id app_id event_name event_value platform "
        "country_code media_source"
    )
)

# --- common data model --------------------------------------------------------------------
# Names, order and types of the tables' columns.

CDM_PAID_MEDIA = _struct(
    "date date NOT NULL, platform string NOT NULL, channel_type string, campaign_id string, "
    "campaign_name string, objective string, ad_group_id string, ad_group_name string, "
    "ad_id string, ad_name string, country string, impressions bigint, clicks bigint, "
    "cost_usd double, installs bigint, conversions bigint, conversion_value_usd double, "
    "video_views bigint, video_completions bigint, engagements bigint, likes bigint, "
    "comments bigint, shares bigint, cpm double, cpc double, ctr double, cpi double, cps double, "
    "roas double, attribution_window string, raw_source string, _extracted_at string, "
    "_pipeline_version string"
)
CDM_ORGANIC = _struct(
    "date date, platform string, channel_type string, post_id string, content_type string, "
    "topic string, is_viral boolean, reach bigint, impressions bigint, likes bigint, "
    "comments bigint, shares bigint, saves bigint, engagements bigint, "
    "blended_engagement_rate double, video_views bigint, avg_watch_time_s double, "
    "video_completion_rate double, follower_delta bigint, outbound_clicks bigint, "
    "profile_visits bigint, platform_engagement_rate double, raw_source string, "
    "_extracted_at string, _pipeline_version string"
)
CDM_INSTALLS = _struct(
    "appsflyer_id string, customer_user_id string, app_id string, install_date date, "
    "install_timestamp string, media_source string, channel string, campaign_id string, "
    "campaign_name string, adset_id string, ad_id string, is_retargeting boolean, "
    "is_primary_attribution boolean, platform string, os_version string, device_type string, "
    "country string, att_status string, has_idfa boolean, is_skan boolean, "
    "skad_campaign_id string, registered boolean, first_activity boolean, paywall_viewed boolean, "
    "trial_started boolean, subscribed boolean, subscription_type string, "
    "subscription_value_usd double, days_to_subscribe bigint, raw_source string, "
    "_extracted_at string, _pipeline_version string"
)
CDM_FUNNEL_EVENTS = _struct(
    "event_date date, event_timestamp string, appsflyer_id string, customer_user_id string, "
    "app_id string, event_name string, revenue_usd double, sport_type string, distance_km double, "
    "duration_min bigint, subscription_plan string, share_platform string, cancel_reason string, "
    "event_properties string, platform string, country string, media_source string, "
    "channel string, raw_source string, _extracted_at string, _pipeline_version string"
)
CDM_FUNNEL_SUMMARY = _struct(
    "install_date date, channel string, installs bigint, registrations bigint, "
    "first_activities bigint, paywall_views bigint, trials bigint, subscriptions bigint, "
    "revenue_usd double, ios_att_authorized bigint, ios_att_denied bigint, skan_installs bigint, "
    "reg_rate double, act_rate double, paywall_rate double, trial_rate double, sub_rate double, "
    "overall_cvr double, ltv_per_install double, arpu double, ios_att_rate double, "
    "skan_pct double, _extracted_at string, _pipeline_version string"
)
CDM_LTV_COHORT = _struct(
    "cohort_month date, channel string, subscription_type string, installs bigint, "
    "subscribers bigint, revenue_usd double, avg_days_to_sub double, sub_rate double, "
    "arpu double, ltv_per_install double, funnel_status string, _extracted_at string, "
    "_pipeline_version string"
)

# Which column each table is stored and replaced by.
PARTITION_COLUMN = {
    "cdm_paid_media_daily": "date",
    "cdm_organic_daily": "date",
    "cdm_installs": "install_date",
    "cdm_funnel_events": "event_date",
    "cdm_funnel_summary": "install_date",
    "cdm_ltv_cohort": "cohort_month",
}
CDM_SCHEMAS = {
    "cdm_paid_media_daily": CDM_PAID_MEDIA,
    "cdm_organic_daily": CDM_ORGANIC,
    "cdm_installs": CDM_INSTALLS,
    "cdm_funnel_events": CDM_FUNNEL_EVENTS,
    "cdm_funnel_summary": CDM_FUNNEL_SUMMARY,
    "cdm_ltv_cohort": CDM_LTV_COHORT,
}
AUDIT_COLUMNS = ("_extracted_at", "_pipeline_version", "_loaded_at")

"""The models written a second time, in plain SQL for DuckDB, for comparison.

Each entry of MODELS is a common table expression over the feeds or over earlier entries;
`statement` puts the ones a query needs in front of it.
"""

from __future__ import annotations

import re

from checks.feeds import FAULTY_INSTALLS, FAULTY_PAID, FEEDS


def div(a: str, b: str) -> str:
    """a / b, NULL for a zero divisor."""
    return f"(CAST({a} AS DOUBLE) / NULLIF({b}, 0))"


def div0(a: str, b: str) -> str:
    return f"COALESCE({div(a, b)}, CAST(0 AS DOUBLE))"


def long(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def exact(x: str, digits: int) -> str:
    """Correct rounding of the binary value: on an apparent tie the exact product decides."""
    s = f"CAST({10**digits} AS DOUBLE)"
    c = f"(({x}) * CAST(134217729 AS DOUBLE))"
    high = f"({c} - ({c} - ({x})))"
    rest = f"(({high} * {s} - ({x}) * {s}) + (({x}) - {high}) * {s})"
    near = f"round_even(({x}) * {s}, 0)"
    tie = f"abs(({x}) * {s} - {near}) = 0.5"
    half = "CAST(0.5 AS DOUBLE)"
    return (
        f"(CASE WHEN {tie} AND {rest} > 0 THEN ({x}) * {s} + {half} "
        f"WHEN {tie} AND {rest} < 0 THEN ({x}) * {s} - {half} ELSE {near} END / {s})"
    )


def frame(x: str, digits: int) -> str:
    return f"round_even(CAST({x} AS DOUBLE), {digits})"


def status(rate: str) -> str:
    return f"CASE WHEN {rate} >= 0.05 THEN 'healthy' WHEN {rate} >= 0.03 THEN 'watch' ELSE 'at_risk' END"


def month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def week(day: str) -> str:
    return f"CAST(date_trunc('week', {day}) AS DATE)"


MODELS: dict[str, str] = {}

# --- common data model ---------------------------------------------------------------------

_PAID_DOUBLES = "cpm cpc ctr cpi cps roas".split()


def _paid(source: str, platform: str, day: str, n: dict[str, str], window: str, raw_source: str) -> str:
    return f"""
SELECT CAST(substring({day}, 1, 10) AS DATE) AS date, '{platform}' AS platform, 'paid' AS channel_type,
  campaign_id, campaign_name, {n['objective']} AS objective, {n['group']} AS ad_group_id, '' AS ad_group_name,
  ad_id, '' AS ad_name, {n['country']} AS country, {long('impressions')} AS impressions,
  {long(n['clicks'])} AS clicks, CAST({n['cost']} AS DOUBLE) AS cost_usd, {long(n['installs'])} AS installs,
  {long(n['conversions'])} AS conversions, CAST({n['value']} AS DOUBLE) AS conversion_value_usd,
  {long(n['views'])} AS video_views, {long(n['completions'])} AS video_completions,
  {long(n['engagements'])} AS engagements, {long(n['likes'])} AS likes, {long(n['comments'])} AS comments,
  {long(n['shares'])} AS shares,
  CAST({n['cpm']} AS DOUBLE) AS cpm, CAST({n['cpc']} AS DOUBLE) AS cpc, CAST({n['ctr']} AS DOUBLE) AS ctr,
  {n['cpi']} AS cpi, {n['cps']} AS cps, CAST({n['roas']} AS DOUBLE) AS roas,
  '{window}' AS attribution_window, '{raw_source}' AS raw_source
FROM {source}"""


_IMPR = "CAST(impressions AS BIGINT)"
_TIKTOK = dict(
    objective="objective_type", group="adgroup_id", country="country_code", clicks="clicks", cost="spend",
    installs="app_install", conversions="conversion", value="value", views="video_play_actions",
    completions="video_views_p100", engagements="likes + comments + shares + follows", likes="likes",
    comments="comments", shares="shares", cpm=div0("spend", _IMPR) + " * 1000", cpc=div0("spend", "clicks"),
    ctr=div0("clicks", _IMPR), cpi=div0("spend", "app_install"), cps=div0("spend", "conversion"),
    roas=div0("value", "spend"),
)
_META_ROAS = "CASE WHEN purchase_roas = '[]' THEN 0 WHEN purchase_roas LIKE '[%' THEN 1.25 ELSE 0.5 END"
_META = dict(
    objective="objective", group="adset_id", country="country", clicks="link_clicks", cost="spend",
    installs="mobile_app_installs", conversions="purchases",
    value=exact("purchases * CAST(9.99 AS DOUBLE)", 2), views="video_views",
    completions="video_thruplay_watched_actions",
    engagements="post_reactions + post_comments + post_shares + post_saves", likes="post_reactions",
    comments="post_comments", shares="post_shares", cpm=div0("spend", _IMPR) + " * 1000",
    cpc=div0("spend", "link_clicks"), ctr=div0("link_clicks", _IMPR), cpi=div0("spend", "mobile_app_installs"),
    cps=div0("spend", "purchases"), roas=_META_ROAS,
)
_REDDIT = dict(
    objective="objective", group="ad_group_id", country="country", clicks="clicks", cost="spend_usd",
    installs="app_installs", conversions="0", value="0", views="video_views", completions="0",
    engagements="upvotes + comments + shares", likes="upvotes", comments="comments", shares="shares",
    cpm="ecpm", cpc="ecpc", ctr="ctr", cpi=div0("spend_usd", "app_installs"), cps="CAST(0 AS DOUBLE)", roas="0",
)
MODELS["cdm_tiktok"] = _paid("raw_tiktok_ads", "tiktok", "stat_time_day", _TIKTOK, "7d_click_1d_view", "tiktok_ads_api_v1.3")
MODELS["cdm_meta"] = _paid("raw_meta_ads", "instagram_meta", "date_start", _META, "7d_click_1d_view", "meta_marketing_api_v19.0")
MODELS["cdm_reddit"] = _paid("raw_reddit_ads", "reddit", "date", _REDDIT, "30d_click", "reddit_ads_api_v3")
MODELS["cdm_paid"] = "SELECT * FROM cdm_tiktok UNION ALL SELECT * FROM cdm_meta UNION ALL SELECT * FROM cdm_reddit"

_OLD_PAID = (
    "date, platform, channel_type, campaign_id, campaign_name, objective, ad_group_id, ad_group_name, ad_id, "
    "ad_name, country, impressions, clicks, cost_usd, installs, conversions, conversion_value_usd, video_views, "
    "video_completions, {engagements} AS engagements, {cpm} AS cpm, {cpc} AS cpc, {ctr} AS ctr, {cpi} AS cpi, "
    "{cps} AS cps, {roas} AS roas, attribution_window, {source} AS raw_source"
)


def _old_paid(model: str, engagements: str, roas: str, source: str = "raw_source") -> str:
    columns = _OLD_PAID.format(
        engagements=engagements,
        cpm=exact(div0("cost_usd", "impressions") + " * 1000", 4),
        cpc=exact(div0("cost_usd", "clicks"), 4),
        ctr=exact(div0("clicks", "impressions"), 6),
        cpi=exact(div0("cost_usd", "installs"), 4),
        cps=exact(div0("cost_usd", "conversions"), 4),
        roas=roas,
        source=source,
    )
    return f"SELECT {columns} FROM {model}"


MODELS["old_tiktok"] = _old_paid("cdm_tiktok", "likes + comments + shares", exact(div0("conversion_value_usd", "cost_usd"), 4))
# The older mapping reads a plain number only, so a list of actions counts as zero.
MODELS["old_meta"] = _old_paid("cdm_meta", "engagements", "CASE WHEN roas = 0.5 THEN roas ELSE 0 END", "'meta_marketing_api_v19'")
MODELS["old_reddit"] = _old_paid("cdm_reddit", "engagements", "CAST(0 AS DOUBLE)")
MODELS["old_paid"] = "SELECT * FROM old_tiktok UNION ALL SELECT * FROM old_meta UNION ALL SELECT * FROM old_reddit"

MODELS["cdm_instagram_posts"] = f"""
SELECT CAST(substring(timestamp, 1, 10) AS DATE) AS date, 'instagram' AS platform, 'organic' AS channel_type,
  media_id AS post_id, media_type AS content_type, topic, is_viral, reach, impressions, like_count AS likes,
  comments_count AS comments, shares, saved AS saves, like_count + comments_count + shares + saved AS engagements,
  CASE WHEN reach > 0 THEN {exact(div('like_count + comments_count + shares + saved', 'reach'), 5)} ELSE 0 END AS blended_engagement_rate,
  video_views, {exact('CAST(avg_watch_time_ms AS DOUBLE) / 1000', 1)} AS avg_watch_time_s,
  CAST(NULL AS DOUBLE) AS video_completion_rate, follows AS follower_delta, website_clicks AS outbound_clicks,
  profile_visits, CAST(NULL AS DOUBLE) AS platform_engagement_rate, 'instagram_graph_api_v19' AS raw_source
FROM raw_instagram_posts"""
MODELS["cdm_tiktok_posts"] = f"""
SELECT CAST(make_timestamp(create_time * 1000000) AS DATE) AS date, 'tiktok' AS platform, 'organic' AS channel_type,
  id AS post_id, content_type, topic, is_viral,
  COALESCE(reach, {long('trunc(play_count * CAST(0.72 AS DOUBLE))')}) AS reach, play_count AS impressions,
  like_count AS likes, comment_count AS comments, share_count AS shares, collect_count AS saves,
  like_count + comment_count + share_count + collect_count AS engagements,
  CASE WHEN play_count > 0 THEN {exact(div('like_count + comment_count + share_count + collect_count', 'play_count'), 5)} ELSE 0 END AS blended_engagement_rate,
  play_count AS video_views, average_time_watched AS avg_watch_time_s,
  full_video_watched_rate AS video_completion_rate, fans_delta AS follower_delta, {long('0')} AS outbound_clicks,
  profile_visits, engagement_rate AS platform_engagement_rate, 'tiktok_display_api_v2' AS raw_source
FROM raw_tiktok_posts"""
MODELS["cdm_reddit_posts"] = f"""
SELECT date, platform, channel_type, post_id, content_type, topic, is_viral, reach, reach AS impressions, likes,
  comments, shares, saves, likes + comments + shares AS engagements,
  CASE WHEN reach > 0 THEN {exact(div('likes + comments + shares', 'reach'), 5)} ELSE 0 END AS blended_engagement_rate,
  video_views, CAST(NULL AS DOUBLE) AS avg_watch_time_s, CAST(NULL AS DOUBLE) AS video_completion_rate,
  follower_delta, outbound_clicks, {long('0')} AS profile_visits, upvote_ratio AS platform_engagement_rate,
  'reddit_api_v1' AS raw_source
FROM (SELECT CAST(make_timestamp(created_utc * 1000000) AS DATE) AS date, 'reddit' AS platform, 'organic' AS channel_type,
  post_id, post_type AS content_type, topic, is_viral, COALESCE(unique_views, greatest(score * 4, 1)) AS reach,
  score AS likes, num_comments AS comments, num_shares AS shares, awards_count AS saves, video_views,
  subscriber_delta AS follower_delta, outbound_clicks, upvote_ratio FROM raw_reddit_posts)"""
MODELS["cdm_organic"] = (
    "SELECT * FROM cdm_instagram_posts UNION ALL SELECT * FROM cdm_tiktok_posts UNION ALL SELECT * FROM cdm_reddit_posts"
)
MODELS["old_organic"] = f"""
SELECT CAST(published_date AS DATE) AS date, platform, 'organic' AS channel_type, post_id, content_type, topic,
  is_viral, reach, impressions, engagement_rate, likes, comments, shares, {long('COALESCE(saves, 0)')} AS saves,
  {long('COALESCE(video_views, total_play, 0)')} AS video_views, COALESCE(avg_watch_time_s, 0) AS avg_watch_time_s,
  COALESCE(completion_rate, 0) AS video_completion_rate, {long('0')} AS profile_visits,
  {long('COALESCE(follower_delta, fans_delta, subscriber_delta, 0)')} AS follower_delta,
  {long('COALESCE(outbound_clicks, 0)')} AS outbound_clicks, platform || '_organic_api' AS raw_source,
  likes + comments + shares + {long('COALESCE(saves, 0)')} AS engagements
FROM raw_mixed_posts"""

_CHANNEL = (
    "CASE media_source WHEN 'tiktokglobal_int' THEN 'TikTok Ads' WHEN 'facebook' THEN 'Meta Ads' "
    "WHEN 'reddit_int' THEN 'Reddit Ads' WHEN 'organic' THEN 'Organic' ELSE media_source END"
)


def _installs(source: str) -> str:
    return f"""
SELECT appsflyer_id, customer_user_id, '' AS app_id, CAST(substring(install_time, 1, 10) AS DATE) AS install_date,
  install_time AS install_timestamp, media_source, {_CHANNEL} AS channel, campaign_id, '' AS campaign_name,
  '' AS adset_id, '' AS ad_id, FALSE AS is_retargeting, TRUE AS is_primary_attribution, lower(platform) AS platform,
  '' AS os_version, '' AS device_type, country_code AS country, att_status, FALSE AS has_idfa,
  skad_campaign_id <> '' AS is_skan, skad_campaign_id, registration = 'true' AS registered,
  first_activity_uploaded = 'TRUE' AS first_activity, paywall_viewed = 'yes' AS paywall_viewed,
  trial_started = '1' AS trial_started, subscribed = 'true' AS subscribed, subscription_type,
  CAST(subscription_value_usd AS DOUBLE) AS subscription_value_usd,
  CAST(NULLIF(days_to_subscribe, '') AS BIGINT) AS days_to_subscribe, 'appsflyer_pull_api_v5' AS raw_source
FROM {source} WHERE is_primary_attribution = 'true'"""


MODELS["cdm_installs"] = _installs("raw_installs")
MODELS["recent_installs"] = _installs("raw_recent_installs")
MODELS["old_installs"] = """
SELECT CAST(substring(install_time, 1, 10) AS DATE) AS install_date, appsflyer_id, customer_user_id, media_source,
  channel, campaign AS campaign_id, lower(platform) AS platform, country_code AS country, '' AS device_type,
  app_version, FALSE AS is_retargeting, att_status, registration_event = 'true' AS registered,
  first_activity_uploaded = 'true' AS first_activity, paywall_viewed = 'true' AS paywall_viewed,
  trial_started = 'true' AS trial_started, subscribed = 'true' AS subscribed, subscription_type,
  CAST(subscription_value_usd AS DOUBLE) AS subscription_value_usd,
  CAST(NULLIF(days_to_subscribe, '') AS BIGINT) AS days_to_subscribe, 'appsflyer_pull_api' AS raw_source
FROM raw_installs_old"""


def _json(name: str) -> str:
    return f"CASE WHEN json_valid(event_value) THEN json_extract_string(event_value, '$.{name}') END"


def _events(source: str, appsflyer: str, platform: str, media_source: str, channel: str) -> str:
    return f"""
SELECT CAST(substring(event_time, 1, 10) AS DATE) AS event_date, event_time AS event_timestamp, {appsflyer} AS appsflyer_id,
  customer_user_id, '' AS app_id, event_name, COALESCE(TRY_CAST({_json('value_usd')} AS DOUBLE), 0) AS revenue_usd,
  COALESCE({_json('sport_type')}, '') AS sport_type, COALESCE(TRY_CAST({_json('distance_km')} AS DOUBLE), 0) AS distance_km,
  TRY_CAST({_json('duration_min')} AS BIGINT) AS duration_min, COALESCE({_json('plan')}, '') AS subscription_plan,
  COALESCE({_json('platform')}, '') AS share_platform, COALESCE({_json('reason')}, '') AS cancel_reason,
  event_value AS event_properties, {platform} AS platform, '' AS country, {media_source} AS media_source,
  {channel} AS channel, 'appsflyer_pull_api_v5' AS raw_source
FROM {source}"""


MODELS["cdm_events"] = _events("raw_events", "appsflyer_id", "lower(platform)", "media_source", _CHANNEL)
MODELS["recent_events"] = _events("raw_recent_events", "''", "''", "''", "''")
MODELS["old_events"] = """
SELECT event_id, user_id, event_name, CAST(substring(event_timestamp, 1, 10) AS DATE) AS event_date, event_timestamp,
  lower(platform) AS platform, app_version, session_id, properties FROM raw_app_events"""

_COUNTS = (
    "COUNT(appsflyer_id) AS installs, COUNT(*) FILTER (registered) AS registrations, "
    "COUNT(*) FILTER (first_activity) AS first_activities, COUNT(*) FILTER (paywall_viewed) AS paywall_views, "
    "COUNT(*) FILTER (trial_started) AS trials, COUNT(*) FILTER (subscribed) AS subscriptions, "
    "CAST(SUM(CAST(subscription_value_usd AS DECIMAL(38, 18))) AS DOUBLE) AS revenue_usd"
)
_ATT = (
    "COUNT(*) FILTER (att_status = 'authorized') AS ios_att_authorized, "
    "COUNT(*) FILTER (att_status = 'denied') AS ios_att_denied, COUNT(*) FILTER (is_skan) AS skan_installs"
)
_DAILY = {
    "reg_rate": ("registrations", "installs"),
    "act_rate": ("first_activities", "registrations"),
    "paywall_rate": ("paywall_views", "first_activities"),
    "trial_rate": ("trials", "paywall_views"),
    "sub_rate": ("subscriptions", "trials"),
    "overall_cvr": ("subscriptions", "installs"),
}
_daily = ", ".join(f"{frame(div0(a, b), 4)} AS {n}" for n, (a, b) in _DAILY.items())
_daily_old = ", ".join(
    f"{frame(f'(CAST({a} AS DOUBLE) / CASE WHEN {b} = 0 THEN 1 ELSE {b} END)', 4)} AS {n}" for n, (a, b) in _DAILY.items()
)
MODELS["funnel_summary"] = f"""
SELECT * EXCLUDE (revenue_usd), {frame('revenue_usd', 2)} AS revenue_usd, {_daily},
  {frame(div0('revenue_usd', 'installs'), 2)} AS ltv_per_install, {frame(div0('revenue_usd', 'subscriptions'), 2)} AS arpu,
  {frame(div0('ios_att_authorized', '(ios_att_authorized + ios_att_denied)'), 4)} AS ios_att_rate,
  {frame(div0('skan_installs', 'installs'), 4)} AS skan_pct
FROM (SELECT install_date, channel, {_COUNTS}, {_ATT} FROM cdm_installs GROUP BY 1, 2)"""
MODELS["funnel_summary_old"] = (
    f"SELECT *, {_daily_old} FROM (SELECT install_date, channel, {_COUNTS} FROM old_installs GROUP BY 1, 2)"
)
MODELS["cohort_table"] = f"""
SELECT *, {status('sub_rate')} AS funnel_status FROM (
SELECT * EXCLUDE (avg_days), {frame('avg_days', 1)} AS avg_days_to_sub, {frame(div0('subscribers', 'installs'), 4)} AS sub_rate,
  {frame(div0('revenue_usd', 'subscribers'), 2)} AS arpu, {frame(div0('revenue_usd', 'installs'), 2)} AS ltv_per_install
FROM (SELECT {month('install_date')} AS cohort_month, channel, subscription_type, COUNT(appsflyer_id) AS installs,
  COUNT(*) FILTER (subscribed) AS subscribers, CAST(SUM(CAST(subscription_value_usd AS DECIMAL(38, 18))) AS DOUBLE) AS revenue_usd,
  AVG(CAST(days_to_subscribe AS DOUBLE)) AS avg_days FROM cdm_installs GROUP BY 1, 2, 3))"""

# --- staging -------------------------------------------------------------------------------


def _stg_paid(source: str) -> str:
    cost, value = "COALESCE(cost_usd, 0)", "COALESCE(conversion_value_usd, 0)"
    whole = ", ".join(
        f"{long(f'COALESCE({c}, 0)')} AS {c}"
        for c in "impressions clicks installs conversions video_views video_completions engagements likes comments shares".split()
    )
    blank = ", ".join(
        f"NULLIF(TRIM({c}), '') AS {c}" for c in "campaign_id campaign_name ad_group_id ad_group_name ad_id ad_name".split()
    )
    return f"""
SELECT date, LOWER(TRIM(platform)) AS platform, channel_type, {blank}, LOWER(TRIM(objective)) AS objective,
  UPPER(TRIM(country)) AS country, {whole}, ROUND({cost}, 2) AS cost_usd, ROUND({value}, 2) AS conversion_value_usd,
  {div(cost, 'impressions')} * 1000 AS cpm, {div(cost, 'clicks')} AS cpc, {div('clicks', 'impressions')} AS ctr,
  {div(cost, 'installs')} AS cpi, {div(cost, 'conversions')} AS cps, {div(value, cost)} AS roas,
  attribution_window, raw_source
FROM {source} WHERE date IS NOT NULL AND {cost} >= 0"""


def _stg_installs(source: str) -> str:
    return f"""
SELECT install_date, TRIM(appsflyer_id) AS appsflyer_id, NULLIF(TRIM(customer_user_id), '') AS customer_user_id,
  LOWER(TRIM(media_source)) AS media_source, TRIM(channel) AS channel, NULLIF(TRIM(campaign_id), '') AS campaign_id,
  LOWER(TRIM(platform)) AS platform, UPPER(TRIM(country)) AS country, TRIM(device_type) AS device_type,
  TRIM(att_status) AS att_status, COALESCE(is_retargeting, FALSE) AS is_retargeting,
  COALESCE(is_primary_attribution, TRUE) AS is_primary_attribution, COALESCE(is_skan, FALSE) AS is_skan,
  COALESCE(registered, FALSE) AS registered, COALESCE(first_activity, FALSE) AS first_activity,
  COALESCE(paywall_viewed, FALSE) AS paywall_viewed, COALESCE(trial_started, FALSE) AS trial_started,
  COALESCE(subscribed, FALSE) AS subscribed, NULLIF(TRIM(subscription_type), '') AS subscription_type,
  ROUND(COALESCE(subscription_value_usd, 0), 2) AS subscription_value_usd, days_to_subscribe, raw_source
FROM {source} WHERE is_primary_attribution = TRUE AND install_date IS NOT NULL"""


MODELS["faulty_paid"] = FAULTY_PAID
MODELS["faulty_installs"] = FAULTY_INSTALLS
MODELS["stg_paid"] = _stg_paid("cdm_paid")
MODELS["stg_faulty_paid"] = _stg_paid("faulty_paid")
MODELS["stg_installs"] = _stg_installs("cdm_installs")
MODELS["stg_faulty_installs"] = _stg_installs("faulty_installs")
MODELS["stg_recent_installs"] = _stg_installs("recent_installs")
MODELS["stg_organic"] = f"""
SELECT date, LOWER(TRIM(platform)) AS platform, channel_type, TRIM(post_id) AS post_id, TRIM(content_type) AS content_type,
  TRIM(topic) AS topic, COALESCE(is_viral, FALSE) AS is_viral, reach, impressions, likes, comments, shares, saves,
  engagements, video_views, avg_watch_time_s, video_completion_rate, follower_delta, outbound_clicks,
  {div('likes + comments + shares + saves', 'reach')} AS blended_engagement_rate, platform_engagement_rate, raw_source
FROM cdm_organic WHERE date IS NOT NULL AND reach >= 0"""
MODELS["stg_paid_old"] = """
SELECT date, platform, channel_type, campaign_id, campaign_name, objective, ad_group_id, ad_group_name, ad_id, ad_name,
  country, impressions, clicks, ROUND(cost_usd, 2) AS cost_usd, installs, conversions,
  ROUND(conversion_value_usd, 2) AS conversion_value_usd, video_views, video_completions, engagements,
  attribution_window, raw_source FROM old_paid WHERE date IS NOT NULL AND cost_usd > 0"""
MODELS["stg_organic_old"] = """
SELECT date, platform, channel_type, post_id, content_type, topic, is_viral, reach, impressions,
  ROUND(engagement_rate, 5) AS engagement_rate, likes, comments, shares, saves, video_views, avg_watch_time_s,
  video_completion_rate, engagements, follower_delta, raw_source FROM old_organic"""
MODELS["stg_installs_old"] = """
SELECT install_date, appsflyer_id, customer_user_id, media_source, channel, campaign_id, platform, country, device_type,
  is_retargeting, att_status, registered, first_activity, paywall_viewed, trial_started, subscribed, subscription_type,
  ROUND(subscription_value_usd, 2) AS subscription_value_usd, days_to_subscribe FROM old_installs"""

# --- marts ---------------------------------------------------------------------------------


def _sums(names: str) -> str:
    return ", ".join(f"{long(f'SUM({n})')} AS {n}" for n in names.split())


def _ratios(**pairs: tuple[str, str]) -> str:
    return ", ".join(f"{div(a, b)} AS {n}" for n, (a, b) in pairs.items())


_EFFICIENCY = (
    f"{div('cost_usd', 'impressions')} * 1000 AS cpm, "
    + _ratios(
        cpc=("cost_usd", "clicks"), ctr=("clicks", "impressions"), cpi=("cost_usd", "installs"),
        cps=("cost_usd", "conversions"), roas=("revenue_usd", "cost_usd"),
        video_view_rate=("video_views", "impressions"), engagement_rate=("engagements", "impressions"),
    )
)
_DAY_KEYS = "date, platform, campaign_id, campaign_name, objective, country"
MODELS["mart_performance"] = f"""
SELECT *, {_EFFICIENCY}, {div('video_completions', 'video_views')} AS video_completion_rate FROM (
SELECT {_DAY_KEYS}, {_sums('impressions clicks installs conversions video_views video_completions engagements')},
  CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE) AS cost_usd, CAST(SUM(CAST(conversion_value_usd AS DECIMAL(38, 18))) AS DOUBLE) AS revenue_usd, MAX(attribution_window) AS attribution_window
FROM stg_paid GROUP BY {_DAY_KEYS})"""
MODELS["mart_performance_old"] = f"""
SELECT *, {_EFFICIENCY} FROM (
SELECT {_DAY_KEYS}, {_sums('impressions clicks installs conversions video_views engagements')},
  CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE) AS cost_usd, CAST(SUM(CAST(conversion_value_usd AS DECIMAL(38, 18))) AS DOUBLE) AS revenue_usd, MAX(attribution_window) AS attribution_window
FROM stg_paid_old GROUP BY {_DAY_KEYS})"""

_STAGES = _COUNTS.replace("COUNT(appsflyer_id)", "COUNT(*)") + (
    ", AVG(CASE WHEN subscribed THEN CAST(days_to_subscribe AS DOUBLE) END) AS avg_days_to_subscribe"
)
_STAGE_RATES = _ratios(
    install_to_reg_rate=("registrations", "installs"), reg_to_activation_rate=("first_activities", "registrations"),
    activation_to_paywall_rate=("paywall_views", "first_activities"), paywall_to_trial_rate=("trials", "paywall_views"),
    trial_to_sub_rate=("subscriptions", "trials"), overall_cvr=("subscriptions", "installs"),
    ltv_per_install=("revenue_usd", "installs"),
)


def _funnel(source: str) -> str:
    return f"""
SELECT *, {_STAGE_RATES}, {div('revenue_usd', 'subscriptions')} AS arpu,
  {div('ios_att_authorized', '(ios_att_authorized + ios_att_denied)')} AS ios_att_rate,
  {div('skan_installs', 'installs')} AS skan_pct, {status(div('subscriptions', 'installs'))} AS funnel_status
FROM (SELECT {month('install_date')} AS cohort_month, channel, platform, country, {_STAGES}, {_ATT}
  FROM {source} GROUP BY 1, 2, 3, 4)"""


MODELS["mart_funnel"] = _funnel("stg_installs")
MODELS["mart_faulty_funnel"] = _funnel("stg_faulty_installs")
MODELS["mart_funnel_old"] = f"""
SELECT *, {_STAGE_RATES} FROM (SELECT {month('install_date')} AS cohort_month, channel, platform, country, {_STAGES}
  FROM stg_installs_old GROUP BY 1, 2, 3, 4)"""


def _ltv(source: str) -> str:
    mix = ", ".join(
        f"{div(f'COUNT(*) FILTER (subscription_type = {p!r})', 'COUNT(*) FILTER (subscribed)')} AS {p}_mix"
        for p in ("annual", "monthly", "family")
    )
    return f"""
SELECT {month('install_date')} AS cohort_month, channel, platform, COALESCE(subscription_type, 'unknown') AS subscription_type,
  COUNT(*) AS installs, COUNT(*) FILTER (subscribed) AS subscribers, CAST(SUM(CAST(subscription_value_usd AS DECIMAL(38, 18))) AS DOUBLE) AS cohort_revenue_usd,
  {div('COUNT(*) FILTER (subscribed)', 'COUNT(*)')} AS sub_rate,
  {div('CAST(SUM(CAST(subscription_value_usd AS DECIMAL(38, 18))) AS DOUBLE)', 'COUNT(*) FILTER (subscribed)')} AS arpu,
  {div('CAST(SUM(CAST(subscription_value_usd AS DECIMAL(38, 18))) AS DOUBLE)', 'COUNT(*)')} AS ltv_per_install,
  AVG(CASE WHEN subscribed THEN CAST(days_to_subscribe AS DOUBLE) END) AS avg_days_to_convert, {mix}
FROM {source} GROUP BY {month('install_date')}, channel, platform, COALESCE(subscription_type, 'unknown')"""


MODELS["mart_ltv"] = _ltv("stg_installs")
MODELS["mart_faulty_ltv"] = _ltv("stg_faulty_installs")
MODELS["mart_ltv_old"] = f"""
SELECT {month('install_date')} AS cohort_month, channel, subscription_type, COUNT(*) AS installs,
  COUNT(*) FILTER (subscribed) AS subscribers, CAST(SUM(CAST(subscription_value_usd AS DECIMAL(38, 18))) AS DOUBLE) AS cohort_revenue_usd,
  {div('CAST(SUM(CAST(subscription_value_usd AS DECIMAL(38, 18))) AS DOUBLE)', 'COUNT(*) FILTER (subscribed)')} AS arpu_subscribers,
  {div('CAST(SUM(CAST(subscription_value_usd AS DECIMAL(38, 18))) AS DOUBLE)', 'COUNT(*)')} AS ltv_per_install,
  AVG(CASE WHEN subscribed THEN days_to_subscribe END) AS avg_days_to_convert
FROM stg_installs_old GROUP BY 1, 2, 3"""

_POSTS = (
    f"{month('date')} AS month, platform, content_type, topic, COUNT(post_id) AS posts, "
    "COUNT(*) FILTER (is_viral) AS viral_posts, "
    + ", ".join(
        f"{long(f'SUM({c})')} AS {n}"
        for n, c in {
            "total_reach": "reach", "total_impressions": "impressions", "total_engagements": "engagements",
            "total_video_views": "video_views", "net_follower_growth": "follower_delta",
        }.items()
    )
    + ", AVG(avg_watch_time_s) AS avg_watch_time_s, AVG(video_completion_rate) AS avg_completion_rate"
)
MODELS["mart_organic"] = f"""
SELECT {_POSTS}, {long('SUM(outbound_clicks)')} AS total_outbound_clicks,
  AVG(blended_engagement_rate) AS avg_engagement_rate,
  AVG(CASE WHEN is_viral THEN CAST(reach AS DOUBLE) END)
    / NULLIF(AVG(CASE WHEN NOT is_viral THEN CAST(reach AS DOUBLE) END), 0) AS viral_reach_multiplier
FROM stg_organic GROUP BY 1, 2, 3, 4"""
MODELS["mart_organic_old"] = f"""
SELECT {_POSTS}, AVG(engagement_rate) AS avg_engagement_rate,
  {div('SUM(engagements)', 'SUM(reach)')} AS blended_engagement_rate
FROM stg_organic_old GROUP BY 1, 2, 3, 4"""

# --- reports -------------------------------------------------------------------------------

MODELS["paid_weekly"] = f"""
SELECT {week('date')} AS week, CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE) AS total_spend, {long('SUM(impressions)')} AS paid_impressions,
  {long('SUM(installs)')} AS total_installs, {long('SUM(conversions)')} AS paid_subscriptions,
  CAST(SUM(CAST(revenue_usd AS DECIMAL(38, 18))) AS DOUBLE) AS paid_revenue FROM mart_performance GROUP BY 1"""
MODELS["organic_weekly"] = f"""
SELECT {week('date')} AS week, {long('SUM(reach)')} AS organic_reach, {long('SUM(engagements)')} AS organic_engagements,
  AVG(blended_engagement_rate) AS avg_organic_eng_rate, {long('SUM(follower_delta)')} AS follower_growth
FROM stg_organic GROUP BY 1"""
MODELS["executive_summary"] = f"""
SELECT COALESCE(p.week, o.week) AS week, total_spend, paid_impressions, total_installs, paid_subscriptions, paid_revenue,
  {div('paid_revenue', 'total_spend')} AS blended_roas, {div('total_spend', 'total_installs')} AS blended_cpi,
  organic_reach, organic_engagements, avg_organic_eng_rate, follower_growth,
  {div('paid_revenue', 'total_spend')} AS paid_roas,
  {div('total_spend', '(paid_impressions + COALESCE(organic_reach, 0))')} * 1000 AS blended_cpm_all_media
FROM paid_weekly p FULL OUTER JOIN organic_weekly o ON p.week = o.week"""
MODELS["platform_comparison"] = f"""
SELECT platform, COUNT(DISTINCT campaign_id) AS campaigns, COUNT(DISTINCT date) AS active_days,
  CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE) AS total_spend, {long('SUM(impressions)')} AS total_impressions, {long('SUM(installs)')} AS total_installs,
  {long('SUM(conversions)')} AS total_conversions, CAST(SUM(CAST(revenue_usd AS DECIMAL(38, 18))) AS DOUBLE) AS total_revenue, AVG(cpm) AS avg_cpm,
  AVG(ctr) AS avg_ctr, AVG(cpi) AS avg_cpi, AVG(roas) AS avg_roas, {div('CAST(SUM(CAST(revenue_usd AS DECIMAL(38, 18))) AS DOUBLE)', 'CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE)')} AS overall_roas,
  {div('SUM(installs)', 'SUM(impressions)')} AS install_rate, MAX(attribution_window) AS attribution_window
FROM mart_performance GROUP BY 1"""

_WORD = re.compile(r"[a-z_]+")


def statement(select: str, doubles: str = "") -> str:
    """`select` with the expressions it needs in front, its `doubles` rounded to six digits."""
    if doubles:
        rounded = ", ".join(f"round_even(CAST({d} AS DOUBLE), 6) AS {d}" for d in doubles.split())
        select = f"SELECT * REPLACE ({rounded}) FROM ({select}) AS result"
    definitions = {**FEEDS, **MODELS}
    needed: set[str] = set()
    waiting = [select]
    while waiting:
        for word in set(_WORD.findall(waiting.pop())):
            if word in definitions and word not in needed:
                needed.add(word)
                waiting.append(definitions[word])
    order = [n for n in definitions if n in needed]
    tables = ",\n".join(f"{n} AS ({definitions[n].strip()})" for n in order)
    return f"WITH {tables}\n{select}" if tables else select

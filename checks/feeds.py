"""Raw feeds derived from the supplied tables.

The same SQL text runs in Spark (tables are passed in) and in DuckDB (tables are views), so
both sides of a comparison start from the same rows.  Only integer arithmetic, `floor` and
exact binary fractions are used, so no rounding rule can make the feeds differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("nation", "supplier", "orders", "lineitem", "events", "documents")

FEEDS: dict[str, str] = {}

FEEDS["raw_ads"] = """
SELECT CASE l.l_suppkey % 3 WHEN 0 THEN 'tiktok' WHEN 1 THEN 'instagram_meta' ELSE 'reddit' END AS platform,
  CAST(CAST(l.l_shipdate AS DATE) AS STRING) AS date_text,
  'C_' || CAST(l.l_partkey % 5 AS STRING) AS campaign_id,
  'Campaign ' || CAST(l.l_partkey % 5 AS STRING) AS campaign_name,
  CASE l.l_returnflag WHEN 'A' THEN 'REACH' WHEN 'N' THEN 'APP_INSTALL' ELSE 'CONVERSIONS' END AS objective,
  'AG_' || CAST(l.l_suppkey % 20 AS STRING) AS ad_group_id,
  'AD_' || CAST(l.l_partkey AS STRING) AS ad_id,
  n.n_name AS country,
  CAST(floor(l.l_extendedprice) AS BIGINT) AS impressions,
  CAST(floor(l.l_quantity) AS BIGINT) * 10 AS clicks,
  CAST(floor(l.l_extendedprice * l.l_discount * 10) AS DOUBLE) / CAST(100 AS DOUBLE) AS spend,
  CASE WHEN l.l_returnflag = 'N' THEN CAST(floor(l.l_quantity) AS BIGINT) ELSE 0 END AS installs,
  CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_linenumber AS BIGINT) ELSE 0 END AS conversions,
  CASE WHEN l.l_returnflag <> 'R' THEN '[]' WHEN l.l_partkey % 2 = 0 THEN '0.5'
    ELSE '[{"action_type":"purchase","value":"1.25"}]' END AS purchase_roas,
  CAST(floor(l.l_extendedprice) AS BIGINT) % 997 AS video_views,
  CAST(floor(l.l_extendedprice) AS BIGINT) % 499 AS video_completions,
  l.l_orderkey % 41 AS likes, l.l_orderkey % 17 AS comments, l.l_orderkey % 11 AS shares,
  l.l_orderkey % 5 AS follows_or_saves
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
"""

FEEDS["raw_tiktok_ads"] = """
SELECT date_text AS stat_time_day, campaign_id, campaign_name, objective AS objective_type,
  ad_group_id AS adgroup_id, ad_id, country AS country_code,
  CAST(impressions AS STRING) AS impressions, clicks, spend, installs AS app_install,
  conversions AS conversion, CAST(conversions * 5 AS DOUBLE) / CAST(2 AS DOUBLE) AS value,
  video_views AS video_play_actions, video_completions AS video_views_p100,
  likes, comments, shares, follows_or_saves AS follows
FROM raw_ads WHERE platform = 'tiktok'
"""

FEEDS["raw_meta_ads"] = """
SELECT date_text AS date_start, campaign_id, campaign_name, objective, ad_group_id AS adset_id,
  ad_id, country, impressions, clicks AS link_clicks, spend, installs AS mobile_app_installs,
  conversions AS purchases, purchase_roas, video_views,
  video_completions AS video_thruplay_watched_actions, likes AS post_reactions,
  comments AS post_comments, shares AS post_shares, follows_or_saves AS post_saves
FROM raw_ads WHERE platform = 'instagram_meta'
"""

FEEDS["raw_reddit_ads"] = """
SELECT date_text || 'T00:00:00Z' AS date, campaign_id, campaign_name, objective, ad_group_id,
  ad_id, country, impressions, clicks, spend AS spend_usd,
  CAST(impressions % 50 AS DOUBLE) / CAST(4 AS DOUBLE) AS ecpm,
  CAST(clicks % 7 AS DOUBLE) / CAST(8 AS DOUBLE) AS ecpc,
  CAST(clicks % 64 AS DOUBLE) / CAST(128 AS DOUBLE) AS ctr,
  installs AS app_installs, likes AS upvotes, comments, shares, video_views
FROM raw_ads WHERE platform = 'reddit'
"""

_INSTALL_COLUMNS = """
  CASE o_orderpriority WHEN '1-URGENT' THEN 'tiktokglobal_int' WHEN '2-HIGH' THEN 'facebook' WHEN '3-MEDIUM' THEN 'reddit_int'
    WHEN '5-LOW' THEN 'organic' ELSE 'partner_x' END AS media_source,
  'C_' || CAST(o_custkey % 5 AS STRING) AS campaign_id,
  CASE WHEN o_orderstatus = 'O' THEN 'Android' ELSE 'iOS' END AS platform,
  CASE o_custkey % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'GB' ELSE ' de ' END AS country_code,
  CASE o_orderstatus WHEN 'F' THEN 'authorized' WHEN 'P' THEN 'denied' ELSE 'not_applicable' END AS att_status,
  CASE WHEN o_orderstatus = 'P' THEN 'SKAN_' || CAST(o_orderkey % 900 AS STRING) ELSE '' END AS skad_campaign_id,
  CASE WHEN o_orderkey % 10 = 0 THEN 'false' ELSE 'true' END AS is_primary_attribution,
  CASE WHEN (o_orderkey * 7919) % 100 < 82 THEN 'true' ELSE 'false' END AS registration,
  CASE WHEN (o_orderkey * 7919) % 100 < 58 THEN 'TRUE' ELSE 'false' END AS first_activity_uploaded,
  CASE WHEN (o_orderkey * 7919) % 100 < 32 THEN 'yes' ELSE 'no' END AS paywall_viewed,
  CASE WHEN (o_orderkey * 7919) % 100 < 12 THEN '1' ELSE '0' END AS trial_started,
  CASE WHEN (o_orderkey * 7919) % 100 < 6 THEN 'true' ELSE 'false' END AS subscribed,
  CASE WHEN (o_orderkey * 7919) % 100 >= 6 THEN '' WHEN o_custkey % 3 = 0 THEN 'monthly' WHEN o_custkey % 3 = 1 THEN 'annual' ELSE 'family' END AS subscription_type,
  CASE WHEN (o_orderkey * 7919) % 100 >= 6 THEN '0' WHEN o_custkey % 3 = 0 THEN '11.99' WHEN o_custkey % 3 = 1 THEN '79.99' ELSE '139.99' END AS subscription_value_usd,
  CASE WHEN (o_orderkey * 7919) % 100 < 6 THEN CAST(o_orderkey % 15 AS STRING) ELSE '' END AS days_to_subscribe
"""

FEEDS["raw_installs"] = f"""
SELECT 'af_' || CAST(o_orderkey AS STRING) AS appsflyer_id,
  CASE WHEN o_orderstatus = 'P' OR (o_orderkey * 7919) % 100 >= 82 THEN '' ELSE 'cu_' || CAST(o_custkey AS STRING) END AS customer_user_id,
  CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:00:00' AS install_time,
  {_INSTALL_COLUMNS}
FROM orders
"""

# The same installs in the months of the events and with the events' users, for the joins.
FEEDS["raw_recent_installs"] = f"""
SELECT 'af_' || CAST(o_orderkey AS STRING) AS appsflyer_id,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'cu_' || CAST(o_custkey % (SELECT MAX(user_id) + 1 FROM events) AS STRING) END AS customer_user_id,
  CAST(DATE '2023-10-01' + CAST(o_orderkey % 120 AS INT) AS STRING) || ' 10:00:00' AS install_time,
  {_INSTALL_COLUMNS}
FROM orders
"""

# The older install report: other names, the channel already given, flags as plain words.
FEEDS["raw_installs_old"] = """
SELECT appsflyer_id, customer_user_id, install_time, media_source, media_source || '_channel' AS channel,
  campaign_id AS campaign, platform, country_code, att_status, registration AS registration_event,
  first_activity_uploaded, paywall_viewed, trial_started, subscribed, subscription_type,
  subscription_value_usd, days_to_subscribe, CAST(4 AS STRING) || '.1' AS app_version
FROM raw_installs
"""

FEEDS["raw_events"] = """
SELECT event_id, CAST(date_trunc('second', ts) AS STRING) AS event_time, 'af_' || CAST(user_id AS STRING) AS appsflyer_id,
  'cu_' || CAST(user_id AS STRING) AS customer_user_id,
  CASE event_type WHEN 'view' THEN 'paywall_viewed' WHEN 'signup' THEN 'registration' WHEN 'purchase' THEN 'subscription_started'
    WHEN 'click' THEN 'activity_uploaded' ELSE 'subscription_cancelled' END AS event_name,
  CASE WHEN event_id % 50 = 0 THEN 'bad{' WHEN event_type = 'purchase' THEN replace(props, '"k"', '"value_usd"')
    WHEN event_type = 'click' THEN replace(props, '"k"', '"duration_min"') ELSE props END AS event_value,
  CASE event_id % 2 WHEN 0 THEN 'iOS' ELSE 'Android' END AS platform,
  CASE event_id % 4 WHEN 0 THEN 'facebook' WHEN 1 THEN 'reddit_int' WHEN 2 THEN 'organic' ELSE 'partner_x' END AS media_source
FROM events
"""

# Subscription and invitation events spread over five months.
FEEDS["raw_recent_events"] = """
SELECT event_id, CAST(CAST(ts AS DATE) + CAST(event_id % 5 * 30 AS INT) AS STRING) || ' 12:00:00' AS event_time,
  CASE WHEN event_id % 11 = 0 THEN '' ELSE 'cu_' || CAST(user_id AS STRING) END AS customer_user_id,
  CASE event_type WHEN 'view' THEN 'friend_invited' WHEN 'signup' THEN 'subscription_started'
    WHEN 'purchase' THEN 'subscription_renewed' WHEN 'click' THEN 'activity_uploaded'
    ELSE 'subscription_cancelled' END AS event_name,
  CASE WHEN event_type IN ('signup', 'purchase')
    THEN '{"value_usd": ' || CAST(event_id % 4 * 6 AS STRING) || ', "plan": "' ||
      CASE event_id % 3 WHEN 0 THEN 'annual' WHEN 1 THEN 'monthly' ELSE 'family' END || '"}'
    ELSE '' END AS event_value
FROM events
"""

FEEDS["raw_app_events"] = """
SELECT 'ev_' || CAST(event_id AS STRING) AS event_id, 'u_' || CAST(user_id AS STRING) AS user_id,
  event_type AS event_name, CAST(CAST(ts AS DATE) AS STRING) || 'T10:00:00Z' AS event_timestamp,
  CASE event_id % 2 WHEN 0 THEN 'iOS' ELSE 'Android' END AS platform,
  CASE event_id % 3 WHEN 0 THEN '4.1.0' ELSE '4.2.0' END AS app_version,
  'ss_' || CAST(event_id % 100 AS STRING) AS session_id, props AS properties
FROM events
"""

FEEDS["raw_organic"] = """
SELECT CASE doc_id % 3 WHEN 0 THEN 'instagram' WHEN 1 THEN 'tiktok' ELSE 'reddit' END AS platform,
  CAST(doc_id AS STRING) AS post_id, source AS content_type, lang AS topic, doc_id % 13 = 0 AS is_viral,
  883612800 + (doc_id % 180) * 86400 + 43200 AS posted_unix,
  CAST(DATE '1998-01-01' + CAST(doc_id % 180 AS INT) AS STRING) || 'T12:00:00+0000' AS posted_text,
  n_chars AS reach, n_chars * 2 AS impressions, n_chars % 97 AS likes, n_chars % 31 AS comments, n_chars % 13 AS shares,
  n_chars % 7 AS saves, n_chars % 501 AS video_views, (n_chars % 100) * 250 AS watch_ms,
  doc_id % 50 - 20 AS follower_delta, n_chars % 19 AS outbound_clicks
FROM documents
"""

FEEDS["raw_instagram_posts"] = """
SELECT post_id AS media_id, content_type AS media_type, posted_text AS timestamp, topic, is_viral,
  reach, impressions, likes AS like_count, comments AS comments_count, saves AS saved, shares,
  video_views, watch_ms AS avg_watch_time_ms, outbound_clicks AS website_clicks,
  follower_delta AS follows, likes AS profile_visits
FROM raw_organic WHERE platform = 'instagram'
"""

FEEDS["raw_tiktok_posts"] = """
SELECT post_id AS id, posted_unix AS create_time, content_type, topic, is_viral,
  impressions AS play_count, likes AS like_count, comments AS comment_count, shares AS share_count,
  saves AS collect_count, CAST(watch_ms AS DOUBLE) / CAST(1000 AS DOUBLE) AS average_time_watched,
  CAST(likes AS DOUBLE) / CAST(128 AS DOUBLE) AS full_video_watched_rate,
  CAST(shares AS DOUBLE) / CAST(64 AS DOUBLE) AS engagement_rate,
  CASE WHEN reach % 5 <> 0 THEN reach END AS reach, follower_delta AS fans_delta,
  comments AS profile_visits
FROM raw_organic WHERE platform = 'tiktok'
"""

FEEDS["raw_reddit_posts"] = """
SELECT post_id, posted_unix AS created_utc, content_type AS post_type, topic, is_viral,
  likes - 20 AS score, CAST(comments AS DOUBLE) / CAST(32 AS DOUBLE) AS upvote_ratio,
  comments AS num_comments, shares AS num_shares, CASE WHEN reach % 4 <> 0 THEN reach END AS unique_views,
  saves AS awards_count, video_views, follower_delta AS subscriber_delta, outbound_clicks
FROM raw_organic WHERE platform = 'reddit'
"""

FEEDS["raw_mixed_posts"] = """
SELECT post_id, platform, content_type, topic, substring(posted_text, 1, 10) AS published_date, is_viral,
  reach, impressions, CAST(likes AS DOUBLE) / CAST(1024 AS DOUBLE) AS engagement_rate, likes, comments, shares,
  CASE WHEN platform = 'instagram' THEN saves END AS saves,
  CASE WHEN platform = 'instagram' THEN video_views END AS video_views,
  CASE WHEN platform = 'tiktok' THEN impressions END AS total_play,
  CASE WHEN platform <> 'reddit' THEN CAST(watch_ms AS DOUBLE) / CAST(1000 AS DOUBLE) END AS avg_watch_time_s,
  CASE WHEN platform = 'tiktok' THEN CAST(likes AS DOUBLE) / CAST(128 AS DOUBLE) END AS completion_rate,
  CASE WHEN platform = 'instagram' THEN follower_delta END AS follower_delta,
  CASE WHEN platform = 'tiktok' THEN follower_delta END AS fans_delta,
  CASE WHEN platform = 'reddit' THEN follower_delta END AS subscriber_delta,
  CASE WHEN platform = 'reddit' THEN outbound_clicks END AS outbound_clicks
FROM raw_organic
"""

# Ad rows with planted faults, one kind per remainder of the likes; every rule has offenders.
_PAID_COLUMNS = """date, platform, channel_type, campaign_id, campaign_name, objective, ad_group_id,
  ad_group_name, ad_id, ad_name, country, impressions, clicks, cost_usd, installs, conversions,
  conversion_value_usd, video_views, video_completions, engagements, likes, comments, shares,
  cpm, cpc, ctr, cpi, cps, roas, attribution_window, raw_source"""
FAULTY_PAID = """
SELECT CASE WHEN likes = 40 THEN CAST(NULL AS DATE) ELSE date END AS date,
  CASE WHEN likes = 39 THEN 'snapchat' ELSE platform END AS platform, channel_type,
  CASE WHEN likes = 38 THEN NULL ELSE campaign_id END AS campaign_id, campaign_name, objective,
  CASE WHEN likes > 30 THEN NULL ELSE ad_group_id END AS ad_group_id, ad_group_name, ad_id, ad_name,
  CASE WHEN likes = 37 THEN NULL ELSE country END AS country,
  CASE WHEN likes = 36 THEN CAST(60000000 AS BIGINT) ELSE impressions END AS impressions,
  CASE WHEN likes = 35 THEN impressions + 1 ELSE clicks END AS clicks,
  CASE WHEN likes = 34 THEN CAST(-1 AS DOUBLE) WHEN likes = 33 THEN CAST(600000 AS DOUBLE)
    WHEN likes = 32 THEN CAST(NULL AS DOUBLE) ELSE cost_usd END AS cost_usd,
  CASE WHEN likes = 31 THEN clicks + 5 ELSE installs END AS installs, conversions,
  conversion_value_usd, video_views, video_completions, engagements, likes, comments, shares,
  CASE WHEN likes = 30 THEN CAST(2000 AS DOUBLE) ELSE cpm END AS cpm, cpc,
  CASE WHEN likes = 29 THEN CAST(0.75 AS DOUBLE) ELSE ctr END AS ctr,
  CASE WHEN likes = 28 THEN CAST(0 AS DOUBLE) WHEN likes = 27 THEN CAST(20000 AS DOUBLE) ELSE cpi END AS cpi, cps,
  CASE WHEN likes = 26 THEN CAST(75 AS DOUBLE) ELSE roas END AS roas,
  CASE WHEN likes = 25 THEN '30d_click' WHEN likes = 24 THEN '7d_click_1d_view' WHEN likes = 23 THEN NULL
    ELSE attribution_window END AS attribution_window, raw_source, '' AS _extracted_at, '' AS _pipeline_version
FROM cdm_paid
"""
FAULTY_INSTALLS = """
SELECT CASE WHEN subscription_type = 'family' THEN 'af_same' ELSE appsflyer_id END AS appsflyer_id,
  CASE WHEN is_skan AND campaign_id = 'C_1' THEN 'cu_x' ELSE customer_user_id END AS customer_user_id,
  install_date, media_source, CASE WHEN campaign_id = 'C_0' AND subscribed THEN NULL ELSE channel END AS channel,
  campaign_id, platform, country, '' AS device_type,
  CASE WHEN campaign_id = 'C_4' THEN 'n/a' ELSE att_status END AS att_status,
  is_retargeting, is_primary_attribution, is_skan, registered AND campaign_id <> 'C_2' AS registered,
  first_activity, paywall_viewed, trial_started, subscribed, subscription_type,
  CASE WHEN campaign_id = 'C_3' THEN -subscription_value_usd ELSE subscription_value_usd END AS subscription_value_usd,
  days_to_subscribe, raw_source, '' AS _extracted_at
FROM cdm_installs
"""

_NAME = re.compile(r"[a-z_]+")


def feed(spark: SparkSession, sf_dir: str, name: str, **frames: DataFrame) -> DataFrame:
    """A derived feed; `frames` are tables the text names besides the supplied ones."""
    text = FEEDS.get(name, name)
    words = set(_NAME.findall(text))
    for other in FEEDS:
        if other in words and other not in frames and other != name:
            frames[other] = feed(spark, sf_dir, other)
    for table in TABLES:
        if re.search(rf"\b(FROM|JOIN) {table}\b", text):
            frames[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    # Tables go in as arguments of the statement, so no view of the session is touched.
    text = text.replace("{", "{{").replace("}", "}}")
    for table in frames:
        text = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", text)
    return spark.sql(text, **{n: f for n, f in frames.items() if f"{{{n}}}" in text})

"""Queries: feeds to the common data model, staging, marts, reports, previews, lifecycle joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import (
    AS_OF,
    COHORT,
    CONTENT,
    DAILY,
    DAILY_OLD,
    HEALTH,
    HEALTH_OLD,
    LTV,
    ORGANIC_DOUBLES,
    PAID_DOUBLES,
    PERFORMANCE,
    PERFORMANCE_OLD,
    STAGES,
    STAGES_OLD,
    STAMP,
    Inputs,
    query,
)
from checks.oracle import div, frame, long, month, week
from mediatide.operators import attribution, lifecycle, marts, organic, paid, profile, reports, staging

# --- feeds to the common data model ---------------------------------------------------------


@query("P1 C2 C7 C13 C24 P24 P25", "SELECT * FROM cdm_tiktok", PAID_DOUBLES)
def paid_tiktok(i: Inputs) -> DataFrame:
    return i.ads[0]


@query("P2 C2 C6 C35", "SELECT * FROM cdm_meta", PAID_DOUBLES)
def paid_meta(i: Inputs) -> DataFrame:
    return i.ads[1]


@query("P3 C19", "SELECT * FROM cdm_reddit", PAID_DOUBLES)
def paid_reddit(i: Inputs) -> DataFrame:
    return i.ads[2]


@query("P4 C4 C23", "SELECT * FROM old_tiktok", PAID_DOUBLES)
def paid_tiktok_rounded(i: Inputs) -> DataFrame:
    return i.old_ads[0]


@query("P5 C4", "SELECT * FROM old_meta", PAID_DOUBLES)
def paid_meta_rounded(i: Inputs) -> DataFrame:
    return i.old_ads[1]


@query("P6 C4", "SELECT * FROM old_reddit", PAID_DOUBLES)
def paid_reddit_rounded(i: Inputs) -> DataFrame:
    return i.old_ads[2]


@query("U1 P21 P23 O1", "SELECT * FROM cdm_paid", PAID_DOUBLES)
def paid_union_sorted(i: Inputs) -> DataFrame:
    return paid.sorted_ads(paid.fill_numbers(i.cdm_paid))


@query("U1 O2", "SELECT * FROM old_paid", PAID_DOUBLES)
def paid_union_rounded_sorted(i: Inputs) -> DataFrame:
    return paid.sorted_ads(i.old_paid, by_ad=False)


@query("F11", "SELECT * FROM cdm_paid WHERE platform = 'reddit'", PAID_DOUBLES)
def paid_rows_of_one_platform(i: Inputs) -> DataFrame:
    return paid.rows_for_platform(i.cdm_paid, "reddit")


@query("P7 C12 C23 C24", "SELECT * FROM cdm_instagram_posts", ORGANIC_DOUBLES)
def organic_instagram(i: Inputs) -> DataFrame:
    return organic.combine_posts(i.posts[:1])


@query("P8 C25 C32 C13", "SELECT * FROM cdm_tiktok_posts", ORGANIC_DOUBLES)
def organic_tiktok(i: Inputs) -> DataFrame:
    return organic.combine_posts(i.posts[1:2])


@query("P9 C25 C32", "SELECT * FROM cdm_reddit_posts", ORGANIC_DOUBLES)
def organic_reddit(i: Inputs) -> DataFrame:
    return organic.combine_posts(i.posts[2:])


@query("P10 C13 C20", "SELECT * FROM old_organic", "engagement_rate avg_watch_time_s video_completion_rate")
def organic_mixed_feed(i: Inputs) -> DataFrame:
    return i.old_organic


@query("U2 P22 O2", "SELECT * FROM cdm_organic", ORGANIC_DOUBLES)
def organic_union_sorted(i: Inputs) -> DataFrame:
    return organic.sorted_posts(i.cdm_organic)


@query("P11 F5 J2 C8 C9 C11 C36", "SELECT * FROM cdm_installs", "subscription_value_usd")
def installs_cdm(i: Inputs) -> DataFrame:
    return i.cdm_installs


@query("P12 C10", "SELECT * FROM old_installs", "subscription_value_usd")
def installs_cdm_old(i: Inputs) -> DataFrame:
    return i.old_installs


@query("P13 C33 C34", "SELECT * FROM cdm_events", "revenue_usd distance_km")
def in_app_events_cdm(i: Inputs) -> DataFrame:
    return i.cdm_events


@query("P14", "SELECT * FROM old_events")
def app_events_cdm_old(i: Inputs) -> DataFrame:
    return attribution.app_events(i.raw("raw_app_events"))


@query(
    "J2 C36",
    "SELECT channel, media_source, COUNT(*) AS installs FROM cdm_installs GROUP BY 1, 2",
)
def channel_lookup(i: Inputs) -> DataFrame:
    named = i.raw("raw_installs").where("is_primary_attribution = 'true'")
    named = named.withColumn("channel", attribution.channel_of(F.col("media_source")))
    return profile.group_sizes(named, "channel", "media_source", name="installs")


# --- staging --------------------------------------------------------------------------------


@query("P15 F1 F2 C1 C15 C16 C17 C18 C21 C22", "SELECT * FROM stg_paid", PAID_DOUBLES)
def stg_paid_media(i: Inputs) -> DataFrame:
    return i.stg_paid


@query("P16 F6 C14", "SELECT * FROM stg_installs", "subscription_value_usd")
def stg_installs(i: Inputs) -> DataFrame:
    return i.stg_installs


@query("P17 F4", "SELECT * FROM stg_organic", ORGANIC_DOUBLES)
def stg_organic(i: Inputs) -> DataFrame:
    return i.stg_organic


@query("P18 F1 F3 C31", "SELECT * FROM stg_paid_old", "cost_usd conversion_value_usd")
def stg_paid_media_old(i: Inputs) -> DataFrame:
    return staging.stg_paid_media_old(i.old_paid)


@query("P19", "SELECT * FROM stg_organic_old", "engagement_rate avg_watch_time_s video_completion_rate")
def stg_organic_old(i: Inputs) -> DataFrame:
    return staging.stg_organic_old(i.old_organic)


@query("P20", "SELECT * FROM stg_installs_old", "subscription_value_usd")
def stg_installs_old(i: Inputs) -> DataFrame:
    return staging.stg_installs_old(i.old_installs)


# --- marts and summaries --------------------------------------------------------------------


@query("A1 A23 C37 P24", "SELECT * FROM mart_performance", PERFORMANCE)
def mart_channel_performance_daily(i: Inputs) -> DataFrame:
    return i.performance


@query("A2 A23", "SELECT * FROM mart_performance_old", PERFORMANCE_OLD)
def mart_channel_performance_daily_old(i: Inputs) -> DataFrame:
    return i.performance_old


@query("A3 A18 A19 P26 C26 C28", "SELECT * FROM mart_funnel", STAGES)
def mart_funnel_by_channel(i: Inputs) -> DataFrame:
    return i.funnel


@query("A4 P26", "SELECT * FROM mart_funnel_old", STAGES_OLD)
def mart_funnel_by_channel_old(i: Inputs) -> DataFrame:
    return i.funnel_old


@query("A5 A18 A19 X6", "SELECT * FROM mart_ltv", LTV)
def mart_ltv_cohort(i: Inputs) -> DataFrame:
    return marts.ltv_cohort(i.stg_installs)


@query(
    "A6",
    "SELECT * FROM mart_ltv_old",
    "cohort_revenue_usd arpu_subscribers ltv_per_install avg_days_to_convert",
)
def mart_ltv_cohort_old(i: Inputs) -> DataFrame:
    return marts.ltv_cohort_old(staging.stg_installs_old(i.old_installs))


@query("A7 A19 X7", "SELECT * FROM mart_organic", f"{CONTENT} viral_reach_multiplier")
def mart_organic_performance(i: Inputs) -> DataFrame:
    return marts.organic_performance(i.stg_organic)


@query("A8", "SELECT * FROM mart_organic_old", f"{CONTENT} blended_engagement_rate")
def mart_organic_performance_old(i: Inputs) -> DataFrame:
    return marts.organic_performance_old(staging.stg_organic_old(i.old_organic))


@query("A15 A21 C3 C23", "SELECT * FROM funnel_summary", DAILY)
def funnel_summary(i: Inputs) -> DataFrame:
    return attribution.funnel_summary(i.cdm_installs, STAMP)


@query("A16 C5", "SELECT * FROM funnel_summary_old", DAILY_OLD)
def funnel_summary_old(i: Inputs) -> DataFrame:
    return attribution.funnel_summary_old(i.old_installs)


@query("A17 A22 C26 C28", "SELECT * FROM cohort_table", COHORT)
def ltv_cohort_table(i: Inputs) -> DataFrame:
    return i.cohort_table


# --- reports --------------------------------------------------------------------------------

_WEEKLY = (
    "total_spend paid_revenue blended_roas blended_cpi avg_organic_eng_rate paid_roas blended_cpm_all_media"
)


@query("A9 J1 O3 C29", "SELECT * FROM executive_summary", _WEEKLY)
def rpt_executive_summary(i: Inputs) -> DataFrame:
    return reports.executive_summary(i.performance, i.stg_organic)


@query(
    "J1 A9",
    "SELECT COALESCE(p.week, o.week) AS week, total_spend, organic_reach FROM "
    "(SELECT * FROM paid_weekly WHERE week < DATE '1998-02-15') p FULL OUTER JOIN organic_weekly o ON p.week = o.week",
    "total_spend",
)
def weeks_of_one_side_only(i: Inputs) -> DataFrame:
    """The weekly report with paid rows up to a day, so that both sides lack weeks."""
    early = i.performance.where("date < DATE '1998-02-16'")
    return reports.executive_summary(early, i.stg_organic).select("week", "total_spend", "organic_reach")


@query(
    "A10 O3",
    f"SELECT {week('date')} AS week, CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE) AS total_spend, {long('SUM(impressions)')} AS total_impressions, "
    f"{long('SUM(installs)')} AS total_installs, {long('SUM(conversions)')} AS total_subscriptions, "
    f"CAST(SUM(CAST(revenue_usd AS DECIMAL(38, 18))) AS DOUBLE) AS total_revenue, {div('CAST(SUM(CAST(revenue_usd AS DECIMAL(38, 18))) AS DOUBLE)', 'CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE)')} AS blended_roas, "
    f"{div('CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE)', 'SUM(installs)')} AS blended_cpi, {div('CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE)', 'SUM(conversions)')} AS blended_cps "
    "FROM mart_performance_old GROUP BY 1",
    "total_spend total_revenue blended_roas blended_cpi blended_cps",
)
def rpt_executive_summary_old(i: Inputs) -> DataFrame:
    return reports.executive_summary_old(i.performance_old)


_AVERAGES = "avg_cpm avg_ctr avg_cpi avg_roas overall_roas"


@query(
    "A11 A20 A23 O4",
    "SELECT * FROM platform_comparison",
    f"total_spend total_revenue install_rate {_AVERAGES}",
)
def rpt_platform_comparison(i: Inputs) -> DataFrame:
    return reports.platform_comparison(i.performance)


@query(
    "A12 O4",
    f"SELECT platform, CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE) AS total_spend, {long('SUM(installs)')} AS total_installs, "
    f"{long('SUM(conversions)')} AS total_conversions, CAST(SUM(CAST(revenue_usd AS DECIMAL(38, 18))) AS DOUBLE) AS total_revenue, AVG(cpm) AS avg_cpm, "
    f"AVG(ctr) AS avg_ctr, AVG(cpi) AS avg_cpi, AVG(roas) AS avg_roas, "
    f"{div('CAST(SUM(CAST(revenue_usd AS DECIMAL(38, 18))) AS DOUBLE)', 'CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE)')} AS overall_roas FROM mart_performance_old GROUP BY 1",
    f"total_spend total_revenue {_AVERAGES}",
)
def rpt_platform_comparison_old(i: Inputs) -> DataFrame:
    return reports.platform_comparison_old(i.performance_old)


@query(
    "A13 F8 O5 C27 C30",
    "SELECT cohort_month, channel, installs, subscriptions, overall_cvr, ltv_per_install, revenue_usd, funnel_status, "
    "CASE WHEN funnel_status = 'at_risk' AND installs >= 100 THEN 'ALERT: High volume, low CVR' "
    "WHEN funnel_status = 'watch' THEN 'Monitor' ELSE 'OK' END AS action_required, avg_days_to_subscribe, "
    f"ios_att_rate, skan_pct FROM mart_funnel WHERE cohort_month >= DATE '2001-06-01'",
    HEALTH,
)
def rpt_funnel_health(i: Inputs) -> DataFrame:
    return reports.funnel_health(i.funnel, AS_OF)


@query(
    "A14 F7 O5 C26",
    "SELECT cohort_month, channel, installs, subscriptions, overall_cvr, ltv_per_install, revenue_usd, "
    "CASE WHEN overall_cvr >= 0.05 THEN 'healthy' WHEN overall_cvr >= 0.03 THEN 'watch' ELSE 'at_risk' END AS funnel_status "
    "FROM mart_funnel_old WHERE cohort_month = DATE '2001-07-01'",
    HEALTH_OLD,
)
def rpt_funnel_health_old(i: Inputs) -> DataFrame:
    return reports.funnel_health_old(i.funnel_old, "2001-07-15")


@query(
    "O6",
    "SELECT cohort_month, channel, subscription_type, installs, subscribers, revenue_usd, ltv_per_install, funnel_status "
    "FROM cohort_table ORDER BY revenue_usd DESC, cohort_month, channel, subscription_type LIMIT 6",
    "revenue_usd ltv_per_install",
)
def top_cohorts(i: Inputs) -> DataFrame:
    return reports.top_cohorts(i.cohort_table)


_SAMPLE = "date platform campaign_name impressions clicks cost_usd installs cpi attribution_window".split()


@query(
    "O7",
    f"SELECT {', '.join(_SAMPLE)} FROM cdm_paid ORDER BY {', '.join(_SAMPLE)} LIMIT 3",
    "cost_usd cpi",
)
def sample_rows(i: Inputs) -> DataFrame:
    return reports.sample_rows(i.cdm_paid.select(*_SAMPLE), _SAMPLE, 3)


# --- previews -------------------------------------------------------------------------------


@query(
    "A24",
    "SELECT channel, COUNT(appsflyer_id) AS installs, COUNT(*) FILTER (subscribed) AS subscribed, "
    f"{frame('CAST(SUM(CAST(subscription_value_usd AS DECIMAL(38, 18))) AS DOUBLE)', 3)} AS revenue_usd, {frame('AVG(CAST(subscribed AS INT))', 3)} AS overall_cvr "
    "FROM cdm_installs GROUP BY 1",
    "revenue_usd overall_cvr",
)
def channel_preview(i: Inputs) -> DataFrame:
    return profile.channel_preview(i.cdm_installs)


@query("A25", "SELECT platform, attribution_window, COUNT(*) AS rows FROM cdm_paid GROUP BY 1, 2")
def rows_per_window(i: Inputs) -> DataFrame:
    return profile.group_sizes(i.cdm_paid, "platform", "attribution_window")


@query("A25", "SELECT att_status, COUNT(*) AS installs FROM cdm_installs GROUP BY 1")
def installs_per_consent(i: Inputs) -> DataFrame:
    return profile.group_sizes(i.cdm_installs, "att_status", name="installs")


@query(
    "A26",
    "SELECT COUNT(*) FILTER (is_skan) AS skan_installs, AVG(CAST(is_skan AS INT)) AS skan_pct FROM cdm_installs",
    "skan_pct",
)
def skan_share(i: Inputs) -> DataFrame:
    return profile.skan_share(i.cdm_installs)


@query(
    "A27",
    f"SELECT funnel_status, COUNT(installs) AS rows, {long('SUM(installs)')} AS installs, CAST(SUM(CAST(revenue_usd AS DECIMAL(38, 18))) AS DOUBLE) AS revenue "
    "FROM cohort_table GROUP BY 1",
    "revenue",
)
def status_rollup(i: Inputs) -> DataFrame:
    return profile.status_rollup(i.cohort_table)


@query(
    "A28 G3",
    f"SELECT platform, COUNT(campaign_id) AS rows, {frame('CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE)', 2)} AS spend_usd, "
    f"{long('SUM(impressions)')} AS impressions, {long('SUM(installs)')} AS installs, {frame('AVG(cpi)', 2)} AS avg_cpi, "
    f"{frame('AVG(ctr)', 2)} AS avg_ctr, format('${{:,}}', {long(frame('CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE)', 0))}) AS spend_text "
    "FROM cdm_paid GROUP BY 1",
    "spend_usd avg_cpi avg_ctr",
)
def paid_preview(i: Inputs) -> DataFrame:
    return profile.paid_preview(i.cdm_paid)


@query(
    "A29",
    f"SELECT platform, COUNT(post_id) AS posts, COUNT(*) FILTER (is_viral) AS viral, {long('SUM(reach)')} AS total_reach, "
    f"{long('SUM(engagements)')} AS total_eng, {frame('AVG(blended_engagement_rate)', 4)} AS avg_eng_rate, "
    f"{frame('AVG(avg_watch_time_s)', 3)} AS avg_watch_s, {long('SUM(follower_delta)')} AS follower_growth "
    "FROM cdm_organic GROUP BY 1",
    "avg_eng_rate avg_watch_s",
)
def organic_preview(i: Inputs) -> DataFrame:
    return profile.organic_preview(i.cdm_organic)


@query("A30", "SELECT MIN(date) AS first_day, MAX(date) AS last_day FROM cdm_paid")
def date_range(i: Inputs) -> DataFrame:
    return profile.date_range(i.cdm_paid)


_NULLABLE = "date campaign_id ad_group_id country cost_usd attribution_window platform".split()


@query(
    "A31",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT(*) FILTER ({c} IS NULL) AS nulls FROM faulty_paid" for c in _NULLABLE
    )
    + ") WHERE nulls > 0",
)
def null_counts(i: Inputs) -> DataFrame:
    return profile.null_counts(i.faulty_paid.select(*_NULLABLE))


@query(
    "A32",
    "SELECT platform, CASE platform WHEN 'instagram' THEN 'video_completion_rate,platform_engagement_rate' "
    "WHEN 'tiktok' THEN '' ELSE 'avg_watch_time_s,video_completion_rate' END AS empty_columns "
    "FROM cdm_organic GROUP BY 1",
)
def empty_columns(i: Inputs) -> DataFrame:
    return profile.empty_columns(i.cdm_organic)


@query(
    "A33",
    "SELECT platform, AVG(blended_engagement_rate) AS avg_blended, AVG(platform_engagement_rate) AS avg_native, "
    "AVG(avg_watch_time_s) AS avg_watch_s FROM cdm_organic GROUP BY 1",
    "avg_blended avg_native avg_watch_s",
)
def rate_check(i: Inputs) -> DataFrame:
    return profile.rate_check(i.cdm_organic)


# --- joins of attribution with spend and events ---------------------------------------------


@query(
    "J3 X1",
    f"""SELECT v.*, spend_usd, {div('revenue_usd', 'installs')} AS ltv_per_install, {div('spend_usd', 'installs')} AS cac,
  {div('revenue_usd', 'installs')} / NULLIF({div('spend_usd', 'installs')}, 0) AS ltv_to_cac
FROM (SELECT cohort_month, channel, {long('SUM(installs)')} AS installs, CAST(SUM(CAST(cohort_revenue_usd AS DECIMAL(38, 18))) AS DOUBLE) AS revenue_usd
  FROM mart_ltv GROUP BY 1, 2) v
LEFT JOIN (SELECT {month('date')} AS cohort_month, CASE platform WHEN 'tiktok' THEN 'TikTok Ads'
  WHEN 'instagram_meta' THEN 'Meta Ads' ELSE 'Reddit Ads' END AS channel, CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE) AS spend_usd
  FROM mart_performance GROUP BY 1, 2) s ON v.cohort_month = s.cohort_month AND v.channel = s.channel""",
    "revenue_usd spend_usd ltv_per_install cac ltv_to_cac",
)
def ltv_to_cac(i: Inputs) -> DataFrame:
    return lifecycle.ltv_to_cac(marts.ltv_cohort(i.stg_installs), i.performance)


@query(
    "J4",
    f"""SELECT a.*, spend_usd, clicks, reported_installs, {div('spend_usd', 'attributed_installs')} AS cost_per_attributed_install
FROM (SELECT campaign_id, COUNT(*) AS attributed_installs, COUNT(*) FILTER (subscribed) AS subscriptions,
  CAST(SUM(CAST(subscription_value_usd AS DECIMAL(38, 18))) AS DOUBLE) AS revenue_usd FROM stg_installs GROUP BY 1) a
LEFT JOIN (SELECT campaign_id, CAST(SUM(CAST(cost_usd AS DECIMAL(38, 18))) AS DOUBLE) AS spend_usd, {long('SUM(clicks)')} AS clicks,
  {long('SUM(installs)')} AS reported_installs FROM stg_paid GROUP BY 1) r ON a.campaign_id = r.campaign_id""",
    "revenue_usd spend_usd cost_per_attributed_install",
)
def campaign_acquisition(i: Inputs) -> DataFrame:
    return lifecycle.campaign_acquisition(i.stg_installs, i.stg_paid)


_FIRST = """(SELECT customer_user_id, first.install_date AS install_date, first.channel AS channel FROM (
  SELECT customer_user_id, MIN({'install_date': install_date, 'appsflyer_id': appsflyer_id, 'channel': channel}) AS first
  FROM recent_installs WHERE NOT is_skan AND customer_user_id <> '' GROUP BY 1))"""


@query(
    "J5",
    "SELECT e.event_date, e.event_name, e.customer_user_id, e.revenue_usd, f.install_date, f.channel AS install_channel "
    f"FROM recent_events e JOIN {_FIRST} f ON e.customer_user_id = f.customer_user_id",
    "revenue_usd",
)
def attributed_events(i: Inputs) -> DataFrame:
    joined = lifecycle.attributed_events(i.recent_events, i.recent_installs)
    return joined.select(
        "event_date", "event_name", "customer_user_id", "revenue_usd", "install_date", "install_channel"
    )


@query(
    "J5",
    "SELECT appsflyer_id, customer_user_id, install_date FROM recent_installs WHERE NOT is_skan AND customer_user_id <> '' "
    "AND customer_user_id IN (SELECT customer_user_id FROM recent_events)",
)
def installs_with_events(i: Inputs) -> DataFrame:
    rows = lifecycle.installs_with_events(i.recent_installs, i.recent_events)
    return rows.select("appsflyer_id", "customer_user_id", "install_date")


_AGE = "date_diff('day', f.install_date, e.event_date)"


@query(
    "X2",
    f"SELECT {month('f.install_date')} AS cohort_month, f.channel, COUNT(DISTINCT f.customer_user_id) AS users, "
    + ", ".join(
        f"COALESCE(SUM(CASE WHEN {_AGE} BETWEEN 0 AND {n} THEN e.revenue_usd END), 0) AS revenue_{n}d" for n in (30, 60, 90)
    )
    + f" FROM {_FIRST} f LEFT JOIN recent_events e ON e.customer_user_id = f.customer_user_id GROUP BY 1, 2",
    "revenue_30d revenue_60d revenue_90d",
)
def cohort_revenue(i: Inputs) -> DataFrame:
    return lifecycle.cohort_revenue(i.recent_installs, i.recent_events)


_RETAINED = ", ".join(
    f"COUNT(DISTINCT CASE WHEN {_AGE} = {n} THEN f.customer_user_id END) AS retained_d{n}" for n in (30, 90)
)


@query(
    "X3",
    f"SELECT *, {div('retained_d30', 'users')} AS d30_retention, {div('retained_d90', 'users')} AS d90_retention FROM ("
    f"SELECT {month('f.install_date')} AS cohort_month, f.channel, COUNT(DISTINCT f.customer_user_id) AS users, {_RETAINED} "
    f"FROM {_FIRST} f LEFT JOIN recent_events e ON e.customer_user_id = f.customer_user_id GROUP BY 1, 2)",
    "d30_retention d90_retention",
)
def retention(i: Inputs) -> DataFrame:
    return lifecycle.retention(i.recent_installs, i.recent_events)


@query(
    "X4",
    f"""SELECT r.*, new_subscribers, won_back, churned, {long('COALESCE(SUM(new_subscribers + won_back - churned) OVER (ORDER BY r.month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)')} AS subscribers_at_start,
  {div('churned', 'COALESCE(SUM(new_subscribers + won_back - churned) OVER (ORDER BY r.month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)')} AS churn_rate
FROM (SELECT {month('event_date')} AS month, COUNT(*) FILTER (event_name = 'subscription_started') AS started,
    COUNT(*) FILTER (event_name = 'subscription_renewed') AS renewed, COUNT(*) FILTER (event_name = 'subscription_cancelled') AS cancelled,
    COALESCE(SUM(CASE WHEN event_name <> 'subscription_cancelled' THEN revenue_usd / CASE WHEN subscription_plan IN ('annual', 'family') THEN 12 ELSE 1 END END), 0) AS mrr_usd
  FROM recent_events WHERE event_name LIKE 'subscription_%' GROUP BY 1) r
JOIN (SELECT month, COUNT(*) FILTER (active AND before IS NULL) AS new_subscribers, COUNT(*) FILTER (active AND NOT before) AS won_back,
    COUNT(*) FILTER (NOT active AND before) AS churned
  FROM (SELECT month, active, LAG(active) OVER (PARTITION BY customer_user_id ORDER BY month) AS before
    FROM (SELECT customer_user_id, {month('event_date')} AS month,
      substring(MAX(event_timestamp || event_name), 20) <> 'subscription_cancelled' AS active
      FROM recent_events WHERE event_name LIKE 'subscription_%' AND customer_user_id <> '' GROUP BY 1, 2))
  GROUP BY 1) c ON r.month = c.month""",
    "mrr_usd churn_rate",
)
def subscription_months(i: Inputs) -> DataFrame:
    return lifecycle.subscription_months(i.recent_events)


_MAU = f"(SELECT {month('event_date')} AS month, COUNT(DISTINCT customer_user_id) AS mau FROM recent_events WHERE customer_user_id <> '' GROUP BY 1)"


@query(
    "X5",
    f"SELECT date, dau, mau, {div('dau', 'mau')} AS dau_over_mau FROM (SELECT event_date AS date, "
    f"COUNT(DISTINCT customer_user_id) AS dau FROM recent_events WHERE customer_user_id <> '' GROUP BY 1) d "
    f"JOIN {_MAU} m ON m.month = {month('d.date')}",
    "dau_over_mau",
)
def active_users(i: Inputs) -> DataFrame:
    return lifecycle.active_users(i.recent_events)


@query(
    "X7",
    f"SELECT m.month, mau, COALESCE(invites, 0) AS invites, {div('COALESCE(invites, 0)', 'mau')} AS viral_coefficient "
    f"FROM {_MAU} m LEFT JOIN (SELECT {month('event_date')} AS month, COUNT(*) AS invites FROM recent_events "
    "WHERE event_name = 'friend_invited' GROUP BY 1) v ON m.month = v.month",
    "viral_coefficient",
)
def viral_coefficient(i: Inputs) -> DataFrame:
    return lifecycle.viral_coefficient(i.recent_events)

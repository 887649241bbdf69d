import datetime as dt

import pytest
from pyspark.sql import functions as F

from mediatide.operators import lifecycle, marts, reports

DAY = dt.date


def performance(spark, data):
    schema = "date date, platform string, campaign_id string, cost_usd double, impressions bigint, installs bigint, conversions bigint, revenue_usd double"
    df = spark.createDataFrame(data, schema)
    return df.selectExpr(
        "*", "try_divide(cost_usd, impressions) * 1000 AS cpm", "0.1D AS ctr", "try_divide(cost_usd, installs) AS cpi",
        "try_divide(revenue_usd, cost_usd) AS roas", "'30d_click' AS attribution_window",
    )


def posts(spark, data):
    schema = "date date, platform string, reach bigint, is_viral boolean, blended_engagement_rate double"
    return spark.createDataFrame(data, schema).selectExpr(
        "*", "'Reel' AS content_type", "'t' AS topic", "'p' AS post_id", "1L AS impressions", "2L AS engagements", "3L AS video_views",
        "-1L AS follower_delta", "0L AS outbound_clicks", "cast(null as double) AS avg_watch_time_s", "cast(null as double) AS video_completion_rate",
    )


def test_weeks_of_either_side_and_week_start(spark, rows):
    paid = performance(
        spark,
        [
            (DAY(2025, 1, 5), "tiktok", "c", 10.0, 1000, 0, 1, 5.0),  # a Sunday: week of 30 December
            (DAY(2025, 1, 6), "tiktok", "c", 0.0, 0, 0, 0, 0.0),  # a Monday
        ],
    )
    organic = posts(spark, [(DAY(2025, 1, 12), "tiktok", 500, True, 0.1), (DAY(2025, 1, 20), "tiktok", 50, True, None)])
    got = rows(reports.executive_summary(paid, organic))
    assert [r["week"] for r in got] == [DAY(2025, 1, 20), DAY(2025, 1, 6), DAY(2024, 12, 30)]
    only_organic, both, only_paid = got
    assert only_organic["total_spend"] is None and only_organic["organic_reach"] == 50 and only_organic["blended_cpm_all_media"] is None
    assert both["paid_roas"] is None and both["blended_cpi"] is None and both["blended_cpm_all_media"] == 0
    assert only_paid["organic_reach"] is None and only_paid["blended_cpm_all_media"] == 10.0 and only_paid["paid_roas"] == 0.5
    old = rows(reports.executive_summary_old(paid))
    assert [r["week"] for r in old] == [DAY(2024, 12, 30), DAY(2025, 1, 6)] and old[0]["blended_cps"] == 10.0


def test_average_of_ratios_is_not_ratio_of_totals(spark, rows):
    paid = performance(
        spark,
        [
            (DAY(2025, 1, 1), "tiktok", "a", 10.0, 100, 1, 0, 10.0),
            (DAY(2025, 1, 1), "tiktok", "b", 30.0, 100, 0, 0, 0.0),
            (DAY(2025, 1, 2), "tiktok", "a", 0.0, 0, 0, 0, 0.0),
        ],
    )
    got = rows(reports.platform_comparison(paid))[0]
    assert (got["campaigns"], got["active_days"], got["total_spend"]) == (2, 2, 40.0)
    assert (got["avg_roas"], got["overall_roas"], got["avg_cpi"], got["avg_cpm"]) == (0.5, 0.25, 10.0, 200.0)
    assert got["install_rate"] == 0.005
    assert rows(reports.platform_comparison_old(paid))[0]["avg_roas"] == 0.5


def funnel(spark):
    data = [(DAY(2025, m, 1), n, r) for m in (1, 2, 3, 4, 5) for n, r in ((100, 0.01), (99, 0.01), (10, 0.04))]
    return spark.createDataFrame(data, "cohort_month date, installs bigint, overall_cvr double").selectExpr(
        "*", "'TikTok Ads' AS channel", "0L AS subscriptions", "0D AS ltv_per_install", "0D AS revenue_usd",
        "CASE WHEN overall_cvr >= 0.03 THEN 'watch' ELSE 'at_risk' END AS funnel_status", "1D AS avg_days_to_subscribe",
        "1D AS ios_att_rate", "1D AS skan_pct",
    )


def test_funnel_health_covers_three_calendar_months(spark, rows):
    got = rows(reports.funnel_health(funnel(spark), DAY(2025, 4, 30)))
    assert [r["cohort_month"].month for r in got] == [5] * 3 + [4] * 3 + [3] * 3 + [2] * 3
    assert [r["action_required"] for r in got[:3]] == ["ALERT: High volume, low CVR", "OK", "Monitor"]
    old = rows(reports.funnel_health_old(funnel(spark), DAY(2025, 4, 30)))
    assert [(r["cohort_month"].month, r["installs"]) for r in old] == [(4, 100), (4, 99), (4, 10)]
    assert reports.funnel_health(funnel(spark)).count() == 0  # no as_of: today


def test_funnel_without_subscribers_or_trials(spark, rows):
    staged = spark.sql(
        "SELECT DATE '2025-01-31' AS install_date, 'Organic' AS channel, 'ios' AS platform, 'US' AS country, true AS registered, "
        "false AS first_activity, false AS paywall_viewed, false AS trial_started, false AS subscribed, 0D AS subscription_value_usd, "
        "cast(null as bigint) AS days_to_subscribe, 'not_applicable' AS att_status, false AS is_skan, cast(null as string) AS subscription_type"
    )
    got = rows(marts.funnel_by_channel(staged))[0]
    assert got["cohort_month"] == DAY(2025, 1, 1) and got["install_to_reg_rate"] == 1
    assert got["trial_to_sub_rate"] is None and got["arpu"] is None and got["ios_att_rate"] is None
    assert got["funnel_status"] == "at_risk" and got["avg_days_to_subscribe"] is None
    assert rows(marts.ltv_cohort(staged))[0]["subscription_type"] == "unknown"
    assert rows(marts.ltv_cohort_old(staged))[0]["subscription_type"] is None


def test_viral_uplift(spark, rows):
    got = rows(marts.organic_performance(posts(spark, [(DAY(2025, 1, 1), "tiktok", 300, True, 0.1), (DAY(2025, 1, 9), "tiktok", 100, False, 0.3)])))
    assert got[0]["viral_reach_multiplier"] == 3.0 and got[0]["avg_engagement_rate"] == pytest.approx(0.2)
    only = rows(marts.organic_performance(posts(spark, [(DAY(2025, 1, 1), "tiktok", 300, True, 0.1)])))
    assert only[0]["viral_reach_multiplier"] is None


def test_top_cohorts_break_ties_by_key(spark):
    df = spark.createDataFrame([(DAY(2025, 1, 1), c, "annual", 5.0) for c in "hgfedcba"], "cohort_month date, channel string, subscription_type string, revenue_usd double")
    df = df.selectExpr("*", "1L AS installs", "1L AS subscribers", "1D AS ltv_per_install", "'ok' AS funnel_status")
    assert [r["channel"] for r in reports.top_cohorts(df).collect()] == list("abcdef")


# --- joins with events ----------------------------------------------------------------------


def installs(spark, data):
    df = spark.createDataFrame(data, "appsflyer_id string, customer_user_id string, install_date date, is_skan boolean")
    return df.withColumn("channel", F.lit("Organic"))


def events(spark, data):
    schema = "customer_user_id string, event_date date, event_name string, revenue_usd double, subscription_plan string"
    return spark.createDataFrame(data, schema).withColumn("event_timestamp", F.concat(F.col("event_date").cast("string"), F.lit(" 00:00:00")))


def buy(user, day, amount=10.0, name="subscription_renewed", plan="monthly"):
    return (user, day, name, amount, plan)


def test_skan_and_unknown_users_are_not_joined(spark):
    people = installs(
        spark,
        [("a1", "u1", DAY(2025, 1, 2), False), ("a0", "u1", DAY(2025, 1, 1), False), ("a2", "u2", DAY(2025, 1, 1), True), ("a3", " ", DAY(2025, 1, 1), False)],
    )
    log = events(spark, [buy("u1", DAY(2025, 1, 3)), buy("u2", DAY(2025, 1, 3)), buy("", DAY(2025, 1, 3)), buy("u9", DAY(2025, 1, 3))])
    joined = lifecycle.attributed_events(log, people).collect()
    assert [(r["customer_user_id"], r["install_date"]) for r in joined] == [("u1", DAY(2025, 1, 1))]
    assert {r["appsflyer_id"] for r in lifecycle.installs_with_events(people, log).collect()} == {"a0", "a1"}


def test_cohort_revenue_and_retention_at_their_bounds(spark, rows):
    start = DAY(2025, 1, 1)
    people = installs(spark, [("a", "u", start, False), ("b", "silent", start, False)])
    ages = (-1, 0, 30, 31, 60, 90, 91)
    log = events(spark, [buy("u", start + dt.timedelta(days=n)) for n in ages])
    got = rows(lifecycle.cohort_revenue(people, log))[0]
    assert (got["users"], got["revenue_30d"], got["revenue_60d"], got["revenue_90d"]) == (2, 20.0, 40.0, 50.0)
    kept = rows(lifecycle.retention(people, log))[0]
    assert (kept["retained_d30"], kept["retained_d90"], kept["d30_retention"]) == (1, 1, 0.5)


def test_heavy_user_gives_one_row_per_day_before_the_join(spark):
    people = installs(spark, [("a", "heavy", DAY(2025, 1, 1), False)])
    log = spark.range(60000).selectExpr(
        "if(id % 3 = 0, 'heavy', concat('u', id)) AS customer_user_id", "date_add(DATE '2025-01-01', cast(id % 5 as int)) AS event_date",
        "'x' AS event_name", "1D AS revenue_usd",
    )
    days = lifecycle._user_days(log)
    assert days.where("customer_user_id = 'heavy'").count() == 5
    assert lifecycle.cohort_revenue(people, log).first()["revenue_30d"] == 20000.0


def test_subscription_months(spark, rows):
    started, cancelled = "subscription_started", "subscription_cancelled"
    log = events(
        spark,
        [
            buy("u", DAY(2025, 1, 5), 12.0, started, "annual"),
            buy("u", DAY(2025, 3, 1), 0.0, cancelled),
            buy("u", DAY(2025, 4, 1), 10.0, started),
            buy("v", DAY(2025, 1, 7), 10.0, started),
            buy("v", DAY(2025, 2, 7), 10.0),
            buy("w", DAY(2025, 2, 1), 10.0, started),
            buy("w", DAY(2025, 2, 2), 0.0, cancelled),
        ],
    )
    got = {r["month"].month: r for r in rows(lifecycle.subscription_months(log))}
    assert [got[m]["new_subscribers"] for m in (1, 2, 3, 4)] == [2, 0, 0, 0]
    assert [got[m]["churned"] for m in (1, 2, 3, 4)] == [0, 0, 1, 0]
    assert [got[m]["won_back"] for m in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert [got[m]["subscribers_at_start"] for m in (1, 2, 3, 4)] == [0, 2, 2, 1]
    assert [got[m]["churn_rate"] for m in (1, 2, 3, 4)] == [None, 0.0, 0.5, 0.0]
    assert [got[m]["mrr_usd"] for m in (1, 2, 3, 4)] == [11.0, 20.0, 0.0, 10.0]


def test_active_users_and_invitations(spark, rows):
    log = events(spark, [buy("u", DAY(2025, 1, 1)), buy("u", DAY(2025, 1, 1)), buy("v", DAY(2025, 1, 2), name="friend_invited"), buy("", DAY(2025, 1, 2))])
    got = {r["date"]: r for r in rows(lifecycle.active_users(log))}
    assert (got[DAY(2025, 1, 1)]["dau"], got[DAY(2025, 1, 1)]["mau"], got[DAY(2025, 1, 1)]["dau_over_mau"]) == (1, 2, 0.5)
    assert rows(lifecycle.viral_coefficient(log))[0]["viral_coefficient"] == 0.5


def test_value_over_cost_without_spend(spark, rows):
    cohorts = spark.createDataFrame(
        [(DAY(2025, 1, 1), "TikTok Ads", 4, 20.0), (DAY(2025, 1, 1), "Organic", 5, 5.0)], "cohort_month date, channel string, installs bigint, cohort_revenue_usd double"
    )
    paid = performance(spark, [(DAY(2025, 1, 9), "tiktok", "c", 10.0, 1, 99, 0, 0.0)])
    got = {r["channel"]: r for r in rows(lifecycle.ltv_to_cac(cohorts, paid))}
    assert (got["TikTok Ads"]["cac"], got["TikTok Ads"]["ltv_to_cac"]) == (2.5, 2.0)
    assert got["Organic"]["ltv_per_install"] == 1.0 and got["Organic"]["ltv_to_cac"] is None

"""Queries: the quality report and the data tests, on sound rows and on rows with planted faults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.oracle import div
from checks.registry import LTV, ORGANIC_DOUBLES, PAID_DOUBLES, STAGES, Inputs, query
from mediatide.operators import datatests, marts, quality, staging


def _report_sql(table: str) -> str:
    """The report's rules, one SELECT per check."""
    parts = []

    def add(check: str, severity: str, passed: str, affected: str = "0", having: str = "") -> None:
        parts.append(
            f"SELECT '{check}' AS check, '{severity}' AS severity, {passed} AS passed, "
            f"CAST({affected} AS BIGINT) AS rows_affected FROM {table} {having}"
        )

    def none_of(check: str, severity: str, condition: str, having: str = "") -> None:
        n = f"COUNT(*) FILTER ({condition})"
        add(check, severity, f"{n} = 0", n, having)

    # Names of the checks, the columns they look at, and their bounds.
    add("required_columns", "ERROR", "COUNT(*) >= 0")
    add("date_dtype", "ERROR", "COUNT(*) >= 0")
    for c in "impressions clicks cost_usd installs cpm ctr cpi roas".split():
        add(f"dtype_{c}", "ERROR", "COUNT(*) >= 0")
    for c in "date platform campaign_id impressions cost_usd".split():
        none_of(f"no_nulls_{c}", "ERROR", f"{c} IS NULL")
    for c in "ad_group_id ad_name country".split():
        n = f"COUNT(*) FILTER ({c} IS NULL)"
        add(f"low_nulls_{c}", "WARNING", f"{n} < 0.05 * COUNT(*)", n)
    for c, low, high, severity in (
        ("impressions", 0, 50_000_000, "ERROR"), ("cost_usd", 0, 500_000, "ERROR"), ("ctr", 0, 0.5, "WARNING"),
        ("cpm", 0, 1000, "WARNING"), ("cpi", 0, 10_000, "WARNING"), ("roas", 0, 50, "WARNING"),
    ):
        none_of(f"range_{c}", severity, f"{c} < {low} OR {c} > {high}")
    none_of("cost_vs_impressions", "WARNING", "cost_usd = 0 AND impressions > 0")
    none_of("clicks_le_impressions", "ERROR", "clicks > impressions")
    none_of("installs_le_clicks", "WARNING", "installs > clicks")
    none_of("cpi_consistency", "WARNING", "installs > 0 AND cost_usd > 0 AND cpi = 0")
    none_of("reddit_no_roas", "ERROR", "platform = 'reddit' AND roas > 0")
    for platform, window in (("tiktok", "7d_click_1d_view"), ("instagram_meta", "7d_click_1d_view"), ("reddit", "30d_click")):
        none_of(
            f"attribution_window_{platform}", "ERROR",
            f"platform = '{platform}' AND attribution_window IS DISTINCT FROM '{window}'",
            f"HAVING COUNT(*) FILTER (platform = '{platform}') > 0",
        )
    add("all_platforms_present", "WARNING", "COUNT(DISTINCT platform) FILTER (platform IN ('tiktok', 'instagram_meta', 'reddit')) = 3")
    add("minimum_row_count", "WARNING", "COUNT(*) >= 30 * COUNT(DISTINCT date)")
    return " UNION ALL ".join(parts)


def _rules(report: DataFrame) -> DataFrame:
    return report.select("check", "severity", "passed", "rows_affected")


@query("V1 V2 V3 V4 V5 V6 V7 V8 V9 V10 V11 V12 V13 V14 V15 V16", _report_sql("cdm_paid"))
def quality_report(i: Inputs) -> DataFrame:
    return _rules(quality.validate_paid_media(i.cdm_paid))


@query("V4 V5 V6 V7 V9 V10 V11 V12 V13 V14 V16 P23", _report_sql("faulty_paid"))
def quality_report_of_faulty_rows(i: Inputs) -> DataFrame:
    return _rules(quality.validate_paid_media(i.faulty_paid))


@query("V14 V15 U4", _report_sql("(SELECT * FROM cdm_paid WHERE platform = 'tiktok')"))
def quality_report_of_one_platform(i: Inputs) -> DataFrame:
    return _rules(quality.validate_paid_media(i.cdm_paid.where("platform = 'tiktok'")))


_SUMMARY = """SELECT COUNT(*) FILTER (NOT passed AND severity = 'ERROR') = 0 AS passed, COUNT(*) AS checks_run,
  COUNT(*) FILTER (passed) AS checks_passed, COUNT(*) FILTER (NOT passed AND severity = 'ERROR') AS errors,
  COUNT(*) FILTER (NOT passed AND severity = 'WARNING') AS warnings"""


@query("V17 V18", f"{_SUMMARY} FROM ({_report_sql('faulty_paid')})")
def quality_summary(i: Inputs) -> DataFrame:
    return quality.summarise(quality.validate_paid_media(i.faulty_paid))


# --- tests that yield rows ------------------------------------------------------------------


def _faulty_stg_paid(i: Inputs) -> DataFrame:
    return staging.stg_paid_media(i.faulty_paid)


def _faulty_stg_installs(i: Inputs) -> DataFrame:
    return staging.stg_installs(i.faulty_installs)


# Reddit rows get a value so that their recomputed ratio breaks the rule.
_REDDIT_VALUE = "conversion_value_usd + CASE WHEN platform = 'reddit' THEN likes ELSE 0 END"


@query(
    "T1 F9",
    f"SELECT date, ad_id, likes, roas FROM (SELECT *, {div(_REDDIT_VALUE, 'cost_usd')} AS roas FROM "
    "(SELECT date, ad_id, platform, likes, cost_usd, conversion_value_usd FROM stg_paid)) "
    "WHERE platform = 'reddit' AND roas > 0",
    "roas",
)
def test_reddit_no_roas(i: Inputs) -> DataFrame:
    valued = i.cdm_paid.withColumn("conversion_value_usd", F.expr(_REDDIT_VALUE))
    rows = datatests.offending_rows(staging.stg_paid_media(valued), "reddit_no_roas")
    return rows.select("date", "ad_id", "likes", "roas")


@query(
    "T2 F9 F10",
    "SELECT platform, attribution_window, COUNT(*) AS rows FROM stg_faulty_paid WHERE (platform = 'reddit' AND attribution_window <> '30d_click') "
    "OR (platform IN ('tiktok', 'instagram_meta') AND attribution_window <> '7d_click_1d_view') GROUP BY 1, 2",
)
def test_attribution_windows(i: Inputs) -> DataFrame:
    return datatests.wrong_windows(_faulty_stg_paid(i))


@query(
    "T3 U3",
    "SELECT 'paid_media' AS source, date FROM stg_paid WHERE date > DATE '1998-05-01' UNION ALL "
    "SELECT 'installs', install_date FROM stg_installs WHERE install_date > DATE '1998-05-01' UNION ALL "
    "SELECT 'organic', date FROM stg_organic WHERE date > DATE '1998-05-01'",
)
def test_no_future_dates(i: Inputs) -> DataFrame:
    models = {"stg_paid_media": i.stg_paid, "stg_installs": i.stg_installs, "stg_organic": i.stg_organic}
    return datatests.future_dates(models, "1998-05-01")


@query("T4", "SELECT * FROM stg_faulty_paid WHERE clicks > impressions AND impressions > 0", PAID_DOUBLES)
def test_clicks_le_impressions(i: Inputs) -> DataFrame:
    return datatests.offending_rows(_faulty_stg_paid(i), "clicks_le_impressions")


@query(
    "T5",
    "SELECT * FROM stg_organic WHERE platform = 'instagram' AND avg_watch_time_s IS NOT NULL AND (avg_watch_time_s < 1 OR avg_watch_time_s > 120)",
    ORGANIC_DOUBLES,
)
def test_instagram_watch_time(i: Inputs) -> DataFrame:
    return datatests.offending_rows(i.stg_organic, "instagram_watch_time")


@query(
    "T6",
    "SELECT * FROM stg_organic WHERE platform = 'tiktok' AND avg_watch_time_s IS NOT NULL AND (avg_watch_time_s < 1 OR avg_watch_time_s > 600)",
    ORGANIC_DOUBLES,
)
def test_tiktok_watch_time(i: Inputs) -> DataFrame:
    return datatests.offending_rows(i.stg_organic, "tiktok_watch_time")


@query(
    "T7",
    "SELECT * FROM mart_faulty_funnel WHERE registrations > installs OR first_activities > registrations "
    "OR paywall_views > first_activities OR trials > paywall_views OR subscriptions > trials",
    STAGES,
)
def test_funnel_ordering(i: Inputs) -> DataFrame:
    return datatests.offending_rows(marts.funnel_by_channel(_faulty_stg_installs(i)), "funnel_ordering")


@query("T8", "SELECT * FROM mart_faulty_ltv WHERE ltv_per_install < 0", LTV)
def test_ltv_not_negative(i: Inputs) -> DataFrame:
    return datatests.offending_rows(marts.ltv_cohort(_faulty_stg_installs(i)), "ltv_not_negative")


@query(
    "T9",
    "SELECT * FROM stg_organic WHERE blended_engagement_rate > 1 OR blended_engagement_rate < 0",
    ORGANIC_DOUBLES,
)
def test_engagement_rate_bounded(i: Inputs) -> DataFrame:
    return datatests.offending_rows(i.stg_organic, "engagement_rate_bounded")


@query(
    "T10",
    "SELECT * FROM stg_faulty_installs WHERE is_skan AND customer_user_id IS NOT NULL AND TRIM(customer_user_id) <> ''",
    "subscription_value_usd",
)
def test_skan_without_user(i: Inputs) -> DataFrame:
    return datatests.offending_rows(_faulty_stg_installs(i), "skan_without_user")


def _column_test(table: str, column: str, kind: str) -> datatests.ColumnTest:
    found = [t for t in datatests.COLUMN_TESTS if (t.table, t.column, t.kind) == (table, column, kind)]
    return found[0]


@query("T11", "SELECT appsflyer_id, install_date FROM faulty_installs WHERE channel IS NULL")
def test_not_null(i: Inputs) -> DataFrame:
    rows = datatests.column_offenders(i.faulty_installs, _column_test("cdm_installs", "channel", "not_null"))
    return rows.select("appsflyer_id", "install_date")


@query("T12", "SELECT appsflyer_id, COUNT(*) AS rows FROM faulty_installs GROUP BY 1 HAVING COUNT(*) > 1")
def test_unique(i: Inputs) -> DataFrame:
    return datatests.column_offenders(i.faulty_installs, _column_test("cdm_installs", "appsflyer_id", "unique"))


@query(
    "T13",
    "SELECT appsflyer_id, att_status FROM faulty_installs WHERE att_status NOT IN ('authorized', 'denied', 'not_determined', 'not_applicable')",
)
def test_accepted_values(i: Inputs) -> DataFrame:
    test = _column_test("cdm_installs", "att_status", "accepted_values")
    return datatests.column_offenders(i.faulty_installs, test).select("appsflyer_id", "att_status")


@query("T14", "SELECT date, ad_id, likes, ctr FROM stg_faulty_paid WHERE NOT (ctr < 0.5)", "ctr")
def test_expression(i: Inputs) -> DataFrame:
    test = _column_test("stg_paid_media", "ctr", "expression")
    return datatests.column_offenders(_faulty_stg_paid(i), test).select("date", "ad_id", "likes", "ctr")


@query(
    "T15",
    "SELECT 'cdm_funnel_events' AS table, age AS age_hours, CASE WHEN age > 49 THEN 'error' WHEN age > 25 THEN 'warn' ELSE 'pass' END AS status "
    "FROM (SELECT CAST(date_diff('second', MAX(CAST(event_timestamp AS TIMESTAMP)), TIMESTAMP '2024-02-01 06:00:00') AS DOUBLE) / 3600 AS age FROM cdm_events)",
    "age_hours",
)
def test_freshness(i: Inputs) -> DataFrame:
    # The events' own times stand in for the time of extraction, which is fixed in these inputs.
    timed = i.cdm_events.withColumn("_extracted_at", F.col("event_timestamp"))
    return datatests.freshness({"cdm_funnel_events": timed}, "2024-02-01 06:00:00")


def _tests_sql() -> str:
    """Offenders of every test on the faulty paid and install tables and their models."""
    names = {
        "cdm_paid_media_daily": "faulty_paid",
        "cdm_installs": "faulty_installs",
        "stg_paid_media": "stg_faulty_paid",
        "stg_installs": "stg_faulty_installs",
    }
    tests = {
        "cdm_paid_media_daily": {
            "not_null_cdm_paid_media_daily_date": "date IS NULL",
            "not_null_cdm_paid_media_daily_platform": "platform IS NULL",
            "not_null_cdm_paid_media_daily_cost_usd": "cost_usd IS NULL",
            "accepted_values_cdm_paid_media_daily_platform": "platform NOT IN ('tiktok', 'instagram_meta', 'reddit')",
            "accepted_values_cdm_paid_media_daily_attribution_window": "attribution_window NOT IN ('7d_click_1d_view', '30d_click')",
        },
        "cdm_installs": {
            "not_null_cdm_installs_appsflyer_id": "appsflyer_id IS NULL",
            "not_null_cdm_installs_install_date": "install_date IS NULL",
            "not_null_cdm_installs_channel": "channel IS NULL",
            "accepted_values_cdm_installs_att_status": "att_status = 'n/a'",
        },
        "stg_paid_media": {
            "not_null_stg_paid_media_date": "date IS NULL",
            "not_null_stg_paid_media_platform": "platform IS NULL",
            "not_null_stg_paid_media_cost_usd": "cost_usd IS NULL",
            "expression_stg_paid_media_cost_usd": "cost_usd < 0",
            "expression_stg_paid_media_ctr": "ctr >= 0.5",
            "reddit_no_roas": "platform = 'reddit' AND roas > 0",
            "clicks_le_impressions": "clicks > impressions AND impressions > 0",
            "attribution_windows": "(platform = 'reddit' AND attribution_window <> '30d_click') OR "
            "(platform IN ('tiktok', 'instagram_meta') AND attribution_window <> '7d_click_1d_view')",
            "no_future_dates_paid_media": "date > DATE '2001-08-15'",
        },
        "stg_installs": {
            "not_null_stg_installs_appsflyer_id": "appsflyer_id IS NULL",
            "not_null_stg_installs_install_date": "install_date IS NULL",
            "skan_without_user": "is_skan AND TRIM(customer_user_id) <> ''",
            "no_future_dates_installs": "install_date > DATE '2001-08-15'",
        },
    }
    parts = [
        f"SELECT '{table}' AS table, '{test}' AS test, COUNT(*) FILTER ({condition}) AS offenders FROM {names[table]}"
        for table, conditions in tests.items()
        for test, condition in conditions.items()
    ]
    parts.append(
        "SELECT 'cdm_installs', 'unique_cdm_installs_appsflyer_id', COUNT(*) FROM "
        "(SELECT appsflyer_id FROM faulty_installs GROUP BY 1 HAVING COUNT(*) > 1)"
    )
    return "SELECT *, offenders = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


@query("G8 T1 T2 T3 T4 T10 T11 T12 T13 T14", _tests_sql())
def test_run_report(i: Inputs) -> DataFrame:
    tables = {
        "cdm_paid_media_daily": i.faulty_paid,
        "cdm_installs": i.faulty_installs,
        "stg_paid_media": _faulty_stg_paid(i),
        "stg_installs": _faulty_stg_installs(i),
    }
    return datatests.run_tests(tables, "2001-08-15")

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mediatide.operators import datatests, quality
from mediatide.schemas import CDM_PAID_MEDIA


def sound(spark, days=1):
    """Ten rows per platform and day that pass every check."""
    df = spark.range(30 * days).selectExpr(
        "date_add(DATE '2025-01-01', cast(id DIV 30 as int)) AS date",
        "CASE id % 3 WHEN 0 THEN 'tiktok' WHEN 1 THEN 'instagram_meta' ELSE 'reddit' END AS platform", "id",
    )
    values = {f.name: F.lit("x") if f.dataType.simpleString() == "string" else F.lit(1).cast(f.dataType) for f in CDM_PAID_MEDIA.fields[2:]}
    values |= {
        "impressions": F.lit(1000).cast("bigint"), "clicks": F.lit(10).cast("bigint"), "ctr": F.lit(0.01),
        "roas": F.when(F.col("platform") == "reddit", 0.0).otherwise(1.0),
        "attribution_window": F.when(F.col("platform") == "reddit", "30d_click").otherwise("7d_click_1d_view"),
    }
    return df.withColumns(values)


def report(df):
    return {r["check"]: r for r in quality.validate_paid_media(df).collect()}


def test_sound_table_has_34_passing_checks(spark):
    got = report(sound(spark))
    assert len(got) == 34 and all(r["passed"] for r in got.values()), [r for r in got.values() if not r["passed"]]
    summary = quality.summarise(quality.validate_paid_media(sound(spark))).first().asDict()
    assert summary == {"passed": True, "checks_run": 34, "checks_passed": 34, "errors": 0, "warnings": 0}
    quality.gate(list(got.values()))


@pytest.mark.parametrize(
    ("column", "value", "where", "check"),
    [
        *((c, None, "id = 3", f"no_nulls_{c}") for c in quality.NEVER_NULL),
        *((c, None, "id < 2", f"low_nulls_{c}") for c in quality.RARELY_NULL),
        ("impressions", 50_000_001, "id = 3", "range_impressions"),
        ("cost_usd", -0.01, "id = 3", "range_cost_usd"),
        ("ctr", 0.51, "id = 3", "range_ctr"),
        ("cpm", 1000.5, "id = 3", "range_cpm"),
        ("cpi", 10001.0, "id = 3", "range_cpi"),
        ("roas", 50.5, "id = 3", "range_roas"),
        ("cost_usd", 0.0, "id = 3", "cost_vs_impressions"),
        ("clicks", 1001, "id = 3", "clicks_le_impressions"),
        ("installs", 11, "id = 3", "installs_le_clicks"),
        ("cpi", 0.0, "id = 3", "cpi_consistency"),
        ("roas", 0.5, "id = 2", "reddit_no_roas"),
        ("attribution_window", "30d_click", "id = 3", "attribution_window_tiktok"),
        ("attribution_window", None, "id = 1", "attribution_window_instagram_meta"),
        ("attribution_window", "7d_click_1d_view", "id = 2", "attribution_window_reddit"),
    ],
)
def test_one_planted_fault_fails_its_check(spark, column, value, where, check):
    df = sound(spark)
    kind = df.schema[column].dataType
    faulty = df.withColumn(column, F.when(F.expr(where), F.lit(value).cast(kind)).otherwise(F.col(column)))
    got = report(faulty)
    assert not got[check]["passed"] and got[check]["rows_affected"] == (2 if where == "id < 2" else 1)


def test_absent_columns_and_platforms(spark):
    got = report(sound(spark).drop("cpi", "raw_source").where("platform = 'tiktok'"))
    assert not got["required_columns"]["passed"] and "raw_source" in got["required_columns"]["message"]
    assert not {"dtype_cpi", "range_cpi", "cpi_consistency", "attribution_window_reddit"} & set(got)
    assert not got["all_platforms_present"]["passed"] and "reddit" in got["all_platforms_present"]["message"]
    assert not got["minimum_row_count"]["passed"]


def test_wrong_types(spark):
    got = report(sound(spark).withColumn("date", F.lit(1)).withColumn("ctr", F.lit("x")))
    assert not got["date_dtype"]["passed"] and not got["dtype_ctr"]["passed"] and "range_ctr" not in got


def test_not_a_number_is_null_and_in_no_range(spark):
    df = sound(spark).withColumn("cost_usd", F.when(F.col("id") == 3, float("nan")).otherwise(F.col("cost_usd")))
    got = report(df)
    assert got["no_nulls_cost_usd"]["rows_affected"] == 1 and got["range_cost_usd"]["passed"]


def test_empty_table(spark):
    got = report(sound(spark).where("id < 0"))
    assert not got["low_nulls_country"]["passed"] and got["minimum_row_count"]["passed"] and not got["all_platforms_present"]["passed"]


def test_gate_stops_on_errors_only(spark):
    warned = sound(spark).where("id < 20")
    quality.gate(quality.validate_paid_media(warned).collect())
    with pytest.raises(quality.QualityError) as stopped:
        quality.gate(quality.validate_paid_media(sound(spark).withColumn("clicks", F.lit(5000).cast("bigint"))).collect())
    assert [r["check"] for r in stopped.value.failed] == ["clicks_le_impressions"]


def test_report_is_one_scan(spark, tmp_path):
    sound(spark, 3).write.parquet(str(tmp_path / "cdm"))
    plan = quality.validate_paid_media(spark.read.parquet(str(tmp_path / "cdm")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


# --- data tests -----------------------------------------------------------------------------


def test_row_tests_on_one_good_and_one_bad_row(spark):
    cases = {
        "reddit_no_roas": ("platform string, roas double", [("reddit", 0.1)], [("reddit", 0.0), ("reddit", None), ("tiktok", 5.0)]),
        "clicks_le_impressions": ("clicks bigint, impressions bigint", [(2, 1)], [(2, 0), (1, 1), (1, 2)]),
        "instagram_watch_time": ("platform string, avg_watch_time_s double", [("instagram", 0.9), ("instagram", 120.1)], [("instagram", None), ("instagram", 1.0), ("tiktok", 0.1)]),
        "tiktok_watch_time": ("platform string, avg_watch_time_s double", [("tiktok", 600.1)], [("tiktok", 600.0), ("reddit", 900.0)]),
        "funnel_ordering": (
            "installs bigint, registrations bigint, first_activities bigint, paywall_views bigint, trials bigint, subscriptions bigint",
            [(1, 2, 0, 0, 0, 0), (5, 5, 5, 5, 1, 2)], [(5, 5, 4, 3, 2, 1)],
        ),
        "ltv_not_negative": ("ltv_per_install double", [(-0.01,)], [(0.0,), (None,)]),
        "engagement_rate_bounded": ("blended_engagement_rate double", [(1.01,), (-0.01,)], [(0.0,), (1.0,), (None,)]),
        "skan_without_user": ("is_skan boolean, customer_user_id string", [(True, "u")], [(True, None), (True, " "), (False, "u")]),
    }
    assert set(cases) == set(datatests.ROW_TESTS)
    for test, (schema, bad, good) in cases.items():
        df = spark.createDataFrame(bad + good, schema)
        assert datatests.offending_rows(df, test).count() == len(bad), test


def test_freshness_levels(spark):
    stamps = {"fresh": "2025-01-01T00:00:00+00:00", "old": "2024-12-31T00:00:00+00:00", "older": "2024-12-29T22:00:00+00:00"}
    tables = {n: spark.createDataFrame([(s,), (None,)], "_extracted_at string") for n, s in stamps.items()}
    tables["empty"] = spark.createDataFrame([], "_extracted_at string")
    got = {r["table"]: r["status"] for r in datatests.freshness(tables, dt.datetime(2025, 1, 1, 1, 30)).collect()}
    assert got == {"fresh": "pass", "old": "warn", "older": "error", "empty": "error"}


def test_declared_column_tests():
    uses = [t.kind for t in datatests.COLUMN_TESTS]
    assert {k: uses.count(k) for k in set(uses)} == {"not_null": 18, "unique": 1, "accepted_values": 5, "expression": 3}

"""Properties that the physical plans must keep."""

import re
from pathlib import Path

import pytest

from checks.registry import Inputs
from mediatide.operators import attribution, lifecycle, marts, quality, reports, staging
from mediatide.sources import tables
from tests.conftest import SMALL

PACKAGE = Path(__file__).resolve().parents[1] / "mediatide"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SMALL)


@pytest.fixture(scope="module")
def cdm_path(spark, tmp_path_factory, inputs):
    path = str(tmp_path_factory.mktemp("cdm") / "cdm_organic_daily")
    tables.save_table(inputs.cdm_organic, path, "date")
    return path


def test_no_python_in_the_plans_and_no_pairs(inputs):
    for df in (
        inputs.performance, inputs.funnel, inputs.cdm_organic, reports.executive_summary(inputs.performance, inputs.stg_organic),
        lifecycle.cohort_revenue(inputs.recent_installs, inputs.recent_events), lifecycle.subscription_months(inputs.recent_events),
        lifecycle.active_users(inputs.recent_events),
    ):
        text = plan(df)
        assert not re.search("Python|ArrowEval|MapInPandas|CartesianProduct|BroadcastNestedLoop", text)


def test_package_has_no_udf_rdd_or_unbounded_collect():
    # The operators on text have rules of their own.
    for path in (p for p in PACKAGE.rglob("*.py") if "llm" not in p.parts):
        source = path.read_text()
        assert not re.search(r"pandas_udf|F\.udf|\.rdd\b|toPandas|localCheckpoint|crossJoin|F\.broadcast", source), path
        # Two collects are allowed: the quality report of at most 34 rows, and the different headers of landed reports.
        assert source.count(".collect()") == (1 if path.name in ("jobs.py", "landing.py") else 0), path
        # So is the list of months that have changed since the marts were built.
        assert source.count("toLocalIterator") == (1 if path.name == "models.py" else 0), path


def test_all_rows_meet_hash_aggregations_only(spark, inputs, cdm_path):
    """What is nearest to the scan must not sort before it combines."""
    staged = staging.stg_organic(tables.read_table(spark, cdm_path))
    for df in (
        inputs.performance, inputs.funnel, marts.ltv_cohort(inputs.stg_installs), marts.organic_performance(staged),
        reports.platform_comparison(inputs.performance), attribution.funnel_summary(inputs.cdm_installs),
        quality.validate_paid_media(inputs.cdm_paid),
    ):
        kinds = re.findall(r"(Hash|Sort|ObjectHash)Aggregate\(key", plan(df))
        assert kinds[-2:] == ["Hash", "Hash"], plan(df)


def test_the_flagship_mart_shuffles_once(spark, inputs, tmp_path):
    """One hash aggregation of the rows; the list of windows is a subquery over one column."""
    path = str(tmp_path / "paid")
    tables.save_table(inputs.cdm_paid, path, "date")
    staged = staging.stg_paid_media(tables.read_table(spark, path))
    for mart in (marts.channel_performance_daily(staged), marts.channel_performance_daily_old(staged)):
        text = plan(mart)
        assert len(re.findall(r"Exchange hashpartitioning\(date", text)) == 1
        assert "SortAggregate" not in text and "Sort [" not in text
        assert text.count("HashAggregate(keys=[date") == 2
        scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
        assert any(scan.count(":") <= 3 and "attribution_window" in scan for scan in scans), scans


def test_active_users_shuffle_once_by_user(inputs):
    text = plan(lifecycle.active_users(inputs.recent_events))
    assert text.count("Exchange hashpartitioning(user") == 1 and text.count("Exchange hashpartitioning") == 2
    assert text.count("HashAggregate(keys=[user") == 2 and "SortAggregate" not in text


def test_dates_prune_partitions_and_columns_are_pruned(spark, cdm_path):
    staged = staging.stg_organic(tables.read_table(spark, cdm_path))
    text = plan(staged.where("date >= DATE '1998-02-01'").groupBy("platform").sum("outbound_clicks"))
    assert re.search(r"PartitionFilters: \[.*date#\d+ >= 1998-02-01", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert schema == "platform:string,reach:bigint,outbound_clicks:bigint"
    assert "PushedFilters" in text


def test_wide_mappings_stay_in_generated_code(spark, inputs):
    # A star in front of a node marks whole-stage code.  Parsing JSON into a struct has none in
    # Spark; it is one projection of its own, several times faster than eight path lookups.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (*inputs.ads, inputs.stg_paid, inputs.cdm_installs, inputs.cdm_events):
            projects = [line for line in plan(df.select("*")).splitlines() if "Project [" in line and "from_json" not in line]
            assert projects and all("*(" in line for line in projects)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_heavy_users_partition_is_split_in_the_join(spark, tmp_path):
    """A third of all events, or installs, belong to one user; AQE gives that user's partition to several tasks."""
    log = spark.range(0, 400000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 'heavy', concat('u', id % 5000)) AS customer_user_id", "uuid() AS event_name", "DATE '2025-01-01' AS event_date"
    )
    people = spark.range(5000).selectExpr(
        "concat('a', id) AS appsflyer_id", "if(id = 0, 'heavy', concat('u', id)) AS customer_user_id",
        "DATE '2025-01-01' AS install_date", "'Organic' AS channel", "false AS is_skan",
    )
    log.write.parquet(str(tmp_path / "log"))
    people.write.parquet(str(tmp_path / "people"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = lifecycle.attributed_events(
            spark.read.parquet(str(tmp_path / "log")), spark.read.parquet(str(tmp_path / "people"))
        )
        counted = joined.selectExpr("max(length(event_name))", "count(*)")
        assert counted.collect()[0][1] > 250000
        assert "skew=true" in plan(counted)
        installs = log.selectExpr("*", "event_name AS appsflyer_id", "event_date AS install_date", "'x' AS channel", "false AS is_skan")
        installs.write.parquet(str(tmp_path / "installs"))
        kept = lifecycle.installs_with_events(spark.read.parquet(str(tmp_path / "installs")), spark.read.parquet(str(tmp_path / "people")))
        counted = kept.selectExpr("max(length(appsflyer_id))", "count(*)")
        assert counted.collect()[0][1] > 250000
        assert "skew=true" in plan(counted)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")


def test_user_level_steps_reuse_the_joins_partitioning(spark, inputs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lifecycle.cohort_revenue(inputs.recent_installs, inputs.recent_events))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # First days by user, the join of installs with them by a computed key (two), first installs by user, events by user and
    # day, events by user, result by cohort.
    assert text.count("Exchange hashpartitioning") == 7
    assert "SortAggregate" not in text[text.index("min(install_date") :]

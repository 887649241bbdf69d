import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from checks import catalog_loads, catalog_storage
from checks.registry import Inputs
from mediatide import schemas
from mediatide.operators.fields import RunStamp
from mediatide.plans import jobs, models
from mediatide.session import scratch_path, shared_dir
from mediatide.sources import files, landing, tables
from mediatide.streaming import events as event_log

SMALL = "/root/testdata/sf0.001"
DAY = dt.date
STAMP = RunStamp("2025-01-02T00:00:00+00:00", "9")
SCHEMA = schemas._struct("date date NOT NULL, k string, v bigint")


def batch(spark, data):
    return spark.createDataFrame(data, "k string, date date, v int")


def stored(spark, path):
    return sorted(tuple(r) for r in tables.read_table(spark, path, schema=SCHEMA).collect())


def test_rerun_replaces_only_the_days_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = DAY(2025, 1, 1), DAY(2025, 1, 2)
    first = tables.load_table(batch(spark, [("a", one, 1), ("b", two, 2)]), path, SCHEMA)
    assert (first.status, first.table, first.rows, first.first_day, first.last_day) == ("success", "t", 2, one, two)
    for _ in range(2):
        again = tables.load_table(batch(spark, [("c", two, 3), ("d", two, 4)]), path, SCHEMA)
        assert (again.rows, again.first_day) == (2, two)
    assert stored(spark, path) == [(one, "a", 1), (two, "c", 3), (two, "d", 4)]
    empty = tables.load_table(batch(spark, []), path, SCHEMA)
    assert (empty.rows, empty.first_day) == (0, None) and len(stored(spark, path)) == 3
    tables.load_table(batch(spark, [("e", two, 5)]), path, SCHEMA, mode=tables.APPEND)
    assert len(stored(spark, path)) == 4
    tables.load_table(batch(spark, [("f", two, 6)]), path, SCHEMA, mode=tables.TRUNCATE)
    assert stored(spark, path) == [(two, "f", 6)]
    with pytest.raises(ValueError):
        tables.load_table(batch(spark, []), path, SCHEMA, mode="other")


def test_null_in_a_required_column_fails_and_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.load_table(batch(spark, [("a", DAY(2025, 1, 1), 1)]), path, SCHEMA)
    with pytest.raises(Exception, match="date is required"):
        tables.load_table(batch(spark, [("b", None, 1)]), path, SCHEMA)
    with pytest.raises(Exception, match="date is required"):
        tables.load_table(batch(spark, [("b", None, 1)]), path, SCHEMA, dry_run=True)
    assert stored(spark, path) == [(DAY(2025, 1, 1), "a", 1)]


def test_loads_keep_their_own_rejected_rows(spark, tmp_path):
    """A later load with other rejected rows leaves those of an earlier one; repeated, it replaces its own."""
    loose = schemas._struct("date date, k string, v bigint")
    jan, feb = DAY(2025, 1, 1), DAY(2025, 2, 1)
    january = [("a", jan, 1), *[(f"j{i}", None, i) for i in range(5)]]
    february = [("b", feb, 1), *[(f"f{i}", None, i) for i in range(3)]]

    def rejected(path):
        return sorted(r["k"] for r in spark.read.parquet(path + "__rejected").collect())

    both = [f"f{i}" for i in range(3)] + [f"j{i}" for i in range(5)]
    for mode in (tables.INCREMENTAL, tables.APPEND):
        path = str(tmp_path / mode)
        for data, name in ((january, "x/1"), (february, "x/2"), (february, "x/2")):
            got = tables.load_table(batch(spark, data), path, loose, mode=mode, load=name if mode == tables.APPEND else None)
            assert got.rejected == len(data) - 1
        assert rejected(path) == both
    tables.load_table(batch(spark, february[:1]), path, loose, mode=tables.APPEND, load="x/2")
    assert rejected(path) == both[3:]
    path = str(tmp_path / "days")
    for data in (january[1:], february[1:], february[1:]):
        tables.load_table(batch(spark, data), path, loose)
    assert rejected(path) == both
    tables.load_table(batch(spark, january), path, loose, mode=tables.TRUNCATE)
    assert rejected(path) == both[3:]


def test_dry_run_writes_nothing(spark, tmp_path):
    path = tmp_path / "t"
    got = tables.load_table(batch(spark, [("a", DAY(2025, 1, 1), 1)]), str(path), SCHEMA, dry_run=True)
    assert (got.status, got.rows) == ("dry_run", 1) and not path.exists()


def test_run_copies_and_ranges(spark, tmp_path):
    path = str(tmp_path / "runs")
    df = batch(spark, [("a", DAY(2025, 1, 1), 1), ("b", DAY(2025, 1, 5), 2)])
    for day in (1, 2, 2):
        tables.save_run_copy(df, path, DAY(2025, 2, day))
    assert spark.read.parquet(path).groupBy("run_date").count().count() == 2 and spark.read.parquet(path).count() == 4
    table = str(tmp_path / "t")
    tables.save_table(df, table, "date", ("k",))
    assert [r["k"] for r in tables.read_table(spark, table, "date", DAY(2025, 1, 1), DAY(2025, 1, 1)).collect()] == ["a"]


def test_heavy_day_of_a_large_batch_is_split(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        path = str(tmp_path / "t")
        rows = spark.range(0, 900000, numPartitions=8).selectExpr(
            "date_add(DATE '2025-01-01', if(id % 3 = 0, 0, cast(id % 20 as int))) AS date", "uuid() AS k", "id AS v"
        )
        tables.load_table(rows, path, SCHEMA, cluster=("k",))
        files = tables.read_table(spark, path).withColumn("f", F.input_file_name()).groupBy("date", "f").count()
        heavy = files.where("date = DATE '2025-01-01'")
        assert heavy.count() > 2 and heavy.agg(F.sum("count")).first()[0] > 300000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")


def test_ddl_lists_types_and_partition():
    text = tables.table_ddl("db.t", SCHEMA, "date")
    assert text.startswith("CREATE TABLE IF NOT EXISTS db.t") and "`date` DATE NOT NULL" in text and "`v` BIGINT" in text
    assert text.endswith("PARTITIONED BY (`date`)")


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named


def test_date_ranges():
    today = DAY(2025, 1, 10)
    assert jobs.date_range(today=today) == (DAY(2025, 1, 9), DAY(2025, 1, 9))
    assert jobs.date_range(day=DAY(2025, 1, 3), today=today) == (DAY(2025, 1, 3), DAY(2025, 1, 3))
    assert jobs.date_range(start=DAY(2025, 1, 3), today=today) == (DAY(2025, 1, 3), today)
    assert jobs.date_range(start=DAY(2025, 1, 3), end=DAY(2025, 1, 4)) == (DAY(2025, 1, 3), DAY(2025, 1, 4))
    assert jobs.date_range(backfill=True) == (DAY(2024, 10, 1), DAY(2025, 3, 31))


# --- jobs -----------------------------------------------------------------------------------


def ads(spark, clicks=10, days=2):
    return spark.range(10 * days).selectExpr(
        "cast(date_add(DATE '2025-01-01', cast(id DIV 10 as int)) as string) AS day", "concat('a', id) AS ad_id", "'c' AS campaign_id",
        "1000L AS impressions", f"{clicks}L AS clicks", "5D AS spend",
    )


def land_ads(spark, path, clicks=10):
    df = ads(spark, clicks)
    landing.land_rows(df.withColumnRenamed("day", "stat_time_day"), path, "tiktok_ads", "stat_time_day", STAMP)
    landing.land_rows(df.withColumnRenamed("day", "date_start").withColumnRenamed("clicks", "link_clicks"), path, "meta_ads", "date_start", STAMP)
    landing.land_rows(df.selectExpr("concat(day, 'T00:00:00Z') AS date", "ad_id", "impressions", "clicks", "spend AS spend_usd"), path, "reddit_ads", "date", STAMP)


def job(spark, tmp_path, start=DAY(2025, 1, 1), end=DAY(2025, 1, 2), **options):
    return jobs.Job(spark, str(tmp_path / "landing"), str(tmp_path / "warehouse"), start, end, stamp=STAMP, **options)


def test_paid_job_loads_reruns_and_previews(spark, tmp_path):
    land_ads(spark, str(tmp_path / "landing"))
    for _ in range(2):
        run = job(spark, tmp_path)
        result = jobs.paid_media_job(run)
    assert result.status == "success" and result.loads["cdm_paid_media_daily"].rows == 60
    assert {r["platform"]: r["rows"] for r in result.previews["platforms"].collect()} == {"tiktok": 20, "instagram_meta": 20, "reddit": 20}
    assert spark.read.parquet(run.path("cdm_paid_media_daily")).count() == 60
    one_day = jobs.paid_media_job(job(spark, tmp_path, end=DAY(2025, 1, 1)))
    assert one_day.loads["cdm_paid_media_daily"].last_day == DAY(2025, 1, 1)
    assert spark.read.parquet(run.path("cdm_paid_media_daily")).count() == 60
    scratch = list(run._scratch)
    run.discard_scratch()
    with pytest.raises(Exception):
        spark.read.schema("a int").parquet(scratch[0]).count()


def test_paid_job_stops_at_the_gate(spark, tmp_path):
    land_ads(spark, str(tmp_path / "landing"), clicks=5000)
    result = jobs.paid_media_job(job(spark, tmp_path))
    assert result.status == "failed_validation" and not (tmp_path / "warehouse").exists()
    assert [r["check"] for r in result.report if r["severity"] == "ERROR" and not r["passed"]] == ["clicks_le_impressions"]


def test_dry_run_job_writes_nothing(spark, tmp_path):
    land_ads(spark, str(tmp_path / "landing"))
    result = jobs.paid_media_job(job(spark, tmp_path, dry_run=True))
    assert result.status == "dry_run" and result.loads["cdm_paid_media_daily"].rows == 60 and not (tmp_path / "warehouse").exists()


def test_day_without_landed_rows_loads_nothing(spark, tmp_path):
    land_ads(spark, str(tmp_path / "landing"))
    jobs.paid_media_job(job(spark, tmp_path))
    empty = job(spark, tmp_path, start=DAY(2024, 1, 1), end=DAY(2024, 1, 1), dry_run=True)
    assert empty.feed("tiktok_ads").count() == 0


def test_one_day_run_keeps_the_months_cohort_whole(spark, tmp_path):
    path = str(tmp_path / "landing")
    installs = spark.range(40).selectExpr(
        "concat('a', id) AS appsflyer_id", "concat(date_add(DATE '2025-01-01', cast(id DIV 20 as int)), ' 10:00:00') AS install_time",
        "'organic' AS media_source", "'p' AS subscription_type", "'true' AS subscribed", "'2.5' AS subscription_value_usd",
    )
    landing.land_rows(installs, path, "installs", "install_time", STAMP)
    events = spark.range(5).selectExpr("concat('2025-01-0', id % 2 + 1, ' 01:00:00') AS event_time", "'x' AS event_name")
    landing.land_rows(events, path, "in_app_events", "event_time", STAMP)
    for day in (1, 2, 2):
        run = job(spark, tmp_path, DAY(2025, 1, day), DAY(2025, 1, day))
        result = jobs.attribution_job(run)
    assert result.loads["cdm_installs"].rows == 20
    cohort = spark.read.parquet(run.path("cdm_ltv_cohort")).collect()
    assert [(r["cohort_month"], r["installs"], r["revenue_usd"]) for r in cohort] == [(DAY(2025, 1, 1), 40, 100.0)]
    assert spark.read.parquet(run.path("cdm_funnel_summary")).count() == 2
    assert spark.read.parquet(run.path("cdm_funnel_events")).count() == 5


def test_models_are_stored_in_order_with_views_and_tests(spark, tmp_path):
    land_ads(spark, str(tmp_path / "landing"))
    run = job(spark, tmp_path)
    jobs.paid_media_job(run)
    cdm = {"cdm_paid_media_daily": tables.read_table(spark, run.path("cdm_paid_media_daily"), schema=schemas.CDM_PAID_MEDIA)}
    built, tests = models.run_models(spark, cdm, str(tmp_path / "marts"), DAY(2025, 1, 31))
    assert list(built) == ["stg_paid_media", "mart_channel_performance_daily", "rpt_platform_comparison"]
    assert all(r["passed"] for r in tests.collect())
    assert spark.sql("SELECT SUM(total_spend) FROM rpt_platform_comparison").first()[0] == 300.0
    files = built["rpt_platform_comparison"].inputFiles()
    assert files and all("/marts/mart_channel_performance_daily/" in f for f in files)


# --- streaming ------------------------------------------------------------------------------


def test_event_log_takes_each_event_once_and_keeps_late_ones(spark, tmp_path):
    landed, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))
    schema = "event_id long, event_time string, event_name string"

    def deliver(*ids_and_times):
        spark.createDataFrame([(i, t, "x") for i, t in ids_and_times], schema).coalesce(1).write.mode("append").parquet(landed)
        stream = event_log.event_stream(spark, landed, spark.createDataFrame([], schema).schema)
        event_log.append_events(event_log.cleaned_events(stream, "event_id", STAMP), log, checkpoint).awaitTermination()

    deliver((1, "2025-03-01 00:00:00"), (1, "2025-03-01 00:00:00"), (2, "2025-03-02 00:00:00"))
    deliver((2, "2025-03-02 00:00:00"), (3, "2020-01-01 00:00:00"), (4, "no time"))
    got = [(r["event_date"], r["event_timestamp"]) for r in spark.read.parquet(log).collect()]
    assert len(got) == 4 and (None, "no time") in got and (DAY(2020, 1, 1), "2020-01-01 00:00:00") in got


def test_landing_reads_only_the_wanted_days(spark, tmp_path):
    path = str(tmp_path / "landing")
    land_ads(spark, path)
    rows = landing.read_landing(spark, path, "tiktok_ads", DAY(2025, 1, 2), DAY(2025, 1, 2))
    assert rows.count() == 10 and "_day" not in rows.columns
    assert len(rows.inputFiles()) >= 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_day", plan) and all("_day=2025-01-02" in f for f in rows.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])


def test_plain_json_arrays(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text(json.dumps([{"event_id": "e", "platform": "iOS", "properties": "{}"}, {"event_id": "f"}]))
    assert landing.read_json_rows(spark, str(path), schemas.APP_EVENTS).count() == 2


# --- exchanges ------------------------------------------------------------------------------


def test_an_exchange_cut_short_at_any_step_loses_nothing(spark, tmp_path):
    path, one, two = str(tmp_path / "t"), DAY(2025, 1, 1), DAY(2025, 1, 2)
    tables.save_table(batch(spark, [("a", one, 1), ("b", two, 2)]).select("date", "k", F.col("v").cast("long")), path, "date")
    folder = files.Folder(spark, path)
    # Moved away, nothing in its place: readers find it, a writer moves it back first.
    folder.move("", f"{path}__before")
    assert stored(spark, path) == [(one, "a", 1), (two, "b", 2)]
    files.settle(spark, path)
    assert folder.exists() and not files.Folder(spark, f"{path}__before").exists()
    # The new one is in place and the old one still there.
    batch(spark, [("old", one, 0)]).write.parquet(f"{path}__before")
    tables.save_table(batch(spark, [("c", two, 3)]).select("date", "k", F.col("v").cast("long")), path, "date")
    assert stored(spark, path) == [(two, "c", 3)] and sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    # A note of partitions to be moved, one of them moved already.
    fresh = files.fresh_inside(path)
    batch(spark, [("d", one, 4), ("e", two, 5)]).withColumn("v", F.col("v").cast("long")).write.partitionBy("date").parquet(fresh)
    note = {"fresh": fresh.rsplit("/", 1)[-1], "depth": 1, "gone": ["date=2025-01-03"]}
    folder.write_text("_notes/n.json", json.dumps(note))
    files.Folder(spark, fresh).move("date=2025-01-01", f"{path}/date=2025-01-01")
    for _ in range(2):
        assert stored(spark, path) == [(one, "d", 4), (two, "e", 5)]
    assert folder.children("_notes") == [] and not files.Folder(spark, fresh).exists()


def test_a_failing_exchange_puts_the_table_back(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save_table(batch(spark, [("a", DAY(2025, 1, 1), 1)]), path, "date")
    with pytest.raises(Exception):
        files.exchange(spark, str(tmp_path / "nothing"), path)
    assert spark.read.parquet(path).count() == 1


def test_loads_are_known_by_name_writer_and_partitions(spark, tmp_path):
    path, one, two, three = str(tmp_path / "log"), *(DAY(2025, 1, d) for d in (1, 2, 3))

    def add(rows, load, **options):
        tables.append_once(batch(spark, rows).select("date", "k", "v"), path, "date", load, **options)

    add([("a", one, 1), ("b", two, 2), ("c", three, 3)], "x/1")
    add([("s", two, 9)], "stream-0", writer="first")
    with pytest.raises(ValueError, match="belongs to first"):
        add([("t", two, 9)], "stream-0", writer="second")
    assert files.load_entry(spark, path, "x/1")["partitions"] == [f"date=2025-01-0{d}/_load=x%2F1" for d in (1, 2, 3)]
    # Only days 1 and 2 are covered: day 3 stays, day 1 is gone.
    add([("B", two, 5)], "x/1", covers=(one, two))
    assert sorted((r["k"], r["date"]) for r in spark.read.parquet(path).collect()) == [("B", two), ("c", three), ("s", two)]
    add([], "x/1")
    assert [r["k"] for r in spark.read.parquet(path).collect()] == ["s"]


def test_equal_rejected_rows_of_a_delivery_are_all_held(spark, tmp_path):
    loose, path = schemas._struct("date date, k string, v bigint"), str(tmp_path / "t")
    rows = [("same", None, 1)] * 3 + [("other", None, 1), ("placed", DAY(2025, 1, 1), 1)]
    for _ in range(2):
        assert tables.load_table(batch(spark, rows), path, loose).rejected == 4
    assert spark.read.parquet(path + "__rejected").count() == 4


def test_writes_at_once_restore_the_setting(spark):
    name = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(name)
    with tables.many_writers(spark):
        with tables.many_writers(spark):
            assert spark.conf.get(name) == "16KB"
        assert spark.conf.get(name) == "16KB"
    assert spark.conf.get(name) == before


def test_marts_without_a_known_state_are_built(spark, tmp_path):
    land_ads(spark, str(tmp_path / "landing"))
    run = job(spark, tmp_path)
    jobs.paid_media_job(run)
    cdm = {"cdm_paid_media_daily": tables.read_table(spark, run.path("cdm_paid_media_daily"), schema=schemas.CDM_PAID_MEDIA)}
    root = str(tmp_path / "marts")
    for _ in range(2):
        built = models.refresh_models(spark, cdm, root, DAY(2025, 1, 31))
        assert built["mart_channel_performance_daily"].agg(F.sum("cost_usd")).first()[0] == 300.0
    nothing = {"cdm_paid_media_daily": cdm["cdm_paid_media_daily"].where("date > DATE '2030-01-01'")}
    assert models.refresh_models(spark, nothing, root, DAY(2025, 1, 31))["mart_channel_performance_daily"].count() == 0


def test_a_merged_batch_is_put_aside_once_a_task(spark, tmp_path):
    """Twenty days in four tasks are a file a task and one a day, not eighty; what other loads hold is left out all the same."""
    log = str(tmp_path / "log")
    rows = spark.range(0, 400, 1, 4).selectExpr("CAST(id % 200 AS STRING) AS _event_id", "date_add(DATE '2025-01-01', CAST(id % 20 AS INT)) AS event_date", "'n' AS event_name")
    event_log.add_events(rows.where("CAST(_event_id AS INT) < 50"), log, "a")
    with event_log.merged(rows, log, "b") as new:
        [aside] = (tmp_path / "log").glob("_fresh-*")
        assert len(list(aside.rglob("*.parquet"))) <= 4 + 20
        assert sorted(int(r[0]) for r in new.select("_event_id").collect()) == list(range(50, 200))


def test_fingerprints_add_whole_numbers(spark):
    """The sums are exact, beyond 64 bits too, and no row goes through a decimal."""
    df = spark.range(3000).selectExpr("DATE '2025-01-05' AS date", "CAST(id AS STRING) AS ad_id")
    found = models.fingerprints({"cdm_paid_media_daily": df})
    [row] = found.collect()
    hashes = df.select(F.xxhash64("date", "ad_id"), F.xxhash64(F.lit(1), "date", "ad_id")).collect()
    assert (row["rows"], row["hash"], row["other"]) == (3000, *(str(sum(h[k] for h in hashes)) for k in (0, 1)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast" not in plan


def test_ads_are_landed_without_a_copy_beside(spark, monkeypatch):
    landed = []
    monkeypatch.setattr(landing, "land_rows", lambda rows, path, source, *rest: landed.append((source, rows.count())))
    monkeypatch.setattr(Inputs, "stored", lambda *a: pytest.fail("written twice"))
    inputs = Inputs(spark, SMALL)
    catalog_storage._land_ads(inputs, "nowhere")
    assert [s for s, _ in landed] == ["tiktok_ads", "meta_ads", "reddit_ads"] and sum(n for _, n in landed) == inputs.raw("raw_ads").count()


def test_older_and_newer_ads_are_landed_without_a_copy_beside(spark, monkeypatch):
    landed = []
    monkeypatch.setattr(landing, "land_rows", lambda rows, path, source, *rest: landed.append((source, rest[-1], rows.count())))
    monkeypatch.setattr(Inputs, "stored", lambda *a: pytest.fail("written twice"))
    monkeypatch.setattr(catalog_loads, "_job", lambda *a: 1 / 0)
    inputs = Inputs(spark, SMALL)
    with pytest.raises(ZeroDivisionError):
        catalog_loads.run_beside_an_unreadable_delivery(inputs)
    assert {(s, d) for s, d, _ in landed} == {(f"{s}_ads", d) for s in ("tiktok", "meta", "reddit") for d in ("newer", "older")}
    assert sum(n for *_, n in landed) == inputs.raw("raw_ads").count()

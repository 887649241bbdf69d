"""Queries that write derived feeds or tables to the shared folder and read them back."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.oracle import long
from checks.registry import (
    ORGANIC_DOUBLES,
    PAID_DOUBLES,
    PERFORMANCE,
    STAMP,
    Inputs,
    query,
)
from mediatide import schemas
from mediatide.operators import attribution, organic, paid
from mediatide.plans import jobs, models
from mediatide.sources import landing, tables
from mediatide.streaming import events as event_log

FEBRUARY = "date BETWEEN DATE '1998-02-01' AND DATE '1998-02-28'"
WHOLE_RANGE = (dt.date(1990, 1, 1), dt.date(2030, 1, 1))

# --- reading landed feeds -------------------------------------------------------------------


def _envelopes(i: Inputs, feed: str, rows: DataFrame, meta: Column) -> DataFrame:
    """Lands one API response per line and reads the rows back."""
    listed = F.array(F.struct(*rows.columns))
    data = F.struct(listed.alias("list")) if landing.ENVELOPES[feed].rows == "data.list" else listed
    path = i.scratch(feed)
    rows.select(F.to_json(F.struct(meta.alias("_meta"), data.alias("data"))).alias("value")).write.text(path)
    return landing.read_envelopes(i.spark, path, feed, per_line=True)


def _meta(**values: str) -> Column:
    return F.struct(*(F.lit(v).alias(k) for k, v in {"source": "api", **values}.items()))


@query("S1 C6 C7", "SELECT * FROM cdm_tiktok", PAID_DOUBLES)
def landed_tiktok_ads(i: Inputs) -> DataFrame:
    return paid.tiktok_ads(_envelopes(i, "tiktok_ads", i.raw("raw_tiktok_ads"), _meta()))


@query("S2 C35", "SELECT * FROM cdm_meta", PAID_DOUBLES)
def landed_meta_ads(i: Inputs) -> DataFrame:
    return paid.meta_ads(_envelopes(i, "meta_ads", i.raw("raw_meta_ads"), _meta()))


@query(
    "S3 P3",
    "SELECT * REPLACE ('28d_click' AS attribution_window) FROM cdm_reddit",
    PAID_DOUBLES,
)
def landed_reddit_ads(i: Inputs) -> DataFrame:
    meta = _meta(attribution_window="28d_click")
    return paid.reddit_ads(_envelopes(i, "reddit_ads", i.raw("raw_reddit_ads"), meta))


@query("S8", "SELECT * FROM cdm_organic", ORGANIC_DOUBLES)
def landed_organic_posts(i: Inputs) -> DataFrame:
    feeds = {
        "instagram_organic": ("raw_instagram_posts", organic.instagram_posts),
        "tiktok_organic": ("raw_tiktok_posts", organic.tiktok_posts),
        "reddit_organic": ("raw_reddit_posts", organic.reddit_posts),
    }
    frames = [
        mapped(_envelopes(i, feed, i.raw(raw), _meta()), STAMP) for feed, (raw, mapped) in feeds.items()
    ]
    return organic.combine_posts(frames)


def _as_report(i: Inputs, rows: DataFrame, name: str) -> DataFrame:
    path = i.scratch(name)
    # Spaces at the ends of a value belong to it.
    writer = rows.write.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("header", True).option("escape", '"').csv(path)
    return landing.read_report(i.spark, path)


@query("S4", "SELECT * FROM cdm_installs", "subscription_value_usd")
def landed_installs_report(i: Inputs) -> DataFrame:
    return attribution.installs(_as_report(i, i.raw("raw_installs"), "installs"), STAMP)


@query("S5", "SELECT * FROM cdm_events", "revenue_usd distance_km")
def landed_events_report(i: Inputs) -> DataFrame:
    return attribution.in_app_events(_as_report(i, i.raw("raw_events"), "events"), STAMP)


@query("S6", "SELECT * FROM old_events")
def landed_app_events(i: Inputs) -> DataFrame:
    path = i.scratch("app_events")
    i.raw("raw_app_events").write.json(path)
    return attribution.app_events(landing.read_json_rows(i.spark, path, schemas.APP_EVENTS, per_line=True))


@query("S7", "SELECT * FROM old_organic", "engagement_rate avg_watch_time_s video_completion_rate")
def landed_mixed_posts(i: Inputs) -> DataFrame:
    path = i.scratch("mixed_posts")
    i.raw("raw_mixed_posts").write.json(path)
    return organic.mixed_posts(landing.read_json_rows(i.spark, path, schemas.MIXED_POSTS, per_line=True))


@query(
    "S9 K14",
    f"SELECT * FROM cdm_instagram_posts WHERE {FEBRUARY}",
    ORGANIC_DOUBLES,
)
def landing_date_range(i: Inputs) -> DataFrame:
    path = i.scratch("landing")
    landing.land_rows(i.raw("raw_instagram_posts"), path, "instagram_organic", "timestamp", STAMP)
    rows = landing.read_landing(i.spark, path, "instagram_organic", dt.date(1998, 2, 1), dt.date(1998, 2, 28))
    return organic.combine_posts([organic.instagram_posts(rows, STAMP)])


# --- writing tables -------------------------------------------------------------------------


def _february(rows: DataFrame) -> DataFrame:
    return rows.where(FEBRUARY).withColumn("reach", F.col("reach") + 1)


def _load_organic(rows: DataFrame, path: str, **options) -> tables.LoadResult:
    return tables.load_table(rows, path, schemas.CDM_ORGANIC, "date", **options)


def _stored_organic(i: Inputs, path: str) -> DataFrame:
    return tables.read_table(i.spark, path, schema=schemas.CDM_ORGANIC)


@query("K1 S10", "SELECT * FROM cdm_organic", ORGANIC_DOUBLES)
def stored_full_table(i: Inputs) -> DataFrame:
    path = i.scratch("cdm_organic_daily")
    tables.save_table(i.cdm_organic, path)
    tables.save_table(i.cdm_organic, path)
    return tables.read_table(i.spark, path)


@query(
    "K2",
    "SELECT *, DATE '2024-01-01' AS run_date FROM cdm_organic UNION ALL SELECT *, DATE '2024-01-02' AS run_date FROM cdm_organic",
    ORGANIC_DOUBLES,
)
def stored_run_copies(i: Inputs) -> DataFrame:
    path = i.scratch("organic_runs")
    for day in (1, 2, 1):
        tables.save_run_copy(i.cdm_organic, path, dt.date(2024, 1, day))
    return tables.read_table(i.spark, path)


@query(
    "K3 K7 G1",
    f"SELECT * REPLACE (CASE WHEN {FEBRUARY} THEN reach + 1 ELSE reach END AS reach) FROM cdm_organic",
    ORGANIC_DOUBLES,
)
def stored_incremental_rerun(i: Inputs) -> DataFrame:
    """A month is corrected and loaded twice, an empty batch changes nothing."""
    path = i.scratch("cdm_organic_daily")
    _load_organic(i.cdm_organic, path)
    _load_organic(_february(i.cdm_organic), path)
    _load_organic(_february(i.cdm_organic), path)
    _load_organic(i.cdm_organic.where("date < DATE '1900-01-01'"), path)
    return _stored_organic(i, path)


@query(
    "K4",
    f"SELECT * REPLACE (reach + 1 AS reach) FROM cdm_organic WHERE {FEBRUARY}",
    ORGANIC_DOUBLES,
)
def stored_full_refresh(i: Inputs) -> DataFrame:
    path = i.scratch("cdm_organic_daily")
    _load_organic(i.cdm_organic, path)
    _load_organic(_february(i.cdm_organic), path, mode=tables.TRUNCATE)
    return _stored_organic(i, path)


@query(
    "K5",
    f"SELECT * FROM cdm_organic UNION ALL SELECT * REPLACE (reach + 1 AS reach) FROM cdm_organic WHERE {FEBRUARY}",
    ORGANIC_DOUBLES,
)
def stored_append(i: Inputs) -> DataFrame:
    path = i.scratch("cdm_organic_daily")
    _load_organic(i.cdm_organic, path)
    _load_organic(_february(i.cdm_organic), path, mode=tables.APPEND)
    return _stored_organic(i, path)


@query("K6 K7", "SELECT * FROM cdm_installs", "subscription_value_usd")
def stored_installs_by_day(i: Inputs) -> DataFrame:
    path = i.scratch("cdm_installs")
    year = i.cdm_installs.where("install_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'")
    for batch in (i.cdm_installs, year):
        tables.load_table(batch, path, schemas.CDM_INSTALLS, "install_date", cluster=("channel",))
    return tables.read_table(i.spark, path, schema=schemas.CDM_INSTALLS)


def _results(i: Inputs, *results: tables.LoadResult) -> DataFrame:
    return i.spark.createDataFrame(
        [(r.status, r.rows, r.first_day, r.last_day) for r in results],
        "status string, rows bigint, first_day date, last_day date",
    )


_FIGURES = "COUNT(*) AS rows, MIN(date) AS first_day, MAX(date) AS last_day"


@query(
    "K8 K9 A30",
    f"SELECT 'dry_run' AS status, {_FIGURES} FROM cdm_organic UNION ALL SELECT 'success', {_FIGURES} FROM cdm_organic "
    f"UNION ALL SELECT 'success', {_FIGURES} FROM cdm_organic WHERE {FEBRUARY}",
)
def load_results(i: Inputs) -> DataFrame:
    path = i.scratch("cdm_organic_daily")
    return _results(
        i,
        _load_organic(i.cdm_organic, path, dry_run=True),
        _load_organic(i.cdm_organic, path),
        _load_organic(_february(i.cdm_organic), path),
    )


@query("K10 S10", "SELECT * FROM cdm_organic", ORGANIC_DOUBLES)
def table_from_ddl(i: Inputs) -> DataFrame:
    name = f"cdm_organic_{uuid.uuid4().hex}"
    path = i.scratch("cdm_organic_daily")
    i.spark.sql(tables.table_ddl(name, schemas.CDM_ORGANIC, "date", path))
    checked = tables.enforce_schema(i.cdm_organic, schemas.CDM_ORGANIC)
    checked.select(*i.spark.table(name).columns).write.insertInto(name)
    return i.spark.table(name).select(*schemas.CDM_ORGANIC.names)


_MART = "SELECT * FROM mart_organic"
_MART_DOUBLES = "avg_watch_time_s avg_completion_rate avg_engagement_rate viral_reach_multiplier"


def _models(i: Inputs) -> dict[str, DataFrame]:
    cdm = {"cdm_organic_daily": i.cdm_organic}
    return models.materialise_models(i.spark, cdm, i.scratch("models"))


@query("K11 G8", _MART, _MART_DOUBLES)
def stored_mart(i: Inputs) -> DataFrame:
    return _models(i)["mart_organic_performance"]


@query("K12 S11", "SELECT platform, " + long("SUM(posts)") + " AS posts FROM mart_organic GROUP BY 1")
def model_views(i: Inputs) -> DataFrame:
    _models(i)
    return i.spark.sql("SELECT platform, SUM(posts) AS posts FROM mart_organic_performance GROUP BY platform")


@query("K13", _MART, _MART_DOUBLES)
def table_as_select(i: Inputs) -> DataFrame:
    name = f"mart_organic_{uuid.uuid4().hex}"
    mart = models.build_models({"cdm_organic_daily": i.cdm_organic})["mart_organic_performance"]
    models.catalog_model(mart, name, i.scratch(name), "month", ("platform",))
    return i.spark.table(name)


# --- jobs -----------------------------------------------------------------------------------


def _land_ads(i: Inputs, path: str) -> None:
    for source, day in (("tiktok_ads", "stat_time_day"), ("meta_ads", "date_start"), ("reddit_ads", "date")):
        landing.land_rows(i.raw(f"raw_{source}"), path, source, day, STAMP)


def _job(i: Inputs, path: str, days: tuple[dt.date, dt.date] = WHOLE_RANGE) -> jobs.Job:
    return jobs.Job(i.spark, path, i.scratch("warehouse"), *days, stamp=STAMP)


@query("G4 G9 V18 S9 K3", "SELECT * FROM cdm_paid", PAID_DOUBLES)
def job_paid_media(i: Inputs) -> DataFrame:
    path = i.scratch("landing")
    _land_ads(i, path)
    job = _job(i, path)
    jobs.paid_media_job(job)
    job.discard_scratch()
    return tables.read_table(i.spark, job.path("cdm_paid_media_daily"), schema=schemas.CDM_PAID_MEDIA)


@query("G6 G9", f"SELECT * FROM cdm_organic WHERE {FEBRUARY}", ORGANIC_DOUBLES)
def job_organic(i: Inputs) -> DataFrame:
    """A backfill of one month, run twice."""
    path = i.scratch("landing")
    landing.land_rows(i.raw("raw_instagram_posts"), path, "instagram_organic", "timestamp", STAMP)
    # The two feeds with Unix times are landed under their UTC day.
    for source, raw, seconds in (
        ("tiktok_organic", "raw_tiktok_posts", "create_time"),
        ("reddit_organic", "raw_reddit_posts", "created_utc"),
    ):
        day = F.date_from_unix_date((F.col(seconds) / 86400).cast("int"))
        landing.land_rows(i.raw(raw).withColumn("_landed", day), path, source, "_landed", STAMP)
    job = _job(i, path, (dt.date(1998, 2, 1), dt.date(1998, 2, 28)))
    jobs.organic_job(job)
    jobs.organic_job(job)
    job.discard_scratch()
    return tables.read_table(i.spark, job.path("cdm_organic_daily"), schema=schemas.CDM_ORGANIC)


def _attribution(i: Inputs) -> jobs.Job:
    path = i.scratch("landing")
    landing.land_rows(i.raw("raw_installs"), path, "installs", "install_time", STAMP)
    landing.land_rows(i.raw("raw_events"), path, "in_app_events", "event_time", STAMP)
    # Two halves that meet within a month: its cohort must hold the days of both.
    job = _job(i, path, (dt.date(1990, 1, 1), dt.date(1998, 3, 15)))
    jobs.attribution_job(job)
    job.start, job.end = dt.date(1998, 3, 16), dt.date(2030, 1, 1)
    jobs.attribution_job(job)
    job.discard_scratch()
    return job


@query(
    "G5 K6 A15 A17",
    "SELECT 'summary' AS table, install_date AS period, channel, '' AS plan, installs, subscriptions AS subscribers, "
    "revenue_usd, ltv_per_install FROM funnel_summary UNION ALL SELECT 'cohort', cohort_month, channel, subscription_type, "
    "installs, subscribers, revenue_usd, ltv_per_install FROM cohort_table UNION ALL "
    "SELECT 'installs', install_date, channel, subscription_type, days_to_subscribe, 0, subscription_value_usd, 0 FROM cdm_installs "
    "UNION ALL SELECT 'events', event_date, channel, event_name, duration_min, 0, revenue_usd, 0 FROM cdm_events",
    "revenue_usd ltv_per_install",
)
def job_attribution(i: Inputs) -> DataFrame:
    """All four tables of the job, brought to common columns."""
    job = _attribution(i)
    wanted = {
        "cdm_funnel_summary": "'summary', install_date, channel, '', installs, subscriptions, revenue_usd, ltv_per_install",
        "cdm_ltv_cohort": "'cohort', cohort_month, channel, subscription_type, installs, subscribers, revenue_usd, ltv_per_install",
        "cdm_installs": "'installs', install_date, channel, subscription_type, days_to_subscribe, 0L, subscription_value_usd, 0D",
        "cdm_funnel_events": "'events', event_date, channel, event_name, duration_min, 0L, revenue_usd, 0D",
    }
    names = ("table", "period", "channel", "plan", "installs", "subscribers", "revenue_usd", "ltv_per_install")
    frames = [
        tables.read_table(i.spark, job.path(t), schema=schemas.CDM_SCHEMAS[t])
        .select(*(F.expr(e.strip()) for e in text.split(", ")))
        .toDF(*names)
        for t, text in wanted.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


@query(
    "G7",
    "SELECT 'cdm_paid_media_daily' AS table, COUNT(*) AS rows FROM old_paid UNION ALL "
    "SELECT 'cdm_organic_daily', COUNT(*) FROM old_organic UNION ALL SELECT 'cdm_installs', COUNT(*) FROM old_installs UNION ALL "
    "SELECT 'cdm_funnel_events', COUNT(*) FROM old_events UNION ALL SELECT 'cdm_funnel_summary', COUNT(*) FROM funnel_summary_old",
)
def job_rounded_tables(i: Inputs) -> DataFrame:
    raw = ("raw_tiktok_ads", "raw_meta_ads", "raw_reddit_ads", "raw_mixed_posts", "raw_installs_old", "raw_app_events")
    built = jobs.rounded_cdm_tables(*(i.raw(name) for name in raw))
    counts = [df.agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name, df in built.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query("G8 A1 K11", "SELECT * FROM mart_performance", PERFORMANCE)
def job_models(i: Inputs) -> DataFrame:
    cdm = {"cdm_paid_media_daily": i.stored(i.cdm_paid, "cdm_paid_media_daily")}
    built = models.materialise_models(i.spark, cdm, i.scratch("models"))
    return built["mart_channel_performance_daily"]


# --- streaming ------------------------------------------------------------------------------


@query("G2 K5 P13", "SELECT * FROM cdm_events", "revenue_usd distance_km")
def stream_event_log(i: Inputs) -> DataFrame:
    """Files with repeated deliveries of events; each event is in the log once."""
    landed, log, checkpoint = i.scratch("event_files"), i.scratch("event_log"), i.scratch("checkpoint")
    rows = i.raw("raw_events")
    rows.write.parquet(landed)
    rows.where("event_id % 10 < 4").write.mode("append").parquet(landed)
    stream = event_log.event_stream(i.spark, landed, rows.schema)
    started = event_log.append_events(event_log.cleaned_events(stream, "event_id", STAMP), log, checkpoint)
    started.awaitTermination()
    return i.spark.read.parquet(log).select(*schemas.CDM_FUNNEL_EVENTS.names)

"""Queries on loads that come again, meet other loads, fail on the way, or lose what they had."""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.catalog_storage import FEBRUARY, WHOLE_RANGE, _job, _stored_organic
from checks.oracle import long
from checks.registry import ORGANIC_DOUBLES, PAID_DOUBLES, PERFORMANCE, STAMP, Inputs, query
from mediatide import schemas
from mediatide.operators import attribution
from mediatide.plans import jobs, models
from mediatide.sources import files, landing, tables
from mediatide.streaming import events as event_log

EVENT_DOUBLES = "revenue_usd distance_km"


def _log(i: Inputs, path: str) -> DataFrame:
    return tables.read_table(i.spark, path, schema=schemas.CDM_FUNNEL_EVENTS)


@query(
    "K5 G2",
    "SELECT * REPLACE (CAST(CASE WHEN platform = 'ios' THEN event_date + INTERVAL 1 DAY ELSE event_date END AS DATE) AS event_date) "
    "FROM cdm_events WHERE country <> 'C1'",
    EVENT_DOUBLES,
)
def log_load_with_moved_rows(i: Inputs) -> DataFrame:
    """A load comes again with many rows on other days and some rows gone: nothing of its first form is left."""
    path = i.scratch("event_log")
    moved = i.cdm_events.where("country <> 'C1'").withColumn(
        "event_date", F.when(F.col("platform") == "ios", F.date_add("event_date", 1)).otherwise(F.col("event_date"))
    )
    for batch in (i.cdm_events, moved, moved):
        tables.load_table(batch, path, schemas.CDM_FUNNEL_EVENTS, "event_date", tables.APPEND, load="b1")
    return _log(i, path)


@query("K5 G2 P13", "SELECT * FROM cdm_events", EVENT_DOUBLES)
def log_of_streams_and_batches(i: Inputs) -> DataFrame:
    """Two streams, one of them started anew with a fresh checkpoint, and a batch load share most of their events."""
    rows, log = i.raw("raw_events"), i.scratch("event_log")

    def stream(part: DataFrame, folder: str, checkpoint: str) -> None:
        part.write.mode("append").parquet(folder)
        found = event_log.event_stream(i.spark, folder, rows.schema)
        event_log.append_events(event_log.cleaned_events(found, "event_id", STAMP), log, checkpoint).awaitTermination()

    first, second, checkpoint = i.scratch("files"), i.scratch("files"), i.scratch("checkpoint")
    stream(rows.where("event_id % 3 <> 0"), first, checkpoint)
    stream(rows.where("event_id % 3 <> 1"), second, i.scratch("checkpoint"))
    # The first stream loses its checkpoint and reads all its files again.
    stream(rows.where("event_id % 6 = 0"), first, i.scratch("checkpoint"))
    batch = attribution.in_app_events(rows.withColumn("_event_id", F.col("event_id").cast("string")), STAMP)
    event_log.add_events(batch, log, "batch")
    return _log(i, log)


@query("G5 G9 K5", "SELECT * FROM cdm_events", EVENT_DOUBLES)
def log_of_overlapping_runs(i: Inputs) -> DataFrame:
    """A run of a month, a backfill of everything and a run of a day add the same events; each is there once."""
    path = i.scratch("landing")
    landing.land_rows(i.raw("raw_installs"), path, "installs", "install_time", STAMP)
    landing.land_rows(i.raw("raw_events"), path, "in_app_events", "event_time", STAMP)
    job = _job(i, path)
    for days in ((dt.date(1998, 3, 1), dt.date(1998, 3, 31)), WHOLE_RANGE, (dt.date(1998, 3, 7), dt.date(1998, 3, 7))):
        job.start, job.end = days
        jobs.attribution_job(job, event_id="event_id")
    job.discard_scratch()
    return _log(i, job.path("cdm_funnel_events"))


_UNREADABLE = "CAST(media_id AS BIGINT) % 10 = 3"
_BAD_POST = "platform = 'instagram' AND CAST(post_id AS BIGINT) % 10 = 3"


@query(
    "S9 K3 K6 G6",
    f"SELECT {long('COUNT(*)')} AS landed, {long('COUNT(*) FILTER (NOT (' + _BAD_POST + '))')} AS loaded, "
    f"{long('COUNT(*) FILTER (' + _BAD_POST + ')')} AS rejected, {long('COUNT(*) FILTER (' + _BAD_POST + ')')} AS different FROM raw_organic",
)
def rejected_once_over_many_runs(i: Inputs) -> DataFrame:
    """Runs of several ranges over two deliveries, one of which has no readable day: every row is loaded or rejected once."""
    path = i.scratch("landing")
    rows = i.raw("raw_instagram_posts")
    bad = rows.withColumn("timestamp", F.when(F.expr(_UNREADABLE), F.lit("some day")).otherwise(F.col("timestamp")))
    wholly = F.expr(f"{_UNREADABLE} AND CAST(media_id AS BIGINT) % 20 = 13")
    landing.land_rows(bad.where(~wholly), path, "instagram_organic", "timestamp", STAMP, "first delivery")
    landing.land_rows(bad.where(wholly), path, "instagram_organic", "timestamp", STAMP, "second/delivery")
    landed = rows.count()
    for source, seconds in (("tiktok", "create_time"), ("reddit", "created_utc")):
        posts = i.raw(f"raw_{source}_posts")
        landed += posts.count()
        day = F.date_from_unix_date((F.col(seconds) / 86400).cast("int"))
        landing.land_rows(posts.withColumn("_landed", day), path, f"{source}_organic", "_landed", STAMP)
    job = _job(i, path)
    month = (dt.date(1998, 2, 1), dt.date(1998, 2, 28))
    for days in (month, (dt.date(1998, 2, 3), dt.date(1998, 2, 3)), WHOLE_RANGE, month):
        job.start, job.end = days
        jobs.organic_job(job)
    job.discard_scratch()
    loaded = tables.read_table(i.spark, job.path("cdm_organic_daily"), schema=schemas.CDM_ORGANIC).agg(F.count("*").alias("loaded"))
    kept = i.spark.read.parquet(job.path(jobs.UNREADABLE)).agg(F.count("*").alias("rejected"), F.countDistinct("row").alias("different"))
    counts = loaded.withColumn("k", F.lit(1)).join(kept.withColumn("k", F.lit(1)), "k").drop("k")
    return counts.withColumn("landed", F.lit(landed).cast("bigint"))


@query("V4 V18 G4 S9", "SELECT * FROM cdm_paid WHERE date >= DATE '1997-01-01'", PAID_DOUBLES)
def run_beside_an_unreadable_delivery(i: Inputs) -> DataFrame:
    """An older delivery has unreadable days.  Runs of other days go on; a run of its own days stops and changes nothing."""
    path = i.scratch("landing")
    later = dt.date(1997, 1, 1)
    for source, day in (("tiktok_ads", "stat_time_day"), ("meta_ads", "date_start"), ("reddit_ads", "date")):
        rows = i.raw(f"raw_{source}")
        readable = F.substring(F.col(day).cast("string"), 1, 10) >= str(later)
        landing.land_rows(rows.where(readable), path, source, day, STAMP, "newer")
        old = rows.where(~readable)
        if source == "meta_ads":
            old = old.withColumn(day, F.when(F.col("impressions") % 4 == 0, F.lit("n/a")).otherwise(F.col(day)))
        landing.land_rows(old, path, source, day, STAMP, "older")
    job = _job(i, path, (later, WHOLE_RANGE[1]))
    assert jobs.paid_media_job(job).status == "success"
    job.start, job.end = WHOLE_RANGE[0], later - dt.timedelta(days=1)
    assert jobs.paid_media_job(job).status == "failed_validation"
    job.discard_scratch()
    return tables.read_table(i.spark, job.path("cdm_paid_media_daily"), schema=schemas.CDM_PAID_MEDIA)


@query(
    "K1 K4 K13",
    " UNION ALL ".join(f"SELECT '{n}' AS entry, * REPLACE (reach + 1 AS reach) FROM cdm_organic" for n in ("load", "save", "select")),
    ORGANIC_DOUBLES,
)
def full_writes_that_fail(i: Inputs) -> DataFrame:
    """Each way of replacing a whole table fails once in its writing tasks, which leaves the old rows, and then succeeds."""
    kinds = {
        "load": lambda df, path: tables.load_table(df, path, schemas.CDM_ORGANIC, "date", tables.TRUNCATE),
        "save": lambda df, path: tables.save_table(df, path, "date", ("platform",)),
        "select": lambda df, path: tables.create_table_as(df, path.rsplit("/", 1)[-1].replace("-", "_"), path, "date"),
    }
    newer = i.cdm_organic.withColumn("reach", F.col("reach") + 1)
    codec = "spark.sql.parquet.compression.codec"
    frames = []
    for name, write in kinds.items():
        path = i.scratch(f"organic_{name}")
        write(i.cdm_organic, path)
        usual = i.spark.conf.get(codec)
        # No such codec is there when the tasks open their files.
        i.spark.conf.set(codec, "lzo")
        try:
            write(newer, path)
            raise AssertionError("the write should have failed")
        except AssertionError:
            raise
        except Exception:  # noqa: BLE001 - whatever the tasks report
            pass
        finally:
            i.spark.conf.set(codec, usual)
        left = _stored_organic(i, path).agg(F.count("*").alias("n"), F.sum("reach").alias("reach"))
        assert left.first() == i.cdm_organic.agg(F.count("*").alias("n"), F.sum("reach").alias("reach")).first()
        write(newer, path)
        rows = i.spark.table(path.rsplit("/", 1)[-1].replace("-", "_")) if name == "select" else _stored_organic(i, path)
        frames.append(rows.select(F.lit(name).alias("entry"), *schemas.CDM_ORGANIC.names))
    return reduce(DataFrame.unionByName, frames)


@query(
    "K11 G8",
    "SELECT * FROM mart_performance WHERE date <> DATE '1998-02-10' AND NOT (date BETWEEN DATE '1997-05-01' AND DATE '1997-05-31')",
    PERFORMANCE,
)
def marts_after_days_are_gone(i: Inputs) -> DataFrame:
    """A day and a whole month leave the CDM table; the marts follow without being told and without a full build."""
    path, root = i.scratch("cdm_paid_media_daily"), i.scratch("models")
    tables.save_table(i.cdm_paid, path, "date")
    cdm = {"cdm_paid_media_daily": tables.read_table(i.spark, path, schema=schemas.CDM_PAID_MEDIA)}
    models.materialise_models(i.spark, cdm, root)
    before = i.stored(_files(i, f"{root}/mart_channel_performance_daily"), "before")
    gone = "date = DATE '1998-02-10' OR date BETWEEN DATE '1997-05-01' AND DATE '1997-05-31'"
    rest = i.stored(cdm["cdm_paid_media_daily"].where(f"NOT ({gone})"), "rest")
    got = models.refresh_models(i.spark, {"cdm_paid_media_daily": rest}, root)["mart_channel_performance_daily"]
    # Months that have not changed keep their files.
    kept = before.join(_files(i, f"{root}/mart_channel_performance_daily"), "file", "left_semi")
    untouched = before.where("month NOT IN ('1998-02', '1997-05')")
    assert kept.count() == untouched.count() > 0
    return got


def _files(i: Inputs, path: str) -> DataFrame:
    rows = i.spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.date_format("date", "yyyy-MM").alias("month"))
    return rows.distinct()


@query("K11 G8", f"SELECT * REPLACE (CASE WHEN {FEBRUARY} THEN reach + 1 ELSE reach END AS reach) FROM cdm_organic", ORGANIC_DOUBLES)
def table_through_cut_short_exchanges(i: Inputs) -> DataFrame:
    """A crash between the steps of an exchange: the next reader still finds a whole table, and the next writer goes on from there."""
    path = i.scratch("cdm_organic_daily")
    tables.save_table(i.cdm_organic, path, "date")
    # The old table has been moved away and the new one has not come yet.
    files.Folder(i.spark, path).move("", f"{path}__before")
    assert _stored_organic(i, path).count() == i.cdm_organic.count()
    tables.save_table(i.cdm_organic, path, "date")
    # A note says which partitions are to be moved, and nothing has been moved.
    february = i.cdm_organic.where(FEBRUARY).withColumn("reach", F.col("reach") + 1)
    fresh = files.fresh_inside(path)
    february.write.partitionBy("date").parquet(fresh)
    note = {"fresh": fresh.rsplit("/", 1)[-1], "depth": 1, "gone": []}
    files.Folder(i.spark, path).write_text("_notes/n.json", json.dumps(note))
    return _stored_organic(i, path)

"""Queries on feeds with planted faults: unreadable days, late deliveries, odd amounts, mixed formats, shuffled reports."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.catalog_storage import FEBRUARY, WHOLE_RANGE, _job, _results, _stored_organic
from checks.oracle import long, month
from checks.registry import ORGANIC_DOUBLES, STAMP, Inputs, query
from mediatide import schemas
from mediatide.functions.numbers import money_sum, parse_double
from mediatide.operators import attribution, lifecycle, organic, paid
from mediatide.operators.fields import RunStamp
from mediatide.plans import jobs, models
from mediatide.sources import landing, tables
from mediatide.streaming import events as event_log

_UNREADABLE = "CAST(media_id AS BIGINT) % 10 = 3"
_BAD_POST = "platform = 'instagram' AND CAST(post_id AS BIGINT) % 10 = 3"


@query(
    "S9 K3 K14 G6",
    f"SELECT 'cdm_organic_daily' AS table, {long('COUNT(*)')} AS landed, "
    f"{long('COUNT(*) FILTER (NOT (' + _BAD_POST + '))')} AS loaded, {long('COUNT(*) FILTER (' + _BAD_POST + ')')} AS rejected FROM raw_organic",
)
def job_with_unreadable_days(i: Inputs) -> DataFrame:
    """What has landed is loaded or rejected, with nothing lost; the job runs twice."""
    path = i.scratch("landing")
    rows = i.raw("raw_instagram_posts")
    bad = rows.withColumn("timestamp", F.when(F.expr(_UNREADABLE), F.lit("some day")).otherwise(F.col("timestamp")))
    landing.land_rows(bad, path, "instagram_organic", "timestamp", STAMP)
    landed = rows.count()
    for source, seconds in (("tiktok", "create_time"), ("reddit", "created_utc")):
        posts = i.raw(f"raw_{source}_posts")
        landed += posts.count()
        day = F.date_from_unix_date((F.col(seconds) / 86400).cast("int"))
        landing.land_rows(posts.withColumn("_landed", day), path, f"{source}_organic", "_landed", STAMP)
    job = _job(i, path)
    for _ in range(2):
        load = jobs.organic_job(job).loads["cdm_organic_daily"]
    job.discard_scratch()
    stored = tables.read_table(i.spark, job.path("cdm_organic_daily"), schema=schemas.CDM_ORGANIC).count()
    kept = i.spark.read.parquet(job.path(jobs.UNREADABLE)).count()
    assert (load.rows, load.rejected) == (stored, kept)
    return i.spark.createDataFrame([(load.table, landed, stored, kept)], "table string, landed bigint, loaded bigint, rejected bigint")


@query("V4 V18 G4", f"SELECT 'failed_validation' AS status, {long('0')} AS tables, {long('0')} AS staged")
def gate_stops_unreadable_days(i: Inputs) -> DataFrame:
    """A quarter of one platform's rows has no readable day: the job stops, loads nothing and leaves nothing staged."""
    path = i.scratch("landing")
    for source, day in (("tiktok_ads", "stat_time_day"), ("meta_ads", "date_start"), ("reddit_ads", "date")):
        rows = i.raw(f"raw_{source}").where("campaign_id = 'C_1'")
        if source == "meta_ads":
            rows = rows.withColumn(day, F.when(F.col("impressions") % 4 == 0, F.lit("n/a")).otherwise(F.col(day)))
        landing.land_rows(rows.withColumn("_month", F.date_trunc("year", F.col(day).try_cast("timestamp")).cast("date")), path, source, "_month", STAMP)
    job = _job(i, path)
    result = jobs.paid_media_job(job)
    return i.spark.createDataFrame([(result.status, len(result.loads), len(job._scratch))], "status string, tables bigint, staged bigint")


@query("S9 K14", f"SELECT * FROM cdm_instagram_posts WHERE {FEBRUARY}", ORGANIC_DOUBLES)
def landing_late_delivery(i: Inputs) -> DataFrame:
    """A tenth of the rows arrives in a later delivery, which is landed twice, to days that have landed before."""
    path = i.scratch("landing")
    rows = i.raw("raw_instagram_posts")
    late = F.col("media_id").cast("bigint") % 10 == 6
    landing.land_rows(rows.where(~late), path, "instagram_organic", "timestamp", STAMP)
    later = RunStamp("2024-01-02T00:00:00+00:00", "test")
    for _ in range(2):
        landing.land_rows(rows.where(late), path, "instagram_organic", "timestamp", later)
    got = landing.read_landing(i.spark, path, "instagram_organic", dt.date(1998, 2, 1), dt.date(1998, 2, 28))
    return organic.combine_posts([organic.instagram_posts(got, STAMP)])


_NO_DAY = "substring(post_id, -1) IN ('1', '2')"


@query(
    "K3 K5 K7",
    f"SELECT * REPLACE (CASE WHEN {FEBRUARY} THEN reach + 1 ELSE reach END AS reach) FROM cdm_organic WHERE NOT {_NO_DAY}",
    ORGANIC_DOUBLES,
)
def stored_without_days(i: Inputs) -> DataFrame:
    """Rows without a day in a full load and in a corrected month: no load destroys or keeps them as a day."""
    path = i.scratch("cdm_organic_daily")
    planted = i.cdm_organic.withColumn("date", F.when(~F.expr(_NO_DAY), F.col("date")))
    corrected = planted.where(f"date IS NULL OR {FEBRUARY}").withColumn("reach", F.col("reach") + 1)
    for batch in (planted, corrected, corrected):
        result = tables.load_table(batch, path, schemas.CDM_ORGANIC, "date")
        assert result.rejected == planted.where("date IS NULL").count()
    return _stored_organic(i, path)


_AMOUNT = (
    "CASE WHEN l_linenumber = 1 THEN 'nan' WHEN l_linenumber = 2 THEN '0.0000004' WHEN l_linenumber = 3 THEN '10000000000000' "
    "WHEN l_linenumber = 4 THEN '-9200000000000' ELSE CAST(l_orderkey % 97 AS STRING) || '.0000001' END"
)


@query(
    "A15 A17 A24 X2 C9",
    f"SELECT l_returnflag, CAST(SUM(CASE WHEN amount <> 'nan' THEN CAST(amount AS DECIMAL(38, 18)) END) AS DOUBLE) AS total_usd FROM "
    f"(SELECT l_returnflag, {_AMOUNT.replace('STRING', 'VARCHAR')} AS amount FROM lineitem) GROUP BY 1",
)
def money_of_odd_amounts(i: Inputs) -> DataFrame:
    """Amounts below a millionth, of trillions, and no numbers at all."""
    amounts = i.table("lineitem").select("l_returnflag", parse_double(F.expr(_AMOUNT)).alias("amount"))
    return amounts.groupBy("l_returnflag").agg(money_sum(F.col("amount")).alias("total_usd"))


@query(
    "J5 X2 X3",
    "SELECT customer_user_id, MIN(install_date) AS install_date FROM recent_installs WHERE customer_user_id <> '' AND NOT is_skan "
    "AND substring(appsflyer_id, -1) <> '4' GROUP BY 1",
)
def first_installs_with_days(i: Inputs) -> DataFrame:
    """Installs without a day are nobody's first."""
    day = F.when(F.substring("appsflyer_id", -1, 1) != "4", F.col("install_date"))
    return lifecycle.first_installs(i.recent_installs.withColumn("install_date", day)).select("customer_user_id", "install_date")


_ONE_MONTH = "event_date BETWEEN DATE '2024-03-01' AND DATE '2024-03-31'"


@query(
    "X4",
    f"SELECT {month('event_date')} AS month, {long('COUNT(DISTINCT customer_user_id)')} AS users, {long('COUNT(DISTINCT customer_user_id)')} AS churned "
    f"FROM recent_events WHERE event_name = 'subscription_started' AND customer_user_id <> '' AND {_ONE_MONTH} GROUP BY 1",
)
def states_with_mixed_times(i: Inputs) -> DataFrame:
    """Each start of a month, written as T01:00:00Z, is cancelled at 23:00 of the same day in the other notation."""
    starts = i.recent_events.where(f"event_name = 'subscription_started' AND customer_user_id <> '' AND {_ONE_MONTH}")
    day = F.col("event_date").cast("string")
    early = starts.withColumn("event_timestamp", F.concat(day, F.lit("T01:00:00Z")))
    late = starts.withColumns({"event_timestamp": F.concat(day, F.lit(" 23:00:00")), "event_name": F.lit("subscription_cancelled")})
    # A start in the month before makes every one of them a churn of its month.
    before = early.withColumns({n: F.add_months("event_date", -1) if n == "event_date" else F.lit("2000-01-01 00:00:00") for n in ("event_date", "event_timestamp")})
    got = lifecycle.subscription_months(before.union(early).union(late)).where("churned > 0")
    months = starts.groupBy(F.trunc("event_date", "month").alias("month")).agg(F.countDistinct("customer_user_id").alias("users"))
    return months.join(got.select("month", "churned"), "month", "left")


def _reports(i: Inputs, name: str) -> str:
    """The events in two reports: columns in another order, a column less, JSON text over several lines."""
    path = i.scratch(name)
    rows = i.raw("raw_events").withColumn("event_value", F.regexp_replace("event_value", r"\{", "{\n "))
    options = dict(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows.where("event_id % 2 = 0").write.options(**options).csv(path)
    rows.where("event_id % 2 = 1").select(*reversed(rows.columns)).write.mode("append").options(**options).csv(path)
    return path


@query("S4 S5", "SELECT * FROM cdm_events", "revenue_usd distance_km")
def landed_reports_of_two_layouts(i: Inputs) -> DataFrame:
    got = landing.read_report(i.spark, _reports(i, "reports"))
    whole = got.withColumn("event_value", F.regexp_replace("event_value", r"\{\n ", "{"))
    return attribution.in_app_events(whole, STAMP)


@query("G2 K5 G5", "SELECT * FROM cdm_events UNION ALL SELECT * FROM cdm_events UNION ALL SELECT * FROM cdm_events WHERE platform = 'ios'", "revenue_usd distance_km")
def one_event_log(i: Inputs) -> DataFrame:
    """A stream, a batch load and a repeated batch load feed one table; events without an id are all kept."""
    landed, log, checkpoint = i.scratch("event_files"), i.scratch("event_log"), i.scratch("checkpoint")
    rows = i.raw("raw_events")
    rows.write.parquet(landed)
    rows.where("event_id % 10 < 4").write.mode("append").parquet(landed)
    rows.where("platform = 'iOS'").withColumn("event_id", F.lit(None).cast("bigint")).write.mode("append").parquet(landed)
    stream = event_log.event_stream(i.spark, landed, rows.schema)
    event_log.append_events(event_log.cleaned_events(stream, "event_id", STAMP), log, checkpoint).awaitTermination()
    for _ in range(2):
        tables.load_table(i.cdm_events, log, schemas.CDM_FUNNEL_EVENTS, "event_date", tables.APPEND, load="batch-1")
    return tables.read_table(i.spark, log, schema=schemas.CDM_FUNNEL_EVENTS)


@query("K11 G8", "SELECT * FROM mart_organic", "avg_watch_time_s avg_completion_rate avg_engagement_rate viral_reach_multiplier")
def refreshed_marts(i: Inputs) -> DataFrame:
    """Marts built with a wrong day, then brought up to date; what has changed is found."""
    root = i.scratch("models")
    wrong = i.cdm_organic.withColumn("reach", F.when(F.expr("date = DATE '1998-02-10'"), F.col("reach") * 3).otherwise(F.col("reach")))
    models.materialise_models(i.spark, {"cdm_organic_daily": wrong}, root)
    return models.refresh_models(i.spark, {"cdm_organic_daily": i.cdm_organic}, root)["mart_organic_performance"]


PAGE_ROWS = 5_000


#: Deletes a shuffle's files as soon as the statement that made them has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _pages(i: Inputs, feed: str, rows: DataFrame, per_line: bool) -> DataFrame:
    """Responses of many rows with their paging, one a line or one a file, compressed.

    Rows become pages in the task that has them, without a shuffle; a page's number is its task's and its own.
    """
    path = i.scratch(feed)
    held = i.spark.conf.get(_CLEANUP, "false")
    i.spark.conf.set(_CLEANUP, "true")
    try:
        # A page holds at most PAGE_ROWS rows, however many there are in all; few rows make about 23 pages.
        size = max(1, min(PAGE_ROWS, rows.count() // 23))
        meta = json.dumps({"source": "api", "attribution_window": "7d"})
        listed = landing.ENVELOPES[feed].rows == "data.list"
        begin = f'{{"_meta": {meta}, "data": ' + ('{"list": [' if listed else "[")
        end = '], "page_info": %s}}' if listed else '], "paging": %s}'
        break_ = "" if per_line else "\n"

        def paged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Each `size` rows of the task as one text, and what is left at its end as another."""
            task, number, waiting = TaskContext.get().partitionId(), 0, []

            def page(own: list[pa.Array]) -> pa.RecordBatch:
                paging = json.dumps({"task": task, "page": number, "page_size": size})
                body = f",{break_}".join(row for part in own for row in part.to_pylist())
                return pa.RecordBatch.from_arrays([pa.array([begin + break_ + body + break_ + end % paging])], ["value"])

            for batch in batches:
                column = batch.column(0)
                while sum(map(len, waiting)) + len(column) >= size:
                    own = column.slice(0, size - sum(map(len, waiting)))
                    yield page([*waiting, own])
                    column, number, waiting = column.slice(len(own)), number + 1, []
                if len(column):
                    waiting.append(column)
            if waiting:
                yield page(waiting)

        text = F.to_json(F.struct(*rows.columns), {"pretty": str(not per_line).lower()})
        writer = rows.select(text.alias("row")).mapInArrow(paged, "value string").write.option("compression", "gzip")
        if not per_line:
            writer = writer.option("maxRecordsPerFile", 1)
        writer.text(path)
    finally:
        i.spark.conf.set(_CLEANUP, held)
    return landing.read_envelopes(i.spark, path, feed, per_line=per_line)


_BOTH = "SELECT * FROM {0} UNION ALL SELECT * FROM {0}"


@query("S1 S2 S8", " UNION ALL ".join(_BOTH.format(n) for n in ("cdm_tiktok", "cdm_meta")), "cpm cpc ctr cpi cps roas cost_usd conversion_value_usd")
def landed_pages_of_ads(i: Inputs) -> DataFrame:
    frames = []
    for per_line in (True, False):
        frames.append(paid.tiktok_ads(_pages(i, "tiktok_ads", i.raw("raw_tiktok_ads"), per_line)))
        frames.append(paid.meta_ads(_pages(i, "meta_ads", i.raw("raw_meta_ads"), per_line)))
    return reduce(lambda a, b: a.unionByName(b), frames)


@query("K8 K9", f"SELECT 'success' AS status, {long('COUNT(*)')} AS rows, MIN(date) AS first_day, MAX(date) AS last_day FROM cdm_organic")
def load_result_of_whole_range(i: Inputs) -> DataFrame:
    """A load reports the days it has placed, not those it has rejected."""
    path = i.scratch("cdm_organic_daily")
    planted = i.cdm_organic.union(i.cdm_organic.limit(5).withColumn("date", F.lit(None).cast("date")))
    assert WHOLE_RANGE[0] < WHOLE_RANGE[1]
    return _results(i, tables.load_table(planted, path, schemas.CDM_ORGANIC, "date"))

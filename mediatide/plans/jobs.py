"""Batch jobs: read a date range from the landing, map, check, load, summarise.

A batch is written once to the shared scratch folder and then read back by the checks and
the load.  That parses the landed rows a single time and cuts the lineage, so losing an
executor during the load never re-reads the landing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediatide.operators import attribution, organic, paid, profile, quality
from mediatide.operators.fields import RunStamp
from mediatide.schemas import CDM_SCHEMAS, PARTITION_COLUMN
from mediatide.session import scratch_path
from mediatide.sources.files import Folder, partition_value
from mediatide.sources.landing import Delivered, delivered, read_landing, unreadable_rows
from mediatide.sources.rejected import keyed, replace_rejected
from mediatide.sources.tables import APPEND, LoadResult, load_table, read_table
from mediatide.streaming.events import merged

#: What the landing's rows without a readable day are kept in, and the name of what the attribution job adds to the event log.
UNREADABLE, LANDED = "landed__rejected", "landed"

# The default backfill range.
BACKFILL = (dt.date(2024, 10, 1), dt.date(2025, 3, 31))

CLUSTER = {
    "cdm_paid_media_daily": ("platform", "campaign_id", "ad_id"),
    "cdm_organic_daily": ("platform",),
    "cdm_installs": ("channel",),
    "cdm_funnel_events": ("event_name",),
}


def date_range(
    day: dt.date | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    backfill: bool = False,
    today: dt.date | None = None,
) -> tuple[dt.date, dt.date]:
    """Backfill, a single day, from `start` to `end` (or today), or else yesterday."""
    today = today or dt.datetime.now(dt.timezone.utc).date()
    if backfill:
        return BACKFILL
    if day:
        return day, day
    if start:
        return start, end or today
    yesterday = today - dt.timedelta(days=1)
    return yesterday, yesterday


@dataclass
class JobResult:
    status: str
    start: dt.date
    end: dt.date
    loads: dict[str, LoadResult] = field(default_factory=dict)
    report: list = field(default_factory=list)
    previews: dict[str, DataFrame] = field(default_factory=dict)


class Job:
    """Shared by the three jobs: where feeds land, where tables are kept, which days."""

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        warehouse: str,
        start: dt.date,
        end: dt.date,
        dry_run: bool = False,
        stamp: RunStamp | None = None,
    ):
        self.spark, self.landing, self.warehouse = spark, landing, warehouse
        self.start, self.end, self.dry_run = start, end, dry_run
        self.stamp = stamp or RunStamp()
        self._scratch: list[str] = []

    def feed(self, source: str) -> DataFrame:
        return read_landing(self.spark, self.landing, source, self.start, self.end)

    def unreadable(self, source: str) -> DataFrame | None:
        """Rows of the run's deliveries whose day cannot be read, None if there are none.

        A delivery takes part if it has a day of the run's range; one that has no readable day at all takes part in the first run
        that meets it.  What older deliveries have left behind concerns no later run.
        """
        names = self._faulty(source, delivered(self.spark, self.landing, source, self.start, self.end))
        return unreadable_rows(self.spark, self.landing, source, names) if names else None

    def _held(self, source: str) -> set[str]:
        """Deliveries of a source that have rejected rows on record."""
        names = (partition_value(p) for p in Folder(self.spark, self.path(UNREADABLE)).partitions(1))
        return {n.split(" ", 1)[1] for n in names if n and n.split(" ", 1)[0] == source}

    def _faulty(self, source: str, found: Delivered) -> set[str]:
        return set(found.unreadable & found.in_range) | (set(found.dayless) - self._held(source))

    def record_unreadable(self, *sources: str) -> int:
        """Keeps the unreadable rows of the run's deliveries, each once; how many there are.

        A delivery that has been landed again replaces what it had on record, also if it has no such rows any more.
        """
        total, frames, names = 0, [], []
        for source in sources:
            found = delivered(self.spark, self.landing, source, self.start, self.end)
            faulty = self._faulty(source, found)
            names += [f"{source} {n}" for n in faulty | (set(found.in_range) & self._held(source))]
            if faulty:
                rows = unreadable_rows(self.spark, self.landing, source, faulty)
                content = [c for c in rows.columns if c != "_ingest"]
                text = F.to_json(F.struct(*content), {"ignoreNullFields": "false"})
                frames.append(rows.select(F.lit(source).alias("source"), "_ingest", text.alias("row")))
                total += rows.count()
        if names and not self.dry_run:
            empty = self.spark.createDataFrame([], "source string, _ingest string, row string")
            rows = reduce(DataFrame.unionByName, frames, empty)
            named = keyed(rows, F.concat_ws(" ", "source", "_ingest")).drop("_ingest")
            replace_rejected(named, self.path(UNREADABLE), names)
        return total

    def mapped(self, mapping: Callable[..., DataFrame], source: str) -> tuple[DataFrame, DataFrame | None]:
        """A feed's rows in the CDM, and those of its rows that have no readable day."""
        odd = self.unreadable(source)
        return mapping(self.feed(source), stamp=self.stamp), odd if odd is None else mapping(odd.drop("_ingest"), stamp=self.stamp)

    def path(self, table: str) -> str:
        return f"{self.warehouse}/{table}"

    def staged(self, df: DataFrame, table: str) -> DataFrame:
        """The batch from the scratch folder; a dry run stays lazy and writes nothing."""
        if self.dry_run:
            return df
        path = scratch_path(self.spark, table)
        self._scratch.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def load(self, df: DataFrame, table: str, mode: str = "incremental", rejected: int = 0) -> LoadResult:
        """Loads a batch; what is added to a log is known as the landing's and replaces the landing's earlier rows of the run's days.

        `rejected` rows were recorded before and are counted with those that the load itself cannot place.
        """
        named = {"load": LANDED, "covers": (self.start, self.end)} if mode == APPEND else {}
        schema = CDM_SCHEMAS[table]
        if "_event_id" in df.columns:
            schema = T.StructType([*schema.fields, T.StructField("_event_id", T.StringType())])
        got = load_table(
            df,
            self.path(table),
            schema,
            PARTITION_COLUMN[table],
            mode,
            CLUSTER.get(table, ()),
            self.dry_run,
            **named,
        )
        return replace(got, rejected=got.rejected + rejected)

    @contextmanager
    def cleaning_up(self) -> Iterator[None]:
        """Discards what has been staged if the job fails; a job that ends well keeps it for its previews."""
        try:
            yield
        except BaseException:
            self.discard_scratch()
            raise

    def stored(self, table: str, start: dt.date, end: dt.date) -> DataFrame:
        return read_table(
            self.spark, self.path(table), PARTITION_COLUMN[table], start, end, CDM_SCHEMAS[table]
        )

    def discard_scratch(self) -> None:
        """Deletes the staged batches; the previews read them, so call it after those."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in self._scratch:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        self._scratch.clear()

    def result(self, status: str = "success") -> JobResult:
        return JobResult("dry_run" if self.dry_run and status == "success" else status, self.start, self.end)


def paid_media_job(job: Job) -> JobResult:
    with job.cleaning_up():
        return _paid_media(job)


def _paid_media(job: Job) -> JobResult:
    """Three ad feeds to `cdm_paid_media_daily`; a failed error check stops the load.

    The checks see the run's unreadable rows as well, the load only what has a day.
    """
    table = "cdm_paid_media_daily"
    feeds = {"tiktok_ads": paid.tiktok_ads, "meta_ads": paid.meta_ads, "reddit_ads": paid.reddit_ads}
    frames = {source: job.mapped(mapping, source) for source, mapping in feeds.items()}
    batch = job.staged(paid.combine_ads([rows for rows, _ in frames.values()]), table)
    odd = [rows for _, rows in frames.values() if rows is not None]
    checked = batch
    if odd:
        # Staged before they are on record: only a first run meets a delivery without any day.
        checked = batch.unionByName(job.staged(paid.combine_ads(odd), f"{table}_unreadable"))
    rejected = job.record_unreadable(*feeds)
    report = quality.validate_paid_media(checked).collect()  # at most 34 rows
    try:
        quality.gate(report)
    except quality.QualityError:
        job.discard_scratch()
        failed = job.result("failed_validation")
        failed.report = report
        return failed
    result = job.result()
    result.report = report
    result.loads[table] = job.load(batch, table, rejected=rejected)
    result.previews = {
        "platforms": profile.paid_preview(batch),
        "windows": profile.group_sizes(batch, "platform", "attribution_window"),
        "date_range": profile.date_range(batch),
        "null_counts": profile.null_counts(batch),
    }
    return result


def organic_job(job: Job) -> JobResult:
    with job.cleaning_up():
        return _organic(job)


def _organic(job: Job) -> JobResult:
    """Three post feeds to `cdm_organic_daily`."""
    table = "cdm_organic_daily"
    frames = [
        organic.instagram_posts(job.feed("instagram_organic"), stamp=job.stamp),
        organic.tiktok_posts(job.feed("tiktok_organic"), stamp=job.stamp),
        organic.reddit_posts(job.feed("reddit_organic"), stamp=job.stamp),
    ]
    batch = job.staged(organic.combine_posts(frames), table)
    rejected = job.record_unreadable("instagram_organic", "tiktok_organic", "reddit_organic")
    result = job.result()
    result.loads[table] = job.load(batch, table, rejected=rejected)
    result.previews = {
        "platforms": profile.organic_preview(batch),
        "rates": profile.rate_check(batch),
        "content": profile.group_sizes(batch, "platform", "content_type", name="posts"),
        "empty_columns": profile.empty_columns(batch),
    }
    return result


def attribution_job(job: Job, replace_events: bool = False, event_id: str | None = None) -> JobResult:
    with job.cleaning_up():
        return _attribution(job, replace_events, event_id)


def _attribution(job: Job, replace_events: bool, event_id: str | None) -> JobResult:
    """Installs and events to their tables, then the two summaries of the touched periods.

    Summaries are recomputed from the stored installs of whole days and months, so a one-day
    run does not leave a month's cohort with that day only.  Events are added to the event log, which a stream may
    feed as well: the run's days take the place of what earlier runs, of whatever ranges, had added for these days.
    With `event_id`, a column of the landed events, an event that another load of the log holds is not added again.
    `replace_events=True` keeps a table without loads instead, replaced by day like the others.
    """
    installs = job.staged(attribution.installs(job.feed("installs"), stamp=job.stamp), "cdm_installs")
    landed = job.feed("in_app_events")
    if event_id:
        landed = landed.withColumn("_event_id", F.col(event_id).cast("string"))
    events = job.staged(attribution.in_app_events(landed, stamp=job.stamp), "cdm_funnel_events")
    result = job.result()
    loads = result.loads
    rejected = {source: job.record_unreadable(source) for source in ("installs", "in_app_events")}
    loads["cdm_installs"] = job.load(installs, "cdm_installs", rejected=rejected["installs"])
    if replace_events or job.dry_run:
        mode = "incremental" if replace_events else APPEND
        loads["cdm_funnel_events"] = job.load(events, "cdm_funnel_events", mode, rejected["in_app_events"])
    else:
        with merged(events, job.path("cdm_funnel_events"), LANDED) as new:
            loads["cdm_funnel_events"] = job.load(new, "cdm_funnel_events", APPEND, rejected["in_app_events"])
    days = months = installs
    if not job.dry_run and loads["cdm_installs"].first_day:
        first, last = loads["cdm_installs"].first_day, loads["cdm_installs"].last_day
        next_month = (last.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        # Both are read by partition.  A day in between without new installs gives the same rows again.
        days = job.stored("cdm_installs", first, last)
        months = job.stored("cdm_installs", first.replace(day=1), next_month - dt.timedelta(days=1))
    cohorts = job.staged(attribution.ltv_cohort(months, job.stamp), "cdm_ltv_cohort")
    loads["cdm_funnel_summary"] = job.load(
        attribution.funnel_summary(days, job.stamp), "cdm_funnel_summary"
    )
    loads["cdm_ltv_cohort"] = job.load(cohorts, "cdm_ltv_cohort")
    result.previews = {
        "channels": profile.channel_preview(installs),
        "consent": profile.group_sizes(installs, "att_status", name="installs"),
        "skan": profile.skan_share(installs),
        "status": profile.status_rollup(cohorts),
    }
    return result


def rounded_cdm_tables(
    tiktok: DataFrame, meta: DataFrame, reddit: DataFrame, posts: DataFrame, installs: DataFrame, events: DataFrame
) -> dict[str, DataFrame]:
    """All tables of the older data model from its six feeds."""
    ads = [
        paid.tiktok_ads(tiktok, rounded=True),
        paid.meta_ads(meta, rounded=True),
        paid.reddit_ads(reddit, rounded=True),
    ]
    installs_table = attribution.installs_old(installs)
    return {
        "cdm_paid_media_daily": paid.combine_ads(ads),
        "cdm_organic_daily": organic.mixed_posts(posts),
        "cdm_installs": installs_table,
        "cdm_funnel_events": attribution.app_events(events),
        "cdm_funnel_summary": attribution.funnel_summary_old(installs_table),
    }

"""Registering queries, and the inputs they share.

"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.feeds import FAULTY_INSTALLS, FAULTY_PAID, feed
from checks.oracle import statement
from mediatide.operators import attribution, marts, organic, paid, staging
from mediatide.operators.fields import RunStamp
from mediatide.schemas import AUDIT_COLUMNS
from mediatide.session import scratch_path

# The day that the calendar reports look back from, inside the supplied tables' range.
AS_OF = "2001-08-15"
STAMP = RunStamp("2024-01-01T00:00:00+00:00", "test")


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


ENTRIES: dict[str, Entry] = {}


class Inputs:
    """Feeds, CDM tables and models over one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str, **frames: DataFrame) -> DataFrame:
        return feed(self.spark, self.sf_dir, name, **frames)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """The rows from files, as a feed or table would come in use."""
        path = self.scratch(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def ads(self) -> list[DataFrame]:
        return [
            paid.tiktok_ads(self.raw("raw_tiktok_ads"), stamp=STAMP),
            paid.meta_ads(self.raw("raw_meta_ads"), stamp=STAMP),
            paid.reddit_ads(self.raw("raw_reddit_ads"), stamp=STAMP),
        ]

    @cached_property
    def old_ads(self) -> list[DataFrame]:
        return [
            paid.tiktok_ads(self.raw("raw_tiktok_ads"), rounded=True),
            paid.meta_ads(self.raw("raw_meta_ads"), rounded=True),
            paid.reddit_ads(self.raw("raw_reddit_ads"), rounded=True),
        ]

    @cached_property
    def cdm_paid(self) -> DataFrame:
        return paid.combine_ads(self.ads)

    @cached_property
    def old_paid(self) -> DataFrame:
        return paid.combine_ads(self.old_ads)

    @cached_property
    def faulty_paid(self) -> DataFrame:
        return self.raw(FAULTY_PAID, cdm_paid=self.cdm_paid)

    @cached_property
    def posts(self) -> list[DataFrame]:
        return [
            organic.instagram_posts(self.raw("raw_instagram_posts"), STAMP),
            organic.tiktok_posts(self.raw("raw_tiktok_posts"), STAMP),
            organic.reddit_posts(self.raw("raw_reddit_posts"), STAMP),
        ]

    @cached_property
    def cdm_organic(self) -> DataFrame:
        return organic.combine_posts(self.posts)

    @cached_property
    def old_organic(self) -> DataFrame:
        return organic.mixed_posts(self.raw("raw_mixed_posts"))

    @cached_property
    def cdm_installs(self) -> DataFrame:
        return attribution.installs(self.raw("raw_installs"), STAMP)

    @cached_property
    def recent_installs(self) -> DataFrame:
        return attribution.installs(self.raw("raw_recent_installs"), STAMP)

    @cached_property
    def faulty_installs(self) -> DataFrame:
        return self.raw(FAULTY_INSTALLS, cdm_installs=self.cdm_installs)

    @cached_property
    def old_installs(self) -> DataFrame:
        return attribution.installs_old(self.raw("raw_installs_old"))

    @cached_property
    def cdm_events(self) -> DataFrame:
        return attribution.in_app_events(self.raw("raw_events"), STAMP)

    @cached_property
    def recent_events(self) -> DataFrame:
        return attribution.in_app_events(self.raw("raw_recent_events"), STAMP)

    @cached_property
    def stg_paid(self) -> DataFrame:
        return staging.stg_paid_media(self.cdm_paid)

    @cached_property
    def stg_organic(self) -> DataFrame:
        return staging.stg_organic(self.cdm_organic)

    @cached_property
    def stg_installs(self) -> DataFrame:
        return staging.stg_installs(self.cdm_installs)

    @cached_property
    def performance(self) -> DataFrame:
        return marts.channel_performance_daily(self.stg_paid)

    @cached_property
    def performance_old(self) -> DataFrame:
        return marts.channel_performance_daily_old(staging.stg_paid_media_old(self.old_paid))

    @cached_property
    def funnel(self) -> DataFrame:
        return marts.funnel_by_channel(self.stg_installs)

    @cached_property
    def funnel_old(self) -> DataFrame:
        return marts.funnel_by_channel_old(staging.stg_installs_old(self.old_installs))

    @cached_property
    def cohort_table(self) -> DataFrame:
        return attribution.ltv_cohort(self.cdm_installs, STAMP)


def comparable(df: DataFrame) -> DataFrame:
    """Without audit columns; doubles to six digits, since the order of a sum is not fixed."""
    scale = F.lit(1e6)
    columns = [
        (F.rint(F.col(f.name) * scale) / scale).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
        for f in df.schema.fields
        if f.name not in AUDIT_COLUMNS
    ]
    return df.select(*columns)


def query(covers: str, sql: str | None = None, doubles: str = "", name: str | None = None):
    """Registers a function of Inputs under its own name, with its SQL when there is one."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Inputs(spark, sf_dir)))

        text = statement(sql, doubles) if sql else None
        ENTRIES[name or build.__name__] = Entry(run, text, tuple(covers.split()))
        return build

    return register


RATIOS = "cpm cpc ctr cpi cps roas"
PAID_DOUBLES = f"cost_usd conversion_value_usd {RATIOS}"
ORGANIC_DOUBLES = (
    "blended_engagement_rate avg_watch_time_s video_completion_rate platform_engagement_rate"
)
PERFORMANCE_OLD = f"cost_usd revenue_usd {RATIOS} video_view_rate engagement_rate"
PERFORMANCE = f"{PERFORMANCE_OLD} video_completion_rate"
STAGES_OLD = (
    "revenue_usd avg_days_to_subscribe install_to_reg_rate reg_to_activation_rate activation_to_paywall_rate "
    "paywall_to_trial_rate trial_to_sub_rate overall_cvr ltv_per_install"
)
STAGES = f"{STAGES_OLD} arpu ios_att_rate skan_pct"
LTV = (
    "cohort_revenue_usd sub_rate arpu ltv_per_install avg_days_to_convert annual_mix monthly_mix family_mix"
)
CONTENT = "avg_watch_time_s avg_completion_rate avg_engagement_rate"
DAILY_OLD = "revenue_usd reg_rate act_rate paywall_rate trial_rate sub_rate overall_cvr"
DAILY = f"{DAILY_OLD} ltv_per_install arpu ios_att_rate skan_pct"
COHORT = "revenue_usd avg_days_to_sub sub_rate arpu ltv_per_install"
HEALTH_OLD = "overall_cvr ltv_per_install revenue_usd"
HEALTH = f"{HEALTH_OLD} avg_days_to_subscribe ios_att_rate skan_pct"

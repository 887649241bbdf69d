"""Ad-platform feeds to `cdm_paid_media_daily`."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediatide.functions.metrics import paid_efficiency
from mediatide.functions.numbers import ratio_or_zero, round_exact
from mediatide.functions.text import first_action_value
from mediatide.operators.fields import Feed, RunStamp
from mediatide.schemas import CDM_PAID_MEDIA

_TEXTS = (
    "campaign_id", "campaign_name", "objective", "ad_group_id", "ad_group_name", "ad_id",
    "ad_name", "country",
)
_COUNTS = (
    "impressions", "clicks", "installs", "conversions", "video_views", "video_completions",
    "likes", "comments", "shares",
)


@dataclass(frozen=True)
class AdPlatform:
    """How one platform's feed maps to the CDM; a CDM column without a field is zero."""

    name: str
    raw_source: str
    raw_source_rounded: str
    window: str
    fields: dict[str, str]
    extra_engagement: tuple[str, ...] = ()
    extra_engagement_rounded: tuple[str, ...] = ()
    price_per_conversion: float | None = None
    roas_field: str | None = None
    native_ratios: dict[str, str] | None = None
    window_field: str | None = None


# Names of the platforms' fields, their sources and attribution windows.
TIKTOK = AdPlatform(
    name="tiktok",
    raw_source="tiktok_ads_api_v1.3",
    raw_source_rounded="tiktok_ads_api_v1.3",
    window="7d_click_1d_view",
    fields={
        "date": "stat_time_day",
        "campaign_id": "campaign_id",
        "campaign_name": "campaign_name",
        "objective": "objective_type",
        "ad_group_id": "adgroup_id",
        "ad_group_name": "adgroup_name",
        "ad_id": "ad_id",
        "ad_name": "ad_name",
        "country": "country_code",
        "impressions": "impressions",
        "clicks": "clicks",
        "cost_usd": "spend",
        "installs": "app_install",
        "conversions": "conversion",
        "conversion_value_usd": "value",
        "video_views": "video_play_actions",
        "video_completions": "video_views_p100",
        "likes": "likes",
        "comments": "comments",
        "shares": "shares",
    },
    extra_engagement=("follows",),
)
META = AdPlatform(
    name="instagram_meta",
    raw_source="meta_marketing_api_v19.0",
    raw_source_rounded="meta_marketing_api_v19",
    window="7d_click_1d_view",
    fields={
        "date": "date_start",
        "campaign_id": "campaign_id",
        "campaign_name": "campaign_name",
        "objective": "objective",
        "ad_group_id": "adset_id",
        "ad_group_name": "adset_name",
        "ad_id": "ad_id",
        "ad_name": "ad_name",
        "country": "country",
        "impressions": "impressions",
        "clicks": "link_clicks",
        "cost_usd": "spend",
        "installs": "mobile_app_installs",
        "conversions": "purchases",
        "video_views": "video_views",
        "video_completions": "video_thruplay_watched_actions",
        "likes": "post_reactions",
        "comments": "post_comments",
        "shares": "post_shares",
    },
    extra_engagement=("post_saves",),
    extra_engagement_rounded=("post_saves",),
    price_per_conversion=9.99,
    roas_field="purchase_roas",
)
REDDIT = AdPlatform(
    name="reddit",
    raw_source="reddit_ads_api_v3",
    raw_source_rounded="reddit_ads_api_v3",
    window="30d_click",
    fields={
        "date": "date",
        "campaign_id": "campaign_id",
        "campaign_name": "campaign_name",
        "objective": "objective",
        "ad_group_id": "ad_group_id",
        "ad_group_name": "ad_group_name",
        "ad_id": "ad_id",
        "ad_name": "ad_name",
        "country": "country",
        "impressions": "impressions",
        "clicks": "clicks",
        "cost_usd": "spend_usd",
        "installs": "app_installs",
        "video_views": "video_views",
        "likes": "upvotes",
        "comments": "comments",
        "shares": "shares",
    },
    native_ratios={"cpm": "ecpm", "cpc": "ecpc", "ctr": "ctr"},
    window_field="attribution_window",
)
PLATFORMS = (TIKTOK, META, REDDIT)


def _roas(feed: Feed, platform: AdPlatform, scalar_only: bool) -> Column:
    name = platform.roas_field
    if isinstance(feed.type_of(name), T.ArrayType):
        value = F.get(F.col(name), 0)["value"].try_cast("double")
        return F.coalesce(value, F.lit(0.0))
    if scalar_only or not isinstance(feed.type_of(name), T.StringType):
        return feed.double(name)
    return first_action_value(F.col(name))


def _cleaned(raw: DataFrame, platform: AdPlatform, extra: tuple[str, ...], rounded: bool) -> DataFrame:
    """Renamed and typed columns of the feed, before anything is derived from them."""
    feed = Feed(raw)
    names = platform.fields
    zero = F.lit(0).cast("bigint")
    # Not-a-number money counts as zero, as a missing one does.
    money = lambda field: F.nanvl(feed.double(field), F.lit(0.0))

    counts = {c: feed.long(names[c]) if c in names else zero for c in _COUNTS}
    columns = [feed.day(names["date"]).alias("date")]
    columns += [feed.text(names[c]).alias(c) for c in _TEXTS]
    columns += [counts[c].alias(c) for c in _COUNTS]
    columns += [feed.long(f).alias(f"_extra_{i}") for i, f in enumerate(extra)]
    columns.append(money(names["cost_usd"]).alias("cost_usd"))
    if "conversion_value_usd" in names:
        columns.append(money(names["conversion_value_usd"]).alias("conversion_value_usd"))
    if platform.roas_field:
        columns.append(F.nanvl(_roas(feed, platform, rounded), F.lit(0.0)).alias("_roas"))
    for ratio_name, field in (platform.native_ratios or {}).items():
        columns.append(money(field).alias(f"_{ratio_name}"))
    if platform.window_field and feed.type_of(platform.window_field) is not None:
        columns.append(F.col(platform.window_field).alias("_window"))
    return raw.select(*columns)


def _ratios(platform: AdPlatform, rounded: bool) -> list[Column]:
    computed = dict(
        zip(
            ("cpm", "cpc", "ctr", "cpi", "cps", "roas"),
            paid_efficiency("cost_usd", "conversion_value_usd", ratio_or_zero),
        )
    )
    if rounded:
        for name in computed:
            digits = 6 if name == "ctr" else 4
            computed[name] = round_exact(computed[name], digits)
    elif platform.native_ratios:
        for name in platform.native_ratios:
            computed[name] = F.col(f"_{name}")
    if platform.roas_field:
        computed["roas"] = F.col("_roas")
    return [column.alias(name) for name, column in computed.items()]


def normalise_ads(
    raw: DataFrame,
    platform: AdPlatform,
    stamp: RunStamp | None = None,
    rounded: bool = False,
    attribution_window: str | None = None,
) -> DataFrame:
    """One platform's feed as CDM rows.

    The canonical form has all 33 columns.  `rounded` gives the older table: ratios rounded,
    all recomputed, without likes, comments, shares and audit columns.
    A platform that states its attribution window in the envelope keeps that one.
    """
    extra = platform.extra_engagement_rounded if rounded else platform.extra_engagement
    rows = _cleaned(raw, platform, extra, rounded)

    if "conversion_value_usd" not in rows.columns:
        price = platform.price_per_conversion
        value = round_exact(F.col("conversions") * price, 2) if price else F.lit(0.0)
        rows = rows.withColumn("conversion_value_usd", value)

    parts = ["likes", "comments", "shares"] + [c for c in rows.columns if c.startswith("_extra_")]
    engagements = reduce(lambda a, b: a + b, (F.col(c) for c in parts))
    window = F.lit(attribution_window or platform.window)
    if "_window" in rows.columns and not rounded:
        window = F.coalesce(F.col("_window"), window)
    source = platform.raw_source_rounded if rounded else platform.raw_source

    columns = ["date", F.lit(platform.name).alias("platform"), F.lit("paid").alias("channel_type")]
    columns += list(_TEXTS)
    columns += ["impressions", "clicks", "cost_usd", "installs", "conversions"]
    columns += ["conversion_value_usd", "video_views", "video_completions"]
    columns.append(engagements.alias("engagements"))
    if not rounded:
        columns += ["likes", "comments", "shares"]
    columns += _ratios(platform, rounded)
    columns += [window.alias("attribution_window"), F.lit(source).alias("raw_source")]
    if not rounded:
        columns += (stamp or RunStamp()).columns()
    return rows.select(*columns)


def tiktok_ads(raw: DataFrame, **options) -> DataFrame:
    return normalise_ads(raw, TIKTOK, **options)


def meta_ads(raw: DataFrame, **options) -> DataFrame:
    return normalise_ads(raw, META, **options)


def reddit_ads(raw: DataFrame, **options) -> DataFrame:
    return normalise_ads(raw, REDDIT, **options)


def combine_ads(frames: list[DataFrame]) -> DataFrame:
    """All platforms in the CDM's column order.  Left unsorted: see `sorted_ads`."""
    union = reduce(lambda a, b: a.unionByName(b), frames)
    order = [name for name in CDM_PAID_MEDIA.names if name in union.columns]
    return union.select(*order)


def sorted_ads(cdm: DataFrame, by_ad: bool = True) -> DataFrame:
    """Total order of the CDM rows for a reader; a partitioned write sorts within files instead."""
    keys = ["date", "platform", "campaign_id"] + (["ad_id"] if by_ad else [])
    return cdm.orderBy(*keys)


def rows_for_platform(cdm: DataFrame, platform: str) -> DataFrame:
    return cdm.where(F.col("platform") == platform)


def fill_numbers(cdm: DataFrame) -> DataFrame:
    """NULL and NaN numbers become zero and every number gets its CDM type."""
    kinds = {f.name: f.dataType for f in CDM_PAID_MEDIA.fields if isinstance(f.dataType, T.NumericType)}
    filled = cdm.fillna(0, subset=[c for c in cdm.columns if c in kinds])
    return filled.withColumns({c: F.col(c).cast(kinds[c]) for c in cdm.columns if c in kinds})

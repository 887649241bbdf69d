import datetime as dt
import json
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from checks import catalog_planted
from checks.registry import Inputs
from mediatide import schemas
from mediatide.operators import attribution, organic, paid, staging
from mediatide.operators.fields import RunStamp
from mediatide.sources import landing

STAMP = RunStamp("2025-01-02T00:00:00+00:00", "9")


def land(tmp_path, name, payload):
    path = tmp_path / f"{name}.json"
    path.write_text(json.dumps(payload, indent=2))
    return str(path)


def test_tiktok_envelope_with_texts_zeros_and_gaps(spark, rows, tmp_path):
    full = {
        "stat_time_day": "2025-01-01", "campaign_id": "c", "adgroup_id": "g", "country_code": "US", "impressions": "1_000",
        "clicks": 10.9, "spend": "12.5", "app_install": 2, "conversion": 0, "value": "abc", "video_play_actions": 5,
        "video_views_p100": 1, "likes": 1, "comments": 2, "shares": 3, "follows": 4, "placement": "not read",
    }
    path = land(tmp_path, "t", {"code": 0, "_meta": {"source": "x"}, "data": {"page_info": {}, "list": [full, {"stat_time_day": ""}]}})
    cdm = paid.tiktok_ads(landing.read_envelopes(spark, path, "tiktok_ads"), stamp=STAMP)
    assert cdm.columns == schemas.CDM_PAID_MEDIA.names
    first, second = sorted(rows(cdm), key=lambda r: r["date"] is None)
    assert first["date"] == dt.date(2025, 1, 1) and first["impressions"] == 1000 and first["clicks"] == 10
    assert first["engagements"] == 10 and first["cpm"] == 12.5 and first["cpi"] == 6.25
    assert first["cps"] == 0 and first["roas"] == 0 and first["conversion_value_usd"] == 0
    assert (first["_extracted_at"], first["_pipeline_version"]) == ("2025-01-02T00:00:00+00:00", "9")
    assert second["date"] is None and second["campaign_id"] == "" and second["ctr"] == 0 and second["cost_usd"] == 0


def test_meta_roas_of_every_shape(spark, rows, tmp_path):
    shapes = {"a": [], "b": [{"action_type": "p", "value": "1.23"}], "c": 0.5, "d": None, "e": "0.75"}
    data = [{"date_start": "2025-01-01", "ad_id": k, "purchase_roas": v, "purchases": 3, "spend": 0} for k, v in shapes.items()]
    path = land(tmp_path, "m", {"_meta": {"attribution_window": ["7d_click", "1d_view"]}, "data": data, "paging": {}})
    raw = landing.read_envelopes(spark, path, "meta_ads")
    got = {r["ad_id"]: r for r in rows(paid.meta_ads(raw))}
    assert {k: r["roas"] for k, r in got.items()} == {"a": 0, "b": 1.23, "c": 0.5, "d": 0, "e": 0.75}
    assert got["a"]["conversion_value_usd"] == 29.97 and got["a"]["attribution_window"] == "7d_click_1d_view"
    assert "likes" not in paid.meta_ads(raw, rounded=True).columns
    typed = spark.createDataFrame([([("p", "2.5")],), ([],)], "purchase_roas array<struct<action_type string, value string>>")
    assert sorted(r["roas"] for r in rows(paid.meta_ads(typed))) == [0.0, 2.5]


def test_reddit_keeps_source_ratios_and_envelope_window(spark, rows, tmp_path):
    row = {"date": "2025-01-01T00:00:00Z", "impressions": 100, "clicks": 10, "spend_usd": 5, "ecpm": 1.5, "ecpc": 2.5, "ctr": 0.3, "upvotes": 2}
    for window, wanted in (("28d_click", "28d_click"), (None, "30d_click")):
        path = land(tmp_path, f"r{wanted}", {"_meta": {"attribution_window": window}, "data": [row]})
        raw = landing.read_envelopes(spark, path, "reddit_ads")
        got = rows(paid.reddit_ads(raw))[0]
        assert (got["attribution_window"], got["cpm"], got["cpc"], got["ctr"]) == (wanted, 1.5, 2.5, 0.3)
    old = rows(paid.reddit_ads(raw, rounded=True))[0]
    assert (old["cpm"], old["cpc"], old["ctr"], old["attribution_window"]) == (50.0, 0.5, 0.1, "30d_click")


def test_empty_response_has_types_and_damaged_file_stops(spark, tmp_path):
    path = land(tmp_path, "e", {"_meta": {}, "data": []})
    cdm = paid.combine_ads([paid.meta_ads(landing.read_envelopes(spark, path, "meta_ads"))])
    assert cdm.count() == 0 and cdm.columns == schemas.CDM_PAID_MEDIA.names
    broken = tmp_path / "broken.json"
    broken.write_text('{"_meta": {}, "data": [{"date_start": ')
    with pytest.raises(Exception):
        landing.read_envelopes(spark, str(broken), "meta_ads").collect()


def test_only_reddit_takes_its_window_from_the_feed(spark, rows):
    raw = spark.createDataFrame([("x",)], "attribution_window string")
    windows = [rows(f(raw))[0]["attribution_window"] for f in (paid.tiktok_ads, paid.meta_ads, paid.reddit_ads)]
    assert windows == ["7d_click_1d_view", "7d_click_1d_view", "x"]


def test_not_a_number_money_counts_as_zero(spark, rows):
    raw = spark.createDataFrame([("2025-01-01", "nan", "nan")], "stat_time_day string, spend string, clicks string")
    got = rows(paid.tiktok_ads(raw))[0]
    assert got["cost_usd"] == 0 and got["clicks"] == 0


def test_instagram_milliseconds_and_exact_rounding(spark, rows, tmp_path):
    posts = [
        {"id": "only_id", "timestamp": "2025-01-01T06:00:00+0000", "avg_watch_time_ms": 150, "reach": 0, "like_count": 5, "is_viral": True},
        {"media_id": "m", "id": "i", "timestamp": "", "avg_watch_time_ms": 14550, "reach": 320, "like_count": 1},
    ]
    path = land(tmp_path, "i", {"_meta": {}, "data": posts})
    got = {r["post_id"]: r for r in rows(organic.instagram_posts(landing.read_envelopes(spark, path, "instagram_organic")))}
    assert got["only_id"]["avg_watch_time_s"] == round(0.15, 1) == 0.1
    assert got["only_id"]["blended_engagement_rate"] == 0 and got["only_id"]["is_viral"] is True
    assert got["m"]["avg_watch_time_s"] == round(14.55, 1) and got["m"]["blended_engagement_rate"] == round(1 / 320, 5)
    assert got["m"]["date"] is None and got["m"]["is_viral"] is False


def test_tiktok_and_reddit_defaults(spark, rows):
    tiktok = spark.createDataFrame(
        [("v", None, 101, None, 1736121599, 10), (None, 50, None, 7, None, 0)],
        "video_id string, play_count bigint, view_count bigint, reach bigint, create_time bigint, like_count bigint",
    )
    first, second = rows(organic.tiktok_posts(tiktok))
    assert (first["impressions"], first["reach"], first["content_type"]) == (101, int(101 * 0.72), "Standard Video")
    assert first["date"] == dt.date(2025, 1, 5) and first["blended_engagement_rate"] == round(10 / 101, 5)
    assert second["reach"] == 7 and second["date"] == dt.date(1970, 1, 1)
    reddit = spark.createDataFrame(
        [(-5, None, 3, "1736121599"), (10, None, 2, "soon"), (10, 100, 2, "0")],
        "score bigint, unique_views bigint, awards_count bigint, created_utc string",
    )
    a, b, c = rows(organic.combine_posts([organic.reddit_posts(reddit)]))
    assert (a["likes"], a["reach"], a["engagements"], a["saves"]) == (-5, 1, -5, 3)
    assert (b["reach"], b["impressions"], b["date"]) == (40, 40, None)
    assert c["blended_engagement_rate"] == 0.1 and c["avg_watch_time_s"] is None and c["content_type"] == "Post"


def test_installs_flags_channels_and_primary(spark, rows, tmp_path):
    path = tmp_path / "installs.csv"
    path.write_text(
        "days_to_subscribe,appsflyer_id,install_time,media_source,is_primary_attribution,registration,subscribed,skad_campaign_id,platform,subscription_value_usd\n"
        "12.7,a,2025-01-01 10:00:00,facebook,TRUE,Yes,1,,iOS,9.99\n"
        ",d,2025-01-01 10:00:00,,,true,true,,Android,\n"
        ",e,2025-01-01 10:00:00,,1,true,true,,Android,\n"
        ",b,2025-01-01 10:00:00,partner_x,FALSE,true,true,,Android,\n"
        "x,c,2025-01-02 10:00:00,partner_x,true,no, TRUE ,S_1,iOS,abc\n"
    )
    raw = landing.read_report(spark, str(path))
    got = {r["appsflyer_id"]: r for r in rows(attribution.installs(raw, STAMP))}
    assert set(got) == {"a", "c", "e"}  # an empty primary flag is not true, an absent one would be
    assert (got["e"]["media_source"], got["e"]["channel"]) == ("", "")
    assert (got["a"]["channel"], got["a"]["registered"], got["a"]["subscribed"], got["a"]["days_to_subscribe"]) == ("Meta Ads", True, True, 12)
    assert (got["c"]["channel"], got["c"]["is_skan"], got["c"]["subscribed"], got["c"]["days_to_subscribe"]) == ("partner_x", True, True, None)
    assert got["c"]["subscription_value_usd"] == 0 and got["c"]["att_status"] == "not_applicable" and got["c"]["has_idfa"] is False
    assert attribution.installs(raw, STAMP, primary_only=False).count() == 5
    assert attribution.installs(raw.drop("is_primary_attribution", "media_source")).where("media_source = 'unknown'").count() == 5
    assert attribution.installs(raw).columns == schemas.CDM_INSTALLS.names


def test_events_payloads(spark, rows, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(
        "event_time,event_name,event_value,media_source\n"
        '2025-01-01 01:00:00,a,"{""value_usd"": 11.99, ""plan"": ""annual"", ""duration_min"": 12.9}",facebook\n'
        '2025-01-01 02:00:00,b,"{""revenue"": ""5"", ""platform"": ""tiktok""}",\n'
        "2025-01-01 03:00:00,c,not json,\n"
        "bad time,d,,\n"
    )
    got = {r["event_name"]: r for r in rows(attribution.in_app_events(landing.read_report(spark, str(path)), STAMP))}
    assert (got["a"]["revenue_usd"], got["a"]["subscription_plan"], got["a"]["duration_min"]) == (11.99, "annual", 12)
    assert (got["b"]["revenue_usd"], got["b"]["share_platform"]) == (5.0, "tiktok")
    assert (got["c"]["revenue_usd"], got["c"]["event_properties"], got["c"]["sport_type"]) == (0, "not json", "")
    assert got["d"]["event_date"] is None and got["d"]["event_properties"] == ""


def test_staging_filters(spark):
    paid_rows = spark.createDataFrame(
        [("2025-01-01", 0.0), ("2025-01-01", None), ("2025-01-01", -1.0), (None, 5.0), ("2025-01-01", 5.0)], "date string, cost_usd double"
    )
    cdm = paid_rows.selectExpr(
        "cast(date as date) date", "' TikTok ' platform", "'paid' channel_type", "'' campaign_id", "'n' campaign_name", "' Reach' objective",
        "'g' ad_group_id", "'g' ad_group_name", "'a' ad_id", "'a' ad_name", "' us' country", "0L impressions", "0L clicks", "cost_usd",
        "0L installs", "0L conversions", "1D conversion_value_usd", "0L video_views", "0L video_completions", "0L engagements", "0L likes",
        "0L comments", "0L shares", "'w' attribution_window", "'r' raw_source", "'' _extracted_at", "'' _pipeline_version",
    )
    new, old = staging.stg_paid_media(cdm), staging.stg_paid_media_old(cdm)
    assert sorted(r[0] for r in new.select("cost_usd").collect()) == [0.0, 0.0, 5.0]
    assert [r[0] for r in old.select("cost_usd").collect()] == [5.0]
    first = new.where("cost_usd = 5").first()
    assert (first["platform"], first["objective"], first["country"], first["campaign_id"], first["cpm"], first["roas"]) == (
        "tiktok", "reach", "US", None, None, 0.2)
    assert new.where("cost_usd = 0").first()["roas"] is None


def test_staged_installs_drop_a_null_primary_flag(spark):
    installs = attribution.installs(
        spark.createDataFrame([("a", "2025-01-01"), ("b", "2025-01-01")], "appsflyer_id string, install_time string")
    )
    unknown = installs.selectExpr("* EXCEPT (is_primary_attribution)", "if(appsflyer_id = 'a', null, true) AS is_primary_attribution")
    assert [r[0] for r in staging.stg_installs(unknown).select("appsflyer_id").collect()] == ["b"]


def test_status_of_rounded_and_unrounded_rate(spark):
    from mediatide.operators import marts

    # 0.04996 rounds to 0.05 in the table but stays below the bound in the mart.
    raw = spark.range(2502).selectExpr(
        "'a' || id AS appsflyer_id", "'2025-01-01 00:00:00' AS install_time", "'organic' AS media_source",
        "if(id < 125, 'true', 'false') AS subscribed", "'p' AS subscription_type",
    )
    cdm = attribution.installs(raw)
    assert attribution.ltv_cohort(cdm).first()["funnel_status"] == "healthy"
    assert marts.funnel_by_channel(staging.stg_installs(cdm)).first()["funnel_status"] == "watch"


def test_null_group_keys_are_left_out_of_the_tables_only(spark):
    cdm = attribution.installs(
        spark.createDataFrame([("a", "2025-01-01", "organic"), ("b", "no day", "organic")], "appsflyer_id string, install_time string, media_source string")
    )
    assert attribution.funnel_summary(cdm).count() == 1 and attribution.ltv_cohort(cdm).count() == 1


def test_combined_posts_fill_missing_columns(spark):
    part = organic.instagram_posts(spark.createDataFrame([("m",)], "media_id string")).drop("profile_visits")
    combined = organic.combine_posts([part])
    assert combined.columns == schemas.CDM_ORGANIC.names and combined.first()["profile_visits"] is None


def test_whole_files_are_read_once(spark, tmp_path):
    """Numbers wanted as text come as they are written, and the file is not opened again for each of them."""
    row = {"stat_time_day": "2024-10-01", "ad_id": "a", "impressions": 10, "clicks": 1.50, "likes": 3}
    path = tmp_path / "page.json"
    path.write_text(json.dumps({"_meta": {"source": "api"}, "data": {"list": [row] * 2000}}, indent=1))

    def read_bytes():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = read_bytes()
    got = landing.read_envelopes(spark, str(path), "tiktok_ads").groupBy("impressions", "clicks", "likes").count().collect()
    assert [tuple(r) for r in got] == [("10", "1.5", "3", 2000)]
    assert read_bytes() - before < 10 * path.stat().st_size
    (tmp_path / "zeros.json").write_bytes(bytes(4096))
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_envelopes(spark, str(tmp_path / "zeros.json"), "tiktok_ads").collect()
    for encoding in ("utf-16", "utf-32"):
        (tmp_path / encoding).write_text(path.read_text(), encoding=encoding)
        assert landing.read_envelopes(spark, str(tmp_path / encoding), "tiktok_ads").count() == 2000


def test_pages_hold_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(catalog_planted, "PAGE_ROWS", 10)
    rows = spark.range(1000).selectExpr("'2024-10-01' AS stat_time_day", "CAST(id AS STRING) AS ad_id")
    inputs = Inputs(spark, "")
    for per_line in (True, False):
        got = catalog_planted._pages(inputs, "tiktok_ads", rows, per_line)
        assert got.count() == got.select("ad_id").distinct().count() == 1000
        if not per_line:
            assert got.select(F.input_file_name()).distinct().count() > 60


def test_pages_take_little_disk(spark):
    """Landed pages are compressed, and every row is in one of them once."""
    rows = spark.range(5000, numPartitions=3).selectExpr("'2024-10-01' AS date_start", "CAST(id AS STRING) AS ad_id", "'Campaign' AS campaign_name", "id AS impressions")
    plain = rows.selectExpr("sum(length(to_json(struct(*))))").head()[0]
    setting = spark.conf.get(catalog_planted._CLEANUP)
    for per_line in (True, False):
        got = catalog_planted._pages(Inputs(spark, ""), "meta_ads", rows, per_line)
        assert sorted(int(r["ad_id"]) for r in got.select("ad_id").collect()) == list(range(5000))
        assert sum(Path(unquote(urlparse(f).path)).stat().st_size for f in got.inputFiles()) < plain / 4
    assert spark.conf.get(catalog_planted._CLEANUP) == setting
    assert catalog_planted._pages(Inputs(spark, ""), "meta_ads", rows.limit(0), False).count() == 0

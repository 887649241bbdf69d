"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     threads of the local session (default 8)

Every query runs BENCH_WARMUP times (default 3) untimed, because the JVM first interprets the
generated code, and then BENCH_RUNS times (default 3); the median counts.
Results go to a sink that evaluates every row and column and keeps none.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks.registry import Inputs
from mediatide import schemas
from mediatide.operators import attribution, lifecycle, marts, organic, paid, quality, reports, staging
from mediatide.session import build_session
from mediatide.sources import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WARMUP = int(os.environ.get("BENCH_WARMUP", "3"))


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=CPUS, spark__driver__memory="20g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    i = Inputs(spark, SF_DIR)

    # Feeds and tables are stored first, as they are in use; deriving them is not timed.
    # They are spread over as many files as there are threads, as a landing of many files is.
    def spread(df, name):
        return i.stored(df.repartition(int(CPUS)), name)

    feeds = {n: spread(i.raw(n), n) for n in ("raw_tiktok_ads", "raw_meta_ads", "raw_reddit_ads", "raw_installs", "raw_events")}
    ads = lambda: paid.combine_ads(
        [paid.tiktok_ads(feeds["raw_tiktok_ads"]), paid.meta_ads(feeds["raw_meta_ads"]), paid.reddit_ads(feeds["raw_reddit_ads"])]
    )
    cdm_paid = spread(ads(), "cdm_paid_media_daily")
    cdm_organic = spread(i.cdm_organic, "cdm_organic_daily")
    cdm_installs = spread(attribution.installs(feeds["raw_installs"]), "cdm_installs")
    recent = spread(i.recent_installs, "recent_installs"), spread(i.recent_events, "recent_events")
    performance = spread(marts.channel_performance_daily(staging.stg_paid_media(cdm_paid)), "performance")
    staged_installs = staging.stg_installs(cdm_installs)
    staged_organic = staging.stg_organic(cdm_organic)
    target = i.scratch("bench_load")

    lazy = {
        "ads_to_cdm": ads,
        "installs_to_cdm": lambda: attribution.installs(feeds["raw_installs"]),
        "events_to_cdm": lambda: attribution.in_app_events(feeds["raw_events"]),
        "posts_to_cdm": lambda: organic.combine_posts(i.posts),
        "mart_channel_performance_daily": lambda: marts.channel_performance_daily(staging.stg_paid_media(cdm_paid)),
        "mart_funnel_by_channel": lambda: marts.funnel_by_channel(staged_installs),
        "mart_ltv_cohort": lambda: marts.ltv_cohort(staged_installs),
        "mart_organic_performance": lambda: marts.organic_performance(staged_organic),
        "rpt_executive_summary": lambda: reports.executive_summary(performance, staged_organic),
        "rpt_platform_comparison": lambda: reports.platform_comparison(performance),
        "funnel_summary": lambda: attribution.funnel_summary(cdm_installs),
        "quality_report": lambda: quality.validate_paid_media(cdm_paid),
        "cohort_revenue": lambda: lifecycle.cohort_revenue(*recent),
        "subscription_months": lambda: lifecycle.subscription_months(recent[1]),
    }
    actions = {name: (lambda build=build: build().write.format("noop").mode("overwrite").save()) for name, build in lazy.items()}
    actions["load_incremental"] = lambda: tables.load_table(cdm_organic, target, schemas.CDM_ORGANIC)

    seconds = {}
    for name, action in actions.items():
        for _ in range(WARMUP):
            action()
        times = []
        for _ in range(RUNS):
            started = time.perf_counter()
            action()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
    total = round(sum(seconds.values()), 3)
    scale = SF_DIR.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline queries, sum of medians", "value": total, "unit": "sec", "queries": seconds, "sf": scale,
                      "cpus": int(CPUS), "runs": RUNS, "spark": spark.version, "cold_run_included": False}))
    spark.stop()


if __name__ == "__main__":
    main()

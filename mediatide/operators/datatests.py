"""Data tests on models and stored tables.  A test yields the offending rows; none means passed.

`run_tests` counts the offenders of all tests of a table in one pass over that table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediatide.functions.dates import as_of_day

# Test -> model, condition of an offending row.  Fixed values: bounds and windows.
ROW_TESTS = {
    "reddit_no_roas": ("stg_paid_media", "platform = 'reddit' AND roas > 0"),
    "clicks_le_impressions": ("stg_paid_media", "clicks > impressions AND impressions > 0"),
    "instagram_watch_time": (
        "stg_organic",
        "platform = 'instagram' AND (avg_watch_time_s < 1 OR avg_watch_time_s > 120)",
    ),
    "tiktok_watch_time": (
        "stg_organic",
        "platform = 'tiktok' AND (avg_watch_time_s < 1 OR avg_watch_time_s > 600)",
    ),
    "funnel_ordering": (
        "mart_funnel_by_channel",
        "registrations > installs OR first_activities > registrations "
        "OR paywall_views > first_activities OR trials > paywall_views OR subscriptions > trials",
    ),
    "ltv_not_negative": ("mart_ltv_cohort", "ltv_per_install < 0"),
    "engagement_rate_bounded": (
        "stg_organic",
        "blended_engagement_rate > 1 OR blended_engagement_rate < 0",
    ),
    "skan_without_user": ("stg_installs", "is_skan AND trim(customer_user_id) <> ''"),
}
WRONG_WINDOW = (
    "(platform = 'reddit' AND attribution_window <> '30d_click') OR "
    "(platform IN ('tiktok', 'instagram_meta') AND attribution_window <> '7d_click_1d_view')"
)
DATED_MODELS = {
    "paid_media": ("stg_paid_media", "date"),
    "installs": ("stg_installs", "install_date"),
    "organic": ("stg_organic", "date"),
}


@dataclass(frozen=True)
class ColumnTest:
    table: str
    column: str
    kind: str  # not_null, unique, accepted_values, expression
    argument: tuple[str, ...] | str = ()

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"

    def offending(self) -> Column:
        column = F.col(self.column)
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return ~column.isin(*self.argument)
        if self.kind == "expression":
            return F.expr(f"NOT (`{self.column}` {self.argument})")
        raise ValueError(self.kind)


def _not_null(table: str, *columns: str) -> list[ColumnTest]:
    return [ColumnTest(table, c, "not_null") for c in columns]


# The declared column tests.
COLUMN_TESTS = [
    *_not_null("cdm_paid_media_daily", "date", "platform", "cost_usd"),
    ColumnTest("cdm_paid_media_daily", "platform", "accepted_values", ("tiktok", "instagram_meta", "reddit")),
    ColumnTest(
        "cdm_paid_media_daily", "attribution_window", "accepted_values", ("7d_click_1d_view", "30d_click")
    ),
    *_not_null("cdm_installs", "appsflyer_id", "install_date", "channel"),
    ColumnTest("cdm_installs", "appsflyer_id", "unique"),
    ColumnTest(
        "cdm_installs", "att_status", "accepted_values",
        ("authorized", "denied", "not_determined", "not_applicable"),
    ),
    *_not_null("cdm_organic_daily", "date", "platform"),
    ColumnTest("cdm_organic_daily", "platform", "accepted_values", ("instagram", "tiktok", "reddit")),
    *_not_null("stg_paid_media", "date", "platform", "cost_usd"),
    ColumnTest("stg_paid_media", "cost_usd", "expression", ">= 0"),
    ColumnTest("stg_paid_media", "ctr", "expression", "< 0.5"),
    *_not_null("stg_installs", "appsflyer_id", "install_date"),
    *_not_null("mart_channel_performance_daily", "date", "platform", "cost_usd"),
    ColumnTest("mart_channel_performance_daily", "cost_usd", "expression", ">= 0"),
    *_not_null("mart_funnel_by_channel", "cohort_month"),
    ColumnTest("mart_funnel_by_channel", "funnel_status", "accepted_values", ("healthy", "watch", "at_risk")),
    *_not_null("mart_ltv_cohort", "cohort_month"),
]

FRESH_TABLES = ("cdm_paid_media_daily", "cdm_installs", "cdm_organic_daily", "cdm_funnel_events")
WARN_AFTER_HOURS = 25
ERROR_AFTER_HOURS = 49


def offending_rows(model: DataFrame, test: str) -> DataFrame:
    return model.where(ROW_TESTS[test][1])


def wrong_windows(staged: DataFrame) -> DataFrame:
    """Platforms with rows of another platform's attribution window."""
    groups = staged.where(WRONG_WINDOW).groupBy("platform", "attribution_window")
    return groups.agg(F.count("*").alias("rows")).where("rows > 0")


def future_dates(models: dict[str, DataFrame], as_of: dt.date | str | None = None) -> DataFrame:
    """Days after `as_of`, with the kind of table they come from."""
    parts = [
        models[model].where(F.col(column) > as_of_day(as_of)).select(
            F.lit(source).alias("source"), F.col(column).alias("date")
        )
        for source, (model, column) in DATED_MODELS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def column_offenders(table: DataFrame, test: ColumnTest) -> DataFrame:
    """Offending rows of one column test; for `unique` the repeated values with their counts."""
    if test.kind == "unique":
        present = table.where(F.col(test.column).isNotNull())
        return present.groupBy(test.column).agg(F.count("*").alias("rows")).where("rows > 1")
    return table.where(test.offending())


def _counted(table: str, df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row per test with the number of offenders, all from a single aggregation."""
    counted = df.agg(*(F.count_if(c).alias(n) for n, c in conditions.items()))
    rows = [F.struct(F.lit(n).alias("test"), F.col(n).alias("offenders")) for n in conditions]
    return counted.select(F.lit(table).alias("table"), F.inline(F.array(*rows)))


def run_tests(tables: dict[str, DataFrame], as_of: dt.date | str | None = None) -> DataFrame:
    """All declared tests of the given tables: table, test, offenders, passed.

    Each table is read once for its row and column tests; only uniqueness needs a second
    aggregation, by the tested column.
    """
    dates = {model: (source, column) for source, (model, column) in DATED_MODELS.items()}
    parts = []
    for table, df in tables.items():
        conditions = {t.name: t.offending() for t in COLUMN_TESTS if t.table == table and t.kind != "unique"}
        conditions |= {name: F.expr(cond) for name, (model, cond) in ROW_TESTS.items() if model == table}
        if table == "stg_paid_media":
            conditions["attribution_windows"] = F.expr(WRONG_WINDOW)
        if table in dates:
            source, column = dates[table]
            conditions[f"no_future_dates_{source}"] = F.col(column) > as_of_day(as_of)
        if conditions:
            parts.append(_counted(table, df, conditions))
        for test in COLUMN_TESTS:
            if test.table == table and test.kind == "unique":
                repeated = column_offenders(df, test).agg(F.count("*").alias("offenders"))
                parts.append(
                    repeated.select(
                        F.lit(table).alias("table"), F.lit(test.name).alias("test"), "offenders"
                    )
                )
    report = reduce(lambda a, b: a.unionByName(b), parts)
    return report.withColumn("passed", F.col("offenders") == 0)


def freshness(tables: dict[str, DataFrame], as_of: dt.datetime | str | None = None) -> DataFrame:
    """Age of each stored table by its newest `_extracted_at`; a table without rows is an error."""
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    parts = []
    for name, df in tables.items():
        newest = df.agg(F.max(F.col("_extracted_at").try_cast("timestamp")).alias("newest"))
        parts.append(newest.select(F.lit(name).alias("table"), "newest"))
    ages = reduce(lambda a, b: a.unionByName(b), parts)
    hours = (F.unix_seconds(now) - F.unix_seconds("newest")) / 3600
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > ERROR_AFTER_HOURS), "error")
        .when(F.col("age_hours") > WARN_AFTER_HOURS, "warn")
        .otherwise("pass")
    )
    return ages.select("table", hours.alias("age_hours")).withColumn("status", status)



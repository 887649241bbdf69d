"""Quality report for `cdm_paid_media_daily`: every check from one pass over the table.

All row checks are counters of a single aggregation without keys.  The distinct days are
counted in the same aggregation; Spark first groups by day inside each task, so what is
shuffled is one partial row per task and day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR, WARNING = "ERROR", "WARNING"

# The rules' columns, bounds and windows.
REQUIRED = (
    "date", "platform", "campaign_id", "ad_id", "impressions", "clicks", "cost_usd", "installs",
    "cpm", "ctr", "attribution_window", "raw_source",
)
NUMERIC = ("impressions", "clicks", "cost_usd", "installs", "cpm", "ctr", "cpi", "roas")
NEVER_NULL = ("date", "platform", "campaign_id", "impressions", "cost_usd")
RARELY_NULL = ("ad_group_id", "ad_name", "country")
NULL_SHARE_BELOW = 0.05
RANGES = {
    "impressions": (0, 50_000_000, ERROR),
    "cost_usd": (0, 500_000, ERROR),
    "ctr": (0, 0.5, WARNING),
    "cpm": (0, 1_000, WARNING),
    "cpi": (0, 10_000, WARNING),
    "roas": (0, 50, WARNING),
}
WINDOWS = {
    "tiktok": "7d_click_1d_view",
    "instagram_meta": "7d_click_1d_view",
    "reddit": "30d_click",
}
ROWS_PER_PLATFORM_DAY = 10


@dataclass
class _Check:
    name: str
    severity: str
    passed: Column
    affected: Column
    message: Column
    shown: Column | None = None  # a check without a subject is left out of the report


class _Builder:
    """Collects the counters that the one aggregation computes and the checks on them."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.types = {f.name: f.dataType for f in df.schema.fields}
        self.counters: dict[str, Column] = {}
        self.checks: list[_Check] = []

    def has(self, *names: str) -> bool:
        return all(n in self.types for n in names)

    def value(self, name: str) -> Column:
        """The column, with NaN read as NULL."""
        if isinstance(self.types[name], (T.DoubleType, T.FloatType)):
            return F.nanvl(F.col(name), F.lit(None).cast("double"))
        return F.col(name)

    def counter(self, key: str, column: Column) -> Column:
        self.counters[key] = column
        return F.col(key)

    def fixed(self, name: str, severity: str, passed: bool, rule: str, found: str) -> None:
        self.checks.append(_Check(name, severity, F.lit(passed), F.lit(0), F.lit(f"{rule}: {found}")))

    def none_of(self, name: str, severity: str, bad_row: Column, rule: str, shown=None) -> None:
        """Passes when no row matches `bad_row`; the message is the rule and how many rows are against it."""
        n = self.counter(f"n_{name}", F.count_if(bad_row))
        message = F.concat(F.lit(f"{rule}: "), F.format_number(n, 0), F.lit(" rows against it"))
        self.checks.append(_Check(name, severity, n == 0, n, message, shown))


def _schema_checks(b: _Builder) -> None:
    missing = [c for c in REQUIRED if not b.has(c)]
    b.fixed("required_columns", ERROR, not missing, "columns that must be there", f"{len(missing)} not found {missing}")
    if b.has("date"):
        day_like = (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)
        kind = b.types["date"]
        b.fixed("date_dtype", ERROR, isinstance(kind, day_like), "type of date", kind.simpleString())
    for name in filter(b.has, NUMERIC):
        kind = b.types[name]
        is_number = isinstance(kind, T.NumericType)
        b.fixed(f"dtype_{name}", ERROR, is_number, f"type of {name}", kind.simpleString())


def _null_checks(b: _Builder, total: Column) -> None:
    for name in filter(b.has, NEVER_NULL):
        b.none_of(f"no_nulls_{name}", ERROR, b.value(name).isNull(), f"{name} IS NOT NULL")
    for name in filter(b.has, RARELY_NULL):
        n = b.counter(f"n_low_nulls_{name}", F.count_if(b.value(name).isNull()))
        share = F.try_divide(n, total)
        passed = F.coalesce(share < NULL_SHARE_BELOW, F.lit(False))
        percent = F.format_number(F.coalesce(share, F.lit(0.0)) * 100, 1)
        b.checks.append(
            _Check(f"low_nulls_{name}", WARNING, passed, n, F.concat(F.lit(f"{name} IS NOT NULL: "), percent, F.lit(" percent of the rows against it")))
        )


def _is_number(b: _Builder, *names: str) -> bool:
    return b.has(*names) and all(isinstance(b.types[n], T.NumericType) for n in names)


def _range_checks(b: _Builder) -> None:
    for name, (low, high, severity) in RANGES.items():
        if _is_number(b, name):
            outside = (b.value(name) < low) | (b.value(name) > high)
            b.none_of(f"range_{name}", severity, outside, f"{name} BETWEEN {low} AND {high}")
    if _is_number(b, "cost_usd", "impressions"):
        unpaid = (b.value("cost_usd") == 0) & (F.col("impressions") > 0)
        b.none_of("cost_vs_impressions", WARNING, unpaid, "cost_usd > 0 OR impressions = 0")


def _logic_checks(b: _Builder) -> None:
    c = F.col
    if _is_number(b, "clicks", "impressions"):
        b.none_of("clicks_le_impressions", ERROR, c("clicks") > c("impressions"), "clicks <= impressions")
    if _is_number(b, "installs", "clicks"):
        b.none_of("installs_le_clicks", WARNING, c("installs") > c("clicks"), "installs <= clicks")
    if _is_number(b, "cpi", "installs", "cost_usd"):
        lost = (c("installs") > 0) & (b.value("cost_usd") > 0) & (b.value("cpi") == 0)
        b.none_of("cpi_consistency", WARNING, lost, "cpi > 0 OR installs = 0 OR cost_usd = 0")


def _platform_checks(b: _Builder) -> None:
    c = F.col
    if not b.has("platform"):
        return
    if _is_number(b, "roas"):
        bad = (c("platform") == "reddit") & (b.value("roas") > 0)
        b.none_of("reddit_no_roas", ERROR, bad, "roas = 0 WHERE platform = reddit")
    if b.has("attribution_window"):
        for platform, window in WINDOWS.items():
            rows = F.col(f"rows_{platform}")
            wrong = (c("platform") == platform) & ~c("attribution_window").eqNullSafe(F.lit(window))
            rule = f"attribution_window = {window} WHERE platform = {platform}"
            b.none_of(f"attribution_window_{platform}", ERROR, wrong, rule, shown=rows > 0)


def _coverage_checks(b: _Builder, total: Column) -> None:
    if not b.has("platform"):
        return
    absent = F.concat_ws(", ", *(F.when(F.col(f"rows_{p}") == 0, F.lit(p)) for p in WINDOWS))
    message = F.concat(F.lit("platforms without a row: "), F.when(absent == "", F.lit("none")).otherwise(absent))
    b.checks.append(_Check("all_platforms_present", WARNING, absent == "", F.lit(0), message))
    if b.has("date"):
        days = b.counter("n_days", F.count_distinct("date"))
        needed = days * (ROWS_PER_PLATFORM_DAY * len(WINDOWS))
        message = F.concat(F.lit("rows >= "), needed.cast("string"), F.lit(": "), total.cast("string"))
        b.checks.append(_Check("minimum_row_count", WARNING, total >= needed, F.lit(0), message))


def validate_paid_media(cdm: DataFrame) -> DataFrame:
    """Report rows: check, severity, passed, rows_affected, message.

    Checks on absent columns, and window checks of absent platforms, are left out.
    """
    b = _Builder(cdm)
    total = b.counter("n_rows", F.count("*"))
    if b.has("platform"):
        for platform in WINDOWS:
            b.counter(f"rows_{platform}", F.count_if(F.col("platform") == platform))
    _schema_checks(b)
    _null_checks(b, total)
    _range_checks(b)
    _logic_checks(b)
    _platform_checks(b)
    _coverage_checks(b, total)

    counted = cdm.agg(*(column.alias(key) for key, column in b.counters.items()))
    rows = [
        F.struct(
            F.lit(check.name).alias("check"),
            F.lit(check.severity).alias("severity"),
            check.passed.alias("passed"),
            check.affected.cast("bigint").alias("rows_affected"),
            check.message.alias("message"),
            (check.shown if check.shown is not None else F.lit(True)).alias("_shown"),
        )
        for check in b.checks
    ]
    return counted.select(F.inline(F.array(*rows))).where("_shown").drop("_shown")


def summarise(report: DataFrame) -> DataFrame:
    """One row: passed (no failed error), numbers of checks, errors and warnings."""
    failed = ~F.col("passed")
    return report.agg(
        (F.count_if(failed & (F.col("severity") == ERROR)) == 0).alias("passed"),
        F.count("*").alias("checks_run"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(failed & (F.col("severity") == ERROR)).alias("errors"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("warnings"),
    )


class QualityError(ValueError):
    """Raised by the gate; holds the failed checks."""

    def __init__(self, failed: list[Row]):
        super().__init__("; ".join(f"{r['check']}: {r['message']}" for r in failed))
        self.failed = failed


def gate(report: list[Row]) -> None:
    """Stops a load when an error check failed.  A report has at most 34 rows."""
    failed = [r for r in report if r["severity"] == ERROR and not r["passed"]]
    if failed:
        raise QualityError(failed)

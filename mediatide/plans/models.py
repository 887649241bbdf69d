"""The models, in dependency order: staging, marts, reports."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.operators import marts, reports, staging
from mediatide.operators.datatests import run_tests
from mediatide.schemas import AUDIT_COLUMNS, PARTITION_COLUMN
from mediatide.sources.files import Folder
from mediatide.sources.tables import create_table_as, laid_out, read_table, refresh_table, save_table


@dataclass(frozen=True)
class Model:
    """`inputs` name CDM tables or earlier models.  A model with a partition is stored."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    partition: str | None = None
    cluster: tuple[str, ...] = ()
    dated: bool = False  # takes as_of


MODELS = {
    "stg_paid_media": Model(staging.stg_paid_media, ("cdm_paid_media_daily",)),
    "stg_installs": Model(staging.stg_installs, ("cdm_installs",)),
    "stg_organic": Model(staging.stg_organic, ("cdm_organic_daily",)),
    "mart_channel_performance_daily": Model(
        marts.channel_performance_daily, ("stg_paid_media",), "date", ("platform", "campaign_id")
    ),
    "mart_funnel_by_channel": Model(
        marts.funnel_by_channel, ("stg_installs",), "cohort_month", ("channel",)
    ),
    "mart_ltv_cohort": Model(marts.ltv_cohort, ("stg_installs",), "cohort_month"),
    "mart_organic_performance": Model(
        marts.organic_performance, ("stg_organic",), "month", ("platform",)
    ),
    "rpt_executive_summary": Model(
        reports.executive_summary, ("mart_channel_performance_daily", "stg_organic")
    ),
    "rpt_platform_comparison": Model(
        reports.platform_comparison, ("mart_channel_performance_daily",)
    ),
    "rpt_funnel_health": Model(reports.funnel_health, ("mart_funnel_by_channel",), dated=True),
}

# The older set; its tables have the same names.
MODELS_OLD = {
    "stg_paid_media": Model(staging.stg_paid_media_old, ("cdm_paid_media_daily",)),
    "stg_organic": Model(staging.stg_organic_old, ("cdm_organic_daily",)),
    "stg_installs": Model(staging.stg_installs_old, ("cdm_installs",)),
    "mart_channel_performance_daily": Model(
        marts.channel_performance_daily_old, ("stg_paid_media",), "date"
    ),
    "mart_funnel_by_channel": Model(marts.funnel_by_channel_old, ("stg_installs",), "cohort_month"),
    "mart_ltv_cohort": Model(marts.ltv_cohort_old, ("stg_installs",), "cohort_month"),
    "mart_organic_performance": Model(marts.organic_performance_old, ("stg_organic",), "month"),
    "rpt_executive_summary": Model(
        reports.executive_summary_old, ("mart_channel_performance_daily",)
    ),
    "rpt_platform_comparison": Model(
        reports.platform_comparison_old, ("mart_channel_performance_daily",)
    ),
    "rpt_funnel_health": Model(reports.funnel_health_old, ("mart_funnel_by_channel",), dated=True),
}


def build_models(
    cdm: dict[str, DataFrame],
    as_of: dt.date | str | None = None,
    models: dict[str, Model] | None = None,
    store: Callable[[str, Model, DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Every model whose inputs are there, lazily; `store` may replace one by its stored table."""
    built = dict(cdm)
    for name, model in (models or MODELS).items():
        if not all(i in built for i in model.inputs):
            continue
        extra = {"as_of": as_of} if model.dated else {}
        df = model.build(*(built[i] for i in model.inputs), **extra)
        built[name] = store(name, model, df) if store and model.partition else df
    return {name: df for name, df in built.items() if name not in cdm}


#: Beside the marts: the state of the CDM tables that they were built from.
FINGERPRINTS = "_fingerprints"


def fingerprints(cdm: dict[str, DataFrame]) -> DataFrame:
    """table, month, rows, hash: the rows of each month of the CDM tables, counted and hashed.

    Sums of hashes do not depend on the order of rows; the audit columns, which every load writes anew, are left out.
    The rows combine before the shuffle, so only one line a month and task is sent.
    """

    def of(name: str, df: DataFrame) -> DataFrame:
        content = [c for c in df.columns if c not in AUDIT_COLUMNS]
        month = F.trunc(F.col(PARTITION_COLUMN[name]), "month").alias("month")
        hashes = df.select(month, F.xxhash64(*content).alias("hash"), F.xxhash64(F.lit(1), *content).alias("other"))
        sums = [_sum_parts(h) for h in ("hash", "other")]
        found = hashes.groupBy("month").agg(F.count("*").alias("rows"), *(s for parts in sums for s in parts))
        return found.select(F.lit(name).alias("table"), "month", "rows", *(_exact_sum(h) for h in ("hash", "other")))

    return reduce(DataFrame.unionByName, (of(n, df) for n, df in cdm.items()))


def _sum_parts(column: str) -> list[Column]:
    """Sums of a whole number's four 16-bit parts, the highest with its sign: no sum passes 64 bits below 2^47 rows."""
    parts = [F.shiftright(column, 16 * k) for k in range(4)]
    return [F.sum(p if k == 3 else p.bitwiseAND(0xFFFF)).alias(f"{column}_{k}") for k, p in enumerate(parts)]


def _exact_sum(column: str) -> Column:
    """The sum itself as text, from the sums of its parts."""
    parts = (F.col(f"{column}_{k}").cast("decimal(20,0)") * F.lit(1 << 16 * k).cast("decimal(15,0)") for k in range(4))
    return reduce(lambda a, b: a + b, parts).cast("decimal(38,0)").cast("string").alias(column)


def _own(model: str, models: dict[str, Model]) -> set[str]:
    """The CDM tables below a model."""
    return {c for i in models[model].inputs for c in (_own(i, models) if i in models else {i})}


def materialise_models(
    spark: SparkSession,
    cdm: dict[str, DataFrame],
    root: str,
    as_of: dt.date | str | None = None,
    models: dict[str, Model] | None = None,
) -> dict[str, DataFrame]:
    """Stores the marts below `root` in full, and registers staging and reports as views.

    Reports then read the stored marts, so no aggregation runs twice.  The state of the CDM tables is kept for refresh_models().
    """

    def store(name: str, model: Model, df: DataFrame) -> DataFrame:
        path = f"{root}/{name}"
        save_table(df, path, model.partition, model.cluster)
        return read_table(spark, path, schema=df.schema)

    # Taken before the marts are built: a change meanwhile is found by the next refresh.
    now = f"{root}/_now-{uuid.uuid4().hex}"
    fingerprints(cdm).write.parquet(now)
    built = build_models(cdm, as_of, models, store)
    _keep_state(spark, root, now, set(cdm))
    for name, df in built.items():
        df.createOrReplaceTempView(name)
    return built


_STATE = "table string, month date, rows bigint, hash string, other string"


def _keep_state(spark: SparkSession, root: str, now: str, names: set[str]) -> None:
    """The new state of the named tables, and the old one of all others."""
    rows = spark.read.schema(_STATE).parquet(now)
    path = f"{root}/{FINGERPRINTS}"
    if Folder(spark, path).exists():
        rows = rows.unionByName(read_table(spark, path).where(~F.col("table").isin(*names)).select(*rows.columns))
    save_table(rows.coalesce(1), path)
    Folder(spark, now).delete()


def refresh_models(
    spark: SparkSession,
    cdm: dict[str, DataFrame],
    root: str,
    as_of: dt.date | str | None = None,
    models: dict[str, Model] | None = None,
) -> dict[str, DataFrame]:
    """Brings the stored marts up to date with the CDM tables, whatever has changed there.

    The months of the CDM are compared with the state that the marts were built from; changed, new and vanished ones are found,
    not named.  Only those months are read and aggregated again, since every mart is by day or by month, and only their
    partitions are replaced or, where nothing is left of them, dropped; the files of all other months stay.
    Marts without a known state are built in full.
    """
    models = models or MODELS
    if not Folder(spark, f"{root}/{FINGERPRINTS}").exists():
        return materialise_models(spark, cdm, root, as_of, models)
    now = f"{root}/_now-{uuid.uuid4().hex}"
    fingerprints(cdm).write.parquet(now)
    before, after = read_table(spark, f"{root}/{FINGERPRINTS}"), spark.read.schema(_STATE).parquet(now)
    same = ["table", "rows", "hash", "other"]
    alike = F.col("b.month").eqNullSafe(F.col("a.month"))
    for column in same:
        alike = alike & (F.col(f"b.{column}") == F.col(f"a.{column}"))
    b, a = before.where(F.col("table").isin(*cdm)).alias("b"), after.alias("a")
    differing = b.join(a, alike, "left_anti").unionByName(a.join(b, alike, "left_anti"))
    # One line a changed month and table, of all the months there are.
    changed: dict[str, set[dt.date | None]] = {name: set() for name in cdm}
    for row in differing.select("table", "month").distinct().toLocalIterator():
        changed[row["table"]].add(row["month"])

    touched = {name: df.where(_of_months(F.col(PARTITION_COLUMN[name]), changed[name])) for name, df in cdm.items()}
    marts_only = {n: m for n, m in models.items() if m.partition or n.startswith("stg_")}

    def store(name: str, model: Model, df: DataFrame) -> DataFrame:
        path = f"{root}/{name}"
        months = set().union(*(changed[c] for c in _own(name, models)))
        if months:
            starts = {str(m)[:7] if m else None for m in months}
            refresh_table(df, path, model.partition, model.cluster, lambda day: (day[:7] if day else None) in starts)
        return read_table(spark, path, schema=df.schema)

    stored = {n: df for n, df in build_models(touched, as_of, marts_only, store).items() if marts_only[n].partition}
    _keep_state(spark, root, now, set(cdm))
    # Staging and reports are over everything, the marts as they are stored now.
    rest = {n: m for n, m in models.items() if not m.partition}
    built = {**build_models({**cdm, **stored}, as_of, rest), **stored}
    for name, df in built.items():
        df.createOrReplaceTempView(name)
    return built


def _of_months(day: Column, months: set[dt.date | None]) -> Column:
    """Days of the months, as ranges that prune the partitions of a stored table."""
    found = F.lit(False)
    for month in sorted(m for m in months if m):
        end = (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        found = found | ((day >= F.lit(month)) & (day < F.lit(end)))
    return found | day.isNull() if None in months else found


def catalog_model(df: DataFrame, name: str, path: str, partition: str, cluster: tuple[str, ...] = ()) -> None:
    """Stores a model as a partitioned table of the catalog."""
    create_table_as(laid_out(df, partition, cluster), name, path, partition)


def run_models(
    spark: SparkSession, cdm: dict[str, DataFrame], root: str, as_of: dt.date | str | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Models in order, then all data tests on them and on the CDM tables."""
    built = materialise_models(spark, cdm, root, as_of)
    return built, run_tests({**cdm, **built}, as_of)

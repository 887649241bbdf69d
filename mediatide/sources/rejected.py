"""Rows that a load could not place, each held once.

A row is known by its delivery and its content: equal rows of one delivery are told apart by a number.  So whatever ranges
are run, and however often, an unreadable row is there once; and a delivery that comes again replaces what it had left here.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediatide.schemas import AUDIT_COLUMNS
from mediatide.sources.files import Folder, exchange_partitions, finish, fresh_inside, located, partition_value

#: Rows of loads without a name.
UNNAMED = "unnamed"
KEY = ("_delivery", "_digest", "_copy")


def keyed(rows: DataFrame, delivery: Column) -> DataFrame:
    """The rows with their key.  Equal rows are first counted and then numbered, so that very many of them are no burden for a task."""
    content = [c for c in rows.columns if c not in AUDIT_COLUMNS]
    digest = F.md5(F.to_json(F.struct(*(F.col(c) for c in content)), {"ignoreNullFields": "false"}))
    marked = rows.withColumns({"_delivery": F.coalesce(delivery, F.lit(UNNAMED)), "_digest": digest})
    grouped = marked.groupBy("_delivery", "_digest").agg(
        F.count("*").alias("_n"), *(F.any_value(F.col(c)).alias(c) for c in rows.columns)
    )
    return grouped.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))).select(*rows.columns, *KEY)


def held(rows: DataFrame, path: str) -> DataFrame:
    """What is stored, in the columns of `rows`; empty if there is nothing yet."""
    spark = rows.sparkSession
    finish(spark, path)
    if not Folder(spark, path).exists():
        return rows.limit(0)
    return spark.read.schema(rows.schema).parquet(located(spark, path)).select(*rows.columns)


def add_rejected(rows: DataFrame, path: str) -> None:
    """Adds keyed rows that are not there yet."""
    new = rows.join(held(rows, path).select(*KEY), list(KEY), "left_anti").select(*rows.columns)
    new.write.mode("append").partitionBy("_delivery").parquet(path)


def replace_rejected(rows: DataFrame, path: str, deliveries: Iterable[str]) -> None:
    """The keyed rows take the place of what the named deliveries had left before."""
    spark, fresh, names = rows.sparkSession, fresh_inside(path), set(deliveries)
    try:
        rows.write.mode("overwrite").partitionBy("_delivery").parquet(fresh)
        new = set(Folder(spark, fresh).partitions(1))
        gone = [p for p in Folder(spark, path).partitions(1) if p not in new and partition_value(p) in names]
        exchange_partitions(spark, fresh, path, gone)
    finally:
        Folder(spark, fresh).delete()

"""Landed feeds: API envelopes, JSON arrays, CSV reports and the day-partitioned landing."""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediatide import schemas
from mediatide.functions.dates import iso_day
from mediatide.operators.fields import RunStamp
from mediatide.sources.files import Folder, partition_value
from mediatide.sources.tables import gathered, many_writers

_META = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("source", "extracted_at", "attribution_window")]
)


@dataclass(frozen=True)
class Envelope:
    """Where an API response keeps its rows, and which of its own fields the rows need."""

    rows: str
    schema: T.StructType
    carried: tuple[str, ...] = ()

    def outer(self) -> T.StructType:
        inner: T.DataType = T.ArrayType(self.schema)
        for name in reversed(self.rows.split(".")[1:]):
            inner = T.StructType([T.StructField(name, inner)])
        return T.StructType(
            [T.StructField("_meta", _META), T.StructField(self.rows.split(".")[0], inner)]
        )


# The layout of each platform's response.
ENVELOPES = {
    "tiktok_ads": Envelope("data.list", schemas.TIKTOK_ADS),
    "meta_ads": Envelope("data", schemas.META_ADS),
    "reddit_ads": Envelope("data", schemas.REDDIT_ADS, carried=("attribution_window",)),
    "instagram_organic": Envelope("data", schemas.INSTAGRAM_POSTS),
    "tiktok_organic": Envelope("data", schemas.TIKTOK_POSTS),
    "reddit_organic": Envelope("data", schemas.REDDIT_POSTS),
}


def open_envelopes(responses: DataFrame, feed: str) -> DataFrame:
    """One row per element of each response's list, with the fields carried from `_meta`."""
    envelope = ENVELOPES[feed]
    carried = [F.col(f"_meta.{name}").alias(name) for name in envelope.carried]
    return responses.select(*carried, F.inline(envelope.rows))


#: No JSON text holds these bytes, in whatever encoding: one of the zeros would be a bare U+0000.
_NEVER = "\x1e" + "\0" * 8 + "\x1e"


def _json(spark: SparkSession, path: str | list[str], schema: T.StructType, per_line: bool) -> DataFrame:
    # A damaged file must stop the run: read leniently it would just have no rows.
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    # A whole file is read as one line.  With `multiLine` Spark opens the file anew for every number that is wanted as text.
    return (reader if per_line else reader.option("lineSep", _NEVER)).json(path)


def read_envelopes(
    spark: SparkSession, path: str | list[str], feed: str, per_line: bool = False
) -> DataFrame:
    """Rows of landed API responses.

    By default a file is one response.  Such a file is read by one task, so a file should
    hold one page or one day; beyond 2 GB it stops the run.  `per_line` reads one response per line, which splits.
    """
    return open_envelopes(_json(spark, path, ENVELOPES[feed].outer(), per_line), feed)


def read_json_rows(
    spark: SparkSession, path: str | list[str], schema: T.StructType, per_line: bool = False
) -> DataFrame:
    """Rows of a plain JSON array file, or of one object per line."""
    return _json(spark, path, schema, per_line)


def read_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV reports with a header; every column is text, found by its header name in each file.

    Files are read by their own header, so reports may differ in the order of columns and in which they have;
    a column that a report lacks is empty, like an empty field: an empty text, not an absent value, so no default
    stands in for it.  A value in quotes may hold line breaks, so one task reads one file, which should hold
    a page or a day.  A damaged file stops the run.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    ordered = lines.where("start = 0").withColumn("line", F.monotonically_increasing_id())
    first = ordered.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    frames = []
    # As many rows as there are different headers; each names the files that have it.
    for found in first.groupBy("header").agg(F.collect_list("file").alias("files")).orderBy("header").collect():
        names = next(csv.reader([found["header"].removeprefix("\ufeff")]))
        schema = T.StructType([T.StructField(n.strip(), T.StringType()) for n in names])
        reader = spark.read.schema(schema).options(header=True, quote='"', escape='"', multiLine=True, mode="FAILFAST")
        frames.append(reader.csv(sorted(found["files"])))
    if not frames:
        raise ValueError(f"no report with a header at {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).na.fill("")


def land_rows(
    rows: DataFrame, path: str, source: str, day: str, stamp: RunStamp | None = None, ingest: str | None = None
) -> None:
    """Adds rows to the landing under source, delivery and day.

    `ingest` names the delivery (the time of extraction by default): landing it again replaces it whole, and nothing else.
    So a late delivery adds to a day that has landed before.  `day` is the feed's own date or time text; rows whose day
    cannot be read are kept under no day.
    """
    stamp = stamp or RunStamp()
    marked = rows.withColumns(
        {
            "_day": iso_day(F.col(day).cast("string")),
            "_extracted_at": F.lit(stamp.extracted_at),
            "_pipeline_version": F.lit(stamp.version),
        }
    )
    name = quote(ingest or stamp.extracted_at, safe="")
    writer = gathered(marked, "_day").write.mode("overwrite").partitionBy("_day")
    with many_writers(rows.sparkSession):
        writer.parquet(f"{path}/_source={source}/_ingest={name}")


@dataclass(frozen=True)
class Delivered:
    """What the landing has of a source by its folders: which deliveries have days of a range, and which have rows without a day."""

    in_range: frozenset[str]
    unreadable: frozenset[str]
    #: Deliveries without any readable day.
    dayless: frozenset[str]


def delivered(spark: SparkSession, path: str, source: str, start: dt.date, end: dt.date) -> Delivered:
    pairs = []
    for folder in Folder(spark, f"{path}/_source={source}").partitions(2):
        ingest, day = folder.split("/")
        pairs.append((partition_value(ingest), partition_value(day)))
    with_day = {name for name, day in pairs if day is not None}
    unreadable = {name for name, day in pairs if day is None}
    wanted = {name for name, day in pairs if day is not None and str(start) <= day <= str(end)}
    return Delivered(frozenset(wanted), frozenset(unreadable), frozenset(unreadable - with_day))


_PROVENANCE = ("_source", "_ingest", "_day", "_extracted_at", "_pipeline_version")


def _landed(spark: SparkSession, path: str, source: str) -> DataFrame:
    """All rows of a source; the names of its deliveries stay the texts that they are."""
    reader, where = spark.read.option("basePath", path), f"{path}/_source={source}"
    fields = [
        T.StructField(f.name, T.StringType()) if f.name in ("_ingest", "_day") else f
        for f in reader.parquet(where).schema.fields
    ]
    return spark.read.option("basePath", path).schema(T.StructType(fields)).parquet(where).withColumn("_day", F.col("_day").cast("date"))


def read_landing(
    spark: SparkSession, path: str, source: str, start: dt.date, end: dt.date
) -> DataFrame:
    """Rows of one source from `start` to `end`, both included, of all deliveries; other days are not read.

    Rows without a readable day belong to no range, see unreadable_rows().
    """
    rows = _landed(spark, path, source)
    return rows.where(F.col("_day").between(F.lit(start), F.lit(end))).drop(*_PROVENANCE)


def unreadable_rows(spark: SparkSession, path: str, source: str, deliveries: Iterable[str]) -> DataFrame:
    """Rows without a readable day of the named deliveries, each with its `_ingest`."""
    rows = _landed(spark, path, source)
    provenance = [c for c in _PROVENANCE if c != "_ingest"]
    return rows.where(F.col("_day").isNull() & F.col("_ingest").isin(*sorted(deliveries))).drop(*provenance)

"""Event files as they land, appended once each to the event log.

State is one entry per event id of the last day, not the whole log.  Every micro-batch is written under the identity of its
checkpoint and its own number, so a batch repeated after a failure replaces itself, and other streams, the same
stream with a new checkpoint, and batch loads can add to the same table.  Across all of them an event is held once for
an id and a day where `_event_id` is given.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mediatide.operators.attribution import in_app_events
from mediatide.operators.fields import RunStamp
from mediatide.sources.files import Folder, finish, fresh_inside, partition_value
from mediatide.sources.tables import append_once, laid_out

REPEAT_WITHIN = "1 day"


def event_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    bytes_per_batch: int = 32 << 30,
    **options: str,
) -> DataFrame:
    """Landed event files, about `bytes_per_batch` of them at a time.

    Repeats of an id meet in one task, and a stream cannot combine them before its shuffle;
    the bound on the bytes of a batch bounds what an id with very many repeats can bring to that task.
    """
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    return reader.option("maxBytesPerTrigger", bytes_per_batch).load(path)


def cleaned_events(raw: DataFrame, id_column: str, stamp: RunStamp | None = None) -> DataFrame:
    """CDM events, a repeated delivery of an id within REPEAT_WITHIN left out.

    The watermark follows the time of arrival, not the event's own time: an event that arrives
    late, or whose time cannot be read, is kept like any other.  Events without an id repeat nothing:
    each gets a key of its own.
    """
    key = F.coalesce(F.concat(F.lit("id "), F.col(id_column).cast("string")), F.uuid())
    arrived = raw.withColumn("_arrived", F.current_timestamp()).withColumn("_key", key)
    unique = arrived.withWatermark("_arrived", REPEAT_WITHIN).dropDuplicatesWithinWatermark(["_key"])
    return in_app_events(unique.drop("_key").withColumn("_event_id", F.col(id_column).cast("string")), stamp)


@contextmanager
def merged(events: DataFrame, path: str, load: str) -> Iterator[DataFrame]:
    """The events, each `_event_id` of a day once, without those that the log holds from other loads.

    The batch is written aside, so it is evaluated once, and only the ids of its own days are read from the log.  Events
    without an id repeat nothing.  A table without the column `_event_id` is left as it is.
    """
    spark, aside = events.sparkSession, fresh_inside(path)
    if "_event_id" not in events.columns:
        yield events
        return
    finish(spark, path)
    try:
        # Not by day: every task would write a file for every day.
        events.write.parquet(f"{aside}/rows")
        rows = spark.read.schema(events.schema).parquet(f"{aside}/rows")
        named = rows.where(F.col("_event_id").isNotNull()).dropDuplicates(["_event_id", "event_date"])
        if Folder(spark, path).partitions(1):
            log = spark.read.schema("_event_id string, event_date date, _load string").parquet(path)
            found = rows.select("event_date").distinct().withColumn("found", F.lit(True)).coalesce(1)
            found.write.partitionBy("event_date").parquet(f"{aside}/days")
            days = [partition_value(p) for p in Folder(spark, f"{aside}/days").partitions(1)]
            of_days = F.col("event_date").isin(*(F.lit(d).cast("date") for d in days if d))
            if None in days:
                of_days = of_days | F.col("event_date").isNull()
            known = log.where(of_days & (F.col("_load") != load) & F.col("_event_id").isNotNull())
            same = (F.col("e._event_id") == F.col("k._event_id")) & F.col("e.event_date").eqNullSafe(F.col("k.event_date"))
            named = named.alias("e").join(known.alias("k"), same, "left_anti")
        yield named.unionByName(rows.where(F.col("_event_id").isNull()))
    finally:
        Folder(spark, aside).delete()


def add_events(
    events: DataFrame, path: str, load: str, writer: str = "batch", covers: tuple[dt.date, dt.date] | None = None
) -> None:
    """Adds a load to the log, merged by `_event_id` with the other loads (see append_once for a repeated one)."""
    with merged(events, path, load) as new:
        append_once(laid_out(new, "event_date", ("event_name",)), path, "event_date", load, writer, covers)


def append_events(events: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends to the log by event day; `once` stops when all landed files are taken."""

    def add(batch: DataFrame, number: int) -> None:
        # The id that the checkpoint keeps; another checkpoint has another one, even at the same place.
        identity = json.loads(Folder(batch.sparkSession, checkpoint).read_text("metadata"))["id"]
        add_events(batch, path, f"stream-{identity}-{number}", writer=identity)

    writer = events.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(add)
    return (writer.trigger(availableNow=True) if once else writer).start()

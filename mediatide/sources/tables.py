"""Stored tables: Parquet folders partitioned by day or month."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediatide.sources.files import (
    Folder,
    beside,
    exchange,
    exchange_partitions,
    finish,
    fresh_inside,
    load_entry,
    located,
    partition_value,
    settle,
)
from mediatide.sources.rejected import UNNAMED, add_rejected, keyed, replace_rejected

INCREMENTAL, TRUNCATE, APPEND = "incremental", "truncate", "append"


@dataclass(frozen=True)
class LoadResult:
    status: str
    table: str
    rows: int
    first_day: dt.date | None
    last_day: dt.date | None
    rejected: int = 0  # rows without a partition value, kept beside the table


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns, order and types of `schema`.

    A NULL in a required column fails the job that reads the result; no extra pass is made.
    """

    def column(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            problem = F.raise_error(F.lit(f"{field.name} is required")).cast(field.dataType)
            value = F.when(value.isNull(), problem).otherwise(value)
        return value.alias(field.name)

    return df.select(*(column(f) for f in schema.fields))


def gathered(df: DataFrame, partition: str) -> DataFrame:
    """Rows of a partition value brought together, so that each value gets few files.

    REBALANCE lets AQE split a day that is far larger than the others over several tasks and
    merge small ones, where a plain repartition would give one task the whole day.
    """
    return df.hint("rebalance", F.col(partition))


def laid_out(df: DataFrame, partition: str, cluster: tuple[str, ...] = ()) -> DataFrame:
    """Gathered by partition value and sorted by `cluster` within each file."""
    return gathered(df, partition).sortWithinPartitions(partition, *cluster)


_writing = threading.Lock()
#: Sessions that write at this moment: how many writes, and the setting before the first of them.
_writes: dict[str, tuple[int, str]] = {}


@contextmanager
def many_writers(spark: SparkSession) -> Iterator[None]:
    """While a table is written, AQE leaves small shuffle partitions apart, up to one for each core.

    A batch of very many small days would otherwise be merged into one task that writes file after file.  Of several jobs that
    write in one session at once, the first changes the setting and the last takes it back.
    """
    name, session = "spark.sql.adaptive.coalescePartitions.minPartitionSize", spark._jsparkSession.sessionUUID()
    with _writing:
        count, before = _writes.get(session, (0, None))
        before = before if count else spark.conf.get(name)
        _writes[session] = (count + 1, before)
        spark.conf.set(name, "16KB")
    try:
        yield
    finally:
        with _writing:
            count, before = _writes.pop(session)
            if count > 1:
                _writes[session] = (count - 1, before)
            else:
                spark.conf.set(name, before)


def _write(df: DataFrame, path: str, partition: str | None, mode: str) -> None:
    save_mode = "append" if mode == APPEND else "overwrite"
    overwrite = "dynamic" if mode == INCREMENTAL else "static"
    writer = df.write.mode(save_mode).option("partitionOverwriteMode", overwrite)
    if partition:
        writer = writer.partitionBy(partition)
    with many_writers(df.sparkSession):
        writer.parquet(path)


def _write_whole(df: DataFrame, path: str, partition: str | None) -> None:
    """The rows become the whole table: written beside it, so that an error leaves the old one, and then exchanged."""
    spark, fresh = df.sparkSession, beside(path)
    try:
        _write(df, fresh, partition, TRUNCATE)
        exchange(spark, fresh, path)
    finally:
        Folder(spark, fresh).delete()


def save_table(df: DataFrame, path: str, partition: str | None = None, cluster: tuple[str, ...] = ()) -> None:
    """The whole table, replacing what is there."""
    _write_whole(laid_out(df, partition, cluster) if partition else df, path, partition)


def refresh_table(
    df: DataFrame, path: str, partition: str, cluster: tuple[str, ...] = (), covers: Callable[[str | None], bool] | None = None
) -> None:
    """Replaces the partitions that df has rows for, and drops those that `covers` tells to be df's and that it no longer has.

    All others keep their files.
    """
    spark, fresh = df.sparkSession, fresh_inside(path)
    try:
        _write(laid_out(df, partition, cluster), fresh, partition, TRUNCATE)
        new = set(Folder(spark, fresh).partitions(1))
        there = Folder(spark, path).partitions(1) if covers else []
        gone = [p for p in there if p not in new and covers(partition_value(p))]
        exchange_partitions(spark, fresh, path, gone)
    finally:
        Folder(spark, fresh).delete()


def append_once(
    laid: DataFrame,
    path: str,
    partition: str,
    load: str,
    writer: str = "batch",
    covers: tuple[dt.date, dt.date] | None = None,
) -> None:
    """Adds a batch under its own name `load` within each partition value: repeated, it replaces itself.

    Batch jobs and streams can so feed one table; `_load` is a partition column below `partition`.  The table keeps an
    entry for each load, with its writer and its partitions: what a repeated load no longer holds is dropped, of all its
    days or, with `covers`, of the days from the first to the last.  A name belongs to one writer.
    """
    spark, fresh = laid.sparkSession, fresh_inside(path)
    finish(spark, path)
    entry = load_entry(spark, path, load)
    if entry and entry["writer"] != writer:
        raise ValueError(f"load {load} of {path} belongs to {entry['writer']}")

    def covered(place: str) -> bool:
        day = partition_value(place)
        return covers is None or (day is not None and str(covers[0]) <= day <= str(covers[1]))

    try:
        out = laid.withColumn("_load", F.lit(load)).write.mode("overwrite").partitionBy(partition, "_load")
        with many_writers(spark):
            out.parquet(fresh)
        new = Folder(spark, fresh).partitions(2)
        before = entry["partitions"] if entry else []
        gone = [p for p in before if p not in set(new) and covered(p)]
        partitions = sorted((set(before) - set(gone)) | set(new))
        exchange_partitions(spark, fresh, path, gone, 2, {"load": load, "writer": writer, "partitions": partitions})
    finally:
        Folder(spark, fresh).delete()


def save_run_copy(df: DataFrame, path: str, run_date: dt.date) -> None:
    """A copy below `run_date=...`; a rerun replaces that day's copy only."""
    _write(df.withColumn("run_date", F.lit(run_date)), path, "run_date", INCREMENTAL)


def keep_rejected(checked: DataFrame, path: str, partition: str, mode: str, load: str | None) -> int:
    """Stores the rows without a partition value; how many there are.

    Those of a named load replace what the load had rejected before, those of a full refresh all others.  Without a name a row
    that is there already is not added again.
    """
    homeless = checked.where(F.col(partition).isNull())
    rejected = homeless.count()
    if not rejected:
        forget_rejected(checked.sparkSession, path, mode, load)
        return 0
    rows = keyed(homeless, F.lit(load or UNNAMED))
    if mode == TRUNCATE:
        _write_whole(rows, path, "_delivery")
    elif load:
        replace_rejected(rows, path, [load])
    else:
        add_rejected(rows, path)
    return rejected


def forget_rejected(spark: SparkSession, path: str, mode: str, load: str | None) -> None:
    """For a load that has rejected nothing: what it had rejected before is in the table now."""
    ledger = Folder(spark, path)
    if mode == TRUNCATE:
        ledger.delete()
    elif load:
        for partition in ledger.partitions(1):
            if partition_value(partition) == load:
                ledger.delete(partition)


def load_table(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    partition: str = "date",
    mode: str = INCREMENTAL,
    cluster: tuple[str, ...] = (),
    dry_run: bool = False,
    load: str | None = None,
    covers: tuple[dt.date, dt.date] | None = None,
) -> LoadResult:
    """Loads a batch and tells rows and date range.

    incremental: replaces exactly the partitions present in the batch, so a rerun of the same
    days leaves the same table and an empty batch changes nothing.  truncate: replaces the
    table, which an error leaves as it was.  append: adds; with a name `load` (see append_once, also for `covers`) a repeated
    load replaces itself, and all loads of the table need one.  A dry run evaluates and checks the batch and writes nothing.

    Rows without a partition value belong to no day that a later load could replace.  They are counted as
    rejected and kept beside the table in `<path>__rejected`, each once (see keep_rejected).  The batch is read a second time
    only if there are any.
    """
    if mode not in (INCREMENTAL, TRUNCATE, APPEND):
        raise ValueError(mode)
    table = path.rstrip("/").rsplit("/", 1)[-1]
    checked = enforce_schema(df, schema)
    placed = F.col(partition).isNotNull()
    figures = [F.count_if(placed).alias("rows"), F.min(partition).alias("first"), F.max(partition).alias("last")]
    if dry_run:
        # Hashing every column makes the checks of all of them run without keeping any row.
        row = checked.agg(*figures, F.count_if(~placed).alias("rejected"), F.max(F.xxhash64(*checked.columns))).first()
        return LoadResult("dry_run", table, row["rows"], row["first"], row["last"], row["rejected"])
    # Whether any row has no place is seen on the way; how many is counted apart, since a repeated task counts twice here.
    homeless, nullable = Observation(f"rejected {table}"), schema[partition].nullable
    observed = checked.observe(homeless, F.count_if(~placed).alias("rows")).where(placed) if nullable else checked
    # Observed behind the shuffle, in the writing stage, where each task counts once.
    seen = Observation(f"load {table}")
    laid = laid_out(observed, partition, cluster).observe(seen, *figures)
    if mode == APPEND and load:
        append_once(laid, path, partition, load, covers=covers)
    elif mode == TRUNCATE:
        _write_whole(laid, path, partition)
    else:
        finish(df.sparkSession, path)
        settle(df.sparkSession, path)
        _write(laid, path, partition, mode)
    got, rejected, ledger = seen.get, 0, path.rstrip("/") + "__rejected"
    # A write that turns out to have no rows at all is cut short before it tells anything.
    if nullable and (not got["rows"] or homeless.get["rows"]):
        rejected = keep_rejected(checked, ledger, partition, mode, load)
    elif nullable:
        forget_rejected(df.sparkSession, ledger, mode, load)
    return LoadResult("success", table, got["rows"], got["first"], got["last"], rejected)


def read_table(
    spark: SparkSession,
    path: str,
    column: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A stored table, or only its partitions from `start` to `end`, both included.

    With `schema` the columns come in its order (a partition column is stored last) and a
    table that has no file yet reads as empty.  An exchange of the table or of its partitions that was cut short is no hindrance.
    """
    path = located(spark, path)
    if "*" not in path:
        finish(spark, path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
    df = reader.parquet(path)
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df.select(*schema.names) if schema is not None else df


def table_ddl(name: str, schema: T.StructType, partition: str | None = None, path: str | None = None) -> str:
    """CREATE TABLE text of a schema."""
    fields = (
        f"  `{f.name}` {f.dataType.simpleString().upper()}" + ("" if f.nullable else " NOT NULL")
        for f in schema.fields
    )
    text = f"CREATE TABLE IF NOT EXISTS {name} (\n" + ",\n".join(fields) + "\n) USING parquet"
    if partition:
        text += f"\nPARTITIONED BY (`{partition}`)"
    if path:
        text += f"\nLOCATION '{path}'"
    return text


def create_table_as(df: DataFrame, name: str, path: str, partition: str | None = None) -> None:
    """Creates or replaces a catalog table with the rows of a model; an error in the model leaves the old table and its rows."""
    spark = df.sparkSession
    _write_whole(df, path, partition)
    columns = [f for f in df.schema.fields if f.name != partition] + [f for f in df.schema.fields if f.name == partition]
    wanted = [(f.name, f.dataType) for f in columns]
    if spark.catalog.tableExists(name) and [(f.name, f.dataType) for f in spark.table(name).schema.fields] == wanted:
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        fields = T.StructType([T.StructField(n, kind) for n, kind in wanted])
        spark.sql(table_ddl(name, fields, partition, path))
    if partition:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")

"""Folders of stored tables: exchanging a whole table, or some of its partitions, so that a crash never leaves less than before.

A whole table is exchanged by two renames; between them the old one is found under its second name.  Partitions are exchanged
one by one from a finished folder, after a note of what is to be done; whoever finds the note after a crash finishes the work.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession


class Folder:
    """Files below one path, through the file system that the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self._at(name))

    def delete(self, name: str = "") -> None:
        self._files.delete(self._at(name), True)

    def move(self, name: str, target: str, parent_exists: bool = False) -> None:
        if not parent_exists:
            self._files.mkdirs(self._path(target).getParent())
        if not self._files.rename(self._at(name), self._path(target)):
            raise OSError(f"{self.path}/{name} could not be moved to {target}")

    def children(self, name: str = "") -> list[str]:
        """Names directly below; none if there is no such folder."""
        if not self.exists(name):
            return []
        # One call for all names.
        found = self.spark._jvm.org.apache.spark.deploy.SparkHadoopUtil.get().globPath(self._files, self._at(f"{name}/*" if name else "*"))
        return sorted(p.rsplit("/", 1)[1] for p in found.mkString("\n").split("\n") if p)

    def partitions(self, depth: int, name: str = "") -> list[str]:
        """Partition folders `depth` levels down, as `a=1/b=2`."""
        prefix = f"{name}/" if name else ""
        here = [c for c in self.children(name) if "=" in c]
        if depth == 1:
            return [prefix + c for c in here]
        return [p for c in here for p in self.partitions(depth - 1, prefix + c)]

    def write_text(self, name: str, text: str) -> None:
        """Written beside and renamed, so that a reader sees all of it or nothing."""
        beside = f"{name}.{uuid.uuid4().hex}"
        out = self._files.create(self._at(beside), True)
        out.write(text.encode("utf-8"))
        out.close()
        self.delete(name)
        self.move(beside, f"{self.path}/{name}")

    def read_text(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self._files.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()


# --- a whole table


def _second_name(path: str) -> str:
    return f"{path.rstrip('/')}__before"


def located(spark: SparkSession, path: str) -> str:
    """Where the table is to be read: between the renames of an exchange it has its second name."""
    path = path.rstrip("/")
    if "*" in path or Folder(spark, path).exists() or not Folder(spark, _second_name(path)).exists():
        return path
    return _second_name(path)


def settle(spark: SparkSession, path: str) -> None:
    """Ends an exchange that was cut short: the table has its own name again and nothing else is left."""
    table, before = Folder(spark, path), Folder(spark, _second_name(path))
    if before.exists():
        if table.exists():
            before.delete()
        else:
            before.move("", table.path)


def exchange(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts the finished folder `fresh` in the place of the table."""
    settle(spark, path)
    table, before = Folder(spark, path), Folder(spark, _second_name(path))
    if table.exists():
        table.move("", before.path)
    try:
        Folder(spark, fresh).move("", table.path)
    except BaseException:
        if before.exists() and not table.exists():
            before.move("", table.path)
        raise
    before.delete()


def beside(path: str) -> str:
    """A name for a folder that is to take the table's place."""
    return f"{path.rstrip('/')}__{uuid.uuid4().hex}"


# --- some partitions of a table

_NOTES, _LOADS = "_notes", "_loads"


def fresh_inside(path: str) -> str:
    """A folder within the table that no reader sees."""
    return f"{path.rstrip('/')}/_fresh-{uuid.uuid4().hex}"


def finish(spark: SparkSession, path: str) -> None:
    """Does what notes of earlier, unfinished exchanges say."""
    table = Folder(spark, path)
    for name in table.children(_NOTES):
        text = table.read_text(f"{_NOTES}/{name}") if name.endswith(".json") else None
        if text:
            _apply(table, name, json.loads(text))


def _apply(table: Folder, name: str, note: dict) -> None:
    fresh = Folder(table.spark, f"{table.path}/{note['fresh']}")
    there = set(table.children())
    for top in fresh.partitions(1):
        if top not in there:
            # Nothing of the table is in its way.
            fresh.move(top, f"{table.path}/{top}", True)
            continue
        for partition in [top] if note["depth"] == 1 else fresh.partitions(note["depth"] - 1, top):
            table.delete(partition)
            fresh.move(partition, f"{table.path}/{partition}", True)
    for partition in note["gone"]:
        table.delete(partition)
    if note.get("load"):
        table.write_text(f"{_LOADS}/{quote(note['load']['load'], safe='')}.json", json.dumps(note["load"]))
    fresh.delete()
    table.delete(f"{_NOTES}/{name}")


def exchange_partitions(
    spark: SparkSession, fresh: str, path: str, gone: Iterable[str] = (), depth: int = 1, load: dict | None = None
) -> None:
    """Moves the partitions of `fresh`, a folder of fresh_inside(), to the table in place of the table's own, and deletes those in `gone`.

    `load` is kept as the load's entry, see load_entry().
    """
    finish(spark, path)
    table = Folder(spark, path)
    note = {"fresh": fresh.rstrip("/").rsplit("/", 1)[-1], "depth": depth, "gone": sorted(gone), "load": load}
    name = f"{uuid.uuid4().hex}.json"
    table.write_text(f"{_NOTES}/{name}", json.dumps(note))
    _apply(table, name, note)


def load_entry(spark: SparkSession, path: str, load: str) -> dict | None:
    """What the table knows of a load by this name: its writer and the partitions that hold it."""
    text = Folder(spark, path).read_text(f"{_LOADS}/{quote(load, safe='')}.json")
    return json.loads(text) if text else None


def partition_value(partition: str) -> str | None:
    """The value in `name=value`, None for the partition of NULL."""
    value = unquote(partition.split("/", 1)[0].split("=", 1)[1])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value

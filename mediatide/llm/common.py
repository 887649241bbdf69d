"""What the operators of this subpackage share: scratch tables, splits, components, ranks.

Intermediate tables go to the folder that spark.checkpoint.dir names, so that a lost executor
costs a reread and never a recomputation of the chain before it.
"""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mediatide.session import scratch_path

# The characters that separate words and are stripped from lines, and what folds to what.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Stands for an id that is null: such a row sorts after all others.
NO_ID = (1 << 63) - 1


def prepare(spark: SparkSession) -> None:
    """Lets Python workers import this package even if only the driver's own path names it."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table in the shared folder; `path` of the result names it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.path = path
    return out


def discard(*stored: DataFrame) -> None:
    """Deletes what store() has written, once nothing needs it."""
    for df in stored:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(df.path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fold(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit("")).cast("binary")) % divisor


def split_of(divisor: int, held: int) -> Column:
    """Whether the row of doc_id is held out."""
    return remainder(F.col("doc_id").cast("string"), divisor) == held


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones stand for themselves, the rest from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class RecentCache(dict):
    """Values computed once for each key and kept while they are used, in about `most` bytes.

    When the newer half is full it becomes the older, and what nobody has asked for since then goes.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most, self.held, self.older = most, 0, {}

    def compute(self, keys: list) -> Iterable:
        """The values of keys that are not kept, in their order."""
        raise NotImplementedError

    def weight(self, keys: list) -> int:
        """About how many bytes the entries of these keys take."""
        raise NotImplementedError

    def learn(self, groups: Iterable[Iterable]) -> None:
        """Afterwards all keys of the groups are there, until forget() is called."""
        wanted = [key for key in set().union(*groups) if key not in self]
        self.held += self.weight(wanted)
        older = self.older
        new = [key for key in wanted if key not in older]
        if len(new) < len(wanted):
            self.update((key, older[key]) for key in wanted if key in older)
        if new:
            self.update(zip(new, self.compute(new), strict=True))

    def forget(self) -> None:
        if self.held > self.most // 2:
            self.older = dict(self)
            self.clear()
            self.held = 0


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns node, component (the smallest node reachable) for every node of the edges (a, b).

    Alternates the two star operations: every node hands its larger neighbours to the smallest one,
    then every node links itself and its smaller neighbours to the smallest.  Minima combine before
    the shuffle, and the joins are on a computed key (~a): both inputs then come straight from an
    exchange, so that AQE splits a node with most of the edges.  The loop ends when every edge leads from a node with
    no other to a root, which has none: then the edges are the answer.
    """
    key = F.bitwise_not("a").alias("k")

    def lowest(links: DataFrame) -> DataFrame:
        return links.groupBy("a").agg(F.min("b").alias("low")).select(key, F.least("a", "low").alias("low"))

    links = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    now = store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    settled = False
    while not settled:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        handed = both.select("b", "a", key).where("b > a").join(lowest(both), "k")
        large = store(handed.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "edges")
        low = lowest(large)
        joined = large.select("a", "b", key).join(low, "k").where("b <> low")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
        own = low.select(F.bitwise_not("k").alias("a"), F.col("low").alias("b"))
        then = store(small.union(own).distinct(), "edges")
        discard(now, large)
        now = then
        # As often an end as a start, or the start of two edges: neither is in a forest of stars.
        ends = now.select("a", F.lit(1).alias("up")).union(now.select(F.col("b").alias("a"), F.lit(0).alias("up")).distinct())
        counts = ends.groupBy("a").agg(F.count("*").alias("n"), F.sum("up").alias("up"))
        settled = counts.where("n > 1 AND up > 0").limit(1).count() == 0
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def salted_ranks(df: DataFrame, keys: list[str], order: Iterable[str], rows_per_range: int = 50_000) -> DataFrame:
    """Adds `rank`, the row's place from 0 within its keys by `order` (a long hash first).

    A key may hold most rows: it is cut into ranges of the hash, each range ranks its own rows, and
    ranges are placed by the running count of those before.  The ranks do not depend on the cut.
    The result must not be evaluated over a source that changes.
    """
    order = list(order)
    ranges = 64 + df.count() // rows_per_range
    width = float(1 << 64) / ranges
    cut = F.floor((F.col(order[0]).cast("double") + float(1 << 63)) / F.lit(width)).cast("long")
    marked = df.withColumn("_range", cut)
    counts = marked.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, "_range").orderBy(*order)
    ranked = marked.withColumn("_place", F.row_number().over(within) - 1)
    return (
        ranked.join(starts, [*keys, "_range"])
        .withColumn("rank", F.col("_start") + F.col("_place"))
        .drop("_range", "_start", "_place")
    )

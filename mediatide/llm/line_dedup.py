"""Line deduplication against levelled sorted runs of line hashes.

The runs are tables bucketed and sorted by the 128-bit hash of a line's key; each key lies in one run,
with the smallest doc_id that held it when it was new.  A batch of documents merge-anti-joins every run
(no run is shuffled or sorted for that), and the keys that are left become a new run of level 0.  When a
level has `fanout` runs they are merged into one of the next level, so that n batches leave O(log n) runs.

Batches come in ascending order of doc_id, hence the holder of a key is always the smallest doc_id.

Defined results: a null or empty text is one empty line; a row without doc_id takes part as a document that
sorts after all others; rows that repeat one doc_id are one document when documents are counted, and
every one of them keeps the lines that the document holds.  Extra columns, whatever they are called,
pass through.  An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.llm.common import BLANKS, NO_ID, discard, fold, store, table
from mediatide.session import scratch_path

KEY = ["h1", "h2"]


def keyed_lines(docs: DataFrame, min_length: int = 10) -> DataFrame:
    """One row for each line whose key has min_length code points: did, tid, pos, h1, h2.

    tid tells rows of one doc_id with different texts apart.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"),
        F.xxhash64(text).alias("tid"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    )
    key = fold(F.btrim("line", F.lit(BLANKS)))
    keyed = lines.select("did", "tid", "pos", key.alias("key")).where(F.length("key") >= min_length)
    return keyed.select("did", "tid", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """The keys of all lines seen so far, as sorted runs by level."""

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.folder = scratch_path(spark, "runs")

    def _write(self, keys: DataFrame, level: int) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = keys.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.folder}/{name}")
        writer.saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return name

    def compact(self) -> None:
        """Merges the runs of every level that is full into one run of the next."""
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                full, self.levels[level] = self.levels[level], []
                merged = self.spark.table(full[0])
                for name in full[1:]:
                    merged = merged.union(self.spark.table(name))
                self._write(merged.repartition(self.buckets, *KEY), level + 1)
                for name in full:
                    self.spark.sql(f"DROP TABLE {name}")
            level += 1

    def add(self, lines: DataFrame) -> DataFrame:
        """Takes a batch of keyed lines in; returns them with `keep`, whether their document holds the line."""
        self.compact()
        fresh = lines.groupBy(*KEY).agg(F.min("did").alias("holder"))
        for name in (n for level in self.levels for n in level):
            fresh = fresh.hint("merge").join(self.spark.table(name).select(*KEY), KEY, "left_anti")
        name = self._write(fresh, 0)
        # Read as plain files, not as buckets: a line that most documents hold can then be split between tasks.
        run = self.spark.read.schema(fresh.schema).parquet(f"{self.folder}/{name}")
        found = lines.join(run, KEY, "left")
        return found.select("did", "tid", "pos", F.coalesce(F.col("holder") == F.col("did"), F.lit(False)).alias("keep"))

    def close(self) -> None:
        for name in (n for level in self.levels for n in level):
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []
        run = self.spark.createDataFrame([], "h1 long")
        run.path = self.folder
        discard(run)


def batches_of(docs: DataFrame, batches: int) -> list[float]:
    """Upper bounds of doc_id that cut the table into about equal batches; their place changes no result."""
    at = [i / batches for i in range(1, batches)]
    if not at:
        return []
    bounds = docs.select(F.col("doc_id").cast("double").alias("doc_id")).approxQuantile("doc_id", at, 0.02)
    return sorted(set(bounds))


def dedup_lines(docs: DataFrame, min_length: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """All rows of docs with kept_text, n_lines, n_dropped beside a struct `row` of their columns."""
    spark = docs.sparkSession
    lines = store(keyed_lines(docs, min_length), "lines")
    runs = LineRuns(spark, fanout)
    dropped = []
    bounds = [float("-inf"), *batches_of(docs, batches), float("inf")]
    for low, high in zip(bounds, bounds[1:], strict=False):
        part = lines
        if low != float("-inf"):
            part = part.where(F.col("did") > low)
        if high != float("inf"):
            part = part.where(F.col("did") <= high)
        judged = runs.add(part).where("not keep")
        gone = judged.groupBy("did", "tid").agg(F.collect_set("pos").alias("gone"))
        dropped.append(store(gone, "dropped_lines"))
    runs.close()
    discard(lines)
    drops = dropped[0]
    for more in dropped[1:]:
        drops = drops.union(more)
    text = F.coalesce(F.col("text"), F.lit(""))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    split = docs.select(
        F.struct(*others).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"),
        F.xxhash64(text).alias("tid"),
        F.split(text, "\n", -1).alias("lines"),
    )
    joined = split.join(drops, ["did", "tid"], "left")
    # `lines` and `gone` are columns of the join here, so the lookup by position is constant time.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(left, lambda p: F.get(F.col("lines"), p)))
    return joined.select(
        "row",
        F.array_join(kept, "\n").alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with the lines they keep; a document may be left empty."""
    out = dedup_lines(docs)
    texts = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*(texts[c].alias(c) if c in texts else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


#: No regular expressions over whole lines: DuckDB's trim takes the set of characters.
SQL = """
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), k AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, min(doc_id) AS holder FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT k.doc_id, count(*) AS n_lines,
  count(*) FILTER (f.holder IS NOT NULL AND f.holder <> k.doc_id) AS n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (f.holder IS NULL OR f.holder = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY k.doc_id
"""

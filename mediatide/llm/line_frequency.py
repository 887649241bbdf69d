"""Quality rules with cross-document line frequency.

Lines are normalised (stripped, lower case, runs of digits as one 0) and hashed; a line found in more than
`max_documents` documents of one host (the column source) is removed from that host's documents.  A document
is rejected when it fails the base rules, or when fewer than `min_words` words or less than `min_share`
of its words remain.

Defined results: a null text has no words and fails the base rules; a null source is a host of its own; rows
that repeat one doc_id count as one document, and rows without doc_id as one more.  Other columns are not
read.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.llm.common import BLANK_RUN, BLANKS, NO_ID, discard, store, table

SYMBOLS = "#*$%&|<>"
#: Words of a window that counts as a repetition.
WINDOW = 8
#: Of a document's words.
MAX_REPEATED_PERCENT = 30
MIN_BASE_WORDS = 20


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK_RUN, -1), lambda w: w != "")


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.lower(F.btrim(line, F.lit(BLANKS))), "[0-9]+", "0")


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id, host, the base counts and `lines`, an array of (hash, words) of the lines with a word.

    Every step that a lambda looks into is a column of the step before, so that it is computed once a row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select(
        F.col("doc_id"),
        F.col("source").alias("host"),
        text.alias("text"),
        words_of(text).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("raw"),
    )
    out = out.select(
        "doc_id", "host", "raw",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    last = F.size("hashes") - WINDOW
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.xxhash64(*(F.get(F.col("hashes"), i + j) for j in range(WINDOW)))
    out = out.withColumn("windows", F.transform(places, window)).drop("hashes")
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    sorted_windows = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("ranked", F.when(repeated, sorted_windows)).drop("windows")
    twice = F.filter(
        "ranked",
        lambda x, i: (x["h"] == F.get(F.col("ranked"), i + 1)["h"]) | ((i > 0) & (x["h"] == F.get(F.col("ranked"), i - 1)["h"])),
    )
    out = out.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("ranked")
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum")),
        lambda a, i: F.struct((i + WINDOW).alias("end"), (a["sum"] + i + WINDOW - F.greatest(i, a["end"])).alias("sum")),
        lambda a: a["sum"],
    )
    lines = F.transform("raw", lambda x: F.struct(F.xxhash64(normalised(x)).alias("line"), F.size(words_of(x)).alias("words")))
    return out.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols",
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        lines.alias("lines"),
    )


def judge(docs: DataFrame, max_documents: int = 100, min_words: int = 20, min_share: float = 0.3) -> DataFrame:
    """The base counts of each row, its words on lines above the limit, and the verdict."""
    counts = store(with_counts(docs).withColumn("rid", F.monotonically_increasing_id()), "line_counts")
    lines = counts.select("rid", F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), "host", F.explode("lines").alias("l"))
    lines = lines.select("rid", "did", F.coalesce(F.xxhash64("host"), F.lit(0)).alias("hh"), "l.line", "l.words")
    common = (
        lines.groupBy("hh", "line").agg(F.countDistinct("did").alias("documents")).where(F.col("documents") > max_documents)
    )
    removed = lines.join(common.select("hh", "line"), ["hh", "line"]).groupBy("rid").agg(F.sum("words").alias("removed"))
    out = counts.drop("lines").join(removed, "rid", "left")
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    failed = (F.col("n_words") < MIN_BASE_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    depleted = (left < min_words) | (left < min_share * F.col("n_words"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
        F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed_words"),
    )


def cleaned(docs: DataFrame, max_documents: int = 100) -> DataFrame:
    """doc_id and the text without the lines above the limit, for documents that lose any; others are as they are."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("tid"), F.col("source").alias("host"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "raw"))
    hashed = F.when(F.btrim("raw", F.lit(BLANKS)) != "", F.xxhash64(normalised(F.col("raw")))).alias("line")
    lines = rows.select("doc_id", "tid", F.coalesce(F.xxhash64("host"), F.lit(0)).alias("hh"), "pos", "raw", hashed)
    common = (
        lines.where("line IS NOT NULL").groupBy("hh", "line").agg(F.countDistinct("doc_id").alias("n"))
        .where(F.col("n") > max_documents).select("hh", "line", F.lit(True).alias("gone"))
    )
    marked = lines.join(common, ["hh", "line"], "left").groupBy("doc_id", "tid").agg(
        F.max("gone").alias("gone"),
        F.sort_array(F.collect_set(F.when(F.col("gone").isNull(), F.struct("pos", "raw")))).alias("rest"),
    )
    return marked.where("gone").select("doc_id", F.array_join(F.col("rest.raw"), "\n").alias("text"))


def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, chr(1) || 'none') AS host, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS raw
  FROM documents
), w AS (
  SELECT doc_id, i, words[i:i + {WINDOW - 1}] AS window_words
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM d)
), t AS (
  SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, window_words) > 1
), r AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM t, (SELECT unnest(range(0, {WINDOW})) AS j) GROUP BY doc_id
), l AS (
  SELECT doc_id, host, regexp_replace(lower(trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[0-9]+', '0', 'g') AS line,
    len(list_filter(string_split_regex(raw, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS n
  FROM (SELECT doc_id, host, unnest(raw) AS raw FROM d)
), c AS (
  SELECT host, line FROM l GROUP BY host, line HAVING count(DISTINCT doc_id) > 100
), x AS (
  SELECT doc_id, sum(n) AS removed FROM l JOIN c USING (host, line) GROUP BY doc_id
), b AS (
  SELECT d.doc_id, len(words) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')) AS n_symbols,
    len(raw) - len(list_distinct(raw)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(x.removed, 0) AS removed
  FROM d LEFT JOIN r USING (doc_id) LEFT JOIN x USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_BASE_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_BASE_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)
    AND n_words - removed >= 20 AND n_words - removed >= 0.3 * n_words AS kept,
  CAST(removed AS BIGINT) AS n_removed_words
FROM b
"""

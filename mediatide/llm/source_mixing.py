"""Mixing sources to target weights by entropy balancing.

Every source has a target of words.  Among all document rates between 0 and `limit` that meet their source's
target, the ones closest to the base rate 1 in (two-sided) entropy are exponentially tilted by size:
rate / (limit - rate) = exp(tilt * size / mean size) / (limit - 1).  The tilts maximise the convex dual, whose gradient
(words taken less target) and curvature are sums over documents: each Newton iteration is one aggregation over all
documents, for all sources at once, kept inside a shrinking bracket.  Documents of one source and size have one rate, so the
sums run over (source, size, count) cells.  Sums are exact decimals, which makes reruns agree.

Rates become copies by systematic rounding: down the sizes of a source, a cell gets the whole copies by which the rounded
running total of expected copies grows, so that a source misses its target by at most half its largest document; in
a cell the documents with the smallest hash get one copy more than the rest.

Defined results: a null text has size 0; a null source is a source of its own, last in order; rows that repeat are
mixed as documents of their own; without any word all targets are 0 and every document is taken at most once.
Extra columns pass through the stage and are not read otherwise.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mediatide.llm.common import NO_ID, discard, salted_ranks, store, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
#: Rates are whole multiples of this, so that their running totals are exact.
UNIT = float(1 << 32)


def ordered(df: DataFrame, *order: str, partitions: int = 16) -> DataFrame:
    """Adds `place`, the row's place from 0 in the whole order: ranges are sorted apart and offset by those before."""
    ranged = df.repartitionByRange(partitions, *order).withColumn("_part", F.spark_partition_id())
    ranged = store(ranged, "ranged")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = sizes.select(F.col("_part").alias("_p"), F.col("_n").alias("_m"))
    # One row for each of the `partitions` ranges.
    start = sizes.join(F.broadcast(earlier), F.col("_p") < F.col("_part"), "left").groupBy("_part").agg(F.coalesce(F.sum("_m"), F.lit(0)).alias("_start"))
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn("_inner", inner).join(start, "_part").withColumn("place", F.col("_start") + F.col("_inner")).drop("_part", "_inner", "_start")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """Adds `target` to rows (missing, source, source_size, ...): weights by order, capped, the excess reshared.

    A source is at its cap when its cap over its weight lies below the level that the others share; the level rises
    with each round until no more sources are capped.  Each round is an aggregation.
    """
    placed = ordered(sources, "missing", "source")
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = store(placed.withColumn("weight", weight), "weighed")
    cap = F.col("source_size") * F.lit(float(limit))
    total = (weighed.agg(F.sum("source_size")).head()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = cap < F.lit(level) * F.col("weight") if capped >= 0 else F.lit(False)
        n, taken, free = weighed.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)), F.sum(F.when(~full, F.col("weight")))
        ).head()
        if n == capped or not free:
            break
        capped, level = n, (total - taken * float(limit)) / free
    return weighed.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def rate(tilt: str, size: str, mean: str, limit: float = LIMIT):
    """The tilted rate; both forms of the logistic function are kept away from overflow."""
    x = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col(tilt) * F.col(size) / F.col(mean)))
    return F.lit(float(limit)) / (1 + F.lit(limit - 1.0) * F.exp(-x))


def solve(cells: DataFrame, sources: DataFrame, limit: float = LIMIT, tolerance: float = 1e-7, rounds: int = 60) -> DataFrame:
    """Adds `tilt` to the sources: Newton steps for all at once, each inside a bracket that shrinks.

    cells: sid, size, n.  A source whose target is its cap gets the largest tilt; one without words gets 0.
    """
    far = 600.0
    trivial = F.col("source_size") == 0
    at_cap = F.col("target") >= F.col("source_size") * F.lit(float(limit)) * (1 - 1e-12)
    state = sources.select(
        "sid", "source_size", "target", "mean",
        F.when(trivial, 0.0).when(at_cap, far).otherwise(0.0).alias("tilt"),
        F.lit(-far).alias("low"), F.lit(far).alias("high"), (trivial | at_cap).alias("done"),
    )
    state = store(state, "tilts")
    words = F.col("n") * F.col("size")
    exact = lambda c: F.sum(c.cast("decimal(38,9)")).cast("double")
    for _ in range(rounds):
        if not state.where("not done").limit(1).count():
            break
        r = F.col("r")
        tilted = cells.join(state.where("not done").select("sid", "tilt", "mean"), "sid").withColumn("r", rate("tilt", "size", "mean", limit))
        sums = tilted.groupBy("sid").agg(
            exact(words * r).alias("taken"), exact(words * r * (1 - r / float(limit)) * F.col("size") / F.col("mean")).alias("slope")
        )
        gap = F.col("taken") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - gap / F.greatest("slope", F.lit(1e-9))
        inside = (step > low) & (step < high)
        middle = F.when(F.abs(high - low) > 64, (low + high) / 32 + F.signum(-gap)).otherwise((low + high) / 2)
        middle = F.when((middle > low) & (middle < high), middle).otherwise((low + high) / 2)
        close = (F.abs(gap) <= tolerance * F.col("target")) | ((high - low) < 1e-13)
        moved = state.join(sums, "sid", "left").select(
            "sid", "source_size", "target", "mean",
            F.when(F.col("done") | close, F.col("tilt")).when(inside, step).otherwise(middle).alias("tilt"),
            F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
            (F.col("done") | close).alias("done"),
        )
        then = store(moved, "tilts")
        discard(state)
        state = then
    return state


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """doc_id, rid, size, source_size, target, rate, copies, taken for every row; rid is the hash of the row's columns."""
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)).alias("rid"),
        F.col("source").isNull().alias("missing"), F.coalesce("source", F.lit("")).alias("source"), words.alias("size"),
    )
    sized = store(sized, "sizes")
    sources = sized.groupBy("missing", "source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents"), F.count_if(F.col("size") > 0).alias("filled")
    )
    aimed = targets(sources, weights, share, limit).withColumnRenamed("place", "sid")
    mean = F.when(F.col("filled") > 0, F.col("source_size") / F.col("filled")).otherwise(1.0)
    aimed = store(aimed.withColumn("mean", mean), "sources")
    rows = store(sized.join(aimed.select("missing", "source", "sid"), ["missing", "source"]).select("doc_id", "rid", "sid", "size"), "sized")
    cells = store(rows.groupBy("sid", "size").agg(F.count("*").alias("n")), "cells")
    tilts = solve(cells, aimed, limit)
    rated = cells.join(tilts.select("sid", "tilt", "mean", "source_size", "target"), "sid")
    rated = rated.withColumn("rate", rate("tilt", "size", "mean", limit))
    # The running total down the sizes of a source: its cells are at most as many as its largest document has words.
    down = Window.partitionBy("sid").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum((F.col("n") * F.round(F.col("rate") * UNIT).cast("long")).cast("decimal(38,0)")).over(down)
    rounded = F.floor(total / F.lit(int(UNIT)).cast("decimal(38,0)") + F.lit(0.5).cast("decimal(2,1)")).cast("long")
    rated = rated.withColumn("upto", rounded)
    before = F.coalesce(F.lag("upto").over(Window.partitionBy("sid").orderBy(F.desc("size"))), F.lit(0))
    shared = store(rated.withColumn("all_copies", F.col("upto") - before)
                   .select("sid", "size", "n", "rate", "all_copies", "source_size", "target"), "shared")
    ranked = salted_ranks(rows.withColumn("_order", F.xxhash64("doc_id", "rid")), ["sid", "size"], ["_order"])
    joined = ranked.join(shared, ["sid", "size"])
    each = F.floor(F.col("all_copies") / F.col("n"))
    copies = (each + F.when(F.col("rank") < F.col("all_copies") - each * F.col("n"), 1).otherwise(0)).cast("int")
    return joined.select(
        "doc_id", "rid", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "copies")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    taken = mix(docs).groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), "rid").agg(F.sum("copies").alias("copies"))
    taken = store(taken.where("copies > 0"), "copies")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"), F.xxhash64(*columns).alias("rid"), F.struct(*columns).alias("row")
    )
    # Equal rows are one here and have their copies together.
    once = rows.join(taken, ["did", "rid"]).dropDuplicates(["did", "rid"])
    repeated = once.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return repeated.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))

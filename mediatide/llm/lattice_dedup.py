"""Near-duplicate embeddings by lattice hashing.

In each of several tables a vector's direction is projected at random to eight dimensions and decoded to the
nearest point of the lattice E8; a vector lives in the cell of its point and visits the neighbouring cells (of the 240 nearest
lattice points) that its residual points to most.  Vectors meet in a cell if at least one of them lives there;
each meeting pair of one label is verified by its cosine in double precision.

With the defaults a pair at cosine 0.93 differs by about 1 in a projection, where the lattice's cells have radii of 0.7 to 1;
measured against brute force, pairs at 0.93 are missed less often than 1 in 1000 (tests).

Equal vectors are one class, compared once.  The members of a cell are cut into blocks of at most BLOCK vectors, and pairs
of blocks are the unit of work, so no task gets an unbounded cell.  A pair that meets in several cells counts in the
first of them only; a block pair yields a count and a link to a neighbour for each vector, never its pairs.

Defined results: a null or empty vector, one of length 0, or one with a null or non-finite component, and any row without label,
links with nothing; vectors of different dimensions do not link; rows that repeat a vec_id are vectors of their own; rows
without vec_id take part and give no id to a component.  Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.llm.common import connected_components, discard, prepare, store, table

TABLES, PROBES, SCALE = 8, 12, 0.9
BLOCK = 1024
PAIRS_AT_ONCE = 40_000


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(out)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """The nearest whole vectors with even sum: round, and where the sum is odd move the worst coordinate the other way."""
    whole = np.rint(y)
    off = y - whole
    odd = np.flatnonzero(whole.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    whole[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return whole


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The nearest lattice points: the better of the whole and the half-whole coset."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    closer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


@lru_cache(maxsize=8)
def _projection(dimension: int, number: int) -> np.ndarray:
    return np.random.default_rng([17, dimension, number]).normal(0, 1, (dimension, 8))


def cells(vectors: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the cells the unit vectors live in (n x TABLES) and visit (n x TABLES x PROBES); salt tells labels apart."""
    multipliers = np.random.default_rng(23).integers(1, 1 << 62, 8, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def key(points: np.ndarray, t: int) -> np.ndarray:
        doubled = np.rint(points * 2).astype(np.int64).astype(np.uint64)
        mixed = salt.astype(np.uint64).reshape(-1, *[1] * (points.ndim - 2)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t + 1)
        for i in range(8):
            mixed = (mixed ^ (doubled[..., i] * multipliers[i])) * np.uint64(0xC2B2AE3D27D4EB4F)
            mixed ^= mixed >> np.uint64(32)
        return mixed.view(np.int64)

    homes = np.empty((len(vectors), TABLES), np.int64)
    visits = np.empty((len(vectors), TABLES, PROBES), np.int64)
    shifts = neighbours()
    for t in range(TABLES):
        y = SCALE * (vectors @ _projection(vectors.shape[1], t))
        point = nearest_e8(y)
        homes[:, t] = key(point, t)
        lean = (y - point) @ shifts.T
        near = np.argpartition(-lean, PROBES, axis=1)[:, :PROBES]
        visits[:, t] = key(point[:, None, :] + shifts[near], t)
    return homes, visits


def _usable(vector: list | None) -> np.ndarray | None:
    if not vector or None in vector:
        return None
    v = np.asarray(vector, np.float64)
    if not np.isfinite(v).all():
        return None
    # Scaled by the largest component first, so that no square overflows or vanishes.
    top = np.abs(v).max()
    return v / top / np.linalg.norm(v / top) if top > 0 else None


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks, units = [], []
        for vector in batch.column("embedding").to_pylist():
            unit = _usable(vector)
            units.append(unit.tolist() if unit is not None else None)
            marks.append(xxhash.xxh3_128_intdigest(unit.tobytes()) if unit is not None else None)
        half = (1 << 63) - 1
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array([None if m is None else m & half for m in marks], pa.int64()),
             pa.array([None if m is None else (m >> 64) & half for m in marks], pa.int64()), pa.array(units, pa.list_(pa.float64()))],
            ["vec_id", "label", "f1", "f2", "unit"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = batch.column("unit").to_pylist()
        sizes = np.array([len(u) for u in units])
        salt = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64) * 4096 + sizes
        homes = np.empty((len(units), TABLES), np.int64)
        visits = np.empty((len(units), TABLES, PROBES), np.int64)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            for part in np.array_split(at, -(-len(at) // 500)):
                homes[part], visits[part] = cells(np.array([units[i] for i in part]), salt[part])
        columns = [
            pa.ListArray.from_arrays(np.arange(len(units) + 1, dtype=np.int32) * (x.size // max(1, len(units))), pa.array(x.reshape(-1))) for x in (homes, visits)
        ]
        yield pa.RecordBatch.from_arrays([batch.column("node"), *columns], ["node", "homes", "visits"])


def _first_meeting(homes_a, visits_a, homes_b, visits_b) -> np.ndarray:
    """For each pair the key of the first cell in which it meets: by table, then by the smaller key."""
    none = np.iinfo(np.int64).max
    out = np.full(len(homes_a), none)
    for t in range(TABLES):
        a, b = homes_a[:, t], homes_b[:, t]
        at_a = (a == b) | (visits_b[:, t] == a[:, None]).any(axis=1)
        at_b = (visits_a[:, t] == b[:, None]).any(axis=1)
        here = np.minimum(np.where(at_a, a, none), np.where(at_b, b, none))
        out = np.where(out == none, here, out)
    return out


def _links(threshold: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Of one bundle of block pairs: for each vector its links counted here, and a neighbour to reach it by."""
        frame = frame.sort_values(["key", "low", "high"], ignore_index=True)
        node = frame["node"].to_numpy()
        distinct, first = np.unique(node, return_index=True)
        row = np.searchsorted(distinct, node)
        units = np.array([np.asarray(u) for u in frame["unit"].iloc[first]], dtype=object)
        sizes = np.array([len(u) for u in units])
        wide = np.zeros((len(distinct), sizes.max()))
        for i, u in enumerate(units):
            wide[i, : sizes[i]] = u
        homes = np.stack(frame["homes"].iloc[first].to_numpy())
        visits = np.stack(frame["visits"].iloc[first].to_numpy()).reshape(-1, TABLES, PROBES)
        copies = frame["copies"].to_numpy()[first]
        salt = frame["label"].to_numpy()[first] * 4096 + sizes
        key, block = frame["key"].to_numpy(), frame["block"].to_numpy()
        low, high, home = frame["low"].to_numpy(), frame["high"].to_numpy(), frame["home"].to_numpy()
        counts = np.zeros(len(distinct), np.int64)
        reach = np.arange(len(distinct))
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        ends = np.r_[starts[1:], len(frame)]
        edges: set[tuple[int, int]] = set()

        def verify(a: np.ndarray, b: np.ndarray) -> None:
            i, j = row[a], row[b]
            ok = (home[a] | home[b]) & (i != j) & (salt[i] == salt[j])
            # Within a block each pair once; between two blocks one from each; never the same pair in two bundles.
            ok &= np.where(low[a] == high[a], True, block[a] != block[b])
            a, i, j = a[ok], i[ok], j[ok]
            close = np.einsum("ij,ij->i", wide[i], wide[j]) >= threshold
            a, i, j = a[close], i[close], j[close]
            if not len(i):
                return
            mine = _first_meeting(homes[i], visits[i], homes[j], visits[j]) == key[a]
            i, j = i[mine], j[mine]
            np.add.at(counts, i, copies[j])
            np.add.at(counts, j, copies[i])
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                while reach[x] != x:
                    reach[x] = reach[reach[x]]
                    x = reach[x]
                while reach[y] != y:
                    reach[y] = reach[reach[y]]
                    y = reach[y]
                if x != y:
                    reach[max(x, y)] = min(x, y)

        waiting_a, waiting_b, waiting = [], [], 0
        for s, e in zip(starts, ends, strict=True):
            for i in range(s, e - 1):
                waiting_a.append(np.full(e - i - 1, i))
                waiting_b.append(np.arange(i + 1, e))
                waiting += e - i - 1
                if waiting >= PAIRS_AT_ONCE:
                    verify(np.concatenate(waiting_a), np.concatenate(waiting_b))
                    waiting_a, waiting_b, waiting = [], [], 0
        if waiting:
            verify(np.concatenate(waiting_a), np.concatenate(waiting_b))
        for x in range(len(reach)):
            root = x
            while reach[root] != root:
                root = reach[root]
            if root != x:
                edges.add((x, root))
        reached = np.arange(len(distinct))
        for x, root in edges:
            reached[x] = root
        told = (counts > 0) | (reached != np.arange(len(distinct)))
        return pd.DataFrame({"node": distinct[told], "links": counts[told], "other": distinct[reached[told]]})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, rows_per_bundle: int = 4096) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label)."""
    prepare(vectors.sparkSession)
    plain = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label").cast("long"))
    shape = "vec_id long, label long, f1 long, f2 long, unit array<double>"
    rows = store(plain.mapInArrow(_classes, shape).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    usable = rows.where("unit IS NOT NULL AND label IS NOT NULL")
    grouped = usable.groupBy("label", "f1", "f2").agg(F.min("rid").alias("node"), F.count("*").alias("copies"))
    classes = grouped.join(usable.select("rid", "unit"), F.col("node") == F.col("rid")).drop("rid")
    classes = store(classes, "vector_classes")
    hashed = store(classes.select("node", "label", "unit").mapInArrow(_hashed, "node long, homes array<long>, visits array<long>"), "cells")

    lives = hashed.select(F.explode("homes").alias("key"), "node", F.lit(True).alias("home"))
    visit = hashed.select(F.explode("visits").alias("key"), "node", F.lit(False).alias("home"))
    stays = lives.union(visit)
    shared = stays.groupBy("key").agg(F.count("*").alias("n"), F.max("home").alias("lived")).where("n > 1 AND lived")
    shared = shared.select(F.bitwise_not("key").alias("k"), "n")
    members = stays.select(F.bitwise_not("key").alias("k"), "node", "home").join(shared, "k")
    blocks = F.ceil(F.col("n") / BLOCK)
    members = members.withColumn("block", F.pmod(F.xxhash64("node", "k"), blocks))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    members = store(
        members.select("node", F.bitwise_not("k").alias("key"), "home", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")),
        "cell_members",
    )
    bundles = 1 + members.count() // rows_per_bundle
    full = members.join(hashed, "node").join(classes.select("node", "label", "unit", "copies"), "node")
    bundled = full.withColumn("bundle", F.pmod(F.xxhash64("key", "low", "high"), F.lit(bundles)))
    found = bundled.groupBy("bundle").applyInPandas(_links(threshold), "node long, links long, other long")
    found = store(found, "vector_links")
    components = store(connected_components(found.select(F.col("node").alias("a"), F.col("other").alias("b"))), "vector_components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = (
        classes.select("label", "f1", "f2", "node", "copies").join(links, "node", "left").join(components, "node", "left")
        .select("label", "f1", "f2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    )
    nodes = store(nodes, "vector_nodes")
    discard(classes, hashed, members, found, components)
    placed = rows.select("vec_id", "rid", "label", "f1", "f2").join(nodes, ["label", "f1", "f2"], "left")
    placed = placed.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", -1 - F.col("rid")).alias("component"))
    placed = store(placed, "vector_places")
    discard(rows, nodes)
    smallest = placed.groupBy("component").agg(F.min("vec_id").alias("component_id")).select(F.bitwise_not("component").alias("c"), "component_id")
    out = placed.withColumn("c", F.bitwise_not("component")).join(smallest, "c")
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))

"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A signature is 64 MinHash values of 14 bits.  Two documents of Jaccard similarity 0.8 differ in 12.8
of them on average (deviation 3.2); all pairs that differ in at most `MAX_ERRORS` = 25 (3.8 deviations) are found.
The signature is cut into 16 chunks of 4 values.  By the pigeonhole principle a pair within the threshold
has, for allowed chunk errors e_1..e_16 with sum(e_i + 1) = 26, some chunk i with at most e_i errors:
10 chunks allow one error (4 keys, one for each value left out), 6 allow none (1 key), 46 keys a document.

Documents with the same set of shingles form one class and only classes are compared.  In every key the members
are first compared with its most central one, which joins groups of near copies without listing their pairs.  In keys whose members then still
belong to several components all signatures meet in memory, and components with members within the threshold are chained into clusters;
of the pairs only those come out that chain something new.  In each cluster the members outside its largest component are compared with all
of them on full sets, by an index of shingles in memory, in blocks; what comes out is one link for each two components that a document joins,
never a row for each pair.  While such members fill many blocks, one of them, chosen by hash, is first
compared with the whole cluster, which takes one row a member and again joins what is near to it.
A pair links when 100 * |a & b| >= 80 * |a | b| on the full sets.
The query takes shingles of two words, the pipeline's stage of five.

Defined results: documents without words have an empty set and link with nothing, and the stage keeps all of them; rows without doc_id
take part and give no id to a component (component_id is null if no member has one); rows that repeat a doc_id
are separate rows with equal id; of several rows with the smallest id of a component the stage keeps one; very long texts are
read whole.  The stage reads all columns to tell rows apart, the rest only doc_id and text.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.llm.common import NO_ID, connected_components, discard, prepare, store, table

CHUNKS, PER_CHUNK, SYMBOL_BITS = 16, 4, 14
VALUES = CHUNKS * PER_CHUNK
MAX_ERRORS = 25
#: Chunks that allow one error; sum(e_i + 1) over all chunks must exceed MAX_ERRORS.
LOOSE = MAX_ERRORS + 1 - CHUNKS
LANE = SYMBOL_BITS + 1
SYMBOL = (1 << SYMBOL_BITS) - 1
ALL_SYMBOLS = sum(SYMBOL << (LANE * i) for i in range(PER_CHUNK))
TOP_BITS = sum(1 << (LANE * i + SYMBOL_BITS) for i in range(PER_CHUNK))

_random = np.random.default_rng(20240607)
_FACTORS = _random.integers(1, 1 << 63, VALUES, dtype=np.uint64) * 2 + 1
_TERMS = _random.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """Hash of each word met; emptied by the caller when it has grown past a bound."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


MAX_WORDS_KEPT = 400_000
SHINGLES_AT_ONCE = 500_000
ROWS_PER_BUNDLE = 1_000
#: Members of a key whose signatures are compared in one unit, and rows of such units in a bundle.
MEMBERS_AT_ONCE, MEMBERS_PER_BUNDLE = 4_096, 20_000
#: Leads are tried in clusters whose strangers fill more than so many blocks, while a lead joins one in so many of those it meets.
MANY_SHARES, LEAST_JOINED, MOST_LEADS = 4, 20, 12


def shingles(text: str | None, words: WordHashes, length: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `length` words; fewer words are one shingle."""
    if not text:
        return np.empty(0, np.uint64)
    # bytes.lower folds A-Z only, and bytes.split splits at exactly the six blanks.
    found = text.encode("utf-8").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = len(h)
    own = min(length, n)
    mixed = h[: n - own + 1]
    for j in range(1, own):
        mixed = (mixed * _MIX) ^ (h[j : n - own + 1 + j] + (mixed >> np.uint64(29)))
    h = mixed if own == length else mixed * _MIX2 + np.uint64(n)
    h ^= h >> np.uint64(32)
    h *= _MIX2
    h ^= h >> np.uint64(29)
    return np.unique(h)


def signature(found: np.ndarray) -> np.ndarray:
    """16 longs of four symbols each."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        part = found[at : at + 2048]
        np.minimum(low, (part[None, :] * _FACTORS[:, None] + _TERMS[:, None]).min(axis=1), out=low)
    symbols = ((low * _MIX) >> np.uint64(40)).astype(np.int64) & SYMBOL
    return (symbols.reshape(CHUNKS, PER_CHUNK) << (LANE * np.arange(PER_CHUNK))).sum(axis=1)


def _features(length: int):
    """Sizes, marks and signatures of texts, from shingles of `length` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            if len(words) > MAX_WORDS_KEPT:
                words.clear()
            sizes, marks, signatures = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, words, length)
                sizes.append(len(found))
                mark = xxhash.xxh3_128_intdigest(found.tobytes())
                marks.append(mark)
                signatures.append(signature(found))
            half = (1 << 64) - 1
            f1 = np.array([m & half for m in marks], np.uint64).view(np.int64)
            f2 = np.array([m >> 64 for m in marks], np.uint64).view(np.int64)
            flat = np.concatenate(signatures) if signatures else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, CHUNKS, dtype=np.int32), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tid"), batch.column("whole"), pa.array(sizes, pa.int64()), pa.array(f1), pa.array(f2), lists],
                ["doc_id", "tid", "whole", "n_shingles", "f1", "f2", "sig"],
            )

    return run


def _sets(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            if len(words) > MAX_WORDS_KEPT:
                words.clear()
            sets = [shingles(text, words, length).view(np.int64) for text in batch.column("text").to_pylist()]
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["node", "hashes"]
            )

    return run


def keys_of(sig: str) -> Column:
    """The 46 keys of a signature."""
    keys = []
    for i in range(CHUNKS):
        chunk = F.get(F.col(sig), F.lit(i))
        masks = [ALL_SYMBOLS & ~(SYMBOL << (LANE * j)) for j in range(PER_CHUNK)] if i < LOOSE else [ALL_SYMBOLS]
        keys += [F.xxhash64(F.lit(i * (PER_CHUNK + 1) + j), chunk.bitwiseAND(F.lit(mask))) for j, mask in enumerate(masks)]
    return F.array(*keys)


def _differing(a: str, b: str, i: int) -> Column:
    """Top bits of the lanes of chunk i that differ: such a lane of the exclusive or overflows into its top bit."""
    x = F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))
    return (x + F.lit(ALL_SYMBOLS)).bitwiseAND(F.lit(TOP_BITS))


def errors(a: str, b: str) -> Column:
    """In how many values two signatures differ."""
    total = F.lit(0)
    for i in range(CHUNKS):
        total = total + F.bit_count(_differing(a, b, i))
    return total


def first_key(a: str, b: str) -> Column:
    """Which of the 46 keys is the first that two signatures share, NULL if none."""
    found, place = F.lit(None).cast("int"), 0
    options = []
    for i in range(CHUNKS):
        lanes = _differing(a, b, i)
        options.append((lanes == 0, F.lit(place)))
        if i < LOOSE:
            for j in range(PER_CHUNK):
                options.append((lanes == F.lit(1 << (LANE * j + SYMBOL_BITS)), F.lit(place + j)))
        place += PER_CHUNK if i < LOOSE else 1
    for condition, value in reversed(options):
        found = F.when(condition, value).otherwise(found)
    return found


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, tid (a hash of the text), whole (a hash of the row), text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"), whole.alias("whole"), text.alias("text"))


def near_duplicates(docs: DataFrame, percent: int = 80, length: int = 2) -> DataFrame:
    """doc_id, tid, whole, n_shingles, component_id, kept, first (one row of each component) for every row of docs.

    Shingles are of `length` words.
    """
    prepare(docs.sparkSession)
    texts = identified(docs)
    shape = "doc_id long, tid long, whole long, n_shingles long, f1 long, f2 long, sig array<long>"
    rows = store(texts.mapInArrow(_features(length), shape).withColumn("rid", F.monotonically_increasing_id()), "signatures")
    full = rows.where("n_shingles > 0")
    grouped = full.groupBy("f1", "f2").agg(F.min("rid").alias("node"))
    lead = full.select("rid", "doc_id", "tid", "n_shingles", "sig")
    classes = store(grouped.join(lead, F.col("node") == F.col("rid")).drop("rid"), "classes")
    signatures = classes.select("node", "sig")

    keyed = classes.select(F.posexplode(keys_of("sig")).alias("place", "key"), "node")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.bitwise_not("key").alias("k"), "n")
    sharing = store(keyed.select(F.bitwise_not("key").alias("k"), "place", "node").join(shared, "k"), "sharing")
    # A class whose keys many others share is close to what its group varies: the best lead for the key.
    central = store(sharing.groupBy("node").agg(F.sum("n").alias("central")), "central")
    ranked = sharing.select("k", "node").join(central, "node")
    leads = ranked.groupBy("k").agg(F.max(F.struct("central", -F.col("node"))).alias("m"))
    leads = leads.select(F.bitwise_not("k").alias("key"), (-F.col("m").getField("col2")).alias("lead"))
    members = sharing.select(F.bitwise_not("k").alias("key"), "place", "node").join(store(leads, "leads"), "key")
    members = store(members.select(F.bitwise_not("key").alias("k"), "place", "node", "lead"), "members")
    discard(sharing, central)

    def within(pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (a, b) those whose signatures are within the threshold."""
        left = pairs.join(signatures.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
        both = left.join(signatures.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
        return both.where(errors("sig_a", "sig_b") <= MAX_ERRORS).select("a", "b")

    def sets_of(nodes: DataFrame) -> DataFrame:
        """The full sets of distinct nodes, as a stored table."""
        ids = classes.join(nodes, "node").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), "tid", "node")
        # One row of each class's own document: rows that repeat its id and text hold the same set.
        chosen = texts.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), "tid", "text").join(ids, ["did", "tid"])
        sets = chosen.select("node", "text").mapInArrow(_sets(length), "node long, hashes array<long>")
        return store(sets.dropDuplicates(["node"]), "shingle_sets")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        """Of stored pairs those that link on their full sets."""
        sets = sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct())
        left = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("set_a")), "a")
        both = left.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("set_b")), "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        linked = both.select("a", "b", (F.size("set_a") + F.size("set_b")).alias("sizes"), common.alias("common"))
        out = store(linked.where(F.expr(f"100 * common >= {percent} * (sizes - common)")).select("a", "b"), name)
        discard(sets)
        return out

    stars = members.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    stars = store(within(stars), "stars")
    links = confirmed(stars, "links")
    labels = store(connected_components(links), "labels")
    named = members.select("k", "node").join(labels, "node", "left")
    named = store(named.select(F.bitwise_not("k").alias("key"), "node", F.coalesce("component", "node").alias("component")), "named")

    # Keys whose members are of several components: components with members within the threshold are chained into clusters.
    ranges = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    ranges = store(ranges.where("low <> high").select(F.bitwise_not("key").alias("k"), "low", "n"), "ranges")
    mixed = named.withColumn("k", F.bitwise_not("key")).join(ranges, "k").select("k", "node", "component", "low", "n")
    chains = _chains(mixed, signatures)
    clusters = store(connected_components(chains), "clusters").select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    pool = named.select("node", "component").distinct().join(clusters, "component").join(classes.select("node", "n_shingles"), "node")
    pool = store(pool.select("node", "cluster", "component", "n_shingles"), "pool")
    sets = sets_of(pool.select("node"))
    cluster_links = _cluster_links(pool, sets, percent)
    components = store(connected_components(links.unionByName(cluster_links)), "components")
    discard(members, named, ranges, chains, stars, links, labels, pool, sets, cluster_links)

    nodes = store(classes.select("f1", "f2", "node").join(components, "node", "left")
                  .select("f1", "f2", F.coalesce("component", "node").alias("component")), "nodes")
    discard(classes, components)
    placed = rows.select("rid", "doc_id", "tid", "whole", "n_shingles", "f1", "f2").join(nodes, ["f1", "f2"], "left")
    # Rows without a set are components of their own: a negative number no node has.
    placed = store(placed.withColumn("component", F.coalesce("component", -1 - F.col("rid"))), "placed")
    discard(rows, nodes)
    smallest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    first = placed.groupBy("component").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), "rid")).alias("f"))
    groups = smallest.join(first, "component").select(F.bitwise_not("component").alias("c"), "component_id", "f.rid")
    out = placed.withColumn("c", F.bitwise_not("component")).join(groups.withColumnRenamed("rid", "first_rid"), "c")
    return out.select(
        "doc_id", "tid", "whole", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("rid") == F.col("first_rid")).alias("first"),
    )


def _near(frame: pa.Table) -> pa.Table:
    """Of a bundle of (key, block, share): pairs of components with members within the threshold, as few as join them all.

    role: 0 is only visited, 1 visits as well, 2 only visits.
    """
    order = np.lexsort([frame.column(c).to_numpy() for c in ("node", "share", "block", "k")])
    frame = frame.take(pa.array(order)).combine_chunks()
    key, block, share, part, role = (frame.column(c).to_numpy() for c in ("k", "block", "share", "component", "role"))
    sig = frame.column("sig").chunk(0).flatten().to_numpy().reshape(-1, CHUNKS) if len(frame) else np.empty((0, CHUNKS), np.int64)
    starts = np.flatnonzero((np.diff(key, prepend=key[:1] - 1) != 0) | (np.diff(block, prepend=-1) != 0) | (np.diff(share, prepend=-1) != 0))
    ends = np.append(starts[1:], len(key))
    a, b = [], []

    def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.bitwise_count(((x ^ y) + ALL_SYMBOLS) & TOP_BITS).sum(axis=-1)

    # Keys of two members, most of all, at once.
    pairs = starts[ends - starts == 2]
    hit = pairs[(differing(sig[pairs], sig[pairs + 1]) <= MAX_ERRORS) & (part[pairs] != part[pairs + 1])]
    a.append(part[hit])
    b.append(part[hit + 1])
    for begin, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if end - begin < 3 and (end - begin < 2 or role[begin] < 2 and role[begin + 1] < 2):
            continue
        hosts = begin + np.flatnonzero(role[begin:end] < 2)
        label = part[hosts].copy()
        theirs = sig[hosts]
        for visitor in begin + np.flatnonzero(role[begin:end] > 0):
            near = np.unique(label[differing(theirs, sig[visitor]) <= MAX_ERRORS])
            own = part[visitor]
            mine = label[np.searchsorted(hosts, visitor)] if role[visitor] == 1 else own
            near = near[near != mine]
            if len(near):
                a.append(np.full(len(near), own))
                b.append(near)
                # What has been joined here need not be joined again.
                label[np.isin(label, near)] = mine
    return pa.table({"a": np.concatenate(a).astype(np.int64), "b": np.concatenate(b).astype(np.int64)})


def _chains(mixed: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs (a, b) of components that are to be in one cluster.

    mixed: k, node, component, low (a component of the key, whose members need not visit), n (members of the key).
    A key with more than MEMBERS_AT_ONCE members is cut into blocks, each of which meets each block of its visitors.
    """
    zero = F.lit(0).cast("long")
    stranger = F.col("component") != F.col("low")
    small = mixed.where(F.col("n") <= MEMBERS_AT_ONCE).select(
        "k", "node", "component", zero.alias("block"), zero.alias("share"), stranger.cast("int").alias("role")
    )
    blocks = F.ceil(F.col("n") / MEMBERS_AT_ONCE).cast("long")
    large = mixed.where(F.col("n") > MEMBERS_AT_ONCE).withColumn("own", F.pmod(F.xxhash64("node"), blocks))
    large = large.withColumn("other", F.explode(F.sequence(zero, blocks - 1)))
    hosts = large.select("k", "node", "component", F.col("own").alias("block"), F.col("other").alias("share"), F.lit(0).alias("role"))
    visitors = large.where(stranger).select("k", "node", "component", F.col("other").alias("block"), F.col("own").alias("share"), F.lit(2).alias("role"))
    units = store(small.unionByName(hosts).unionByName(visitors), "key_members")
    bundles = 1 + units.count() // MEMBERS_PER_BUNDLE
    bundled = units.withColumn("bundle", F.pmod(F.xxhash64("k", "block", "share"), F.lit(bundles))).join(signatures, "node")
    found = store(bundled.groupBy("bundle").applyInArrow(_near, "a long, b long"), "chains")
    discard(units)
    return found


def _meetings(percent: int):
    """Of a bundle of (cluster, block, share): for each visitor one link to each other component that it links to."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        frame = frame.sort_values(["cluster", "block", "share", "visitor", "node"], ignore_index=True)
        for _, group in frame.groupby(["cluster", "block", "share"], sort=False):
            hosts, guests = group[~group["visitor"]], group[group["visitor"]]
            if not len(hosts) or not len(guests):
                continue
            sets = [np.asarray(h) for h in hosts["hashes"]]
            sizes = np.array([len(x) for x in sets])
            flat = np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            owner, flat = np.repeat(np.arange(len(sets)), sizes)[order], flat[order]
            nodes, parts = hosts["node"].to_numpy(), hosts["component"].to_numpy()
            for node, part, mine in zip(guests["node"], guests["component"], guests["hashes"], strict=True):
                mine = np.asarray(mine)
                low, high = np.searchsorted(flat, mine, "left"), np.searchsorted(flat, mine, "right")
                n = high - low
                at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                common = np.bincount(owner[at], minlength=len(sets))
                linked = np.flatnonzero((100 * common >= percent * (sizes + len(mine) - common)) & (parts != part))
                if len(linked):
                    _, first = np.unique(parts[linked], return_index=True)
                    found += [(int(node), int(nodes[x])) for x in linked[first]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _cuts(pool: DataFrame) -> DataFrame:
    """Of each cluster (o: its complement) with several components: its largest, and how many blocks its members and its strangers fill."""
    size = pool.groupBy("cluster", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("sum"))
    cluster = size.groupBy("cluster").agg(
        F.max(F.struct("n", "component")).alias("most"), F.sum("sum").alias("all"), F.count("*").alias("parts")
    )
    own = cluster.where("parts > 1").select("cluster", F.col("most.component").alias("component"), "all")
    cut = own.join(size.select("cluster", "component", "sum"), ["cluster", "component"])
    blocks = lambda x: F.greatest(F.lit(1), F.ceil(x / SHINGLES_AT_ONCE)).cast("long")
    return cut.select(
        F.bitwise_not("cluster").alias("o"), F.col("component").alias("home"),
        blocks(F.col("all")).alias("blocks"), blocks(F.col("all") - F.col("sum")).alias("shares"),
    )


def _cluster_links(pool: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join components of one cluster; with those that made the components, a spanning forest of all links.

    pool: node, cluster, component, n_shingles; sets: node, hashes.
    """
    peeled, rounds = [], 0
    held = pool
    while True:
        cuts = store(_cuts(held), "cuts")
        crowded = cuts.where(F.col("shares") > MANY_SHARES)
        if rounds == MOST_LEADS or not crowded.limit(1).count():
            break
        keyed = held.withColumn("o", F.bitwise_not("cluster")).join(crowded, "o")
        lead = keyed.where("component <> home").groupBy("o").agg(F.min(F.struct(F.xxhash64("node", F.lit(rounds)).alias("h"), "node")).alias("lead"))
        lead = lead.select("o", F.col("lead.node").alias("lead")).join(sets.select(F.col("node").alias("lead"), F.col("hashes").alias("theirs")), "lead")
        lead = store(lead, "leads")
        met = keyed.select("o", "node").join(sets, "node").join(lead, "o").where("node <> lead")
        common = F.size(F.array_intersect("hashes", "theirs"))
        pairs = met.select("node", "lead", (F.size("hashes") + F.size("theirs")).alias("sizes"), common.alias("common"))
        near = store(pairs.where(F.expr(f"100 * common >= {percent} * (sizes - common)")).select(F.col("node").alias("a"), F.col("lead").alias("b")), "near")
        peeled.append(near)
        if near.count() * LEAST_JOINED < keyed.count():
            rounds = MOST_LEADS - 1
        # Components that a lead has joined are one from now on.
        part = held.select("node", "component")
        joined = near.join(part.select(F.col("node").alias("a"), F.col("component").alias("p")), "a").join(
            part.select(F.col("node").alias("b"), F.col("component").alias("q")), "b"
        )
        merged = connected_components(joined.select(F.col("p").alias("a"), F.col("q").alias("b")))
        renamed = held.join(merged.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
        held = store(renamed.select("node", "cluster", F.coalesce("to", "component").alias("component"), "n_shingles"), "pool")
        rounds += 1
    zero = F.lit(0).cast("long")
    cut = held.withColumn("o", F.bitwise_not("cluster")).join(cuts, "o")

    def spread(rows: DataFrame, own: str, all_: str, block: str, share: str, visitor: bool) -> DataFrame:
        rows = rows.withColumn(block, F.pmod(F.xxhash64("node"), F.col(own)))
        rows = rows.withColumn(share, F.explode(F.sequence(zero, F.col(all_) - 1)))
        return rows.select("node", "cluster", "component", "block", "share", F.lit(visitor).alias("visitor"))

    hosts = spread(cut, "blocks", "shares", "block", "share", False)
    visitors = spread(cut.where("component <> home"), "shares", "blocks", "share", "block", True)
    meeting = store(hosts.union(visitors), "meetings")
    bundles = 1 + meeting.count() // ROWS_PER_BUNDLE
    bundled = meeting.withColumn("bundle", F.pmod(F.xxhash64("cluster", "block", "share"), F.lit(bundles))).join(sets, "node")
    found = bundled.groupBy("bundle").applyInPandas(_meetings(percent), "a long, b long")
    out = store(reduce(DataFrame.unionByName, peeled, found), "cluster_links")
    discard(meeting, cuts)
    return out


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component, with all its columns; near are documents with shingles of five words."""
    key = ["did", "tid", "whole"]
    first = near_duplicates(docs, length=5).where("first").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), "tid", "whole")
    # Rows without words are components of their own, also where all their columns are equal.
    kept = first.groupBy(*key).agg(F.count("*").alias("copies"))
    others = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tid"),
        F.xxhash64(*others).alias("whole"),
        F.struct(*others).alias("row"),
    )
    chosen = marked.join(kept, key).dropDuplicates(key).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return chosen.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))

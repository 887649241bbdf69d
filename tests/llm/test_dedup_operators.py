"""Line deduplication, near-duplicate documents and vectors, against plain counterparts."""

import hashlib
import random

import brute
import numpy as np
import pytest
from rows import odd_rows

from mediatide.llm import hamming_dedup, lattice_dedup, line_dedup
from mediatide.llm.common import connected_components, salted_ranks


def plain_lines(rows):
    """(doc_id, n_lines, n_dropped, kept text) of every row; a missing id sorts last and is one document."""
    place = lambda i: float("inf") if i is None else i
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = brute.ascii_lower(line.strip(" \t\n\v\f\r"))
            if len(key) >= 10:
                holders[key] = min(holders.get(key, place(i)), place(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = brute.ascii_lower(line.strip(" \t\n\v\f\r"))
            if len(key) < 10 or holders[key] == place(i):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def test_lines_agree_with_a_plain_pass(odd, small):
    for df in (odd, small):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        got = line_dedup.dedup_lines(df, batches=3).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
        assert sorted(map(tuple, got), key=key) == sorted(plain_lines(rows), key=key)


def test_runs_compact_and_batches_change_nothing(small):
    one, many = (
        {r["doc_id"]: hashlib.sha256(r["kept_text"].encode()).hexdigest() for r in line_dedup.dedup_lines(small, batches=b, fanout=f).select("row.doc_id", "kept_text").collect()}
        for b, f in ((1, 2), (6, 2))
    )
    assert one == many


def test_line_stage_keeps_rows_and_columns(spark, odd):
    out = line_dedup.stage(spark, odd, "")
    assert out.columns == odd.columns and out.count() == odd.count()


def test_near_documents_agree_with_all_pairs(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    rng = random.Random(1)
    base = [t for _, t in rows if t and len(t.split()) > 60][:12]
    planted = []
    for n, text in enumerate(base):
        words = text.split()
        for copy in range(n % 4 + 1):
            changed = list(words)
            for _ in range(rng.choice([1, 2, 4, 8]) * len(words) // 100 + 1):
                changed[rng.randrange(len(changed))] = f"new{rng.random()}"
            planted.append((10_000 + 10 * n + copy, " ".join(changed)))
    rows += [*planted, (20_000, None), (20_001, ""), (20_002, "one"), (20_003, "ONE"), (20_004, " \n ")]
    wanted = brute.near_documents(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in hamming_dedup.near_duplicates(df).collect()}
    assert got == wanted


def test_group_of_near_copies_is_one_component_without_its_base(spark):
    """Copies that differ in their own places: some pairs link, most do not."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for n in range(60):
        words = list(base)
        for _ in range(9):
            words[rng.randrange(150)] = f"v{n}_{rng.random()}"
        rows.append((n, " ".join(words)))
    wanted = brute.near_documents(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in hamming_dedup.near_duplicates(df).collect()} == wanted


@pytest.mark.parametrize("leads", [0, 3, 12])
def test_clusters_larger_than_a_block(spark, monkeypatch, leads):
    """Chains of documents, each near to the next only, in more blocks than one, with and without leads tried before."""
    monkeypatch.setattr(hamming_dedup, "SHINGLES_AT_ONCE", 1_500)
    monkeypatch.setattr(hamming_dedup, "MOST_LEADS", leads)
    monkeypatch.setattr(hamming_dedup, "MANY_SHARES", 1)
    monkeypatch.setattr(hamming_dedup, "LEAST_JOINED", 1000)
    monkeypatch.setattr(hamming_dedup, "MEMBERS_AT_ONCE", 7)
    rng = random.Random(6)
    rows = []
    for chain in range(3):
        words = [f"w{chain}_{i}" for i in range(120)]
        for n in range(40):
            for _ in range(rng.choice([3, 5, 8])):
                words[rng.randrange(120)] = f"v{rng.random()}"
            rows.append((100 * chain + n, " ".join(words)))
    wanted = brute.near_documents(rows)
    assert 10 < len({c for _, c, _ in wanted.values()}) < 100
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in hamming_dedup.near_duplicates(df).collect()} == wanted


def test_stage_loses_no_row(spark):
    """Rows without words stay, whatever their ids; of rows that share id and text one stays, with its own columns."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, None, "en"), (None, None, "de"), (None, None, "fr"), (None, None, "fr"), (7, "", "x"), (7, "", "y"), (1, text, "a"), (1, text, "b"), (2, text, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = [tuple(r) for r in hamming_dedup.stage(spark, docs, "").collect()]
    assert sorted((r for r in out if r[1] != text), key=repr) == sorted(rows[:6], key=repr)
    kept = [r for r in out if r[1] == text]
    assert len(kept) == 1 and kept[0] in rows[6:8]


def test_near_documents_of_longer_shingles_agree_with_all_pairs(spark, monkeypatch):
    """Changes a few words apart break few shingles of two words and many of five."""
    rng = random.Random(4)
    rows = []
    for n in range(8):
        words = [f"w{n}_{i}" for i in range(200)]
        rows.append((10 * n, " ".join(words)))
        for copy, changes in enumerate((1, 4, 8, 12), 1):
            changed = list(words)
            for at in rng.sample(range(200), changes):
                changed[at] = f"v{rng.random()}"
            rows.append((10 * n + copy, " ".join(changed)))
    rows += [(900, None), (901, "one"), (902, "ONE"), (903, "a b c d"), (904, "A b c d"), (905, "a b c"), (906, "a b c d e")]

    def five(text):
        w = brute.words(brute.ascii_lower(text or ""))
        return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))

    df = spark.createDataFrame(rows, "doc_id long, text string")
    two_words = brute.near_documents(rows)
    monkeypatch.setattr(brute, "shingle_set", five)
    wanted = brute.near_documents(rows)
    assert sum(kept for _, _, kept in wanted.values()) > sum(kept for _, _, kept in two_words.values())
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in hamming_dedup.near_duplicates(df, length=5).collect()}
    assert got == wanted


def test_documents_with_odd_values(spark, odd, empty):
    out = hamming_dedup.near_duplicates(odd).collect()
    assert len(out) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[6]["component_id"] == by_id[7]["component_id"] == 6
    assert by_id[8]["component_id"] == by_id[9]["component_id"] == 8
    assert [r["component_id"] for r in out if r["doc_id"] is None] in ([8, None], [None, 8])
    assert by_id[0]["kept"] and by_id[0]["n_shingles"] == 0
    stage = hamming_dedup.stage(spark, odd, "")
    assert stage.columns == odd.columns
    # One row for each component: of 8, its repeats, its near copy and the one without id a single row is left.
    assert sorted(r["doc_id"] for r in stage.collect() if r["doc_id"] in (6, 7, 8, 9)) == [6, 8]
    assert hamming_dedup.near_duplicates(empty).collect() == []


def test_keys_find_every_pair_within_the_threshold(spark):
    """Signatures with exactly MAX_ERRORS differences, wherever they are, share a key."""
    rng = np.random.default_rng(3)
    rows = []
    for n in range(200):
        a = rng.integers(0, hamming_dedup.SYMBOL + 1, 64)
        b = a.copy()
        at = rng.permutation(64)[: hamming_dedup.MAX_ERRORS]
        b[at] = (b[at] + 1) & hamming_dedup.SYMBOL
        pack = lambda v: (v.reshape(16, 4) << (15 * np.arange(4))).sum(axis=1).tolist()
        rows.append((n, pack(a), pack(b)))
    df = spark.createDataFrame(rows, "n long, a array<long>, b array<long>")
    from pyspark.sql import functions as F

    both = df.select(
        F.arrays_overlap(hamming_dedup.keys_of("a"), hamming_dedup.keys_of("b")).alias("met"),
        hamming_dedup.errors("a", "b").alias("errors"), hamming_dedup.first_key("a", "b").alias("first"),
        hamming_dedup.keys_of("a").alias("ka"), hamming_dedup.keys_of("b").alias("kb"),
    )
    for r in both.collect():
        shared = [i for i, (x, y) in enumerate(zip(r["ka"], r["kb"], strict=True)) if x == y]
        assert r["met"] and r["errors"] == hamming_dedup.MAX_ERRORS and r["first"] == shared[0]


def test_near_vectors_agree_with_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows, n = [], 0

    def unit(v):
        return v / np.linalg.norm(v)

    for label in (0, 1, 2):
        for _ in range(60):
            x = unit(rng.normal(size=64))
            rows.append((n, x.tolist(), label))
            n += 1
            for cosine in rng.choice([0.90, 0.925, 0.932, 0.95, 0.99, 1.0], 2):
                other = rng.normal(size=64)
                other = unit(other - (other @ x) * x)
                rows.append((n, (7.5 * (cosine * x + np.sqrt(1 - cosine**2) * other)).tolist(), label))
                n += 1
    rows += [(n + i, rows[0][1], 0) for i in range(5)]
    rows += [(n + 10, None, 0), (n + 11, [0.0] * 64, 0), (n + 12, [float("nan")] + [1.0] * 63, 0), (n + 13, [None] + [1.0] * 63, 0), (n + 14, rows[0][1], None)]
    rows += [(n + 15, [], 0), (n + 16, [1.0, 2.0], 0), (n + 17, [2.0, 4.0], 0), (n + 18, [float("inf")] * 64, 0)]
    wanted = brute.near_vectors(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in lattice_dedup.near_duplicates(df).collect()}
    wrong = [i for i in wanted if wanted[i] != got[i]]
    assert len(got) == len(rows) and not wrong
    assert lattice_dedup.near_duplicates(df.limit(0)).collect() == []


def test_crowded_cell_is_cut_into_blocks(spark, monkeypatch):
    """A group of distinct near copies larger than several blocks; every link is counted once."""
    monkeypatch.setattr(lattice_dedup, "BLOCK", 16)
    rng = np.random.default_rng(8)
    x = rng.normal(size=32)
    rows = [(i, (x + 0.04 * rng.normal(size=32)).tolist(), 1) for i in range(90)]
    wanted = brute.near_vectors(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in lattice_dedup.near_duplicates(df).collect()} == wanted


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(1)
    y = rng.normal(0, 2, (300, 8))
    point = lattice_dedup.nearest_e8(y)
    doubled = np.rint(point * 2).astype(int)
    assert ((doubled % 2 == 0).all(axis=1) | (doubled % 2 == 1).all(axis=1)).all()
    assert (np.rint(point.sum(axis=1)).astype(int) % 2 == 0).all()
    best = ((y - point) ** 2).sum(axis=1)
    for shift in lattice_dedup.neighbours():
        assert (best <= ((y - point - shift) ** 2).sum(axis=1) + 1e-9).all()


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(300, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, **{200 + i: 200 for i in range(9)}}


def test_ranks_within_a_heavy_key(spark):
    df = spark.range(3000).selectExpr("id", "IF(id < 2500, 'a', 'b') AS k", "xxhash64(id) AS h")
    rows = salted_ranks(df, ["k"], ["h"]).collect()
    for k in "ab":
        own = sorted((r["h"], r["rank"]) for r in rows if r["k"] == k)
        assert [x for _, x in own] == list(range(len(own)))

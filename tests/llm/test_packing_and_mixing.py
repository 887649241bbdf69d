"""Packing, mixing and line frequency against plain counterparts and SQL."""

import itertools
import struct
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import arrow_rows, connect, difference
from mediatide.llm import bin_packing, line_frequency, queries, source_mixing


def fewest_bins(sizes, capacity):
    """By trying every way to put the pieces, largest first."""
    best = [len(sizes)]

    def place(i, room):
        if len(room) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(room)
            return
        for j in {r: j for j, r in enumerate(room) if r >= sizes[i]}.values():
            place(i + 1, [*room[:j], room[j] - sizes[i], *room[j + 1 :]])
        place(i + 1, [*room, capacity - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best[0]


def test_bin_completion_finds_the_optimum_of_small_cases():
    rng = np.random.default_rng(2)
    for _ in range(150):
        capacity = int(rng.integers(10, 40))
        sizes = rng.integers(1, capacity, int(rng.integers(1, 11))).tolist()
        plan = bin_packing.complete_bins(np.bincount(sizes, minlength=capacity), capacity)
        held = Counter(x for p in plan for x in p.sizes for _ in range(p.times))
        assert held == Counter(sizes) and all(sum(p.sizes) <= capacity for p in plan)
        assert sum(p.times for p in plan) == fewest_bins(sizes, capacity)


def test_large_histograms_come_close_to_the_bound():
    sizes = np.minimum(2047, np.random.default_rng(3).lognormal(6, 1, 30_000).astype(int) + 1)
    counts = np.bincount(sizes, minlength=2048)
    plan = bin_packing.complete_bins(counts)
    assert sum(p.times for p in plan) <= bin_packing.lower_bound(counts, 2048) + 1


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bin_packing.default_vocabulary())
    wanted = Counter()
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at : at + 2048]
            wanted[i, k, at, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    return len(sequences)


def test_pieces_and_places(spark, odd, small, empty):
    for df in (odd, small):
        texts = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        rows = bin_packing.stage(spark, df, "").collect()
        n = check_packing(rows, texts)
        assert n <= -(-sum(r["length"] for r in rows) // 2048) + 1
    assert bin_packing.stage(spark, empty, "").collect() == []


def test_words_apart_have_the_ids_of_the_text():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bin_packing.default_vocabulary())
    known = bin_packing.WordIds(bin_packing.default_vocabulary())
    parts = ["it's", "ΣΑΣ", "é", "́x", "a b", " ", "<|endoftext|>", "x<|startoftext|>y", "Ǆ", "1234", "!!??", "\x1c", "‍", "日本", "İ"]
    for a, b, blank in itertools.product(parts, parts, (" ", "\n", "\t\r")):
        text = f"{a}{blank}{b} "
        assert known.ids([text])[0] == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def check_mix(df):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(brute.words(text))
    largest = defaultdict(int)
    for _, text, source in rows:
        largest[source] = max(largest[source], len(brute.words(text)))
    wanted = brute.source_targets(dict(sizes))
    got = [r.asDict() for r in source_mixing.mix(df).collect()]
    order = lambda x: (str(x[0]), *x[1:])
    found = sorted(((r["doc_id"], r["size"], r["source_size"], r["target"]) for r in got), key=order)
    expected = sorted(((i, len(brute.words(t)), sizes[s], wanted[s]) for i, t, s in rows), key=order)
    assert [x[:3] for x in found] == [x[:3] for x in expected]
    assert [x[3] for x in found] == pytest.approx([x[3] for x in expected], rel=1e-9)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[r["source_size"], round(r["target"])] += r["taken"]
    # Sources of equal size and target cannot be told apart in the result.
    for size, target in {(sizes[s], round(wanted[s])) for s in sizes}:
        alike = [s for s in sizes if (sizes[s], round(wanted[s])) == (size, target)]
        assert abs(taken[size, target] - sum(wanted[s] for s in alike)) <= sum(largest[s] + 1 for s in alike)
    return sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in got)


def test_mixing_meets_targets_and_repeats(odd, small, empty):
    for df in (odd, small):
        assert check_mix(df) == check_mix(df.repartition(5))
    assert source_mixing.mix(empty).collect() == []


def test_mixing_with_many_sources(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "w " * int(rng.integers(0, 40)), f"s{int(rng.integers(0, 30)) ** 2 // 30}", None, None) for i in range(3000)]
    check_mix(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long"))


def test_rates_are_tilted_and_meet_the_constraint(spark):
    cells = spark.createDataFrame([(0, s, 10) for s in range(1, 60)] + [(1, 5, 3), (2, 7, 2)], "sid long, size long, n long")
    total = sum(10 * s for s in range(1, 60))
    sources = spark.createDataFrame([(0, total, 0.3 * total, 30.0), (1, 15, 30.0, 5.0), (2, 14, 14.0, 7.0)], "sid long, source_size long, target double, mean double")
    solved = source_mixing.solve(cells, sources)
    rates = cells.join(solved, "sid").withColumn("r", source_mixing.rate("tilt", "size", "mean"))
    got = {r["sid"]: (r["t"], r["target"]) for r in rates.groupBy("sid").agg(F.sum(F.col("n") * F.col("size") * F.col("r")).alias("t"), F.first("target").alias("target")).collect()}
    for taken, target in got.values():
        assert taken == pytest.approx(target, rel=1e-6)
    # The logit of rate / limit is linear in the size.
    one = [(r["size"], np.log(r["r"] / (2 - r["r"]))) for r in rates.where("sid = 0").collect()]
    slope = {round(y / x, 9) for x, y in one}
    assert len(slope) == 1


def test_mixing_stage_repeats_documents(spark, small):
    out = source_mixing.stage(spark, small, "")
    assert out.columns == small.columns
    copies = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert copies == Counter({r["doc_id"]: r["copies"] for r in source_mixing.mix(small).collect() if r["copies"]})


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_agree_with_their_sql(spark, name):
    path = "/root/testdata/sf0.001"
    got = arrow_rows(queries.QUERIES[name](spark, path).toArrow())
    assert difference(got, arrow_rows(connect(path).sql(queries.SQL[name]).to_arrow_table())) is None


def plain_counts(text):
    words = brute.words(text)
    lines = [x for x in (text or "").split("\n") if brute.words(x)]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_line_frequency_counts_and_verdicts(spark, odd, empty):
    rows = [r.asDict() for r in line_frequency.judge(odd).collect()]
    texts = Counter(plain_counts(r["text"]) for r in odd.select("text").collect())
    assert Counter((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows) == texts
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert line_frequency.judge(empty).collect() == []


def test_lines_above_the_limit_deplete_documents(spark):
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(25))
    menu = "\n".join(" ".join(f"menu{k}y{j}" for j in range(20)) for k in range(4))
    rows = [(i, f"{menu}\n{own(i)}" if i % 2 else menu, "host") for i in range(8)] + [(8, menu, "other"), (9, menu, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["kept"], r["n_removed_words"]) for r in line_frequency.judge(df, max_documents=5, min_share=0.2).collect()}
    assert got == {**{i: (bool(i % 2), 80) for i in range(8)}, 8: (True, 0), 9: (True, 0)}
    texts = {r["doc_id"]: r["text"] for r in line_frequency.cleaned(df, max_documents=5).collect()}
    assert texts == {i: own(i) if i % 2 else "" for i in range(8)}


def test_ids_of_words_are_those_of_whole_texts(small, monkeypatch):
    """Words merged on their own, words encoded together, and a cache that forgets, against the tokenizer on whole texts."""
    texts = [r["text"] for r in small.limit(120).collect()]
    texts += [
        None, "", "a \x1f b", "\x1f", "x\x1fy \x1fz", "é̈ ﬁ İstanbul ΣΑΣ ΟΔΟΣ. it's 'd12 3", "日本 🙂👩‍👩‍👧 <|endoftext|> <|startoftext|>",
        "\x00 \x01", " ̈a b̈", "word. Word, word... word.,x don't. A.B. end.", "ẞ Straße ǅ ŉ K Å ﬃ", "x" * 5000 + " " + "Ab" * 900, "a  b\u00a0c\u2028d e\u0301",
    ]
    plain = bin_packing.WordIds(bin_packing.default_vocabulary()).tokenizer
    wanted = [np.array(plain.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    known = bin_packing.WordIds(bin_packing.default_vocabulary())
    assert known.merge is not None and known.between is not None
    assert known.ids(texts) == wanted
    known.most = 4000
    assert [known.ids([t])[0] for t in texts] == wanted and known.held <= 2000 + 200 * 5000
    monkeypatch.setattr(bin_packing, "_merges", lambda path: None)
    assert bin_packing.WordIds(bin_packing.default_vocabulary()).ids(texts) == wanted

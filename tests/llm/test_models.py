"""Quality, toxicity, language and language-model scores."""

import math
import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from rows import odd_rows, sentence

from mediatide.llm import context_mixing, language_id, quality_ordinal, toxicity
from mediatide.llm.common import split_of


def test_split_is_the_checksum_of_the_id(odd):
    for r in odd.select("doc_id", split_of(4, 2).alias("a"), split_of(5, 1).alias("b")).collect():
        assert r["a"] == (brute.remainder(r["doc_id"], 4) == 2) and r["b"] == (brute.remainder(r["doc_id"], 5) == 1)


# ---- quality


def test_thresholds_are_ordered_and_grades_are_found():
    rng = random.Random(1)
    grades = [i % 3 for i in range(400)]
    cells = quality_ordinal._Cells()
    rows = [quality_ordinal.features(sentence(rng, 30, "abcd") + " bad" * (2 - g) * 3, cells) for g in grades]
    model = quality_ordinal.train(rows, np.array(grades))
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(np.array([model.weights[w] @ v for w, v in rows]))
    assert (np.diff(tails, axis=1) <= 0).all()
    assert np.mean(np.rint(tails.sum(axis=1)) == grades) > 0.9


def test_quality_query_over_odd_rows(spark, odd, empty, folder):
    rated = [(i, i % 2, None if i == 3 else int(i % 3 == 0)) for i in range(16)] + [(None, 1, 1), (1, None, 0), (5, 0, 0)]
    labels = spark.createDataFrame(rated, "doc_id long, quality int, toxic int")
    path = folder(documents=odd, labels=labels)
    rows = quality_ordinal.op1_quality_ordinal(spark, path).collect()
    assert len(rows) == len(odd_rows())
    assert all(0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in rows)
    assert quality_ordinal.op1_quality_ordinal(spark, folder(documents=empty, labels=labels)).collect() == []
    unlabelled = quality_ordinal.op1_quality_ordinal(spark, folder(documents=odd, labels=labels.limit(0)))
    assert {(r["kept"], r["expected_grade"]) for r in unlabelled.collect()} == {(True, 0.0)}


# ---- toxicity


def test_kernel_is_positive_and_tolerates_gaps():
    words = ["idiot", "idjiot", "idot", "table", "stable", "zzzzz"]
    k = toxicity.kernel(words, words)
    assert np.allclose(k, k.T) and np.linalg.eigvalsh(k).min() > -1e-9
    assert k[0, 1] > 3 * k[0, 3] and k[0, 2] > 3 * k[0, 3] and k[0, 5] == 0


def test_subsequences_agree_with_plain_enumeration():
    for word in ("moron", "anan", "ab"):
        marked = [2, *map(ord, word), 3]
        n = sum(1 for i in range(len(marked)) for j in range(i + 1, len(marked)) for k in range(j + 1, len(marked)) if k - i < toxicity.MAX_SPAN)
        cells, weights = toxicity.subsequences([word])
        assert (cells > 0).sum() == n and (weights[cells > 0] > 0).all()


def test_spelled_out_words_are_joined():
    assert "idiot" in toxicity.words_of("you i.d.i.o.t you")
    assert "idiot" in toxicity.words_of("you i d i o t!")
    assert "idiot" in toxicity.words_of("(IDIOT),")
    assert toxicity.words_of(None) == toxicity.words_of(" \n") == set()


def test_planted_insults_are_found_with_inserted_characters():
    rng = random.Random(3)
    insults = ["zorkan", "quimble", "vexpod"]
    texts, toxic = [], []
    for i in range(600):
        words = sentence(rng, 25).split()
        if i % 3 == 0:
            words.insert(rng.randrange(25), rng.choice(insults))
        texts.append(" ".join(words))
        toxic.append(i % 3 == 0)
    machine = toxicity.train(texts, np.array(toxic), landmarks=96)

    def score(text):
        return machine.probability(np.array([toxicity.top_two(machine.words(list(toxicity.words_of(text))))]))[0]

    for insult in insults:
        changed = insult[:3] + "x" + insult[3:]
        assert score(f"{sentence(rng, 20)} {insult}") > 0.7
        assert score(f"{sentence(rng, 20)} {changed}") > score(sentence(rng, 20))
    assert np.mean([score(sentence(rng, 25)) > 0.3 for _ in range(100)]) < 0.1


def test_toxicity_query_over_odd_rows(spark, odd, empty, folder):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(16)] + [(None, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.op8_toxicity(spark, folder(documents=odd, labels=labels)).collect()
    assert len(rows) == len(odd_rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert toxicity.op8_toxicity(spark, folder(documents=empty, labels=labels)).collect() == []
    plain = toxicity.op8_toxicity(spark, folder(documents=odd, labels=labels.limit(0))).collect()
    assert {r["score"] for r in plain} == {0.0}


# ---- language


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    layer = language_id.Direction.random(4, rng)
    layer.inputs = {g: v.astype("f8") for g, v in layer.inputs.items()}
    x = rng.integers(97, 103, (6, 5)).astype(np.int16)
    aim = rng.normal(size=(6, 5, 4))
    loss = lambda: float((layer.run(x) * aim).sum())
    _, found = language_id._back_through_time(layer, x, aim)
    for name, table, at in (("iz", layer.inputs["z"], (98, 1)), ("in", layer.inputs["n"], (99, 2)), ("sr", layer.states["r"], (0, 3)), ("sn", layer.states["n"], (2, 1))):
        old, step = table[at], 1e-2
        table[at] = old + step
        up = loss()
        table[at] = old - step
        down = loss()
        table[at] = old
        assert found[name][at] == pytest.approx((up - down) / (2 * step), rel=0.03, abs=2e-3)


def test_windows_and_padding_do_not_change_states():
    rng = np.random.default_rng(1)
    net = language_id.Network(["a", "b"], language_id.Direction.random(8, rng), language_id.Direction.random(8, rng), rng.normal(size=(17, 2)).astype("f4"))
    whole = language_id.windows_of(b"abcdefgh", 8)
    padded = language_id.windows_of(b"abcdefgh", 16)
    a, b = (net.position_sums(np.ascontiguousarray(x.T).astype(np.intp)) for x in (whole, padded))
    assert np.allclose(a, b, atol=1e-4) and a.sum() == pytest.approx(8, abs=1e-3)
    score = language_id.scorer(net, at_once=4)
    names, values = score(["x" * n for n in (1, 16, 17, 127, 128, 129, 1000)] + [None, ""])
    assert len(names) == 9 and (values[:7] > 0.4).all()


def test_languages_are_found(spark, small, folder):
    found = language_id.op10_language_id(spark, folder(documents=small)).collect()
    lang = {r["doc_id"]: r["lang"] for r in small.collect()}
    held = [r for r in found if r["held_out"] and r["lang_pred"] != "und"]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.9


def test_every_language_is_learned_from_windows(spark, monkeypatch):
    """More languages than 64, some of a single row; what comes to the driver are windows and no whole texts."""
    seen = []
    monkeypatch.setattr(language_id, "train", lambda texts, langs: seen.append((texts, langs)))
    rows = [(40 * k + i, f"w{k} " * 2_000, f"l{k:02}") for k in range(70) for i in range(4 if k < 60 else 1)]
    rows = [r for r in rows if brute.remainder(r[0], 4) != 2] + [(9_999, "no language", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language_id.fit(df.repartition(5), sample_per_language=2)
    texts, langs = seen[0]
    assert set(langs) == {r[2] for r in rows[:-1]} and len(set(langs)) > 64
    assert max(map(len, texts)) <= language_id.TRAINED_WIDTH
    assert min(langs.count(x) for x in set(langs)) >= language_id.WINDOWS_EACH // 2
    assert language_id.steps_for(4) == 500 and language_id.steps_for(640) * language_id.BATCH >= 640 * language_id.WINDOWS_EACH


def test_language_of_odd_rows(spark, odd, empty, folder, monkeypatch):
    monkeypatch.setattr(language_id, "train", lambda texts, langs: _plain_train(texts, langs, steps=20))
    rows = {r["doc_id"]: r for r in language_id.op10_language_id(spark, folder(documents=odd)).collect()}
    for i in (0, 1, 2, 5):
        assert rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0
    assert rows[6]["lang_pred"] in ("en", "de") and 0 < rows[6]["score"] <= 1
    kept = language_id.stage(spark, odd, "")
    assert kept.columns == odd.columns and not {0, 1, 2, 5} & {r["doc_id"] for r in kept.collect()}
    assert language_id.op10_language_id(spark, folder(documents=empty)).collect() == []
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.op10_language_id(spark, folder(documents=unlabelled)).collect()} == {"und"}


_plain_train = language_id.train


# ---- scores


def test_counts_and_base_scores(odd, small):
    for df in (odd, small):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        order = lambda r: (str(r[0]), r[1], r[2], round(r[4], 6))
        wanted = sorted(brute.token_counts(rows), key=order)
        got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"], r["bits_per_byte"]) for r in context_mixing.score(df).collect()), key=order)
        assert [w[:4] for w in wanted] == [g[:4] for g in got]
        for w, g in zip(wanted, got, strict=True):
            assert g[4] == pytest.approx(w[4], rel=1e-9)
            assert g[5] < 0 < g[6]


def test_scores_of_no_rows_and_no_training(spark, empty):
    assert context_mixing.score(empty).collect() == []
    held = [i for i in range(100) if brute.remainder(i, 5) == 1][:5]
    df = spark.createDataFrame([(i, "some words here") for i in held], "doc_id long, text string")
    rows = context_mixing.score(df).collect()
    assert [r["n_known"] for r in rows] == [0] * 5 and all(r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in rows)


def test_spelling_is_a_distribution():
    """Over the first byte of a token, then the second: probabilities of all 256 continuations sum to 1."""
    rng = np.random.default_rng(2)
    shape = (context_mixing.MODELS, context_mixing.SLOTS)
    zeros, ones = rng.poisson(1, shape).astype("f4"), rng.poisson(1, shape).astype("f4")
    model = context_mixing.Model(context_mixing.logits(zeros, ones), context_mixing.levels(zeros + ones), context_mixing.Mixer.fresh())
    # A token's code ends with a blank: a token of one byte has that byte and the blank.
    total = 0.0
    for byte in range(256):
        data, place, contexts, _ = context_mixing.positions([bytes([byte])], np.zeros(1, np.int64))
        p = 1.0
        for bit in range(8):
            where, value = context_mixing.slots(contexts[:, :1], data[:1], bit)
            q, _ = model.mixer.predict(np.take_along_axis(model.logits, where, 1), np.take_along_axis(model.levels, where, 1), bit, place[:1])
            p *= q[0] if value[0] else 1 - q[0]
        total += p
    assert total == pytest.approx(1, rel=1e-6)


def test_document_adaptation_agrees_with_coding_in_turn():
    value = np.log10(np.array([0.2, 0.05, 0.001]))
    times = np.array([3, 1, 2])
    got = context_mixing.adaptive(value, times, np.array([0]))[0]
    options = [float((times * value).sum())]
    for a in context_mixing.INERTIA:
        seen, total, done = [0, 0, 0], 0.0, 0
        for w in (0, 2, 0, 1, 2, 0):
            total += math.log10((seen[w] + a * 10 ** value[w]) / (done + a))
            seen[w] += 1
            done += 1
        options.append(total)
    assert got == pytest.approx(math.log10(sum(10**o for o in options) / 4), rel=1e-9)


def test_repeated_text_scores_better_than_the_base(spark):
    rng = random.Random(6)
    vocabulary = [sentence(rng, 1) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary[:150] if i % 2 else vocabulary[150:]) for _ in range(60))) for i in range(400)]
    out = context_mixing.score(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").agg(F.sum("score"), F.sum("base_score")).head()
    assert out[0] > out[1]


def test_decisions_are_a_distribution():
    """Over being unknown and all cells of known tokens, in every kind, also in those without a training token."""
    rng = np.random.default_rng(4)
    kind, cell = rng.integers(0, 5, 900), rng.integers(0, context_mixing.CELLS, 900)
    n = rng.integers(1, 40, 900)
    tree = context_mixing.Tree.of(kind, cell, n, np.ones(900, np.int64), (n == 1).astype(np.int64))
    assert tree.nodes[1, 1] == n.sum() and (tree.nodes[2:, 1] == np.bincount(kind, n, context_mixing.KINDS)).all()
    mixer = context_mixing.train_decisions(tree, kind, cell, n, n)
    decided = context_mixing.Decided.of(tree, mixer)
    assert 10**decided.unknown + (10 ** decided.cells.astype(float)).sum(axis=1) == pytest.approx(1, rel=1e-4)
    assert decided.sizes.sum() == n.sum()


def test_known_tokens_are_coded_by_the_mixer(spark, monkeypatch):
    """Without what the mixer says, documents of known tokens alone have other scores; counts and base scores stay."""
    words = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join(words[(i * k) % 50] for k in range(1, 30))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    asked = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    mixed = [tuple(r) for r in context_mixing.score(df).where("n_known = n_tokens").select(*asked).orderBy("doc_id").collect()]
    plain = context_mixing.Mixer.predict
    monkeypatch.setattr(context_mixing.Mixer, "predict", lambda *a: (np.full(a[2].shape[1], 0.5), plain(*a)[1]))
    even = [tuple(r) for r in context_mixing.score(df).where("n_known = n_tokens").select(*asked).orderBy("doc_id").collect()]
    assert len(mixed) > 100 and [r[:4] for r in mixed] == [r[:4] for r in even]
    assert [r[4] for r in mixed] == pytest.approx([r[4] for r in even])
    assert sum(r[5] for r in mixed) > sum(r[5] for r in even) + 100


def test_decisions_learn_from_every_training_token(monkeypatch):
    """The batches of a pass hold all tokens of all cells, each by its number, however many there are."""
    kind, cell = np.divmod(np.arange(0, 3 * context_mixing.CELLS, 3), context_mixing.CELLS)
    n = np.where(cell % 1000 == 0, 5_000, 1 + cell % 5)
    once = ((n == 1) & (cell % 2 == 0)).astype(np.int64)
    groups = pa.table({"kind": kind, "cell": cell, "n": n, "words": np.ones_like(n), "once": once, "alone": (n == 1).astype(np.int64)})
    seen = np.zeros((context_mixing.DEPTH + 1, len(n)))
    place = {x: i for i, x in enumerate(zip(kind.tolist(), cell.tolist(), strict=True))}
    counts, learn, now = context_mixing.Tree.counts, context_mixing.Mixer.learn, []

    def counted(self, depth, of_kind, of_cell):
        now[:] = [depth, of_kind, of_cell]
        return counted.plain(self, depth, of_kind, of_cell)

    def learned(self, state, value, rate, squares, weight=1.0):
        depth, of_kind, of_cell = now
        if depth == context_mixing.DEPTH:
            np.add.at(seen[depth], [place[x] for x in zip(of_kind.tolist(), of_cell.tolist(), strict=True)], weight)
        seen[0, 0] += np.sum(weight) * (depth == 0)
        learn(self, state, value, rate, squares, weight)

    counted.plain = counts
    monkeypatch.setattr(context_mixing.Tree, "counts", counted)
    monkeypatch.setattr(context_mixing.Mixer, "learn", learned)
    context_mixing.fit_decisions(groups)
    one = seen[0, 0] / n.sum()
    assert seen[context_mixing.DEPTH] / one == pytest.approx(n - once)


def test_a_block_takes_little_more_than_its_words_and_references():
    """Making its row needs no sorted copies of all references in long numbers; the row is what sorting gives."""
    rng = np.random.default_rng(2)
    kinds = context_mixing.Kinds(np.zeros(context_mixing.KINDS), np.log(rng.random((context_mixing.KINDS, context_mixing.HISTOGRAM))))
    block = context_mixing.Block(0)
    for i in range(400):
        block.add(i, i % 5 == 0, " ".join(f"w{x}" for x in rng.integers(0, 20_000, 4_000)), kinds)
    references = block.docs["ends"][-1]
    tracemalloc.start()
    row = block.row()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * references
    got = {name: row.column(name)[0].values.to_numpy(zero_copy_only=False) for name in row.schema.names if name != "block"}
    lengths = np.diff([0, *block.docs["ends"]])
    both = np.repeat(np.array(block.docs["doc_kinds"], np.int64) << 32, lengths) | np.concatenate(block.docs["places"])
    pairs, places = np.unique(both, return_inverse=True)
    words = list(block.words)
    assert got["tokens"].tolist() == [words[i] for i in pairs & 0xFFFFFFFF] and (got["kinds"] == pairs >> 32).all()
    assert (np.cumsum(got["places"]) == places).all()
    counted = np.bincount(places, np.where(np.repeat(block.docs["held"], lengths), 0, got["times"]), len(pairs))
    assert (got["counts"] == counted).all()
    ends = got["ends"].astype(np.int64)
    found = list(context_mixing.shares(ends, 50_000))
    assert [x.start for x in found[1:]] == [x.stop for x in found[:-1]] and (found[0].start, found[-1].stop) == (0, 400)
    assert max(ends[x.stop - 1] - (ends[x.start - 1] if x.start else 0) for x in found) <= 50_000

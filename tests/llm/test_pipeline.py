"""The pipeline's stages follow each other and their decisions take effect."""

from collections import Counter

import brute
import corpus_pipeline
import pytest
from test_dedup_operators import plain_lines
from test_packing_and_mixing import check_packing

from mediatide.llm import language_id, source_mixing
from mediatide.llm.common import store

_train = language_id.train


def test_stages_in_turn(spark, small, monkeypatch):
    monkeypatch.setattr(language_id, "train", lambda texts, langs: _train(texts, langs, steps=120))
    docs, seen = small, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        assert docs.columns == small.columns, name
        seen.append([tuple(r) for r in docs.select("doc_id", "text", "source").collect()])
    languages, lines, unique, mixed = seen
    all_rows = {r["doc_id"]: r["text"] for r in small.collect()}
    assert all(any(c.isalpha() for c in t) for _, t, _ in languages)
    assert len(languages) >= 0.95 * sum(any(c.isalpha() for c in t or "") for t in all_rows.values())
    assert sorted((i, t) for i, t, _ in lines) == sorted((i, t) for i, _, _, t in plain_lines([(i, t) for i, t, _ in languages]))
    groups = brute.near_documents([(i, t) for i, t, _ in lines], 5)
    assert sorted(i for i, _, _ in unique) == sorted(i for i, (_, _, kept) in groups.items() if kept)
    copies = Counter(i for i, _, _ in mixed)
    assert max(copies.values()) <= 2
    sizes = Counter()
    for _, t, s in unique:
        sizes[s] += len(brute.words(t))
    wanted, taken = brute.source_targets(dict(sizes)), Counter()
    for _, t, s in mixed:
        taken[s] += len(brute.words(t))
    longest = max(len(brute.words(t)) for _, t, _ in unique)
    assert all(abs(taken[s] - wanted[s]) <= longest + 1 for s in sizes)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").collect()
    check_packing(packed, [(i, t) for i, t, _ in mixed])


def test_stages_take_odd_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(language_id, "train", lambda texts, langs: _train(texts, langs, steps=10))
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, ""), "stage")
    assert docs.count() > 0


def test_stages_take_an_empty_table(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, ""), "stage")
    assert docs.count() == 0


def test_stage_functions_are_the_registered_ones():
    assert corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "language identification"
    assert source_mixing.stage in [f for _, f in corpus_pipeline.STAGES]
    with pytest.raises(TypeError):
        corpus_pipeline.run()

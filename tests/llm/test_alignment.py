"""Alignment of two tokenizers against whole texts encoded and compared byte by byte."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from mediatide.llm import token_alignment
from mediatide.llm.common import byte_letters
from mediatide.llm.token_alignment import aligned, op12_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    """doc_id and the digest columns of each row, in the rows' order."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = byte_letters()
    found, counts = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        codes = a.encode(" " + (text or ""), add_special_tokens=False)
        ids = b.encode(text or "")
        a_tokens = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in codes.ids]
        pieces = [b.id_to_piece(i) for i in ids]
        b_tokens = [
            (i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(ids, pieces, strict=True)
        ]
        if not text or b"".join(x for _, x in a_tokens) != whole or b"".join(x for _, x in b_tokens) != whole:
            found.append((doc_id, 0, 0, [], []))
            continue
        spans = []
        for tokens in (a_tokens, b_tokens):
            at, out = 0, []
            for i, x in tokens:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        by_byte = defaultdict(list)
        for j, (_, s, e) in enumerate(spans[1]):
            for x in range(s, e):
                by_byte[x].append(j)
        links = []
        for i, s, e in spans[0]:
            links += [(i, spans[1][j][0]) for j in sorted({j for x in range(s, e) for j in by_byte[x]})]
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, start = [], 0
        for cut in cuts:
            sides = [",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in spans]
            groups.append("|".join(sides))
            start = cut
        counts.update(set(links))
        found.append((doc_id, len(a_tokens), len(b_tokens), groups, links))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    return [
        (i, n_a, n_b, len(g), len(links), sum(counts[x] == highest[x[0]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, n_a, n_b, g, links in found
    ]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


TRICKY = [
    " leading", "trailing ", "two  spaces and   three", "tab\tand\nline", " \n mixed \n white", "a b c d", "no_space_at_all" * 50,
    "<|endoftext|> <s> </s> <0x41>", "▁ piece mark", "é̈ ﬁ ½ naïve", "日本語のテキスト です", "🙂 👩‍👩‍👧 x", "it's we'll 'd", "\x00 nul \x01", "a \x1c b", " ", "  ",
    "x" * 30000, "word " * 400,
]


@pytest.mark.parametrize("most", [token_alignment.MOST_FREQUENT, 50, 0])
def test_against_whole_texts(spark, odd, small, most):
    tricky = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(tricky).union(small.select("doc_id", "text").where("doc_id < 60")).repartition(3)
    wanted = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert in_order(aligned(docs, A, B, most).collect()) == in_order(wanted)


def test_small_caches_and_parts(spark, small, monkeypatch):
    texts = [r["text"] for r in small.limit(40).collect()] + TRICKY
    v = token_alignment.vocabularies(A, B)
    large = token_alignment.Segments(v)
    monkeypatch.setattr(token_alignment, "WORD_BYTES", 20_000)
    monkeypatch.setattr(token_alignment, "CHARS_AT_ONCE", 500)
    tight = token_alignment.Segments(v)
    assert [repr(x) for x in tight.of(texts)] == [repr(x) for x in large.of(texts)]
    assert tight.held <= 10_000 and len(tight.older) < len(large)


def test_extra_columns_and_empty_table(spark, odd, empty):
    assert aligned(empty, A, B).collect() == []
    out = aligned(odd, A, B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert out.count() == odd.count()


def test_query_reads_the_whole_table(spark, folder, odd):
    path = folder(documents=odd)
    assert in_order(op12_token_alignment(spark, path).collect()) == in_order(aligned(odd, A, B).collect())

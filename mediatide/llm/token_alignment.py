"""Alignment of two tokenizers' vocabularies over a corpus, with an identity-map fast path.

Every text is encoded by a byte-level BPE (A) and by a sentencepiece model (B), over the same bytes: a space and the
text.  Where a token of A and one of B end at the same byte a group ends.  Tokens whose byte ranges overlap are linked, and a
pair of ids counts the documents that hold it linked.

The identity map gives for every id of A the id of B with the same bytes.  Links along the map, nearly all of them groups of one
token on each side, are counted in a vector of the length of A's vocabulary; only the other links, from irregular groups,
become (pair, documents) rows, summed in each task before they are shuffled.  Texts are encoded once; their distinct links are
stored and get their counts afterwards: those along the map and those of the most frequent pairs (at most `most_frequent` of
them, so the broadcast is bounded) are looked up in the task, links of rarer pairs are joined with the table of counts.  A rare
pair is in few documents by definition, so that no key of that join is hot.

What stands between two single spaces is encoded on its own and kept: A begins a new word at a single space, and no piece of B
holds a space after another character (checked for the model; else whole texts are encoded).  Spaces beside other white space do not
divide.  A's own merges are applied by tiktoken where the file is of its kind (merges in the order of ids, the usual
pattern), which is five times as fast; else, and for very long words, by tokenizers.

Defined results: null and empty texts, and texts that one of the two does not give back byte by byte, have no tokens: zeros and an
empty digest.  Very long texts are handled whole, in parts; repeated rows are documents of their own; rows without
doc_id count like others; ties for the highest count are all counted as highest.  Only doc_id and text are read.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain, compress
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.llm.common import RecentCache, byte_letters, prepare, store, table

#: Frequent pairs whose counts every task holds: 16 bytes each.
MOST_FREQUENT = 1 << 19
#: Bytes of kept words in a worker, characters of texts handled at once, pairs kept in a task before they are handed on.
WORD_BYTES, CHARS_AT_ONCE, PAIRS_AT_ONCE = 64 << 20, 1 << 20, 1 << 20

#: Words given to the sentencepiece model at once, and the longest that go with others.
PER_CALL, LONG_WORD = 200, 400

_DIVISION = re.compile(r"(?<=\S)(?= \S)")


class Vocabularies:
    """Both tokenizers, the bytes of their ids, and the map from ids of A to the ids of B with the same bytes."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor

        self.a_path, self.b = a_path, SentencePieceProcessor(model_file=b_path)
        file = json.loads(Path(a_path).read_text(encoding="utf-8"))
        letters = byte_letters()
        vocabulary = {t["content"]: t["id"] for t in file["added_tokens"]} | file["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode("utf-8")
        self.fast = self._fast(file, {t["id"] for t in file["added_tokens"]})
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
            for i, p in enumerate(pieces)
        ]
        plain = {x: i for i, x in reversed(list(enumerate(self.b_bytes))) if not (self.b.is_byte(i) or self.b.is_control(i))}
        bytes_only = {x: i for i, x in enumerate(self.b_bytes) if self.b.is_byte(i)}
        self.same = np.array([plain.get(x, bytes_only.get(x, -1)) for x in self.a_bytes], np.int64)
        self.divisible = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_length = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_length = np.array(list(map(len, self.b_bytes)), np.int64)
        # A token is followed by a comma, or by what ends its side of the group.
        a_ids, b_ids = range(len(self.a_bytes)), range(len(self.b_bytes))
        self.spellings = [b"%d%c" % (i, c) for ids, marks in ((a_ids, b",|"), (b_ids, b",;")) for c in marks for i in ids]
        self.spelling_length = np.array(list(map(len, self.spellings)), np.int64)

    def _fast(self, file: dict, added: set[int]):
        """A tiktoken encoding with the same merges, if the file is of that kind."""
        import public_tokenizers
        import tiktoken

        model, before = file["model"], file["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in merges]
        usual = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        if file["normalizer"] or not usual or ids != sorted(ids) or len(model["vocab"]) - len(set(ids)) - len(added) > 256:
            return None
        ranks = {x: i for i, x in enumerate(self.a_bytes) if i not in added}
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def a(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.a_path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for texts that neither begin nor end with white space, a space before each; None where bytes are not given back."""
        parts = [" ".join(texts[i : i + PER_CALL]) for i in range(0, len(texts), PER_CALL)]
        whole = " " + " ".join(texts)
        a_ids = self.fast.encode_ordinary(whole) if self.fast else self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids
        b_ids = list(chain.from_iterable(self.b.encode(parts, num_threads=1)))
        return self._checked(whole, a_ids, b_ids)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a space and the text; None where the bytes are not given back."""
        a_ids = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        return self._checked(" " + text, a_ids, self.b.encode(text, num_threads=1))

    def _checked(self, whole: str, a_ids: list[int], b_ids: list[int]) -> tuple[np.ndarray, np.ndarray] | None:
        wanted = whole.encode("utf-8")
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != wanted or b"".join(map(self.b_bytes.__getitem__, b_ids)) != wanted:
            return None
        return np.array(a_ids, np.int64), np.array(b_ids, np.int64)


@lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabularies(a_path, b_path)


ODD, BROKEN = 1, 2
HALF, FLAGS = 31, 61
#: Codes below this one stand for a link along the identity map, by the id of A alone.
OTHERS = 1 << 32


class Aligned:
    """Stretches of text one after the other: their tokens, groups and links, all as arrays; `flags` by stretch."""

    def __init__(self, v: Vocabularies, keys: list[str]):
        self.v = v
        # White space at an end, so that the space before or behind does not divide.
        odd = [not k or k.strip() != k for k in keys]
        plain, alone = keys, []
        if not v.divisible or any(odd) or max(map(len, keys)) > LONG_WORD:
            fit = [v.divisible and not o and len(k) <= LONG_WORD for k, o in zip(keys, odd, strict=True)]
            plain, alone = ([k for k, f in zip(keys, fit, strict=True) if f == wanted] for wanted in (True, False))
        joint = v.encode_many(plain) if plain else None
        if joint is None:
            plain, alone = [], keys
        self.keys = plain + alone if alone else keys
        odd_of = set(compress(keys, odd))
        flags, parts = [ODD * (k in odd_of) for k in self.keys], [joint] if plain else []
        lengths = [1 + n for n in map(len, plain if "".join(plain).isascii() else [k.encode("utf-8") for k in plain])]
        for i, key in enumerate(alone, len(plain)):
            ids = v.encode(key)
            if ids is None:
                flags[i] |= BROKEN
            else:
                parts.append(ids)
            lengths.append(0 if ids is None else 1 + len(key.encode("utf-8")))
        none = [np.empty(0, np.int64)]
        self.flags = flags
        self.a, self.b = np.concatenate([p[0] for p in parts] or none), np.concatenate([p[1] for p in parts] or none)
        a_end, b_end, ends = np.cumsum(v.a_length[self.a]), np.cumsum(v.b_length[self.b]), np.cumsum(lengths)
        # Between two neighbouring ends exactly one token of A and one of B overlap: a link.
        cuts = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        cuts = cuts[np.concatenate([cuts[1:] != cuts[:-1], [True]])] if len(cuts) else cuts
        a_at, b_at = np.searchsorted(a_end, cuts), np.searchsorted(b_end, cuts)
        closing = (a_end[a_at] == cuts) & (b_end[b_at] == cuts)
        a, b = self.a[a_at], self.b[b_at]
        self.codes = np.where(v.same[a] == b, a, (a + 1 << 32) | b)
        # How many tokens, links and groups there are up to the end of each stretch.
        self.a_to, self.b_to = np.searchsorted(a_end, ends, "right"), np.searchsorted(b_end, ends, "right")
        self.links_to = np.searchsorted(cuts, ends, "right")
        group_ends = cuts[closing]
        self.groups_to = np.searchsorted(group_ends, ends, "right")
        self._places = a_end, b_end, group_ends

    def each(self, up_to: np.ndarray) -> list[int]:
        return np.diff(up_to, prepend=0).tolist()

    def slices(self, values: bytes, up_to: np.ndarray, width: int = 1) -> list[bytes]:
        end = (up_to * width).tolist()
        return [values[i:j] for i, j in zip([0, *end], end, strict=False)]

    def spelled(self) -> list[bytes]:
        """The groups of each stretch as text, each with a ; behind it."""
        a_end, b_end, group_ends = self._places
        if not len(group_ends):
            return [b""] * len(self.keys)
        a_group, b_group = np.searchsorted(group_ends, a_end), np.searchsorted(group_ends, b_end)
        groups = np.arange(len(group_ends))
        # In the text the tokens of A of a group stand before those of B.
        place = np.empty(len(a_end) + len(b_end), np.int64)
        a_kind = self.a + len(self.v.a_bytes) * (group_ends[a_group] == a_end)
        place[np.arange(len(a_end)) + np.searchsorted(b_group, groups)[a_group]] = a_kind
        b_kind = 2 * len(self.v.a_bytes) + self.b + len(self.v.b_bytes) * (group_ends[b_group] == b_end)
        place[np.arange(len(b_end)) + np.searchsorted(a_group, groups, "right")[b_group]] = b_kind
        text = b"".join(map(self.v.spellings.__getitem__, place.tolist()))
        return self.slices(text, np.concatenate([[0], np.cumsum(self.v.spelling_length[place])])[self.a_to + self.b_to])


class Segments(RecentCache):
    """What a stretch between two spaces adds to its document: its size, its groups as text, the codes of its links.

    The size has the tokens of A and of B as one number, so that one sum adds both; flags make it negative.
    """

    def __init__(self, v: Vocabularies):
        super().__init__(WORD_BYTES)
        self.v = v

    def weight(self, keys: list[str]) -> int:
        return 400 * len(keys) + 16 * sum(map(len, keys))

    def compute(self, keys: list[str]) -> list[tuple]:
        found = Aligned(self.v, keys)
        codes = found.slices(found.codes.tobytes(), found.links_to, 8)
        sizes = np.diff(found.a_to, prepend=0) << HALF | np.diff(found.b_to, prepend=0)
        values = list(zip((sizes - (np.array(found.flags) << FLAGS)).tolist(), found.spelled(), codes, strict=True))
        if found.keys is keys:
            return values
        by_key = dict(zip(found.keys, values, strict=True))
        return [by_key[k] for k in keys]

    def of(self, texts: list[str]) -> Iterator[tuple | None]:
        """Each text's tokens of A and of B, its groups as text (each with a ; behind it), its links; None for a text without tokens."""
        at, get = 0, self.__getitem__
        while at < len(texts):
            chosen, size = [], 0
            while at < len(texts) and (not chosen or size + len(texts[at]) < CHARS_AT_ONCE):
                chosen.append(texts[at].split(" ") if self.v.divisible else [texts[at]])
                size += len(texts[at])
                at += 1
            self.learn(chosen)
            found = [tuple(zip(*map(get, keys), strict=True)) for keys in chosen]
            odd = {}
            for i, (sizes, _, _) in enumerate(found):
                if min(sizes) < 0 and self.v.divisible and any(-(x >> FLAGS) & ODD for x in sizes):
                    # A space beside white space or at an end divides nothing: such texts are cut at the other spaces only.
                    odd[i] = [s[1:] for s in _DIVISION.split(" " + " ".join(chosen[i]))]
            self.learn(odd.values())
            for i, keys in odd.items():
                found[i] = tuple(zip(*map(get, keys), strict=True))
            for text, (sizes, groups, links) in zip(texts[at - len(chosen) : at], found, strict=True):
                if not text or (min(sizes) < 0 and any(-(x >> FLAGS) & BROKEN for x in sizes)):
                    yield None
                    continue
                tokens = sum(sizes) if min(sizes) >= 0 else sum(x & (1 << FLAGS) - 1 for x in sizes)
                yield tokens >> HALF, tokens & (1 << HALF) - 1, b"".join(groups), np.frombuffer(b"".join(links), np.int64)
            self.forget()


@lru_cache(maxsize=1)
def _segments(a_path: str, b_path: str) -> Segments:
    """Kept from task to task."""
    return Segments(vocabularies(a_path, b_path))


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    flat = np.concatenate([np.empty(0, kind), *parts]).astype(kind)
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, parts)], dtype=np.int32), pa.array(flat))


FIGURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _encoding(paths: tuple[str, str]):
    """Each document's figures and its distinct links, as codes with how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = _segments(*paths)
        nothing = np.empty(0, np.int64)
        for batch in batches:
            figures, digests, codes, links = [], [], [], []
            for known in segments.of([t or "" for t in batch.column("text").to_pylist()]):
                if known is None:
                    figures.append((0, 0, 0, 0))
                    digests.append("")
                    codes.append(nothing)
                    links.append(nothing)
                    continue
                n_a, n_b, groups, held = known
                found = np.sort(held)
                first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
                figures.append((n_a, n_b, groups.count(b";"), len(found)))
                digests.append(hashlib.sha256(groups[:-1]).hexdigest())
                codes.append(found[first])
                links.append(np.diff(first, append=len(found)))
            columns = [pa.array(x, pa.int64()) for x in zip(*figures, strict=True)] if figures else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(digests, pa.string()), _lists(codes, np.int64), _lists(links, np.int32)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "links"],
            )

    return run


def encoded(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """rid, doc_id, the figures, and the distinct links of every document; a stored table."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(_encoding((a_path, b_path)), f"doc_id long, {FIGURES}, codes array<long>, links array<int>")
    return store(rows.withColumn("rid", F.monotonically_increasing_id()), "links")


def _counting(size: int):
    """Rows (code, documents) of the task's documents: a vector for the links along the map, summed pairs for the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(size, np.int64)
        codes, counts, waiting, held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def rows(code, n):
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "documents"])

        def merged():
            every = np.concatenate([codes, *waiting])
            weight = np.concatenate([counts, np.ones(len(every) - len(codes), np.int64)])
            order = np.argsort(every, kind="stable")
            every, weight = every[order], weight[order]
            first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.empty(0, np.int64)
            return every[first], np.add.reduceat(weight, first) if len(first) else weight

        for batch in batches:
            found = batch.column("codes").flatten().to_numpy()
            along = found < OTHERS
            vector += np.bincount(found[along], minlength=size)
            waiting.append(found[~along])
            held += len(waiting[-1])
            if held > PAIRS_AT_ONCE:
                codes, counts = merged()
                waiting, held = [], 0
                if len(codes) > PAIRS_AT_ONCE:
                    yield rows(codes, counts)
                    codes, counts = codes[:0], counts[:0]
        codes, counts = merged()
        yield rows(codes, counts)
        used = np.flatnonzero(vector)
        yield rows(used, vector[used])

    return run


def link_counts(links: DataFrame, size: int) -> DataFrame:
    """code, documents.  A code is the id of A for a link along the identity map, else 1 and the id of A, shifted by 32, with the id of B."""
    return links.select("codes").mapInArrow(_counting(size), "code long, documents long").groupBy("code").agg(F.sum("documents").alias("documents"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """a, b, documents: in how many documents each pair of ids is linked."""
    v = vocabularies(a_path, b_path)
    counts = link_counts(encoded(docs, a_path, b_path), len(v.same))
    same = docs.sparkSession.createDataFrame([(i, int(b)) for i, b in enumerate(v.same)], "code long, same long")
    pair = F.when(F.col("code") < OTHERS, F.struct(F.col("code").alias("a"), F.col("same").alias("b"))).otherwise(
        F.struct((F.shiftright("code", 32) - 1).alias("a"), F.col("code").bitwiseAND(F.lit(OTHERS - 1)).alias("b"))
    )
    return counts.join(same, "code", "left").select(pair.alias("p"), "documents").select("p.a", "p.b", "documents")


def _scoring(known):
    """Each document's sums over the links that every task knows the counts of, and its links of rarer pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, best, frequent, counts = known.value
        for batch in batches:
            column = batch.column("codes")
            codes, links = column.flatten().to_numpy(), batch.column("links").flatten().to_numpy().astype(np.int64)
            ends = np.cumsum(column.value_lengths().to_numpy())
            along = codes < OTHERS
            a = np.where(along, codes, (codes >> 32) - 1)
            held, n = along.copy(), np.where(along, own[a * along], 0)
            if len(frequent):
                place = np.minimum(np.searchsorted(frequent, codes), len(frequent) - 1)
                hit = frequent[place] == codes
                held |= hit
                n[hit] = counts[place[hit]]
            total, highest, rare = (
                np.concatenate([[0], np.cumsum(x)])[ends] for x in (n * links, links * held * (n == best[a]), ~held)
            )
            sums = [pa.array(np.diff(x, prepend=0)) for x in (highest, total)]
            pairs = pa.StructArray.from_arrays([pa.array(codes[~held]), pa.array(links[~held])], ["code", "links"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], rare]).astype(np.int32)), pairs)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), *sums, lists], ["rid", "n_best", "count_sum", "rare"])

    return run


def frequent_from(others: DataFrame, most: int) -> int:
    """The documents from which on a pair off the identity map counts as frequent: at most `most` pairs do."""
    step = F.floor(4 * F.log2("documents")).cast("int").alias("step")
    # At most 4 steps for each of 63 bits.
    steps = sorted(others.groupBy(step).agg(F.count("*").alias("n"), F.min("documents").alias("from")).collect(), reverse=True)
    least, taken = 1 << 62, 0
    for row in steps:
        taken += row["n"]
        if taken > most:
            break
        least = row["from"]
    return least


def aligned(docs: DataFrame, a_path: str, b_path: str, most_frequent: int = MOST_FREQUENT) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    links = encoded(docs, a_path, b_path)
    size = len(vocabularies(a_path, b_path).same)
    counts = store(link_counts(links, size), "counts")
    along, others = counts.where(F.col("code") < OTHERS), counts.where(F.col("code") >= OTHERS)
    others = others.withColumn("a", F.shiftright("code", 32) - 1)
    highest = along.withColumnRenamed("code", "a").unionByName(others.select("a", "documents"))
    highest = store(highest.groupBy("a").agg(F.max("documents").alias("highest")), "highest")
    best, own = np.zeros(size, np.int64), np.zeros(size, np.int64)
    # Both are vectors of the length of A's vocabulary.
    for vector, rows in ((best, highest), (own, along)):
        found = rows.toArrow()
        vector[found.column(0).to_numpy()] = found.column(1).to_numpy()
    least = frequent_from(others, most_frequent)
    found = others.where(F.col("documents") >= least).select("code", "documents").toArrow()
    codes, n = found["code"].to_numpy(), found["documents"].to_numpy()
    order = np.argsort(codes)
    known = docs.sparkSession.sparkContext.broadcast((own, best, codes[order], n[order]))
    shape = "rid long, n_best long, count_sum long, rare array<struct<code: long, links: long>>"
    scored = store(links.select("rid", "codes", "links").mapInArrow(_scoring(known), shape), "scored")
    rare = others.where(F.col("documents") < least).join(highest, "a")
    rare = rare.select("code", "documents", (F.col("documents") == F.col("highest")).alias("top"))
    more = scored.select("rid", F.inline("rare")).join(rare, "code").select(
        "rid", F.when(F.col("top"), F.col("links")).otherwise(0).alias("n_best"), (F.col("links") * F.col("documents")).alias("count_sum")
    )
    sums = scored.drop("rare").unionByName(more).groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    figures = links.drop("codes", "links")
    return figures.join(sums, "rid").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path
    return aligned(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))

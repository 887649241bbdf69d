"""Packing of tokenised documents into sequences by bin completion.

Tokens are counted on the executors; only the histogram of piece lengths (at most capacity - 1 numbers) comes
to the driver.  There the classic bin completion runs on lengths with multiplicities: take the largest length
left, enumerate the undominated fillings of the rest of its bin (a filling is dominated by one with a larger
single piece in place of some of its pieces), repeat a filling as often as the counts allow, and prune a branch
when its waste exceeds what the incumbent leaves.  The first incumbent is best-fit decreasing; the search ends at
the lower bound or after `max_nodes` nodes, so that the plan is never worse than best-fit decreasing.
Pieces then find their place by their rank among the pieces of their length, in parallel.

Defined results: a null text is an empty document of the one end token; repeated rows and rows without doc_id are
packed as documents of their own; other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.llm.common import RecentCache, byte_letters, discard, prepare, salted_ranks, store, table

CAPACITY = 2048
END = b"\x00\x00\x00\x00"


#: Bytes of words whose ids one worker keeps, and words encoded in one call.
WORD_BYTES, WORDS_PER_CALL = 32 << 20, 2_000
#: Stands between words that are encoded together: a control character, which is a token of its own.
SEPARATOR = "\x1f"

_MARK = re.compile(rb"([a-z])([.,;:!?])(?=[ \n])")


#: A byte that UTF-8 never has stands for the end of a word in the merges.
END_OF_WORD = b"\xff"


def _plain(key: bytes) -> bool:
    word = key.decode("utf-8")
    return word.isalpha() and word == word.lower() and unicodedata.is_normalized("NFC", word)


def _merges(vocabulary: str):
    """The merges of the vocabulary as a function from a word's bytes, with its end, to ids; None if the file is of another kind.

    Ids must be the order of the merges, and each byte with the end of a word a token before all others that have it: then
    merging the last byte with the end comes first, and the rest follows in the order of ids.
    """
    import tiktoken

    model = json.loads(Path(vocabulary).read_text(encoding="utf-8"))["model"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"]["".join(m)] for m in merges]
    suffix = model["end_of_word_suffix"]
    letters = byte_letters()
    # The two special tokens are not of the model's merges.
    known = {t: i for t, i in model["vocab"].items() if all(c in letters for c in t.removesuffix(suffix or "</w>"))}
    singles = {i for t, i in known.items() if len(t.removesuffix(suffix or "</w>")) == 1}
    if suffix != "</w>" or ids != sorted(ids) or len(singles) != 512 or max(singles) >= min(ids) or sys.byteorder != "little":
        return None

    def as_bytes(token: str) -> bytes:
        letters_only = token.removesuffix(suffix)
        return bytes(letters[c] for c in letters_only) + (END_OF_WORD if token.endswith(suffix) and token != letters_only else b"")

    made = set(ids) | singles
    ranks = {as_bytes(t): i for t, i in known.items() if i in made}
    return tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class WordIds(RecentCache):
    """The ids, as bytes, of what stands between two blanks.

    The vocabulary's rules make every blank a boundary: white space separates words and is dropped, and
    neither lower-casing nor composition looks across it.  So the ids of a text are those of its words in a row, and
    many words can be encoded as one text and told apart by the token between them.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        super().__init__(WORD_BYTES)
        self.tokenizer = Tokenizer.from_file(vocabulary)
        between = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        self.merge = _merges(vocabulary)

    def weight(self, keys: list[bytes]) -> int:
        return 200 * len(keys) + 3 * sum(map(len, keys))

    def compute(self, keys: list[bytes]) -> list[bytes]:
        merge, out, rest = self.merge, [], []
        for key in keys:
            # A word of lower-case letters in composed form is one piece, for which only the merges are left to do.
            if merge is not None and (key.isalpha() or _plain(key)):
                ids = merge(key + END_OF_WORD)
                out.append(array("I", ids).tobytes())
            else:
                rest.append(key)
                out.append(None)
        if rest:
            others = iter(self._encoded(rest))
            out = [next(others) if ids is None else ids for ids in out]
        return out

    def _encoded(self, keys: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(keys), WORDS_PER_CALL):
            words = b"\n".join(keys[at : at + WORDS_PER_CALL]).decode("utf-8").split("\n")
            if self.between is None or any(SEPARATOR in w for w in words):
                coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
                out += [np.array(c.ids, "<u4").tobytes() for c in coded]
                continue
            joint = self.tokenizer.encode_batch_fast([f" {SEPARATOR} ".join(words)], add_special_tokens=False)[0].ids
            ids = np.array(joint, "<u4")
            ends = [*np.flatnonzero(ids == self.between).tolist(), len(ids)]
            held = ids.tobytes()
            out += [held[4 * begin : 4 * end] for begin, end in zip([0, *(e + 1 for e in ends)], ends, strict=False)]
        return out

    def ids(self, texts: list[str | None]) -> list[bytes]:
        # A-Z are folded by the vocabulary anyway, and one mark behind a letter is a token of its own.
        split = [_MARK.sub(rb"\1 \2 ", (t or "").encode("utf-8").lower()).split() for t in texts]
        self.learn(split)
        out = [b"".join(map(self.__getitem__, words)) for words in split]
        self.forget()
        return out


ROWS_AT_ONCE = 512


@lru_cache(maxsize=2)
def _word_ids(vocabulary: str) -> WordIds:
    return WordIds(vocabulary)


def _pieces(vocabulary: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = _word_ids(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows, piece, start, length, crc = [], [], [], [], []
                for row, ids in enumerate(known.ids(part.column("text").to_pylist())):
                    ids += END
                    for k, begin in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[begin : begin + 4 * capacity]
                        rows.append(row)
                        piece.append(k)
                        start.append(begin // 4)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int32())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces of at most `capacity` tokens."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_pieces(vocabulary, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")


# ---- planning on the histogram


@dataclass(frozen=True)
class Pattern:
    """`times` sequences that hold `sizes`, largest first."""

    sizes: tuple[int, ...]
    times: int


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Each length, from the largest, goes to the bins with the least room that fits, many equal bins at once."""
    bins: dict[tuple[int, ...], int] = {}
    room: dict[int, list[tuple[int, ...]]] = {}

    def put(sizes: tuple[int, ...], n: int) -> None:
        if sizes not in bins:
            room.setdefault(capacity - sum(sizes), []).append(sizes)
        bins[sizes] = bins.get(sizes, 0) + n

    for size in range(len(counts) - 1, 0, -1):
        left = int(counts[size])
        while left:
            fit = min((r for r, b in room.items() if r >= size and b), default=None)
            if fit is None:
                each = capacity // size
                if left >= each:
                    put((size,) * each, left // each)
                if left % each:
                    put((size,) * (left % each), 1)
                break
            sizes = room[fit][-1]
            n = min(left, bins[sizes])
            bins[sizes] -= n
            if not bins[sizes]:
                del bins[sizes]
                room[fit].pop()
            put((*sizes, size), n)
            left -= n
    return [Pattern(s, n) for s, n in bins.items()]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The larger of the total's bound and, over all thresholds t, bins of large pieces plus what t and above overflow."""
    sizes = np.arange(len(counts))
    best = -(-int((counts * sizes).sum()) // capacity)
    for t in range(1, capacity // 2 + 1):
        huge = int(counts[capacity - t + 1 :].sum())
        large = sizes[(sizes > capacity // 2) & (sizes <= capacity - t)]
        n_large = int(counts[large].sum())
        free = n_large * capacity - int((counts[large] * large).sum())
        small = sizes[(sizes >= t) & (sizes <= capacity // 2)]
        rest = int((counts[small] * small).sum()) - free
        best = max(best, huge + n_large + max(0, -(-rest // capacity)))
    return best


def fillings(counts: np.ndarray, room: int, width: int) -> list[tuple[int, ...]]:
    """Undominated fillings of `room`, the least waste and then the largest pieces first; at most `width`.

    A single piece of exactly the room dominates all else.  Fillings of k pieces count only if they leave
    less than the best of fewer pieces does: each exchange of pieces for a larger one is dominance.
    """
    sizes = np.flatnonzero(counts[: room + 1])
    if not len(sizes):
        return [()]
    below = np.zeros(room + 1, np.int64)
    below[sizes] = sizes
    np.maximum.accumulate(below, out=below)

    def grow(chosen: tuple[int, ...], rest: int, most: int) -> tuple[int, ...]:
        """Best fit: the largest piece that still fits, again and again."""
        used: dict[int, int] = {}
        for c in chosen:
            used[c] = used.get(c, 0) + 1
        while rest > 0:
            x = int(below[min(rest, most)])
            while x > 0 and counts[x] <= used.get(x, 0):
                x = int(below[x - 1])
            if x <= 0:
                break
            n = min(rest // x, int(counts[x]) - used.get(x, 0))
            chosen += (x,) * n
            used[x] = used.get(x, 0) + n
            rest -= n * x
            most = x
        return chosen

    single = int(below[room])
    found = {grow((single,), room - single, single)}
    if single < room:
        for first in sizes[::-1][: 64 * width]:
            first = int(first)
            if counts[first] and first < room:
                second = int(below[min(room - first, first)])
                if second == first and counts[first] < 2:
                    second = int(below[first - 1])
                if second > 0:
                    found.add(grow((first, second), room - first - second, second))
                    if first + second == room and len(found) >= width:
                        break
        if all(sum(f) < room for f in found):
            # Three and more pieces: for each pair of the largest, the piece that fits best below.
            for first in sizes[::-1][:width]:
                for second in sizes[::-1][: 16 * width]:
                    if second <= first and first + second < room:
                        if first == second and counts[first] < 2:
                            continue
                        chosen = grow((int(first), int(second)), room - int(first) - int(second), int(second))
                        found.add(chosen)
                        if sum(chosen) == room:
                            break
    return sorted(found, key=lambda f: (room - sum(f), tuple(-x for x in f)))[:width]


def complete_bins(counts: np.ndarray, capacity: int = CAPACITY, width: int = 8, max_nodes: int = 20_000) -> list[Pattern]:
    """Patterns that hold counts[size] pieces of every size, in as few bins as the search finds."""
    counts = np.asarray(counts, np.int64).copy()
    total = int((counts * np.arange(len(counts))).sum())
    best = best_fit_decreasing(counts, capacity)
    fewest = sum(p.times for p in best)
    bound = lower_bound(counts, capacity)
    nodes = 0
    # Each level: the fillings still to try, and what has been taken to get below.
    path: list[Pattern] = []
    used, waste = 0, 0
    levels: list[list[tuple[tuple[int, ...], int]]] = []

    def choices() -> list[tuple[tuple[int, ...], int]]:
        top = int(np.flatnonzero(counts)[-1])
        counts[top] -= 1
        found = fillings(counts, capacity - top, width)
        counts[top] += 1
        out = []
        for rest in found:
            sizes = (top, *rest)
            need: dict[int, int] = {}
            for x in sizes:
                need[x] = need.get(x, 0) + 1
            times = min(int(counts[x]) // n for x, n in need.items())
            out.append((sizes, times))
            if times > 1:
                out.append((sizes, 1))
        out.sort(key=lambda c: (capacity - sum(c[0]), -c[1]))
        return out[::-1]

    if not counts.any():
        return []
    levels.append(choices())
    while levels and fewest > bound and nodes < max_nodes:
        if not levels[-1]:
            levels.pop()
            if path:
                last = path.pop()
                used -= last.times
                waste -= last.times * (capacity - sum(last.sizes))
                for x in last.sizes:
                    counts[x] += last.times
            continue
        sizes, times = levels[-1].pop()
        nodes += 1
        lost = waste + times * (capacity - sum(sizes))
        # With this waste, fewer bins than the incumbent must still be possible.
        if -(-(total + lost) // capacity) >= fewest:
            continue
        path.append(Pattern(sizes, times))
        used, waste = used + times, lost
        for x in sizes:
            counts[x] -= times
        if counts.any():
            levels.append(choices())
        else:
            if used < fewest:
                best, fewest = list(path), used
            levels.append([])
    return best


def assignments(plan: list[Pattern]) -> dict[str, np.ndarray]:
    """For ranges of ranks within a length: the first sequence, how many of the length each holds, and their offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for p in plan:
        offset, i = 0, 0
        while i < len(p.sizes):
            size = p.sizes[i]
            each = sum(1 for x in p.sizes[i:] if x == size)
            rows.append((size, taken.get(size, 0), sequence, each, offset))
            taken[size] = taken.get(size, 0) + p.times * each
            offset += size * each
            i += each
        sequence += p.times
    rows.sort()
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    names = ("size", "rank", "sequence", "each", "offset")
    return {n: np.array(c, np.int64) for n, c in zip(names, columns, strict=True)}


def _place(plan: dict[str, np.ndarray]):
    shift = np.int64(1 << 44)
    starts = plan["size"] * shift + plan["rank"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            at = np.searchsorted(starts, f["length"].to_numpy() * shift + f["rank"].to_numpy(), "right") - 1
            within = f["rank"].to_numpy() - plan["rank"][at]
            f["sequence_id"] = plan["sequence"][at] + within // plan["each"][at]
            f["offset"] = plan["offset"][at] + within % plan["each"][at] * f["length"].to_numpy()
            yield f.drop(columns=["rank", "_order"])

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY, max_nodes: int = 20_000) -> DataFrame:
    """Adds sequence_id and offset to pieces; `cut` must be a stored table with doc_id, piece, length, ids_crc32."""
    counts = np.zeros(capacity, np.int64)
    for row in cut.where(F.col("length") < capacity).groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    plan = assignments(complete_bins(counts, capacity, max_nodes=max_nodes))
    full = cut.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    full = full.withColumn("offset", F.lit(0).cast("long"))
    if not counts.any():
        return full
    parts = cut.where(F.col("length") < capacity).withColumn("_order", F.xxhash64("doc_id", "piece", "ids_crc32"))
    ranked = salted_ranks(parts, ["length"], ["_order"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    columns = [*cut.columns, "_order", "rank"]
    placed = ranked.select(*columns).mapInPandas(_place(plan), f"{fields}, sequence_id long, offset long")
    return placed.unionByName(full)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, table(spark, sf_dir, "documents"), sf_dir)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents."""
    return pack(store(pieces(docs, default_vocabulary()), "pieces"))

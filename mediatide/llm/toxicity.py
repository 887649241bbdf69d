"""Toxicity by a support vector machine on a string subsequence kernel, with Nystroem landmarks.

The kernel compares two words (with marks for their ends) by their common subsequences of three characters, gaps
allowed: a subsequence that spans s characters counts DECAY^s, up to a span of MAX_SPAN.  So a word with a character inserted,
left out or put between others stays close to itself.  Landmarks are words of labelled sentences; the kernel to them, whitened
by their own kernel matrix, is the Nystroem feature map, on which a linear machine with hinge loss is trained.
The decision is linear in the weighted subsequences of a word, so it is evaluated by summing one table of
subsequences, without visiting the landmarks.

Labels are known for documents only, and one insult makes a toxic document.  So sentences carry the label of
their document, and training alternates: in each sentence of a toxic document the most suspicious words stand for it, all words
of clean sentences are negative.  A document's score is a logistic function, fitted on other labelled documents than the machine, of
its most suspicious words.

Besides words as they stand, letters with marks between them ("i.d.i.o.t") are read as one word, and so are runs of single letters.

Defined results: a null or empty text scores as a text without suspicious words; a document without label teaches
nothing; of several labels for one doc_id the largest counts; without any label, or with one class only, every score is the share of toxic labels (0 without any).
Rows that repeat are scored like any other.  Only doc_id and text are read.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.llm.common import prepare, split_of, table

DECAY = 0.6
MAX_SPAN = 5
#: Places of the second and third character after the first.
GAPS = [(j, k) for k in range(2, MAX_SPAN) for j in range(1, k)]
#: Longer strings without a blank are read in pieces that overlap by half.
PIECE = 32
CELLS = 1 << 20
THRESHOLD = 0.3
MAX_WORDS_KEPT = 300_000

_MARKED = re.compile(r"^(?:\w[^\w\s]+){2,}\w?[^\w\s]*$")
_OTHER = re.compile(r"[^\w]+")


def _cut(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - PIECE // 2, PIECE // 2)]


def words_of(text: str | None) -> set[str]:
    """Distinct words in lower case without marks at their ends or between letters, and spelled-out words."""
    if not text:
        return set()
    out = set()
    found = text.lower().split()
    for raw in set(found):
        if raw.isalnum():
            word = raw
        else:
            parts = _OTHER.split(raw)
            if len(parts) > 1 and not _MARKED.match(raw):
                out.update(x for p in parts if len(p) > 1 for x in _cut(p))
            word = "".join(parts)
        if len(word) > 1:
            out.update(_cut(word))
    # Single letters in a row, with or without marks after them.
    short = [i for i, w in enumerate(found) if len(w) <= 2 and w[0].isalpha() and not w[1:].isalnum()]
    run: list[int] = []
    for i in [*short, -2]:
        if run and i != run[-1] + 1:
            if len(run) >= 3:
                out.update(_cut("".join(found[j][0] for j in run)))
            run = []
        run.append(i)
    return out


#: Weight of a subsequence by its span, and of all of a word of each length: the scale of the word.
_WEIGHTS = np.array([DECAY ** (k + 1) for _, k in GAPS], np.float32)
_NORMS = np.array([1.0] + [np.sqrt(max(1e-12, sum(max(0, n - k) * DECAY ** (2 * k + 2) for _, k in GAPS))) for n in range(1, PIECE + 3)])


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each word, cells of its subsequences (0 where there is none) and their weights, both (words x many).

    Weights are scaled by the word's length, so that long words do not count for more.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max()) + 2
    codes = np.zeros((len(words), width + MAX_SPAN), np.uint64)
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(words)), lengths)
    codes[row, 1 + np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = letters
    codes[:, 0] = 2
    codes[np.arange(len(words)), lengths + 1] = 3
    cells = np.empty((len(words), len(GAPS), width), np.int32)
    first = codes[:, :width] * np.uint64(0x9E3779B97F4A7C15)
    for g, (j, k) in enumerate(GAPS):
        second, third = codes[:, j : width + j], codes[:, k : width + k]
        mixed = (first ^ (second * np.uint64(0xC2B2AE3D27D4EB4F))) + third * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        # The last character is there only if all three are.
        cells[:, g] = np.where(third > 0, (mixed >> np.uint64(44)) | np.uint64(1), np.uint64(0))
    scale = (1 / _NORMS[lengths + 2]).astype(np.float32)
    weights = np.broadcast_to(_WEIGHTS[None, :, None] * scale[:, None, None], cells.shape)
    weights = np.where(cells > 0, weights, np.float32(0))
    return cells.reshape(len(words), -1), weights.reshape(len(words), -1)


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """The kernel matrix of two lists of words."""
    cells_a, weights_a = subsequences(a)
    cells_b, weights_b = subsequences(b)
    used = np.unique(cells_b)
    place = np.full(CELLS, -1)
    place[used] = np.arange(len(used))
    dense = np.zeros((len(b), len(used)))
    np.add.at(dense, (np.arange(len(b))[:, None], place[cells_b]), weights_b)
    if place[0] >= 0:
        dense[:, place[0]] = 0
    out = np.zeros((len(a), len(b)))
    at = place[cells_a]
    for i in range(len(a)):
        hit = (at[i] >= 0) & (cells_a[i] > 0)
        out[i] = dense[:, at[i][hit]] @ weights_a[i][hit]
    return out


@dataclass
class Machine:
    """The decision by subsequence, and the logistic function of a document's largest and second largest word."""

    table: np.ndarray
    bias: float
    scale: np.ndarray

    def words(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(words), 2000):
            part = order[at : at + 2000]
            cells, weights = subsequences([words[i] for i in part])
            out[part] = np.einsum("ij,ij->i", self.table[cells], weights) + self.bias
        return out

    def probability(self, top: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(top @ self.scale[:2] + self.scale[2], -30, 30)))


#: The value of a text without words, and the floor of all.
FLOOR = -3.0


def top_two(values: np.ndarray) -> tuple[float, float]:
    """The two largest decisions above the floor."""
    if not len(values):
        return FLOOR, FLOOR
    if len(values) == 1:
        return max(FLOOR, float(values[0])), FLOOR
    two = np.partition(values, -2)[-2:]
    return max(FLOOR, float(two[1])), max(FLOOR, float(two[0]))


def _hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by gradient steps with momentum over all rows."""
    w, b = np.zeros(x.shape[1]), 0.0
    v, vb = np.zeros_like(w), 0.0
    total = weight.sum()
    rate = 1.0 / (2 * float((x * x).sum(axis=1).max() + 1) + ridge)
    for _ in range(epochs):
        slack = np.maximum(0, 1 - y * (x @ w + b)) * y * weight / total
        v = 0.9 * v + 2 * (x.T @ slack) - ridge * w
        vb = 0.9 * vb + 2 * slack.sum()
        w += rate * v
        b += rate * vb
    return w, b


def train(texts: list[str], toxic: np.ndarray, landmarks: int = 384, rounds: int = 4, seed: int = 5) -> Machine:
    """Alternates between choosing the words that make toxic documents toxic, and the machine."""
    rng = np.random.default_rng(seed)
    bags = [words_of(t) for t in texts]
    fit_on = rng.random(len(bags)) < 0.7
    n_pos, n_neg = max(1, int(toxic[fit_on].sum())), max(1, int((~toxic[fit_on]).sum()))
    seen: dict[str, list[int]] = {}
    for bag, t, use in zip(bags, toxic, fit_on, strict=True):
        if use:
            for w in bag:
                seen.setdefault(w, [0, 0])[int(t)] += 1
    words = sorted(seen)
    place = {w: i for i, w in enumerate(words)}
    clean, dirty = (np.array([seen[w][k] for w in words], float) for k in (0, 1))
    lift = np.log((dirty + 0.05) / (n_pos + 1)) - np.log((clean + 0.5) / (n_neg + 1))
    positives = [np.array(sorted(place[w] for w in bag)) for bag, t, use in zip(bags, toxic, fit_on, strict=True) if use and t and bag]
    # Landmarks: the words that lean most to either side, and others as they come.
    lead = np.argsort(-lift * np.log1p(dirty))[: landmarks // 2]
    rest = rng.choice(len(words), min(len(words), landmarks), replace=False, p=(clean + 0.1) ** 0.5 / ((clean + 0.1) ** 0.5).sum())
    chosen = list(dict.fromkeys([*lead, *rest]))[:landmarks]
    marks = [words[i] for i in chosen]
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    keep = values > 1e-6
    white = vectors[:, keep] / np.sqrt(values[keep])

    current = lift.copy()
    negatives = rng.choice(len(words), min(len(words), 6000), replace=False, p=(clean + 1e-9) / (clean + 1e-9).sum())
    machine = Machine(np.zeros(CELLS), 0.0, np.array([1.0, 0.0, 0.0]))
    cells, weights = subsequences(marks)
    for turn in range(rounds):
        votes = np.zeros(len(words))
        for bag in positives:
            best = bag[np.argsort(-current[bag])[:2]]
            votes[best[0]] += 1.0
            if len(best) > 1 and current[best[1]] > 0.8 * current[best[0]] > 0:
                votes[best[1]] += 1.0
        # The clean words that the machine finds most suspicious are negatives as well.
        hard = np.argsort(-np.where(clean > 0, current, -np.inf))[:2000]
        down = np.unique(np.concatenate([negatives, hard]))
        down = down[clean[down] > 0]
        up = np.flatnonzero((votes > 0) & (votes > clean * n_pos / n_neg))
        if not len(up) or not len(down):
            break
        rows = np.concatenate([up, down])
        y = np.concatenate([np.ones(len(up)), -np.ones(len(down))])
        weight = np.concatenate([votes[up] / votes[up].sum(), np.sqrt(clean[down]) / np.sqrt(clean[down]).sum() * 2])
        x = kernel([words[i] for i in rows], marks) @ white
        w, b = _hinge(x, y, weight, 1e-4, 1500, seed)
        alpha = white @ w
        machine.table[:] = 0
        np.add.at(machine.table, cells, weights * alpha[:, None])
        machine.table[0] = 0
        machine.bias = b
        decisions = machine.words(words)
        # Words that clean documents hold as often cannot be what makes a document toxic.
        current = decisions + 0.2 * np.clip(lift, -3, 3) if turn < rounds - 1 else decisions
    # The logistic function, on the documents kept apart.
    apart = np.flatnonzero(~fit_on)
    others = sorted(set().union(*(bags[i] for i in apart))) if len(apart) else []
    decision = dict(zip(others, machine.words(others), strict=True)) if others else {}
    top = np.array([top_two(np.array([decision[w] for w in bags[i]])) for i in apart]).reshape(-1, 2)
    machine.scale = _logistic(top, toxic[apart].astype(float))
    return machine


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton steps; both coefficients stay at 0 or more, so that a more suspicious word never lowers a score."""
    design = np.column_stack([x, np.ones(len(x))])
    out = np.array([1.0, 0.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ out, -30, 30)))
        gradient = design.T @ (y - p) - ridge * out
        curve = design.T @ (design * (p * (1 - p))[:, None]) + ridge * np.eye(3)
        step = np.linalg.solve(curve, gradient)
        out = out + np.clip(step, -2, 2)
        out[:2] = np.maximum(out[:2], 0)
        if np.abs(step).max() < 1e-8:
            break
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2500, most_chars: int = 8000) -> Machine | float:
    """Trains on a hashed sample of about `per_class` labelled texts of each class, at most twice that many.

    Texts for training have at most `most_chars` characters, so that what comes to the driver is bounded;
    scoring has no such bound.  With one class only the result is its share of toxic labels.
    """
    toxic = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    short = docs.where(~split_of(4, 2) & F.col("text").isNotNull() & (F.length("text") <= most_chars)).select("doc_id", "text")
    # Only ids meet the labels; the sampled ones, bounded in number, go to the texts.
    known = short.select("doc_id").join(toxic, "doc_id")
    counts = dict(known.groupBy((F.col("_toxic") > 0).alias("t")).count().collect())
    if len(counts) < 2:
        return float(bool(counts.get(True)))
    chance = (F.xxhash64("doc_id", F.lit(3)) % F.lit(1 << 30)).cast("double") / float(1 << 31) + 0.5
    wanted = F.when(F.col("_toxic") > 0, chance < per_class / counts[True]).otherwise(chance < per_class / counts[False])
    picked = known.where(wanted).distinct().limit(4 * per_class)
    sample = short.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "_toxic").limit(4 * per_class)
    rows = sorted(map(tuple, sample.collect()))
    labelled = np.array([r[2] > 0 for r in rows])
    if labelled.all() or not labelled.any():
        return float(labelled.mean()) if len(rows) else 0.0
    machine = train([r[1] for r in rows], labelled)
    # The sample has both classes alike; the probability is for the labels as they are.
    share = counts[True] / (counts[True] + counts[False])
    sampled = labelled.mean()
    machine.scale[2] += np.log(share / (1 - share)) - np.log(sampled / (1 - sampled))
    return machine


def score(docs: DataFrame, machine: Machine | float) -> DataFrame:
    """Adds the column `score`."""
    prepare(docs.sparkSession)
    if not isinstance(machine, Machine):
        return docs.withColumn("score", F.lit(machine))
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for texts in parts:
            out = []
            for at in range(0, len(texts), 256):
                bags = [words_of(t) for t in texts.iloc[at : at + 256]]
                new = [w for w in set().union(*bags) if w not in known]
                if new:
                    known.update(zip(new, shared.value.words(new).tolist(), strict=True))
                out += [top_two(np.fromiter(map(known.__getitem__, bag), float, len(bag))) for bag in bags]
                if len(known) > MAX_WORDS_KEPT:
                    known.clear()
            yield pd.Series(shared.value.probability(np.array(out).reshape(-1, 2)))

    return docs.withColumn("score", judge(F.col("text")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", split_of(4, 2).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))

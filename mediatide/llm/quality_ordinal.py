"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = logistic(threshold_k - weights . features), with one set of weights for all grades and ordered thresholds.  A text's
features are hashed words, word shapes, and marks for a word that repeats the one before it or an earlier line, as
log counts scaled to length 1.  Ratings come from the labels in three grades: 0 for poor quality, 1 for good quality
with toxic passages, 2 for good quality without.  The model gives each text its expected grade and the probability of
at least grade `least`, by which it is selected.

Defined results: a null or empty text has no features but the one for its size; of several labels for one doc_id the lowest grade
counts, labels without quality teach nothing; with labels of one grade only, every text gets that grade, and without
any all are kept at grade 0 with probability 1.  Rows that repeat, or have no doc_id, are scored like any other.  Only doc_id and
text are read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.llm.common import prepare, split_of, table

CELLS = 1 << 18
GRADES = 3
MAX_WORDS_KEPT = 300_000


class _Cells(dict):
    """Cells of a word, of its shape, and of its shape as a repeated word."""

    def __missing__(self, word: str) -> tuple[int, int, int]:
        shape = []
        for c in word:
            kind = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c
            if not shape or shape[-1] != kind:
                shape.append(kind)
        form = "".join(shape[:12])
        cell = lambda x: xxhash.xxh3_64_intdigest(x) % CELLS
        value = self[word] = (cell("w" + word.lower()), cell("s" + form), cell("r" + form))
        return value


def features(text: str | None, known: _Cells) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells and their values."""
    words = text.split() if text else []
    lines = [x for x in text.split("\n") if x.strip()] if text else []
    size = [xxhash.xxh3_64_intdigest(f"n{len(words).bit_length()}") % CELLS]
    if not words:
        return np.array(size), np.ones(1)
    cells = np.array([known[w] for w in words])
    again = cells[1:, 2][cells[1:, 0] == cells[:-1, 0]]
    repeated = len(lines) - len(set(lines))
    marks = np.full(repeated, xxhash.xxh3_64_intdigest("line") % CELLS, np.int64)
    distinct, counts = np.unique(np.concatenate([cells[:, 0], cells[:, 1], again, marks, size]), return_counts=True)
    values = np.log1p(counts)
    return distinct, values / np.linalg.norm(values)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..: they sum to the expected grade."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def train(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.3, ridge: float = 1e-5, seed: int = 9) -> Ordinal:
    """Stochastic gradients with a step size for each weight; grades weigh alike, whatever their share."""
    k = int(grades.max()) + 1
    weights, squares = np.zeros(CELLS), np.full(CELLS, 1e-3)
    first, gaps = -0.5, np.full(k - 2, 1.0)
    share = np.bincount(grades, minlength=k) / len(grades)
    importance = (1 / np.maximum(share, 1e-9) / np.count_nonzero(share))[grades]
    squares_t = np.full(k - 1, 1e-3)
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            lengths = np.array([len(rows[i][0]) for i in pick])
            cells = np.concatenate([rows[i][0] for i in pick])
            values = np.concatenate([rows[i][1] for i in pick])
            begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            s = np.add.reduceat(weights[cells] * values, begin)
            y = grades[pick]
            # Gaps between thresholds are kept positive as exp(gap).
            steps = np.exp(gaps)
            bounds = np.concatenate([[-np.inf], first + np.concatenate([[0], np.cumsum(steps)]), [np.inf]])
            upper, lower = _logistic(bounds[y + 1] - s), _logistic(bounds[y] - s)
            upper, lower = np.where(np.isinf(bounds[y + 1]), 1.0, upper), np.where(np.isinf(bounds[y]), 0.0, lower)
            p = np.maximum(upper - lower, 1e-9)
            up, down = upper * (1 - upper) / p, lower * (1 - lower) / p
            g = importance[pick] / len(pick)
            d_s = g * (up - down)
            gradient = np.repeat(d_s, lengths) * values
            distinct, place = np.unique(cells, return_inverse=True)
            total = np.bincount(place, gradient) + ridge * weights[distinct]
            squares[distinct] += total * total
            weights[distinct] -= rate * total / np.sqrt(squares[distinct])
            d_bounds = np.zeros(k + 1)
            np.add.at(d_bounds, y + 1, -g * up)
            np.add.at(d_bounds, y, g * down)
            inner = d_bounds[1:-1]
            # The first threshold moves all, gap j moves those after it.
            moves = np.concatenate([[inner.sum()], [inner[j + 1 :].sum() * steps[j] for j in range(k - 2)]])
            squares_t += moves * moves
            change = rate / 3 * moves / np.sqrt(squares_t)
            first, gaps = first - change[0], gaps - change[1:]
    return Ordinal(weights, first + np.concatenate([[0], np.cumsum(np.exp(gaps))]))


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade: see the module."""
    grade = F.when(F.col("quality") <= 0, 0).when(F.coalesce("toxic", F.lit(0)) > 0, 1).otherwise(2)
    rated = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
    return rated.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, per_grade: int = 2000) -> Ordinal | int | None:
    """Trains on a hashed sample of about `per_grade` rated texts of each grade, at most twice that many.

    Only the features of the sampled texts come to the driver.  ratings: doc_id, grade (0, 1, ..).
    """
    prepare(docs.sparkSession)
    texts = docs.where(~split_of(4, 2)).select("doc_id", "text")
    # Only ids meet the ratings; the sampled ones, bounded in number, go to the texts.
    known = texts.select("doc_id").join(ratings, "doc_id")
    counts = {r["grade"]: r["count"] for r in known.groupBy("grade").count().collect()}
    if len(counts) < 2:
        return next(iter(counts), None)
    chance = (F.xxhash64("doc_id", F.lit(1)) % F.lit(1 << 30)).cast("double") / float(1 << 31) + 0.5
    wanted = F.lit(False)
    for grade, n in counts.items():
        wanted = wanted | ((F.col("grade") == grade) & (chance < per_grade / n))
    most = 2 * per_grade * len(counts)
    sample = texts.join(F.broadcast(known.where(wanted).distinct().limit(most)), "doc_id").limit(most)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cells()
        for batch in batches:
            found = [features(t, cells) for t in batch.column("text").to_pylist()]
            lists = [pa.array([f[i].tolist() for f in found], kind) for i, kind in enumerate((pa.list_(pa.int32()), pa.list_(pa.float32())))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), *lists], ["doc_id", "grade", "cells", "values"])

    shape = "doc_id long, grade int, cells array<int>, values array<float>"
    typed = sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int").alias("grade"), "text")
    got = typed.mapInArrow(extract, shape).toPandas().sort_values("doc_id")
    rows = [(np.asarray(c, np.int64), np.asarray(v, float)) for c, v in zip(got["cells"], got["values"], strict=True)]
    grades = got["grade"].to_numpy()
    if len(set(grades.tolist())) < 2:
        return int(grades[0]) if len(grades) else None
    return train(rows, grades)


def score(docs: DataFrame, model: Ordinal | int | None, least: int = 1) -> DataFrame:
    """Adds expected_grade and tail_probability, of at least grade `least`."""
    prepare(docs.sparkSession)
    if not isinstance(model, Ordinal):
        grade = model or 0
        return docs.withColumns({"expected_grade": F.lit(float(grade)), "tail_probability": F.lit(float(model is None or grade >= least))})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("expected_grade double, tail_probability double")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cells, m = _Cells(), shared.value
        for texts in parts:
            scores = np.zeros(len(texts))
            for i, text in enumerate(texts):
                where, values = features(text, cells)
                scores[i] = m.weights[where] @ values
                if len(cells) > MAX_WORDS_KEPT:
                    cells.clear()
            tails = m.tails(scores)
            yield pd.DataFrame({"expected_grade": tails.sum(axis=1), "tail_probability": tails[:, least - 1] if least <= tails.shape[1] else 0.0})

    return docs.withColumn("_judged", judge(F.col("text"))).select(*docs.columns, "_judged.*")


#: A text is kept from this probability of grade 1 or more.
KEEP_FROM = 0.5


def op1_quality_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out (the rows never trained on), expected_grade 0 to 2, tail_probability, kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, graded(table(spark, sf_dir, "labels"))))
    return scored.select(
        "doc_id", split_of(4, 2).alias("held_out"), "expected_grade", "tail_probability", (F.col("tail_probability") >= KEEP_FROM).alias("kept")
    )

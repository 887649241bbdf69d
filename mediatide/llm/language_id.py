"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows; in each window one network runs forward and one backward, every byte gets a
probability for each language from both states, and a document's probabilities are the mean over all its bytes.
The network is trained in numpy by backpropagation through time on windows of a sample of the labelled rows, bounded for each
language (`sample_per_language` documents of it, in expectation) and never in the number of languages: every lang value is learned.
The windows are cut on the executors; the network then scores every whole text there.

Defined results: a text that is null, empty or without any letter is `und` with score 0; if no language can be learned, so is
every text.  Rows that repeat, or have no doc_id, are scored like any other (a null id belongs to the training part).  The
stage passes extra columns through.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediatide.llm.common import prepare, split_of, table

UNKNOWN = "und"
WINDOW = 128
#: Stands where a window has no byte: it leaves the state as it is.
PAD = 256
GATES = ("z", "r", "n")
#: Bytes of a training window, windows of a training step, and the least numbers of steps and of windows of each language.
TRAINED_WIDTH, BATCH, STEPS, WINDOWS_EACH = 48, 192, 500, 1_500


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Direction:
    """One gated recurrent layer: input tables (257 x H) with biases in them, and state matrices (H x H), by gate."""

    inputs: dict[str, np.ndarray]
    states: dict[str, np.ndarray]

    @staticmethod
    def random(hidden: int, rng: np.random.Generator) -> Direction:
        inputs = {g: rng.normal(0, 0.3, (PAD + 1, hidden)).astype("f4") for g in GATES}
        inputs["z"] += 1.0
        states = {g: rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, hidden)).astype("f4") for g in GATES}
        for g in GATES:
            inputs[g][PAD] = 40.0 if g == "z" else 0.0
        return Direction(inputs, states)

    def run(self, x: np.ndarray) -> np.ndarray:
        """States after each of the (T, B) symbols."""
        steps, batch = x.shape
        hidden = self.states["z"].shape[0]
        half = {g: (self.inputs[g] * (0.5 if g != "n" else 1)).astype("f4") for g in GATES}
        into = {g: (self.states[g] * (0.5 if g != "n" else 1)).astype("f4") for g in GATES}
        out = np.empty((steps, batch, hidden), "f4")
        h = np.zeros((batch, hidden), "f4")
        z, r, n, tmp = (np.empty((batch, hidden), "f4") for _ in range(4))
        for t in range(steps):
            at = x[t]
            half["z"].take(at, axis=0, out=z, mode="clip")
            z += np.dot(h, into["z"], out=tmp)
            np.tanh(z, out=z)
            half["r"].take(at, axis=0, out=r, mode="clip")
            r += np.dot(h, into["r"], out=tmp)
            np.tanh(r, out=r)
            r += 1
            r *= np.dot(h, into["n"], out=tmp)
            r *= 0.5
            half["n"].take(at, axis=0, out=n, mode="clip")
            n += r
            np.tanh(n, out=n)
            # z * h + (1 - z) * n with z = (tanh + 1) / 2
            z += 1
            z *= 0.5
            h -= n
            h *= z
            h += n
            out[t] = h
        return out


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    readout: np.ndarray  # (2H + 1) x languages

    def both(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.forward.run(x), self.backward.run(x[::-1])[::-1]

    def position_sums(self, x: np.ndarray) -> np.ndarray:
        """For (T, B) symbols, each window's sum over its bytes of the languages' probabilities: (B, languages)."""
        front, back = self.both(x)
        hidden = front.shape[2]
        flat_f, flat_b = front.reshape(-1, hidden), np.ascontiguousarray(back).reshape(-1, hidden)
        odds = []
        for k in range(len(self.languages)):
            v = flat_f @ self.readout[:hidden, k]
            v += flat_b @ self.readout[hidden : 2 * hidden, k]
            v += self.readout[-1, k]
            np.clip(v, -30, 30, out=v)
            odds.append(np.exp(v, out=v))
        total = odds[0].copy()
        for v in odds[1:]:
            total += v
        scale = (x.reshape(-1) != PAD) / total
        return np.stack([(v * scale).reshape(x.shape).sum(axis=0) for v in odds], axis=1)


def windows_of(data: bytes, width: int) -> np.ndarray:
    """The bytes as rows of `width` symbols, the last one padded."""
    n = -(-len(data) // width)
    out = np.full(n * width, PAD, np.int16)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, width)


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray], scale: float) -> None:
        self.t += 1
        for k, g in grads.items():
            m = self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * g
            v = self.v[k] = 0.99 * self.v.get(k, 0) + 0.01 * g * g
            params[k] -= self.rate * scale * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-8)


def _back_through_time(layer: Direction, x: np.ndarray, d_out: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """States' gradients to the parameters' gradients; recomputes the gates on the way."""
    steps, batch = x.shape
    hidden = d_out.shape[2]
    states = layer.run(x)
    grads = {f"i{g}": np.zeros((PAD + 1, hidden), "f4") for g in GATES} | {f"s{g}": np.zeros((hidden, hidden), "f4") for g in GATES}
    d_inputs = {g: np.empty((steps, batch, hidden), "f4") for g in GATES}
    d_h = np.zeros((batch, hidden), "f4")
    for t in range(steps - 1, -1, -1):
        h = states[t - 1] if t else np.zeros((batch, hidden), "f4")
        z = _sigmoid(layer.inputs["z"][x[t]] + h @ layer.states["z"])
        r = _sigmoid(layer.inputs["r"][x[t]] + h @ layer.states["r"])
        carried = h @ layer.states["n"]
        n = np.tanh(layer.inputs["n"][x[t]] + r * carried)
        d = d_h + d_out[t]
        d_n = d * (1 - z) * (1 - n * n)
        d_z = d * (h - n) * z * (1 - z)
        d_r = d_n * carried * r * (1 - r)
        d_carried = d_n * r
        grads["sz"] += h.T @ d_z
        grads["sr"] += h.T @ d_r
        grads["sn"] += h.T @ d_carried
        d_inputs["z"][t], d_inputs["r"][t], d_inputs["n"][t] = d_z, d_r, d_n
        d_h = d * z + d_z @ layer.states["z"].T + d_r @ layer.states["r"].T + d_carried @ layer.states["n"].T
    flat = x.reshape(-1)
    for g in GATES:
        values = d_inputs[g].reshape(-1, hidden)
        for j in range(hidden):
            grads[f"i{g}"][:, j] = np.bincount(flat, values[:, j], PAD + 1)
        grads[f"i{g}"][PAD] = 0
    return states, grads


def steps_for(languages: int) -> int:
    """Training steps: more than STEPS where the languages would get fewer than WINDOWS_EACH windows otherwise."""
    return max(STEPS, -(-WINDOWS_EACH * languages // BATCH))


def train(
    texts: list[str | bytes], languages: list[str], hidden: int = 8, steps: int | None = None, batch: int = BATCH, width: int = TRAINED_WIDTH,
    rate: float = 0.03, seed: int = 7,
) -> Network:
    """Every byte of a window is a training position with the language of its document."""
    names = sorted(set(languages))
    steps = steps_for(len(names)) if steps is None else steps
    rng = np.random.default_rng(seed)
    data = [t.encode("utf-8") if isinstance(t, str) else t for t in texts]
    number = {x: k for k, x in enumerate(names)}
    label = np.array([number[x] for x in languages])
    order = np.argsort(label, kind="stable")
    of = np.split(order, np.cumsum(np.bincount(label, minlength=len(names)))[:-1])
    net = Network(names, Direction.random(hidden, rng), Direction.random(hidden, rng), rng.normal(0, 0.1, (2 * hidden + 1, len(names))).astype("f4"))
    layers = {"f": net.forward, "b": net.backward}
    params = {f"{d}{p}{g}": (layer.inputs if p == "i" else layer.states)[g] for d, layer in layers.items() for p in "is" for g in GATES}
    params["out"] = net.readout
    adam = _Adam(rate)
    for step in range(steps):
        # Languages take turns, so that rare ones are learned too; windows start anywhere in the text.
        y = rng.integers(0, len(names), batch)
        x = np.full((batch, width), PAD, np.int16)
        for i, k in enumerate(y):
            text = data[rng.choice(of[k])]
            begin = rng.integers(0, max(1, len(text) - width + 1))
            cut = text[begin : begin + rng.integers(8, width + 1)]
            x[i, : len(cut)] = np.frombuffer(cut, np.uint8)
        x = np.ascontiguousarray(x.T)
        turned = np.ascontiguousarray(x[::-1])
        states = np.concatenate([net.forward.run(x), net.backward.run(turned)[::-1]], axis=2)
        logits = states @ net.readout[:-1] + net.readout[-1]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        real = (x != PAD)[:, :, None]
        p[:, np.arange(batch), y] -= 1
        d_logits = (p * real / max(1, real.sum())).astype("f4")
        grads = {"out": np.concatenate([states.reshape(-1, 2 * hidden).T @ d_logits.reshape(-1, len(names)), d_logits.sum(axis=(0, 1))[None]])}
        d_states = d_logits @ net.readout[:-1].T
        for d, layer, seq, part in (("f", net.forward, x, d_states[:, :, :hidden]), ("b", net.backward, turned, d_states[::-1, :, hidden:])):
            _, found = _back_through_time(layer, seq, part)
            grads |= {d + k: v for k, v in found.items()}
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        grads = {k: g * min(1.0, 1.0 / (norm + 1e-9)) for k, g in grads.items()}
        adam.step(params, grads, 1.0 - 0.95 * step / steps)
    return net


def scorer(net: Network, width: int = WINDOW, at_once: int = 2048):
    """A function from texts to (language, probability), every byte of every text counting."""

    def score(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        sums = np.zeros((len(texts), len(net.languages)))
        lengths = np.zeros(len(texts))
        waiting: dict[int, list[tuple[int, np.ndarray]]] = {}
        count: dict[int, int] = {}

        def flush(w: int) -> None:
            parts = waiting.pop(w)
            count[w] = 0
            rows = np.repeat([i for i, _ in parts], [len(a) for _, a in parts])
            x = np.concatenate([a for _, a in parts])
            for at in range(0, len(x), at_once):
                found = net.position_sums(np.ascontiguousarray(x[at : at + at_once].T).astype(np.intp))
                for k in range(found.shape[1]):
                    sums[:, k] += np.bincount(rows[at : at + at_once], found[:, k], len(texts))

        def put(w: int, i: int, x: np.ndarray) -> None:
            waiting.setdefault(w, []).append((i, x))
            count[w] = count.get(w, 0) + len(x)
            if count[w] >= at_once:
                flush(w)

        for i, text in enumerate(texts):
            data = text.encode("utf-8") if text else b""
            lengths[i] = len(data)
            whole = len(data) // width * width
            if whole:
                put(width, i, windows_of(data[:whole], width))
            if whole < len(data):
                # The rest goes to the shortest of a few widths that holds it.
                rest = data[whole:]
                put(min(w for w in (width // 8, width // 4, width // 2, width) if w >= len(rest)), i, windows_of(rest, min(w for w in (width // 8, width // 4, width // 2, width) if w >= len(rest))))
        for w in list(waiting):
            flush(w)
        mean = sums / np.maximum(lengths, 1)[:, None]
        best = mean.argmax(axis=1)
        return [net.languages[k] for k in best], np.clip(mean[np.arange(len(texts)), best], 0, 1)

    return score


def _cut(per_text: dict[str, int], width: int):
    """Windows of `width` bytes of each text, as many as `per_text` has for its language; they start anywhere in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = []
            for seed, lang, text in zip(*(batch.column(c).to_pylist() for c in ("seed", "lang", "text")), strict=True):
                data = text.encode("utf-8")
                rng = np.random.default_rng(seed & ((1 << 64) - 1))
                begins = rng.integers(0, max(1, len(data) - width + 1), per_text[lang])
                windows.append([data[i : i + width] for i in begins])
            yield pa.RecordBatch.from_arrays(
                [batch.column("seed"), batch.column("lang"), pa.array(windows, pa.list_(pa.binary()))], ["seed", "lang", "windows"]
            )

    return run


def fit(docs: DataFrame, sample_per_language: int = 400) -> Network | None:
    """Trains on a hashed sample of about `sample_per_language` labelled texts with letters of every language.

    Only as many windows of them as the training steps draw come to the driver, shared evenly by the texts of a language.
    """
    prepare(docs.sparkSession)
    labelled = docs.where(~split_of(4, 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # Rows that repeat an id, language and text are one row of the sample: they have the same hash.
    seed = F.xxhash64("doc_id", "text")
    place = (seed % F.lit(1 << 30)).cast("double") / float(1 << 31) + 0.5
    counted = labelled.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("least")).collect()
    sizes = {r["lang"]: r["n"] for r in counted}
    if not sizes:
        return None
    draws = -(-steps_for(len(sizes)) * BATCH // len(sizes))
    per_text = {lang: -(-draws // min(n, sample_per_language)) for lang, n in sizes.items()}
    # A language of few distinct rows may have none below its share: its smallest place counts too.
    bounds = {r["lang"]: max(min(1.0, sample_per_language / r["n"]), np.nextafter(r["least"], 2)) for r in counted}
    bound = F.create_map(*(F.lit(x) for lang, p in bounds.items() for x in (lang, float(p))))
    sample = labelled.where(place < F.element_at(bound, F.col("lang"))).select(seed.alias("seed"), "lang", "text")
    cut = sample.mapInArrow(_cut(per_text, TRAINED_WIDTH), "seed long, lang string, windows array<binary>")
    rows = sorted((r["lang"], r["seed"], [bytes(w) for w in r["windows"]]) for r in cut.dropDuplicates(["seed", "lang"]).collect())
    return train([w for r in rows for w in r[2]], [r[0] for r in rows for _ in r[2]])


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """Adds a struct column `language` (lang_pred, score)."""
    prepare(docs.sparkSession)
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if net is None:
        return docs.withColumn("language", unknown)

    @F.pandas_udf("lang_pred string, score double")
    def label(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = scorer(net)
        for texts in parts:
            names, values = score(texts.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": values})

    # Deterministic in fact; marked so that a filter on the result does not score a second time.
    found = label.asNondeterministic()(F.col("text"))
    scored = docs.withColumn("language", found)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return scored.withColumn("language", F.when(letters, F.col("language")).otherwise(unknown))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = identify(docs.select("doc_id", "text"), fit(docs))
    return scored.select("doc_id", split_of(4, 2).alias("held_out"), "language.lang_pred", "language.score")


#: The stage rejects a document whose best language has a smaller share of its bytes' probability.
LEAST_SCORE = 0.3


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a known language."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), "text")
    scored = identify(rows, fit(docs)).where((F.col("language.lang_pred") != UNKNOWN) & (F.col("language.score") >= LEAST_SCORE))
    return scored.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))

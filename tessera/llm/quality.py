"""Quality classifier: naive Bayes support vectors.

Indicators of n-grams are scaled by the log ratio of their smoothed counts in the two classes, and a linear hinge-loss model
is fitted to the scaled, length-normalised rows by dual coordinate descent. Its margin becomes a probability by a logistic
curve fitted on labelled rows that the model did not see.

The n-grams are of word shapes (runs of upper case, lower case, digits and each sign, and whether the word repeats the one
before), of one to three words, and of single lower-cased words; so they mean the same for words never seen in training.
All are hashed into DIMS slots: the model has a fixed size (1 MB), whatever the corpus.

Fitting takes at most PER_CLASS labelled rows of either class (a documented bound); scoring reads every whole text once,
without a shuffle.

Defined cases: null text is empty and scores as such (no n-gram: the curve at the model's bias); null ids are not held out
and teach nothing; with labels of one class only (or none) every score is the smoothed share of label 1.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches_of, modest, sampled, split_of

BITS = 18
DIMS = 1 << BITS
PER_CLASS = 3000
C, EPOCHS = 1.0, 20

_RUN = re.compile(r"([A-Z])[A-Z]*|([a-z])[a-z]*|([0-9])[0-9]*|(.)\4*", re.S)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_REPEATS = np.uint64(0x5851F42D4C957F2D)


def _shape(word: str) -> str:
    if not word.isascii():
        word = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return "".join(("A" if m[1] else "a" if m[2] else "0" if m[3] else m[4]) * min(2, m.end() - m.start()) for m in _RUN.finditer(word))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


class Features:
    """Text to the sorted slots of its n-grams; keeps the shapes of words that it has met, within a bound."""

    def __init__(self, keep: int = 100_000):
        self.keep, self.known = keep, {}

    def _word(self, w: str) -> tuple[int, int]:
        if len(self.known) >= self.keep:
            self.known.clear()
        out = zlib.crc32(_shape(w).encode("utf-8", "surrogatepass")) + 1, zlib.crc32(w.lower().encode("utf-8", "surrogatepass"))
        if len(w) <= 40:
            self.known[w] = out
        return out

    def __call__(self, text: str) -> np.ndarray:
        words = text.split()
        if not words:
            return np.zeros(0, np.int32)
        known, word = self.known, self._word
        both = np.array([known.get(w) or word(w) for w in words], np.uint64)
        same = np.zeros(len(words), bool)
        same[1:] = [a == b for a, b in zip(words, words[1:], strict=False)]
        one = np.where(same, both[:, 0] ^ _REPEATS, both[:, 0])
        grams = [_mix(both[:, 1] + np.uint64(1 << 40)), _mix(one)]
        two = _mix(one[:-1] * np.uint64(3) + one[1:] * np.uint64(0x10000001B3)) if len(one) > 1 else one[:0]
        three = _mix(two[:-1] * np.uint64(5) + one[2:] * np.uint64(0x100000001B5)) if len(one) > 2 else one[:0]
        return np.unique((np.concatenate([*grams, two, three]) >> np.uint64(64 - BITS)).astype(np.int32))


def fit(rows: list[np.ndarray], y: np.ndarray, seed: int = 7) -> dict:
    """The model from slots per row and labels 0 or 1: weights per slot, bias, and the logistic curve (a, b)."""
    y = np.asarray(y)
    if len(y) == 0 or y.min() == y.max():
        return {"w": np.zeros(DIMS, np.float32), "bias": 0.0, "a": 0.0, "b": float(np.log((y.sum() + 1) / ((1 - y).sum() + 1))), "r": np.zeros(DIMS, np.float32)}
    order = np.random.default_rng(seed).permutation(len(y))
    calm = set(order[: max(2, len(y) // 5)].tolist())
    learn = [i for i in range(len(y)) if i not in calm]
    if len({int(y[i]) for i in learn}) < 2:
        learn, calm = list(range(len(y))), set(range(len(y)))
    counts = np.ones((2, DIMS))
    seen = np.zeros(DIMS, bool)
    for i in learn:
        counts[int(y[i]), rows[i]] += 1
        seen[rows[i]] = True
    r = np.where(seen, np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum()), 0.0)
    # dual coordinate descent for the hinge loss; the bias is a feature of value 1
    xs = []
    for i in learn:
        v = r[rows[i]]
        xs.append(v / max(1e-9, float(np.sqrt((v * v).sum()))))
    w, bias = np.zeros(DIMS), 0.0
    sign, alpha = np.where(y[learn] == 1, 1.0, -1.0), np.zeros(len(learn))
    square = np.array([float((x * x).sum()) + 1.0 for x in xs])
    rng = np.random.default_rng(seed + 1)
    for _ in range(EPOCHS):
        worst = 0.0
        for j in rng.permutation(len(learn)):
            idx, x = rows[learn[j]], xs[j]
            g = sign[j] * (float(w[idx] @ x) + bias) - 1.0
            new = min(C, max(0.0, alpha[j] - g / square[j]))
            step = (new - alpha[j]) * sign[j]
            if step:
                w[idx] += step * x
                bias += step
                worst = max(worst, abs(step))
                alpha[j] = new
        if worst < 1e-3:
            break
    model = {"w": w.astype(np.float32), "bias": float(bias), "r": r.astype(np.float32), "a": 1.0, "b": 0.0}
    held = sorted(calm)
    model["a"], model["b"] = _curve(np.array([margin(model, rows[i]) for i in held]), y[held])
    return model


def _curve(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve a * m + b by Newton steps, with Platt's smoothed targets and a slope of at least 1."""
    up, down = int(y.sum()), int((1 - y).sum())
    t = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 2.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g = np.array([((p - t) * m).sum() + 1e-3 * a, (p - t).sum() + 1e-3 * b])
        q = p * (1 - p)
        h = np.array([[(q * m * m).sum() + 1e-3, (q * m).sum()], [(q * m).sum(), q.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(1.0, float(a)), float(b)


def margin(model: dict, slots: np.ndarray) -> float:
    v = model["r"][slots]
    n = float(np.sqrt((v * v).sum()))
    return model["bias"] + (float((v * model["w"][slots]).sum()) / n if n else 0.0)


def score(model: dict, slots: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(model["a"] * margin(model, slots) + model["b"], -30, 30))))


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    f = Features()
    for b in batches_of(batches):
        slots = pa.array([f(t or "") for t in b.column("text").to_pylist()], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([b.column("y"), slots], ["y", "slots"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 3, held: int = 1, per_class: int = PER_CLASS) -> dict:
    """The model from a bounded sample of labelled rows whose split is not ``held``: per_class rows of either class at most, however often an id repeats."""
    modest(docs.sparkSession)
    texts = sampled(docs, labels, label, parts, held, per_class).select("y", "text")
    got = texts.mapInArrow(_slots, "y int, slots array<int>").toArrow()
    y = got.column("y").to_numpy()
    rows = [np.asarray(s.values.to_numpy(), np.int32) if s.is_valid else np.zeros(0, np.int32) for s in got.column("slots")]
    order = sorted(range(len(y)), key=lambda i: (int(y[i]), zlib.crc32(rows[i].tobytes())))  # the same order whatever the partitions
    return fit([rows[i] for i in order], y[order])


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, m = Features(), model.value
        for b in batches_of(batches):
            out = pa.array([score(m, f(t.as_py() or "")) for t in b.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns) if b.schema.names[i] != "text"), out], [n for n in b.schema.names if n != "text"] + ["score"])

    return run


def score_documents(docs: DataFrame, model: dict, parts: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; labels, language, source and id are no inputs of the score."""
    modest(docs.sparkSession)
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast({k: model[k] for k in ("w", "bias", "r", "a", "b")})  # 2 MB, fixed
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.col("text"))
    out = rows.mapInArrow(_scorer(shipped), "doc_id bigint, score double")
    return out.select("doc_id", (split_of(F.col("doc_id"), parts) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` that the model does not reject (score of 0.5 or more), with all their columns; no join, no shuffle."""
    modest(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast({k: model[k] for k in ("w", "bias", "r", "a", "b")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, m = Features(), shipped.value
        for b in batches_of(batches):
            keep = pa.array([score(m, f(t.as_py() or "")) >= 0.5 for t in b.column("text")], pa.bool_())
            yield b.filter(keep)

    return docs.mapInArrow(run, docs.schema)

"""Toxicity: class-conditional Kneser-Ney models.

A character model of order ORDER for each class, P_c(w | h) = max(c_c(hw) - D, 0) / c_c(h) + g_c(h) P(w | h'), with a discount D
for counts of one, two and more each, backs off to one Kneser-Ney model of continuation counts that both classes share; so a
rare expression is smoothed by what all texts say, and where neither class knows more than the shared model, the classes agree.
The log ratio of a character is then a function of its n-gram (seen) or of its history (unseen): two lookups.

A toxic text is an ordinary one but for what it says here and there. So the toxic likelihood of a word is that by the toxic model
once in 1 / SHARE words and else that by the ordinary one, and the score compares the text's two log-likelihoods, each divided
by its number of words: their difference, and nothing else, goes through a logistic curve (over its logarithm, counted from its
least value) that is fitted on the sample's texts, each scored by counts of the other folds only.

Characters are lower-cased; whatever is no letter or digit separates words. The LETTERS commonest letters of the sample have
symbols of their own, all others are dealt over the remaining symbols by code point. The class counts and the curve are fitted
on at most PER_CLASS labelled rows of either class (a documented bound). The shared model counts the continuations in all texts,
labelled or not: each task hands on its distinct n-grams, which are counted on the cluster; only the counts of n-grams that the
class counts hold come to the driver, so the model is as bounded as the sample. Scoring reads every whole text, without a shuffle.

Defined cases: null and empty texts have a difference of 0; null ids are not held out and teach nothing; a fold without which a
class has no text is scored by the counts of all; with labels of one class only (or none) every score is the smoothed share of
label 1; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Saved, batches_of, sampled, modest, split_of

ORDER = 5
#: Bits of a symbol; letters with a symbol of their own.
BITS, LETTERS = 12, 3072
PER_CLASS = 3000
#: The share of a toxic text's words that speak by the toxic model.
SHARE = 0.01
#: Parts of the sample, each of which is scored for the curve by the counts of the others.
FOLDS = 4


def alphabet_table(letters: str) -> np.ndarray:
    """Code point to symbol: 0 separates words, the LETTERS first of ``letters`` come next, other letters and digits share the rest."""
    out = np.zeros(0x110000, np.uint16)
    place = {c: i + 1 for i, c in enumerate(letters[:LETTERS])}
    for cp in range(0x30000):
        c = chr(cp)
        if c.isalnum():
            low = c.lower() if len(c.lower()) == 1 else c
            out[cp] = place.get(low) or LETTERS + 1 + ord(low) % ((1 << BITS) - LETTERS - 1)
    return out


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """The symbols of a text with one separator before, between and after words; empty without words."""
    s = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    s = np.concatenate((np.zeros(1, np.uint16), s, np.zeros(1, np.uint16)))
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    s = s[keep]
    return s if len(s) > 1 else s[:0]


def grams(s: np.ndarray, n: int) -> np.ndarray:
    """The n-grams that end at each symbol after the first, separators filling up before the text."""
    x = np.concatenate((np.zeros(n - 2, np.uint64), s.astype(np.uint64))) if n > 2 else s.astype(np.uint64)
    m = len(s) - 1
    k = np.zeros(m, np.uint64)
    for j in range(n):
        at = len(x) - m - n + 1 + j
        k = (k << np.uint64(BITS)) | x[at : at + m]
    return k


class Slots:
    """An exact map from 64-bit keys to floats in open arrays: a direct table, and a sorted rest for the keys that meet there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(10, int(len(keys) * 4 - 1).bit_length() if len(keys) else 10)
        size = 1 << self.bits
        self.keys, self.values, self.more = np.full(size, np.iinfo(np.uint64).max, np.uint64), np.zeros(size, np.float32), np.zeros(size, bool)
        at = self._at(keys)
        self.keys[at], self.values[at] = keys, values
        lost = self.keys[at] != keys
        self.more[at[lost]] = True
        order = np.argsort(keys[lost])
        self.rest, self.rest_values = keys[lost][order], values[lost][order].astype(np.float32)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where missing) and whether there is one."""
        at = self._at(keys)
        found = self.keys[at] == keys
        out = np.where(found, self.values[at], np.float32(0))
        if len(self.rest) and len(open_ := np.flatnonzero(~found & self.more[at])):
            i = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[i] == keys[open_]
            out[open_[hit]] = self.rest_values[i[hit]]
            found[open_[hit]] = True
        return out, found


def _mask(n: int) -> int:
    return (1 << (BITS * n)) - 1


def _discount(one: float, two: float) -> float:
    return one / (one + 2 * two) if one and two else 0.5


def _discounts(counts: np.ndarray) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and more."""
    n = [float((counts == i).sum()) for i in range(5)]
    y = _discount(n[1], n[2])
    out = [0.0, y, y, y]
    for i in (1, 2, 3):
        if n[1] and n[2] and n[i]:
            out[i] = min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05)
    return np.array(out)


def continuations(keys: np.ndarray) -> list[tuple]:
    """For n from ORDER - 1 down to 1: n, the n-grams that end one of the distinct ``keys``, each's number of distinct longer
    ones, the sum and the number of these over its history, and the discount."""
    out = []
    for n in range(ORDER - 1, 0, -1):
        keys, counts = np.unique(keys & np.uint64(_mask(n)), return_counts=True)
        inverse = np.unique(keys >> np.uint64(BITS), return_inverse=True)[1]
        out.append((n, keys, counts, np.bincount(inverse, counts)[inverse], np.bincount(inverse)[inverse], _discount(float((counts == 1).sum()), float((counts == 2).sum()))))
    return out


def shared_model(levels: list[tuple], keys: np.ndarray) -> np.ndarray:
    """The probability of the last symbol of each of ``keys`` after the ORDER - 2 before it, from continuation counts."""
    lower_keys, lower = np.zeros(1, np.uint64), np.array([1 / (1 << BITS)])
    for n, grams_, counts, total, kinds, d in reversed(levels):
        back = lower[np.searchsorted(lower_keys, grams_ & np.uint64(_mask(n - 1)))]
        lower = np.maximum(counts - d, 0) / total + d * kinds / total * back
        lower_keys = grams_
    return lower[np.searchsorted(lower_keys, keys & np.uint64(_mask(ORDER - 1)))]


def kneser_ney(keys: np.ndarray, toxic: np.ndarray, plain: np.ndarray, levels: list[tuple] | None = None) -> tuple[Slots, Slots]:
    """Log ratios of the n-grams in ``keys`` (counts per class), and of histories for what neither class has seen.

    ``levels`` are the continuation counts that both classes back off to; without them, those of ``keys``.
    """
    shared = shared_model(levels or continuations(keys), keys)
    hist, inverse = np.unique(keys >> np.uint64(BITS), return_inverse=True)
    logs, weights = [], []
    for counts in (toxic, plain):
        d = _discounts(counts)[np.minimum(counts, 3).astype(int)]
        total, taken = np.bincount(inverse, counts, len(hist)), np.bincount(inverse, d, len(hist))
        back = np.where(total > 0, taken / np.maximum(total, 1), 1.0)
        logs.append(np.log((counts - d) / np.maximum(total, 1)[inverse] + back[inverse] * shared))
        weights.append(np.log(back))
    return Slots(keys, logs[0] - logs[1]), Slots(hist, weights[0] - weights[1])


def evidence(text: str, model: dict) -> float:
    """The text's toxic log-likelihood less its ordinary one, a word (0 without words), less log(1 - SHARE), in logarithms."""
    s = symbols(text, model["table"])
    if not len(s):
        return float(np.log(-np.log1p(-SHARE)))
    keys = grams(s, ORDER)
    ratio, seen = model["ngrams"].get(keys)
    open_ = np.flatnonzero(~seen)
    if len(open_):
        ratio[open_] = model["histories"].get(keys[open_] >> np.uint64(BITS))[0]
    ends = np.flatnonzero(s[1:] == 0)  # each word's own separator closes it
    words = np.add.reduceat(ratio.astype(np.float64), np.concatenate(([0], ends[:-1] + 1)))
    return float(np.log(np.logaddexp(0, words + np.log(SHARE / (1 - SHARE))).mean()))


def _counted(table):
    """Per partition: counts of n-grams of the sample rows, by class and fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown: dict[tuple[int, int], list[np.ndarray]] = {}
        for b in batches_of(batches):
            for y, f, t in zip(b.column("y").to_pylist(), b.column("fold").to_pylist(), b.column("text"), strict=True):
                s = symbols(t.as_py() or "", table.value)
                if len(s):
                    shown.setdefault((y, f), []).append(grams(s, ORDER))
        for (y, f), some in shown.items():
            k, n = np.unique(np.concatenate(some), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), *(pa.array(np.full(len(k), v, np.int32)) for v in (y, f)), pa.array(n.astype(np.int64))], ["gram", "y", "fold", "n"])

    return run


def _met(table):
    """Per partition: its distinct n-grams, some of them more than once. A direct table of bounded size turns most repeats away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.full(1 << 20, np.iinfo(np.uint64).max, np.uint64)
        for b in batches_of(batches):
            for t in b.column("text"):
                s = symbols(t.as_py() or "", table.value)
                if not len(s):
                    continue
                k = grams(s, ORDER)
                at = ((k * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
                new = np.flatnonzero(last[at] != k)
                last[at[new]] = k[new]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(k[new]).astype(np.int64))], ["gram"])

    return run


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches_of(batches):
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array([evidence(t.as_py() or "", m) for t in b.column("text")], pa.float64())], ["y", "e"])

    return run


def gather(docs: DataFrame, wanted: DataFrame, table: np.ndarray) -> list[tuple]:
    """``continuations`` of the n-grams of all texts of ``docs``; of these, the rows that the n-grams in ``wanted`` (gram) need."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    met = Saved(texts.mapInArrow(_met(docs.sparkSession.sparkContext.broadcast(table)), "gram bigint").distinct(), "toxic-grams")
    longer, made, out = met.df, [met], []
    for n in range(ORDER - 1, 0, -1):
        short = F.col("gram").bitwiseAND(F.lit(_mask(n))).alias("gram")
        made.append(Saved(longer.groupBy(short).agg(F.count(F.lit(1)).alias("n")), "toxic-level"))
        level, wanted = made[-1].df.withColumn("history", F.shiftright("gram", BITS)), wanted.select(short).distinct()
        totals = level.groupBy("history").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        rows = level.join(wanted, "gram", "left_semi").join(totals, "history").select("gram", "n", "total", "kinds").toArrow().sort_by("gram")
        once = level.agg(F.count_if(F.expr("n = 1")).alias("one"), F.count_if(F.expr("n = 2")).alias("two")).first()
        out.append((n, rows.column("gram").to_numpy().astype(np.uint64), *(rows.column(c).to_numpy().astype(float) for c in ("n", "total", "kinds")), _discount(float(once.one), float(once.two))))
        longer = level
    for s in made:
        s.drop()
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 5, held: int = 0, per_class: int = PER_CLASS) -> dict:
    """The model from a bounded sample of labelled rows whose split is not ``held``, per_class rows of either class at
    most, however often an id repeats; all of it for the counts, and for the curve by folds that are left out of the counts in turn."""
    modest(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    texts = sampled(docs, labels, label, parts, held, per_class)
    kept = Saved(texts.select("y", "text", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")), "toxic-sample")
    n = {(r.fold, r.y): r.n for r in kept.df.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = [sum(v for (_, y), v in n.items() if y == k) for k in (0, 1)]
    if not all(share):
        kept.drop()
        nothing = Slots(np.zeros(0, np.uint64), np.zeros(0))
        return {"table": alphabet_table(""), "ngrams": nothing, "histories": nothing, "a": 0.0, "b": float(np.log((share[1] + 1) / (share[0] + 1)))}
    chars = kept.df.select(F.explode(F.array_distinct(F.split(F.lower("text"), ""))).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    met = sorted((r for r in chars.where("length(c) = 1").collect() if r.c.isalnum()), key=lambda r: (-r.n, r.c))
    table = alphabet_table("".join(r.c for r in met[:LETTERS]))
    counts = kept.df.select("y", "fold", "text").mapInArrow(_counted(sc.broadcast(table)), "gram bigint, y int, fold int, n bigint")
    parts_ = [(y, f) for y in (0, 1) for f in range(FOLDS)]
    known = Saved(counts.groupBy("gram").agg(*(F.coalesce(F.sum(F.when((F.col("y") == y) & (F.col("fold") == f), F.col("n"))), F.lit(0)).alias(f"n{y}_{f}") for y, f in parts_)), "toxic-counts")
    got = known.df.toArrow()
    levels = gather(docs, known.df.select("gram"), table)
    known.drop()
    keys = got.column("gram").to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    keys, by = keys[order], {p: got.column(f"n{p[0]}_{p[1]}").to_numpy()[order].astype(float) for p in parts_}
    whole = [sum(by[y, f] for f in range(FOLDS)) for y in (0, 1)]
    model = dict(zip(("ngrams", "histories"), kneser_ney(keys, whole[1], whole[0], levels), strict=True)) | {"table": table}
    x, label_ = [], []
    for fold in range(FOLDS):
        own = model
        if all(share[y] > n.get((fold, y), 0) for y in (0, 1)):
            own = dict(zip(("ngrams", "histories"), kneser_ney(keys, whole[1] - by[1, fold], whole[0] - by[0, fold], levels), strict=True)) | {"table": table}
        shipped = sc.broadcast(own)
        rows = kept.df.where(F.col("fold") == fold).select("y", "text").mapInArrow(_scored(shipped), "y int, e double").toArrow()
        shipped.destroy()
        x.append(rows.column("e").to_numpy())
        label_.append(rows.column("y").to_numpy())
    kept.drop()
    return model | _curve(np.concatenate(x), np.concatenate(label_).astype(float))


def _curve(x: np.ndarray, y: np.ndarray) -> dict:
    """The logistic curve a * x + b of label 1 by Newton steps, the classes weighed alike, a little ridge on its slope."""
    z = np.column_stack((x, np.ones(len(x))))
    weight = np.where(y == 1, 1 / max(1.0, y.sum()), 1 / max(1.0, (1 - y).sum())) * len(y) / 2
    w, ridge = np.zeros(2), np.array([0.01, 1e-4])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (weight * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return {"a": float(w[0]), "b": float(w[1])}


def probability(text: str, model: dict) -> float:
    return float(1 / (1 + np.exp(-np.clip(model["a"] * evidence(text, model) + model["b"], -30, 30))))


def score_documents(docs: DataFrame, model: dict, parts: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; labels, language, source and id are no inputs of the score."""
    modest(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in batches_of(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([probability(t.as_py() or "", m) for t in b.column("text")], pa.float64())], ["doc_id", "score"])

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.col("text"))
    out = rows.mapInArrow(run, "doc_id bigint, score double")
    return out.select("doc_id", (split_of(F.col("doc_id"), parts) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

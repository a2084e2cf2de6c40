"""Hard negatives for contrastive training, by a vector-approximation file.

A row's components are whole numbers, floor(scale * x), and its score for an anchor is their inner product. An anchor's positives are
its best rows of the same label; for each of them the best rows of other labels are returned whose score lies in a window below it.

1. ``build`` writes the approximation file, without a shuffle: blocks of up to BLOCK rows, in which every dimension is quantised into
   CELLS cells of as many rows each. A block holds one byte a component, a table of the least and greatest number in every cell,
   and the numbers themselves in the smallest type that holds them.
2. Blocks are dealt out to shards, and the anchors stream through each shard. For an anchor and a block the tables give a lower and an
   upper bound of every score: the cells' edges are looked up once a block, and the sums over the dimensions of all anchors at
   hand are matrix products. Only rows that may enter a window, and in it the best k, are scored exactly: those whose upper
   bound reaches the window and the k-th greatest of what is sure to lie in it, in this block or the blocks before.
3. The best of all shards are merged: first the positives, then, with their scores as windows, the negatives.

Scale: rows are never paired by a join. A shard has LARGEST rows at most, and there are SHARDS of them at least where there are as many
blocks; what is moved is the file, twice, and the anchors once a shard (with 384 shards and 1 % of rows as anchors, about 4 times the
input). A task holds one shard and one batch of anchors, and sends k rows an anchor and window. Labels, ids and vectors that many rows
share are dealt out like any other, since nothing is grouped by them.

Defined cases: rows with a null id, label or vector, without components, or with a null or non-finite one take no part; scores
are taken between vectors of equally many components; a row is not its own positive, but another row of its id is like any other;
repeated anchors give their results each; ties go to the smaller id; components count as 2^62 beyond it, and scores as the
greatest or smallest long; a window under a negative score is empty; other columns are left out; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Saved, modest

#: Rows of a block, cells of a dimension, rows of a shard at most, shards at least, anchors and rows scored together.
BLOCK, CELLS, LARGEST, SHARDS, AT_ONCE = 4096, 64, 262_144, 384, 256
#: Numbers in a block at most, where vectors are long.
NUMBERS = 1 << 19
MOST = np.iinfo(np.int64)

_FILE = "block bigint, dims int, n int, rows binary, ids binary, labels binary, codes binary, low binary, high binary, vectors binary, asked binary, asked_vectors binary"
_ANCHOR = "dims int, row bigint, id bigint, label bigint, vector binary"
_HIT = "anchor_row bigint, anchor_id bigint, slot int, positive_id bigint, positive_score bigint, row bigint, vec_id bigint, score bigint"
_KINDS = {2: np.int16, 4: np.int32, 8: np.float64}


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers in the smallest type that holds them all; ``_unpack`` knows it by the length."""
    most = np.abs(numbers).max(initial=0)
    return numbers.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64).tobytes()


def _unpack(data: bytes, dims: int, n: int) -> np.ndarray:
    return np.frombuffer(data, _KINDS[len(data) // (n * dims)]).reshape(n, dims)


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors.astype(np.float64) * scale), -(2.0**62), 2.0**62) + 0.0


def quantise(numbers: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes (n, d), least and greatest number in each cell (d, c)): the ranks of each dimension cut into cells of equally many rows."""
    n, d = numbers.shape
    c = min(cells, n)
    order = np.argsort(numbers, axis=0, kind="stable")
    codes = np.empty((n, d), np.uint8)
    np.put_along_axis(codes, order, np.broadcast_to((np.arange(n) * c // n).astype(np.uint8)[:, None], (n, d)), 0)
    ranked = np.take_along_axis(numbers, order, 0)
    first = -(-np.arange(c + 1) * n // c)
    return codes, ranked[first[:-1]].T.copy(), ranked[first[1:] - 1].T.copy()


def bounds(codes: np.ndarray, low: np.ndarray, high: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds (a, n) of the scores of all rows of a block for the anchors (a, d), from the tables of its cells."""
    d = np.arange(low.shape[0])
    least, greatest = low[d, codes].astype(np.float64), high[d, codes].astype(np.float64)
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    lower, upper = up @ least.T + down @ greatest.T, up @ greatest.T + down @ least.T
    size = float(np.maximum(np.abs(low), np.abs(high)).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * len(d)
    slack = 0.0 if size < 2**53 else size * 2.0**-50  # up to 2^53 sums of whole numbers are exact
    return lower - slack, upper + slack


def scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """The exact inner products, cut to what a long holds."""
    size = float(np.abs(rows).max(initial=0)) * float(np.abs(anchor).max(initial=0)) * len(anchor)
    if size < 2**53:
        return (rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    if size < 2**62:
        return rows.astype(np.int64) @ anchor.astype(np.int64)
    own = [int(x) for x in anchor]
    return np.array([min(max(sum(int(x) * y for x, y in zip(r, own, strict=True)), MOST.min), MOST.max) for r in rows.tolist()], np.int64)


class Best:
    """The k best (score, id, row) of a window: higher scores first, ties by id, then by row."""

    def __init__(self, least: float, most: float, k: int):
        self.least, self.most, self.k, self.held, self.scored = least, most, k, [], 0

    def offer(self, block: Block, anchor: np.ndarray, lower: np.ndarray, upper: np.ndarray, allowed: np.ndarray) -> None:
        if self.least > self.most:
            return
        floor = self.held[-1][0] if len(self.held) == self.k else None
        floor = self.least if floor is None else max(self.least, -floor)
        sure = lower[allowed & (lower >= floor) & (upper <= self.most)]
        if len(sure) >= self.k:
            floor = max(floor, np.partition(sure, -self.k)[-self.k])
        at = np.flatnonzero(allowed & (upper >= floor) & (lower <= self.most))
        if not len(at):
            return
        self.scored += len(at)
        exact = scores(block.vectors[at], anchor)
        fits = [i for i, s in enumerate(exact.tolist()) if self.least <= s <= self.most]
        found = [(-int(exact[i]), int(block.ids[at[i]]), int(block.rows[at[i]])) for i in fits]
        self.held = sorted(self.held + found)[: self.k]


class Block:
    def __init__(self, r: dict):
        n, d = r["n"], r["dims"]
        self.dims, self.rows, self.ids, self.labels = d, *(np.frombuffer(r[c], np.int64) for c in ("rows", "ids", "labels"))
        self.codes, self.vectors = np.frombuffer(r["codes"], np.uint8).reshape(n, d), _unpack(r["vectors"], d, n)
        self.low, self.high = (_unpack(r[c], min(CELLS, n), d) for c in ("low", "high"))


def _build(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            dims = np.diff(batch.column("vector").offsets.to_numpy())
            for d in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == d))
                vectors = whole(some.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, d), scale)
                now = [vectors, some.column("vec_id").to_numpy(), some.column("label").to_numpy(), some.column("asked").to_numpy(zero_copy_only=False)]
                held[d] = [np.concatenate(x) for x in zip(held[d], now, strict=True)] if d in held else now
                size = max(16, min(BLOCK, NUMBERS // d))
                while len(held[d][0]) >= size:
                    yield _record(part, made, d, [x[:size] for x in held[d]])
                    made, held[d] = made + 1, [x[size:] for x in held[d]]
            # few rows of many sizes must not pile up
            while sum(x[0].size for x in held.values()) > 8 * NUMBERS:
                d = max(held, key=lambda d: held[d][0].size)
                yield _record(part, made, d, held.pop(d))
                made += 1
        for d, x in held.items():
            if len(x[0]):
                yield _record(part, made, d, x)
                made += 1

    return run


def _record(part: int, made: int, d: int, held: list[np.ndarray]) -> pa.RecordBatch:
    vectors, ids, labels, asked = held
    n, block = len(ids), (part << 32) + made * BLOCK
    codes, low, high = quantise(vectors)
    at = np.flatnonzero(asked)
    values = [block, d, n, (block + np.arange(n)).tobytes(), ids.astype(np.int64).tobytes(), labels.astype(np.int64).tobytes(), codes.tobytes(), _pack(low), _pack(high), _pack(vectors), *((at.astype(np.int64).tobytes(), _pack(vectors[at])) if len(at) else (None, None))]
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 9]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [c.split()[0] for c in _FILE.split(", ")])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            at = np.frombuffer(r["asked"], np.int64)
            vectors = _unpack(r["asked_vectors"], r["dims"], len(at))
            ids, labels, rows = (np.frombuffer(r[c], np.int64)[at] for c in ("ids", "labels", "rows"))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r["dims"], np.int32)), pa.array(rows), pa.array(ids), pa.array(labels), pa.array([_pack(v) for v in vectors], pa.binary())], ["dims", "row", "id", "label", "vector"])


def _search(k: int, same: bool, least: int, most: int):
    """The k best rows of the anchors' label, or, within ``least`` to ``most`` hundredths of each positive's score, of other labels."""

    def windows(a: dict) -> list[Best]:
        if same:
            return [Best(-np.inf, np.inf, k)]
        return [Best(-(-least * p // 100), most * p // 100, k) for p in a["positive_scores"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of the shard come first, then anchors."""
        shard, blocks = None, []
        for batch in batches:
            waiting: list[dict] = []
            for r in batch.to_pylist():
                if r["shard"] != shard:
                    yield from answers(waiting, blocks)
                    shard, blocks, waiting = r["shard"], [], []
                if r["kind"] == 0:
                    blocks.append(Block(r))
                else:
                    waiting.append(r)
            yield from answers(waiting, blocks)

    def answers(anchors: list[dict], blocks: list[Block]) -> Iterator[pa.RecordBatch]:
        for d in {a["dims"] for a in anchors}:
            alike, there = [a for a in anchors if a["dims"] == d], [b for b in blocks if b.dims == d]
            for i in range(0, len(alike) if there else 0, AT_ONCE):
                some = alike[i : i + AT_ONCE]
                vectors = np.array([_unpack(a["vector"], d, 1)[0] for a in some], np.float64)
                found = [windows(a) for a in some]
                for b in there:
                    lower, upper = bounds(b.codes, b.low, b.high, vectors)
                    for j, a in enumerate(some):
                        allowed = (b.labels == a["label"]) == same
                        if same:
                            allowed &= b.rows != a["row"]
                        for w in found[j]:
                            w.offer(b, vectors[j], lower[j], upper[j], allowed)
                out = [(a["row"], a["id"], slot, *((None, None) if same else (a["positive_ids"][slot], a["positive_scores"][slot])), row, vec_id, -s) for a, of in zip(some, found, strict=True) for slot, w in enumerate(of) for s, vec_id, row in w.held]
                cols = list(zip(*out, strict=True)) or [()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(cols)], [c.split()[0] for c in _HIT.split(", ")])

    return run


class Index:
    """The written approximation file; ``shards`` is the number of parts that searches cut it into."""

    def __init__(self, file: Saved, shards: int | None = None):
        self.file, n = file, file.df.agg(F.count(F.lit(1)), F.sum("n")).first()
        self.blocks, self.n = n[0], n[1] or 0
        self.shards = shards or max(1, -(-self.n // LARGEST), min(self.blocks, SHARDS))

    def anchors(self) -> DataFrame:
        """(dims, row, id, label, vector) of the rows asked for; only their columns are read."""
        return self.file.df.where("asked IS NOT NULL").select("dims", "rows", "ids", "labels", "asked", "asked_vectors").mapInArrow(_anchors, _ANCHOR)

    def drop(self) -> None:
        self.file.drop()


def usable(embeddings: DataFrame, anchors: Column) -> DataFrame:
    """(vec_id, label, vector, asked): rows that take part, and those among them that are anchors."""
    finite = "forall(vector, x -> coalesce(NOT isnan(x) AND abs(x) < double('infinity'), false))"
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asked"))
    return rows.where(F.expr(f"vec_id IS NOT NULL AND label IS NOT NULL AND size(vector) > 0 AND {finite}"))


def build(embeddings: DataFrame, anchors: Column, scale: int = 256, shards: int | None = None) -> Index:
    """The file over all usable rows (vec_id, label, embedding); ``anchors`` says of a row of ``embeddings`` whether it is one."""
    modest(embeddings.sparkSession)
    return Index(Saved(usable(embeddings, anchors).mapInArrow(_build(scale), _FILE), "approximations"), shards)


def _run(index: Index, anchors: DataFrame, k: int, same: bool, least: int = 0, most: int = 0) -> DataFrame:
    """The k best of each anchor's windows over all shards, with their rank."""
    more = [] if same else ["positive_ids", "positive_scores"]
    null = lambda kind, *names: [F.lit(None).cast(kind).alias(c) for c in names]
    blocks = index.file.df.select(F.pmod(F.xxhash64("block"), F.lit(index.shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "dims", "n", "rows", "ids", "labels", "codes", "low", "high", "vectors",
                                  *null("bigint", "row", "id", "label"), *null("binary", "vector"), *null("array<bigint>", *more))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(index.shards - 1))).alias("shard"), F.lit(1).alias("kind"), "dims", F.lit(0).alias("n"), *null("binary", "rows", "ids", "labels", "codes", "low", "high", "vectors"), "row", "id", "label", "vector", *more)
    dealt = blocks.unionByName(asked).repartitionById(index.shards, F.col("shard")).sortWithinPartitions("shard", "kind")
    hits = dealt.mapInArrow(_search(k, same, least, most), _HIT)
    rank = F.row_number().over(Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), "vec_id", "row"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(index: Index, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every anchor and each of its first ``positives``
    rows of the same label the first ``negatives`` rows of other labels with ``least`` to ``most`` hundredths of the positive's score."""
    modest(index.file.spark)
    first = _run(index, index.anchors(), positives, True)
    # a few rows an anchor; written, since dealing out what follows reads them twice
    own = Saved(first.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p")), "positives")
    windows = own.df.select(F.col("anchor_row").alias("row"), F.col("p.vec_id").alias("positive_ids"), F.col("p.score").alias("positive_scores"))
    found = _run(index, index.anchors().join(windows, "row"), negatives, False, least, most)
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

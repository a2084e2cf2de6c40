"""Approximate nearest neighbours by a robust-pruned directed graph.

Distinct vectors are dealt into shards by a hash. In each shard a graph is built: greedy searches from an entry point propose
neighbours for a batch of nodes at a time, relaxed distance pruning (factor ALPHA) keeps diverse edges, reverse edges are
added and pruned alike. Queries are beam searches (width BEAM) in every shard; the best of all shards are merged, and their
distances are computed in double precision on the original vectors.

Copies of one vector are one node. A node keeps its k + 1 smallest ids, which is all that a result of k can need, so a vector
that a third of all rows share is one node and not a bucket.

Scale: a shard has SHARD nodes or, beyond SHARD * TASKS vectors, as many as make TASKS shards, but never more than LARGEST nodes or
MEMORY bytes; it is built by one task, and the graph is written to the shared folder. Larger shards are searched by wider beams, by
the root of their size, since recall would fall otherwise. For searching, the nodes of a shard come first in a
task and queries stream by in batches; a query sends k rows a shard to the merge, never more. The driver sees one number.

Defined cases: vectors null, zero, or holding null or non-finite components, and rows with a null id, take no part; vectors are
compared only with those of the same number of components, in single precision on the way if they are given so and their
squares fit, else in double;
with fewer than k candidates all are returned; other columns are ignored. A query leaves out one row of its own id and vector:
itself. Further rows of its id, or equal rows, are candidates like any other, and a repeated query gives its result again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Saved, by_ids

SHARD, LARGEST, TASKS, MEMORY = 8192, 65_536, 4096, 256_000_000
DEGREE, BEAM, BUILD_BEAM, ALPHA = 32, 128, 48, 1.2
BATCH = 256


def _distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances from each row of ``to`` (b, d) to each of x (b, n, d); what overflows is merely very far."""
    with np.errstate(over="ignore"):
        diff = x - to[:, None, :]
        return np.minimum(np.einsum("bnd,bnd->bn", diff, diff), np.finfo(x.dtype).max)


def beam_search(vectors: np.ndarray, edges: np.ndarray, entry: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``beam`` best nodes found and their squared distances, nearest first; -1 fills up.

    All queries advance together: each expands its nearest node that it has not expanded, until none is left.
    """
    n, b = len(vectors), len(queries)
    ids = np.full((b, beam), -1, np.int64)
    dist = np.full((b, beam), np.inf, vectors.dtype)
    m = min(beam, len(entry))
    d0 = _distances(np.broadcast_to(vectors[entry[:m]], (b, m, vectors.shape[1])), queries)
    order = np.argsort(d0, axis=1, kind="stable")
    ids[:, :m], dist[:, :m] = entry[:m][order], np.take_along_axis(d0, order, 1)
    done = np.zeros((b, beam), bool)
    seen = np.zeros((b, n), bool)
    seen[:, entry[:m]] = True
    live = np.arange(b)
    while len(live):
        todo = ~done[live] & (ids[live] >= 0)
        has = todo.any(1)
        live = live[has]
        if not len(live):
            break
        at = todo[has].argmax(1)
        done[live, at] = True
        near = edges[ids[live, at]]
        fresh = near >= 0
        safe = np.where(fresh, near, 0)
        fresh &= ~seen[live[:, None], safe]
        seen[np.broadcast_to(live[:, None], near.shape)[fresh], near[fresh]] = True
        d = np.where(fresh, _distances(vectors[safe], queries[live]), np.inf).astype(vectors.dtype)
        all_d = np.concatenate((dist[live], d), 1)
        all_i = np.concatenate((ids[live], np.where(fresh, near, -1)), 1)
        all_done = np.concatenate((done[live], np.zeros(near.shape, bool)), 1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        dist[live], ids[live], done[live] = (np.take_along_axis(a, best, 1) for a in (all_d, all_i, all_done))
        ids[live] = np.where(np.isfinite(dist[live]), ids[live], -1)
    return ids, dist


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """At most ``degree`` diverse neighbours for each node out of its candidates (b, c); -1 fills up.

    The nearest candidate stays; those that are nearer to it by the factor alpha than to the node go; and so on.
    """
    cand = np.where(candidates == nodes[:, None], -1, candidates)
    cand = -np.sort(-cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    points = vectors[np.maximum(cand, 0)]
    d = np.where(cand >= 0, _distances(points, vectors[nodes]), np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, : 4 * degree]
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    points = np.take_along_axis(points, order[:, :, None], 1)
    alive = np.isfinite(d)
    out = np.full((len(nodes), degree), -1, np.int64)
    rows = np.arange(len(nodes))
    for k in range(degree):
        has = alive.any(1)
        if not has.any():
            break
        pick = np.where(alive, d, np.inf).argmin(1)
        out[has, k] = cand[rows[has], pick[has]]
        between = _distances(points, points[rows, pick])
        alive &= ~((alpha * alpha * between <= d) & has[:, None])
        alive[rows, pick] = False
    return out


def build_graph(vectors: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(edges (n, DEGREE), entry points) over the rows of ``vectors``."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    edges = np.full((n, DEGREE), -1, np.int64)
    if n <= 1:
        return edges, np.arange(n)
    if n <= DEGREE:  # everyone knows everyone
        for i in range(n):
            edges[i, : n - 1] = np.delete(np.arange(n), i)
        return edges, np.arange(min(n, 4))
    few = min(DEGREE // 2, n - 1)
    edges[:, :few] = (np.arange(n)[:, None] + rng.integers(1, n, (n, few))) % n
    centre = vectors.mean(0)
    medoid = int(((vectors - centre) ** 2).sum(1).argmin())
    entry = np.unique(np.concatenate(([medoid], rng.choice(n, min(n, 8), replace=False))))
    entry = np.concatenate(([medoid], entry[entry != medoid]))
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for i in range(0, n, BATCH):
            nodes = order[i : i + BATCH]
            found, _ = beam_search(vectors, edges, entry, vectors[nodes], BUILD_BEAM)
            edges[nodes] = robust_prune(vectors, nodes, np.concatenate((found, edges[nodes]), 1), alpha=alpha)
            # reverse edges: into free places, and by pruning where there is none
            src = np.repeat(nodes, DEGREE)
            dst = edges[nodes].ravel()
            src, dst = src[dst >= 0], dst[dst >= 0]
            by = np.argsort(dst, kind="stable")
            src, dst = src[by], dst[by]
            heads, first = np.unique(dst, return_index=True)
            rank = np.arange(len(dst)) - np.repeat(first, np.diff(np.append(first, len(dst))))
            wide = np.full((len(heads), int(rank.max()) + 1), -1, np.int64)
            wide[np.searchsorted(heads, dst), rank] = src
            merged = np.concatenate((edges[heads], wide), 1)
            merged = -np.sort(-merged, axis=1)
            merged[:, 1:][merged[:, 1:] == merged[:, :-1]] = -1
            merged = -np.sort(-merged, axis=1)
            full = (merged >= 0).sum(1) > DEGREE
            edges[heads[~full]] = merged[~full, :DEGREE]
            for j in range(0, int(full.sum()), BATCH):
                some = np.flatnonzero(full)[j : j + BATCH]
                edges[heads[some]] = robust_prune(vectors, heads[some], merged[some], alpha=alpha)
    return edges, entry


_FIELDS = "shard int, node int, vector array<{}>, ids array<bigint>, edges array<int>, entry boolean"


def _working(vectors: np.ndarray) -> np.ndarray:
    """The vectors as they are searched: in double precision where squares in single precision could vanish or overflow."""
    most = float(np.abs(vectors).max()) if vectors.size else 1.0
    return np.ascontiguousarray(vectors, dtype=vectors.dtype if 1e-12 < most < 1e15 else np.float64)


def _rows(column: pa.Array, width: int | None = None) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if width is None else flat.reshape(-1, width)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard, dimensions included in the shard; each is built when it is complete."""
    for shard, table in _by_shard(batches):
        vectors = _working(_rows(table.column("vector").combine_chunks()))
        edges, entry = build_graph(vectors)
        is_entry = np.zeros(len(vectors), bool)
        is_entry[entry] = True
        for i in range(0, len(vectors), 4096):
            part = table.slice(i, 4096)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(part.num_rows, shard, np.int32)), pa.array(np.arange(i, i + part.num_rows, dtype=np.int32)), part.column("vector").combine_chunks(), part.column("ids").combine_chunks(),
                 pa.array(edges[i : i + 4096].astype(np.int32).tolist(), pa.list_(pa.int32())), pa.array(is_entry[i : i + 4096])],
                ["shard", "node", "vector", "ids", "edges", "entry"],
            )


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        edges = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            if held and held[0].column("shard")[0].as_py() != shards[a]:
                yield held[0].column("shard")[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held[0].column("shard")[0].as_py(), pa.Table.from_batches(held)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per shard first its nodes, then queries."""
        shard, nodes, graph = None, [], None
        for batch in batches:
            kinds, shards = batch.column("kind").to_numpy(), batch.column("shard").to_numpy()
            change = np.flatnonzero((shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            edges = [0, *change.tolist(), len(kinds)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if shards[a] != shard:
                    shard, nodes, graph = int(shards[a]), [], None
                if kinds[a] == 0:
                    nodes.append(part)
                    continue
                if not nodes:
                    continue
                if graph is None:
                    t = pa.Table.from_batches(nodes).combine_chunks()
                    graph = (_rows(t.column("vector").combine_chunks()), _rows(t.column("edges").combine_chunks(), DEGREE).astype(np.int64), np.flatnonzero(t.column("entry").to_numpy(zero_copy_only=False)), t.column("ids").combine_chunks())
                yield from _answers(part, graph, k)

    return run


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of b (r, d) to a (r, n, d) in double precision."""
    with np.errstate(over="ignore", under="ignore"):
        diff = a.astype(np.float64) - b[:, None, :].astype(np.float64)
        out = np.sqrt((diff**2).sum(2))
        odd = ~np.isfinite(out) | (out == 0)  # the squares may have overflowed or vanished
        if odd.any():
            most = np.abs(diff[odd]).max(1)
            out[odd] = np.where(most > 0, most * np.sqrt(((diff[odd] / np.where(most > 0, most, 1)[:, None]) ** 2).sum(1)), 0.0)
    return np.minimum(out, np.finfo(np.float64).max)


def _answers(part: pa.RecordBatch, graph: tuple, k: int) -> Iterator[pa.RecordBatch]:
    vectors, edges, entry, ids = graph
    near, beam = _working(vectors), int(BEAM * max(1.0, len(vectors) / SHARD) ** 0.5)
    offsets, flat = ids.offsets.to_numpy() - ids.offsets[0].as_py(), ids.flatten().to_numpy()
    all_queries, asked = _rows(part.column("vector")), _rows(part.column("ids"), 3)
    for i in range(0, len(all_queries), BATCH):
        queries = all_queries[i : i + BATCH]
        kind = np.result_type(near, _working(queries))
        found, _ = beam_search(near.astype(kind, copy=False), edges, entry, np.ascontiguousarray(queries, kind), max(beam, k + 1))
        exact = np.where(found >= 0, _exact(vectors[np.maximum(found, 0)], queries), np.inf)
        out: list[tuple] = []
        for r, (qid, row, times) in enumerate(asked[i : i + BATCH].tolist()):
            # all that tie with the (k + 1)-th: ids decide among them
            last = np.sort(exact[r])[: k + 1][-1]
            order = np.flatnonzero((exact[r] <= last) & np.isfinite(exact[r]))
            hits = [(float(exact[r][j]), int(v)) for j in order for v in flat[offsets[found[r][j]] : offsets[found[r][j] + 1]]]
            if (0.0, qid) in hits:
                hits.remove((0.0, qid))
            out += [(qid, row, times, v, d) for d, v in sorted(hits)[:k]]
        cols = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.float64())], ["query_id", "row", "times", "vec_id", "score"])


def _wide(vectors: DataFrame) -> str:
    """The type of the components: float if they are given so, else double."""
    kind = vectors.schema["embedding"].dataType
    return "float" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "double"


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector): rows that take part."""
    wide = _wide(embeddings)
    v = F.col("embedding").cast(f"array<{wide}>")
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    finite = "forall(vector, x -> coalesce(NOT isnan(x) AND abs(x) < double('infinity'), false))"
    # -0.0 and 0.0 are one value
    return rows.where(F.expr(f"{finite} AND exists(vector, x -> x <> 0)")).withColumn("vector", F.expr(f"transform(vector, x -> x + {wide}(0))"))


class Index:
    """The written graph of all usable vectors: ``df`` (shard, node, vector, ids, edges, entry) and ``layout`` (dims, base, parts)."""

    def __init__(self, graph: Saved, layout: Saved, shards: int, k: int, wide: str):
        self.graph, self.layout, self.shards, self.k, self.wide, self.df = graph, layout, shards, k, wide, graph.df

    def drop(self) -> None:
        self.graph.drop()
        self.layout.drop()


def build_index(embeddings: DataFrame, shard: int = SHARD, k: int = 10) -> Index:
    """The graph, for results of ``k`` at most; ``shard`` is the least size of a shard."""
    wide = _wide(embeddings)
    rows = usable(embeddings)
    # the smallest ids of each distinct vector; the limit is applied before rows are dealt out
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    distinct = Saved(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.size("vector").alias("dims")), "vectors")
    sizes = distinct.df.groupBy("dims").agg(F.count(F.lit(1)).alias("n"))
    most = F.floor(F.lit(MEMORY) / (F.col("dims") * (4 if wide == "float" else 8) + DEGREE * 8))
    parts = sizes.withColumn("parts", F.ceil(F.col("n") / F.greatest(F.lit(1), F.least(most, F.lit(max(shard, LARGEST)), F.greatest(F.lit(shard), F.ceil(F.col("n") / TASKS))))))
    # one row a number of components
    before = F.coalesce(F.sum("parts").over(Window.orderBy("dims").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    layout = Saved(parts.select("dims", before.alias("base"), "parts"), "layout")
    shards = layout.df.agg(F.sum("parts")).first()[0] or 0
    number = (F.pmod(F.xxhash64(F.element_at("ids", 1)), F.col("parts")) + F.col("base")).cast("int")
    # shards are numbered from 0, so ranges of the number deal them out evenly
    dealt = by_ids(distinct.df, layout.df, "dims", "inner").select(number.alias("shard"), "vector", "ids").repartitionByRange(max(1, shards), "shard")
    graph = Saved(dealt.sortWithinPartitions("shard", F.element_at("ids", 1)).mapInArrow(_build, _FIELDS.format(wide)), "graph")
    distinct.drop()
    return Index(graph, layout, shards, k, wide)


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each usable query (vec_id, embedding), itself left out."""
    if k > index.k:
        raise ValueError(f"the index is built for results of {index.k}")
    wide = "float" if index.wide == _wide(queries) == "float" else "double"
    vector = F.col("vector").cast(f"array<{wide}>").alias("vector")
    q = usable(queries).groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("times")).withColumn("dims", F.size("vector"))
    own = F.array("vec_id", F.xxhash64("vector"), "times").alias("ids")
    asked = by_ids(q, index.layout.df, "dims", "inner").select(F.explode(F.expr("sequence(int(base), int(base + parts - 1))")).alias("shard"), F.lit(1).alias("kind"), F.lit(0).alias("node"), vector, own, F.lit(None).cast("array<int>").alias("edges"), F.lit(False).alias("entry"))
    nodes = index.df.select("shard", F.lit(0).alias("kind"), "node", vector, "ids", "edges", "entry")
    both = nodes.unionByName(asked).repartitionByRange(max(1, index.shards), "shard").sortWithinPartitions("shard", "kind", "node")
    found = both.select("shard", "kind", "vector", "ids", "edges", "entry").mapInArrow(_search(k), "query_id bigint, row bigint, times bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "row").orderBy("score", "vec_id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.withColumn("again", F.explode(F.expr("sequence(1L, times)"))).select("query_id", "rank", "vec_id", "score")

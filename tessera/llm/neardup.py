"""MinHash near-dedup with SetSketch registers.

A document's set is its distinct k-word shingles. Its sketch has REGISTERS exponentially spaced, truncated minima
(SetSketch, base B, rate A): register i is floor(1 - log_B(x_i)) of the smallest of Exp(A)-distributed hash values x_i,
so sketches merge by maximum and equal registers are about as likely as the Jaccard similarity.

1. Documents of one shingle set form a class; its smallest id stands for it.
2. Bands of ROWS registers give bucket keys. Pairs at the threshold share no bucket with probability of about
   (1 - t^ROWS)^(REGISTERS / ROWS): 3e-11 at 0.85, 5e-8 at 0.8.
3. In each bucket every member meets the bucket's smallest id (a star, not all pairs). The joint likelihood of the
   registers and the known set sizes estimates the similarity; pairs more than SIGMAS deviations below the threshold go.
4. Each member's likeliest partner is verified on full sets; the links give components.
5. What is left are pairs that share a bucket and are in different components; pairs inside a component cannot change the
   result. Their members' shingles are put in one order, rare ones first. Texts at the threshold must share a shingle among
   the first n - ceil(t n) + 1 of either, early enough for the rest to reach the overlap (prefix and position filters, both
   exact). A text that only resembles others below the threshold has rare shingles of its own in front and meets nobody.
   A shingle of one text only counts for nothing but its size, so texts of one size with the same shared shingles are a kind:
   they are alike to each other and to any other kind all in the same measure, and one of them stands for it.
   In each such shingle's list every kind meets the one with the fewest rare shingles before it; then what is still in
   different components and passes both filters is verified pair by pair. Both filters depend on sizes and places only, so a
   list's sizes meet before its rows do: n texts of one template that are below the threshold give no pair to look at, n texts
   above it are one component by then. No bucket is capped.

Scale: texts move once for the members of candidate pairs, sketches are 256 bytes a document, buckets 24 bytes a band.
Hot classes and buckets are aggregated map-side before they are dealt out; joins to their one row are split by AQE.

Defined cases: null and empty texts have an empty set, are linked with nothing and kept; rows with a null id are kept, with
a null component; repeated rows of an id are all listed and share its component, which links of any of their texts extend;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Saved, batches_of, modest, by_ids

REGISTERS, ROWS = 128, 4
B, A, Q = 1.001, 20.0, 2**16 - 2
SIGMAS = 6
#: Bytes of a text that are hashed at a time, and shingles that leave a task at a time.
PIECE, HELD = 1 << 16, 1 << 17

_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**64, REGISTERS, dtype=np.uint64)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PLACE = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _P and of its inverse modulo 2^64, n at least."""
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in enumerate((_P, pow(_P, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def _pieces(b: np.ndarray) -> Iterator[np.ndarray]:
    """``b`` in pieces of about PIECE bytes that end at blanks, so that a long text needs little memory beside its own."""
    at = 0
    while len(b) - at > PIECE:
        end = at + PIECE
        while end < len(b) and not (blank := np.flatnonzero(_SPACE[b[end : end + PIECE]])).size:
            end += PIECE
        end = min(len(b), end + int(blank[0]) if end < len(b) else end)
        yield b[at:end]
        at = end
    yield b[at:]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word [^\\x20\\x09-\\x0D]+ of the text, A-Z lower-cased."""
    out = []
    for b in _pieces(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)):
        inside = ~_SPACE[b]
        starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1])))
        if len(starts):
            up, down = _power(len(b))
            out.append(_mix(np.add.reduceat(_BYTE[b] * up[: len(b)] * inside, starts) * down[starts]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct hashes of the k-word shingles; of the whole sequence if it is shorter; empty without words."""
    h = word_hashes(text or "")
    n = len(h)
    if not n:
        return h
    width = min(n, k)
    s = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        s += h[j : n - width + 1 + j] * _PLACE[j]
    return np.unique(_mix(s + np.uint64(width)))


def registers(elements: np.ndarray) -> np.ndarray:
    """The SetSketch of a set of 64-bit hashes; sketches of a union are the maxima."""
    if not len(elements):
        return np.zeros(REGISTERS, np.uint16)
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(elements), 512):
        np.minimum(low, (elements[i : i + 512][None, :] * _MUL[:, None] + _ADD[:, None]).min(axis=1), out=low)
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16)) / A
    return np.clip(np.floor(1 - np.log(np.maximum(x, 1e-300)) / np.log(B)), 0, Q + 1).astype(np.uint16)


def likely_similarity(ka: np.ndarray, kb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The Jaccard similarity at which the registers (one row a pair) and the set sizes are likeliest."""
    above, below = (ka > kb).sum(1).astype(float), (ka < kb).sum(1).astype(float)
    equal = REGISTERS - above - below
    u, v = na / (na + nb), nb / (na + nb)

    def p(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B), 1e-12, 1)

    def value(j: np.ndarray) -> np.ndarray:
        pa_, pb_ = p(u - v * j), p(v - u * j)
        return above * np.log(pa_) + below * np.log(pb_) + equal * np.log(np.clip(1 - pa_ - pb_, 1e-12, 1))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = value(a) < value(b)
        lo, hi = np.where(left, a, lo), np.where(left, hi, b)
    return (lo + hi) / 2


def _sketcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            n, keys, regs = [], [], []
            for t in batch.column("text"):
                s = shingle_set(t.as_py(), k)
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "n", "key", "regs"])

    return run


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches_of(batches):
        if not b.num_rows:
            continue
        ka, kb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
        est = likely_similarity(ka, kb, b.column("na").to_numpy().astype(float), b.column("nb").to_numpy().astype(float))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(est)], ["a", "b", "est"])


def _verifier(k: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches_of(batches):
            keep = []
            for a, b in zip(batch.column("ta"), batch.column("tb"), strict=True):
                x, y = shingle_set(a.as_py(), k), b.as_py()
                if last[0] != y:
                    last = (y, shingle_set(y, k))
                both = len(np.intersect1d(x, last[1], assume_unique=True))
                keep.append(both > 0 and den * both >= num * (len(x) + len(last[1]) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def components(edges: DataFrame) -> Saved:
    """(v, comp) for every end of ``edges`` (a, b): the smallest vertex reachable. Minimum labels with pointer jumping."""
    both = Saved(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = Saved(both.df.groupBy(F.col("a").alias("v")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        at = labels.df
        near = both.df.join(at.select(F.col("v").alias("b"), "comp"), "b").groupBy(F.col("a").alias("v")).agg(F.min("comp").alias("near"))
        step = at.join(near, "v").select("v", F.col("comp").alias("was"), F.least("comp", "near").alias("via"))
        far = at.select(F.col("v").alias("via"), F.col("comp").alias("far"))
        new = Saved(step.join(far, "via").select("v", F.least("via", "far").alias("comp"), "was"), "labels")
        labels.drop()
        changed = new.df.where("comp <> was").limit(1).count()
        labels = new
        if not changed:
            both.drop()
            labels.df = labels.df.select("v", "comp")
            return labels


def _with_sketches(pairs: DataFrame, classes: DataFrame, num: int, den: int, least: float) -> DataFrame:
    """Pairs (a, b) that the set sizes allow and whose registers make the threshold likely enough, with the estimate."""
    a = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    b = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    sized = pairs.join(a, "a").join(b, "b").where(den * F.least("na", "nb") >= num * F.greatest("na", "nb"))
    return sized.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_estimate, "a bigint, b bigint, est double").where(F.col("est") >= least)


def _verified(pairs: DataFrame, docs: DataFrame, k: int, num: int, den: int, made: list[Saved]) -> DataFrame:
    ids = Saved(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ids")
    texts = Saved(by_ids(docs, ids.df, "doc_id", "left_semi"), "texts")
    a = texts.df.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    b = texts.df.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    links = Saved(pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(_verifier(k, num, den), "a bigint, b bigint"), "links")
    ids.drop()
    texts.drop()
    made.append(links)
    return links.df


def _reach(n: str, place: str, m: str, other: str, num: int, den: int) -> str:
    """The sizes and what follows a shared shingle allow the overlap that the threshold asks for."""
    return f"{den} * least({n}, {m}) >= {num} * greatest({n}, {m}) AND {num + den} * (1 + least({n} - {place}, {m} - {other})) >= {num} * ({n} + {m})"


def _shingler(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(reps: list[int], texts: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            n = np.array([len(x) for x in sets], np.int64)
            return pa.RecordBatch.from_arrays([*(pa.array(np.repeat(np.array(c, np.int64), n)) for c in (reps, texts, n)), pa.array(np.concatenate(sets).view(np.int64))], ["rep", "text", "n", "token"])

        reps, texts, sets, held = [], [], [], 0
        for batch in batches_of(batches):
            for rep, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = t.as_py() or ""
                reps.append(rep)
                texts.append(int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True))
                sets.append(shingle_set(text, k))
                held += len(sets[-1])
                if held >= HELD:
                    yield rows(reps, texts, sets)
                    reps, texts, sets, held = [], [], [], 0
        if reps:
            yield rows(reps, texts, sets)

    return run


def _prefixes(ids: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(rep, n, token, place, s, h1, h2): the shingles in the prefix of each set that another set has too, rare ones first.

    place counts from 1 over the whole set; s, h1 and h2 are the number and two hashes of all shared shingles of the set.
    """
    texts = by_ids(docs, ids.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    tokens = Saved(texts.mapInArrow(_shingler(k), "rep bigint, text bigint, n bigint, token bigint"), "tokens")
    met = tokens.df.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = tokens.df.join(met, "token")
    by_rep = Window.partitionBy("rep", "text")  # rows of one id may have texts of their own
    hashes = (F.bit_xor(h).over(by_rep).alias(c) for c, h in (("h1", F.col("token")), ("h2", F.xxhash64("token"))))
    counted = shared.select("rep", "n", "token", F.row_number().over(by_rep.orderBy("df", "token")).alias("nth"), F.count(F.lit(1)).over(by_rep).alias("s"), *hashes)
    placed = counted.withColumn("place", F.col("n") - F.col("s") + F.col("nth"))
    return placed.where(f"place <= n - ceil({num} * n / {den}) + 1").select("rep", "n", "token", "place", "s", "h1", "h2")


def _kind_comps(members: DataFrame, labels: Saved) -> DataFrame:
    """(rep, comp) for the representative of each kind: the component of all its members, or a name of its own if there are several."""
    found = _placed(members, labels).groupBy(F.col("kind").alias("rep")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return found.select("rep", F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat(F.lit("kind "), "rep")).alias("comp"))


def _spread(found: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): links of kinds handed on to their members, each to one kind that theirs is linked with."""
    both = found.select("a", "b").union(found.select("b", "a"))
    partner = both.groupBy(F.col("a").alias("kind")).agg(F.min("b").alias("b"))
    return members.where("rep <> kind").join(partner, "kind").select(F.col("rep").alias("a"), "b")


def _placed(rows: DataFrame, labels: Saved) -> DataFrame:
    """``rows`` with the component of rep; itself where it has no link."""
    return rows.join(labels.df.select(F.col("v").alias("rep"), F.col("comp").alias("__comp")), "rep", "left").withColumn("comp", F.coalesce("__comp", "rep")).drop("__comp")


def _several(rows: DataFrame, key: str, made: list[Saved]) -> DataFrame:
    """The rows whose key holds several components, with the largest of these as ``big``."""
    sizes = rows.groupBy(key, "comp").agg(F.count(F.lit(1)).alias("size"))
    split = sizes.groupBy(key).agg(F.max_by("comp", F.struct("size", "comp")).alias("big"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    # written, so that the join deals out both sides anew and AQE can split a hot key
    made.append(Saved(split.select(key, "big"), "split"))
    return rows.join(made[-1].df, key)


def _across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are in different components."""
    a, b = (comps.select(F.col("rep").alias(c), F.col("comp").alias("c" + c)) for c in "ab")
    return pairs.join(a, "a").join(b, "b").where("ca <> cb").select("a", "b")


def _sized(rows: DataFrame, num: int, den: int) -> DataFrame:
    """``rows`` with ``most``: the largest set that this one can still reach the overlap with, given what follows the shingle."""
    return rows.withColumn("most", F.expr(f"least(({num + den} * (1 + n - place)) div {num} - n, ({den} * n) div {num})"))


def _open_pairs(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs across components that pass both filters: all but a token's largest component against all others.

    Both filters say only: the larger set is at most ``most`` of the smaller one, and the smaller one at most ``most`` of the
    larger. So a list's sizes meet first, each once, and rows only where their sizes do: alike texts that cannot be at the
    threshold cost a row each, not a row a pair.
    """
    sized = _sized(rows, num, den)
    small, large = sized.where("most >= n"), sized.where(f"{den} * most >= {num} * n")
    met = None
    for s, l in ((small.where("comp <> big"), large), (small.where("comp = big"), large.where("comp <> big"))):
        ks = s.select("token", F.col("n").alias("nx"), F.col("most").alias("mx")).distinct()
        kl = l.select("token", F.col("n").alias("ny"), F.col("most").alias("my")).distinct()
        sizes = ks.join(kl, "token").where("nx <= ny AND ny <= mx AND nx <= my")
        x = s.select("token", F.col("n").alias("nx"), F.col("most").alias("mx"), F.col("rep").alias("x"), F.col("comp").alias("cx"))
        y = l.select("token", F.col("n").alias("ny"), F.col("most").alias("my"), F.col("rep").alias("y"), F.col("comp").alias("cy"))
        part = x.join(sizes, ["token", "nx", "mx"]).join(y, ["token", "ny", "my"]).where("cx <> cy").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        met = part if met is None else met.unionByName(part)
    return met.distinct()


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; links are pairs with den * intersection >= num * union."""
    modest(docs.sparkSession)
    docs = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    t = num / den
    least = max(0.0, t - SIGMAS * (t * (1 - t) / REGISTERS) ** 0.5)
    made: list[Saved] = []
    sketches = Saved(docs.mapInArrow(_sketcher(k), "doc_id bigint, n bigint, key binary, regs binary"), "sketches")
    full = sketches.df.where("doc_id IS NOT NULL AND key IS NOT NULL")
    classes = Saved(full.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("regs").alias("regs")), "classes")
    width = ROWS * 2
    bands = F.explode(F.expr(f"transform(sequence(0, {REGISTERS // ROWS - 1}), i -> xxhash64(i, substring(regs, i * {width} + 1, {width})))"))
    rows = classes.df.select("rep", "n", bands.alias("bucket"))
    hubs = Saved(rows.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1"), "hubs")
    members = Saved(rows.join(hubs.df.select("bucket", "hub"), "bucket"), "members")
    star = members.df.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    likely = _with_sketches(star, classes.df, num, den, least)
    first = Saved(likely.groupBy("a").agg(F.max_by("b", F.struct("est", "b")).alias("b")), "first")
    links = _verified(first.df, docs, k, num, den, made)
    # an id of several texts belongs with the classes of all of them
    shared_ids = Saved(full.select("doc_id", "key").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("doc_id"), "shared-ids")
    made.append(shared_ids)
    if shared_ids.df.limit(1).count():
        several = by_ids(full.select("doc_id", "key"), shared_ids.df, "doc_id", "left_semi").join(classes.df.select("key", "rep"), "key")
        made.append(Saved(several.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "own"))
        links = links.union(made[-1].df)
    labels = components(links)
    # the members of buckets that hold several components
    placed = _placed(members.df.select("bucket", "rep"), labels)
    mixed = Saved(_several(placed, "bucket", made).select("rep").distinct(), "mixed")
    made += [hubs, members, first, mixed]
    if mixed.df.limit(1).count():
        rest = Saved(_prefixes(mixed.df, docs, k, num, den), "prefixes")
        same = ["n", "s", "h1", "h2"]
        heads = rest.df.where("place = n - s + 1")  # one row a text
        kinds = Saved(heads.groupBy(*same).agg(F.min("rep").alias("kind")), "kinds")
        kin = Saved(heads.join(kinds.df, same).select("rep", "kind", "n", "s"), "kin")
        lists = Saved(rest.df.join(kinds.df.select(F.col("kind").alias("rep")), "rep", "left_semi").select("rep", "n", "token", "place"), "lists")
        alike = Saved(kin.df.where(f"rep <> kind AND {den} * s >= {num} * (2 * n - s)").select(F.col("rep").alias("a"), F.col("kind").alias("b")), "alike")
        least_of = lists.df.groupBy("token").agg(F.min_by(F.struct("rep", "n", "place"), F.struct("place", "rep")).alias("h"), F.count(F.lit(1)).alias("size")).where("size > 1")
        hub = Saved(least_of.select("token", "h.*").toDF("token", "h", "nh", "ph"), "token-hubs")
        near = lists.df.join(hub.df, "token").where(f"rep <> h AND {_reach('n', 'place', 'nh', 'ph', num, den)}")
        shared = near.groupBy(F.col("rep").alias("a"), F.col("h").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
        best = shared.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
        made += [rest, kinds, kin, lists, alike, hub]
        for step in ("alike", "best", "open"):
            if step == "alike":
                part = alike
            elif step == "best":
                part = Saved(_across(best, _kind_comps(kin.df, labels)), "second")
            else:
                comps = Saved(_kind_comps(kin.df, labels), "kind-comps")
                several = Saved(_several(lists.df.join(comps.df, "rep"), "token", made), "several")
                part = Saved(_open_pairs(several.df, num, den), "third")
                made += [comps, several]
            made.append(part)
            if part.df.limit(1).count():
                found = _verified(part.df, docs, k, num, den, made)
                links = links.union(found if step == "alike" else found.union(_spread(found, kin.df)))
                labels.drop()
                labels = components(links)
    for s in made:
        s.drop()
    of_class = classes.df.select("key", "rep").join(labels.df.select(F.col("v").alias("rep"), "comp"), "rep", "left").select("key", F.coalesce("comp", "rep").alias("component"))
    out = sketches.df.select("doc_id", "n", "key").join(of_class, "key", "left")
    comp = F.when(F.col("key").isNull() | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` without the rows of each group but those of its smallest id; all columns stay, rows with a null id too.

    Repeated rows of the id that stays are exact copies in its own class or further texts under that id; all of them stay.
    """
    found = near_duplicates(docs, k, num, den)
    gone = Saved(found.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    names = docs.columns
    return by_ids(docs.withColumn("__gone", F.col("doc_id").cast("bigint")), gone.df, "__gone", "left_anti").select(*names)

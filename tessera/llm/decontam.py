"""Benchmark decontamination by the q-gram lemma.

A benchmark item of m characters (normalised: letters and digits lower-cased, all else one blank) leaks into a document if
a region of the document is within k = floor(ERROR * m) edits of it. An edit destroys at most q of the item's q-grams, so
such a region shares m - q + 1 - k * q of them at least, and all lie within k diagonals of each other. Shared q-grams are
counted in overlapping bands of diagonals, each at least 2 k + 1 wide; bands that meet the bound are verified by a banded
alignment. Each item takes the longest q up to Q that leaves it a bound of LEAST, and 4 at least, so every item with a budget has a
bound; bands of short items, of which common words bring many, are aligned together, row by row.

Items without a budget (8 characters at most) must occur exactly, as whole words; this is the one rule on word borders, for matches of
so few characters inside longer words are no leaks.

Scale: the index holds the benchmark only. It is shipped to every task while it has at most MAX_INDEX q-grams (proven by
counting); beyond that the benchmark is cut into blocks of that size and each block is a further pass over the documents,
so no item is left out. Documents are read whole, one after the other, without a shuffle; hits are taken PAIRS at a time, so that
neither a very long document nor a q-gram that very many items share fills a task.

Defined cases: null and empty texts leak nothing, null and empty items match nothing; repeated items each report;
repeated rows report again; rows with a null id are reported under null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches_of, modest

Q = 7
ERROR = 0.12
#: Shared q-grams that an item's q must leave it.
LEAST = 3
#: Items of up to so many characters are aligned together, so many cells at a time.
SHORT, CELLS = 64, 2_000_000
MAX_INDEX = 4_000_000
#: Hits (a place in a text with one in an item) that are held at a time.
PAIRS = 1_000_000

_P = np.uint64(0x9E3779B97F4A7C15)
_fold: list[np.ndarray] = []


def _folded() -> np.ndarray:
    if not _fold:
        t = np.full(0x110000, 32, np.uint32)
        for cp in range(0x30000):
            c = chr(cp)
            if c.isalnum():
                low = c.lower()
                t[cp] = ord(low) if len(low) == 1 else cp
        _fold.append(t)
    return _fold[0]


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points with one blank at either end, and the place in the text of each."""
    raw = _folded()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    x = np.concatenate((np.array([32], np.uint32), raw, np.array([32], np.uint32)))
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    at = np.flatnonzero(keep)
    return x[at], np.clip(at - 1, 0, max(0, len(raw)))


def qgrams(x: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of the q-gram at each place."""
    n = len(x) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(q):
        h = h * _P + x[j : j + n]
    h ^= h >> np.uint64(31)
    return h * np.uint64(0xBF58476D1CE4E5B9)


class Keys:
    """Where each of some 64-bit hashes stands among the distinct ones: a direct table, and a search for hashes that meet there."""

    def __init__(self, flat: np.ndarray):
        self.order = np.argsort(flat, kind="stable")
        self.keys, first = np.unique(flat[self.order], return_index=True)
        self.first = np.append(first, len(flat))
        self.bits = max(12, int(4 * len(self.keys)).bit_length())
        slot = self._slot(self.keys)
        self.table = np.full(1 << self.bits, -1, np.int32)
        self.table[slot] = np.arange(len(self.keys))
        self.table[slot[:-1][slot[:-1] == slot[1:]]] = -2

    def _slot(self, g: np.ndarray) -> np.ndarray:
        return (g >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``g`` whose hash is known, its number)."""
        if not len(g) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = self.table[self._slot(g)]
        some = np.flatnonzero(at != -1)
        i, g = at[some].astype(np.int64), g[some]
        open_ = np.flatnonzero(i == -2)
        i[open_] = np.minimum(np.searchsorted(self.keys, g[open_]), len(self.keys) - 1)
        real = self.keys[i] == g
        return some[real], i[real]


def gram_size(m: int, k: int) -> int:
    """The longest q up to Q that leaves an item of m characters and k edits a bound of LEAST; 4 at least, whose bound is never below 1."""
    return next((q for q in range(Q, 4, -1) if m - q + 1 - k * q >= LEAST), 4)


class Index:
    """Benchmark items: those with a budget by their q-grams, one group a length of these, the others by hash."""

    def __init__(self, items: list[tuple[int, str]]):
        self.small: list[tuple[int, np.ndarray]] = []
        exact: dict[int, list[int]] = {}
        groups: dict[int, list[tuple[int, np.ndarray, int]]] = {}
        for item, text in items:
            x = normalise(text or "")[0][1:-1]
            if not len(x):
                continue
            if k := int(ERROR * len(x)):
                groups.setdefault(gram_size(len(x), k), []).append((item, x, k))
            else:
                exact.setdefault(len(x), []).append(len(self.small))
                self.small.append((item, x))
        self.groups = [Group(q, own) for q, own in sorted(groups.items())]
        self.exact = {m: (Keys(np.array([qgrams(self.small[o][1], m)[0] for o in own], np.uint64)), np.array(own)) for m, own in exact.items()}

    def hits(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, start, end, edits) of every item's best region in the text, places in code points of the text."""
        x, at = normalise(text)
        found = [(self.small[o][0], *region) for o, region in self._whole_words(x).items()]
        found += [(group.ids[o], *region) for group in self.groups for o, region in group.hits(x).items()]
        return sorted((item, int(at[a]), int(at[max(a, b - 1)]) + 1, d) for item, a, b, d in found)

    def _whole_words(self, x: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """The first region (start, end, 0) of every item without a budget."""
        best: dict[int, tuple[int, int, int]] = {}
        for m, (keys, own) in self.exact.items():
            starts = np.flatnonzero((x[:-1] == 32)[: max(0, len(x) - m - 1)] & (x[m + 1 :] == 32)) + 1
            some, i = keys.find(qgrams(x, m)[starts])
            for first in np.unique(i, return_index=True)[1].tolist():
                for o in own[keys.order[keys.first[i[first]] : keys.first[i[first] + 1]]].tolist():
                    if np.array_equal(x[(s := int(starts[some[first]])) : s + m], self.small[o][1]):
                        best[o] = (s, s + m, 0)
        return best


class Group:
    """The q-grams of benchmark items that have one length of them."""

    def __init__(self, q: int, items: list[tuple[int, np.ndarray, int]]):
        self.q = q
        self.ids, self.x, self.k = [list(c) for c in zip(*items, strict=True)]
        self.bound = [len(x) - q + 1 - k * q for x, k in zip(self.x, self.k, strict=True)]
        keys = [qgrams(x, q) for x in self.x]
        owner = [np.full(len(g), o) for o, g in enumerate(keys)]
        place = [np.arange(len(g)) for g in keys]
        self.found = Keys(np.concatenate(keys))
        order, self.keys, self.first = self.found.order, self.found.keys, self.found.first
        self.owner, self.place = np.concatenate(owner)[order], np.concatenate(place)[order]
        # sorted, for an item's own part of a q-gram's places
        self.rank = np.repeat(np.arange(len(self.keys)), np.diff(self.first)) * len(self.ids) + self.owner
        self.k, self.bound = np.array(self.k, np.int64), np.array(self.bound, np.int64)
        self.length = np.array([len(x) for x in self.x], np.int64)
        # the order of the items by their characters
        self.alike = np.empty(len(self.x), np.int64)
        self.alike[sorted(range(len(self.x)), key=lambda o: self.x[o].tobytes())] = np.arange(len(self.x))
        # two sets of bands, each of twice the width that one set must cover, half a band apart
        self.width = 2 * (2 * self.k + 1)

    def hits(self, x: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """The best region (start, end, edits) of every item in a normalised text; of equally good ones the first."""
        best: dict[int, tuple[int, int, int]] = {}
        some, i = self.found.find(qgrams(x, self.q))
        if not len(some) or len(some) < self.bound.min():
            return best
        for low, high in self._ranges(i):
            for half, keys in self._likely_bands(some, i, low, high):
                owner, band = keys >> 40, keys & ((1 << 40) - 1)
                short = self.length[owner] <= SHORT
                self._together(x, owner[short], band[short], half, best)
                for o, at in zip(owner[~short].tolist(), band[~short].tolist(), strict=True):
                    if o not in best or best[o][2]:
                        got = self._verified(x, some, i, o, at, half)
                        if got and (o not in best or (got[2], got[0]) < (best[o][2], best[o][0])):
                            best[o] = got
        return best

    def _together(self, x: np.ndarray, owner: np.ndarray, band: np.ndarray, half: int, best: dict[int, tuple[int, int, int]]) -> None:
        """The best alignments of short items within their bands, those of one width and so one budget at a time."""
        low = band * self.width[owner] - half * (self.width[owner] // 2) - int(self.length.max())
        for w in np.unique(self.width[owner]).tolist():
            of = np.flatnonzero(self.width[owner] == w)
            of = of[np.lexsort((self.alike[owner[of]], low[of]))]
            for i in range(0, len(of), max(1, CELLS // w)):
                some = of[i : i + max(1, CELLS // w)]
                start, end, cost = align_many([self.x[o] for o in owner[some].tolist()], x, low[some], w, int(self.k[owner[some[0]]]))
                found = np.flatnonzero(end >= 0)
                found = found[np.lexsort((end[found], start[found], cost[found], owner[some[found]]))]
                first = np.unique(owner[some[found]], return_index=True)[1]
                for f in found[first].tolist():
                    o, got = int(owner[some[f]]), (int(start[f]), int(end[f]), int(cost[f]))
                    if o not in best or (got[2], got[0]) < (best[o][2], best[o][0]):
                        best[o] = got

    def _ranges(self, i: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of items that have PAIRS hits at most, or of one item each."""
        n = len(self.ids)
        if int((self.first[i + 1] - self.first[i]).sum()) <= PAIRS:
            return [(0, n)]
        met, times = np.unique(i, return_counts=True)
        each = self.first[met + 1] - self.first[met]
        post = np.repeat(self.first[met] - np.cumsum(each) + each, each) + np.arange(int(each.sum()))
        total = np.cumsum(np.bincount(self.owner[post], np.repeat(times, each), n))
        out, low = [], 0
        while low < n:
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + PAIRS, "right")))
            out.append((low, high))
            low = high
        return out

    def _pairs(self, some: np.ndarray, i: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in the text, place in the item, item) of the hits on items low to high - 1, in blocks of PAIRS or of one place of the text."""
        n = len(self.ids)
        if (low, high) == (0, n):
            first, last = self.first[i], self.first[i + 1]
        else:
            first, last = np.searchsorted(self.rank, i * n + low), np.searchsorted(self.rank, i * n + high)
        size = last - first
        ends = np.cumsum(size)
        at = done = 0
        while at < len(some):
            to = max(at + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            post = np.repeat(first[at:to] - (ends[at:to] - size[at:to] - done), size[at:to]) + np.arange(int(ends[to - 1]) - done)
            yield np.repeat(some[at:to], size[at:to]), self.place[post], self.owner[post]
            at, done = to, int(ends[to - 1])

    def _likely_bands(self, some: np.ndarray, i: np.ndarray, low: int, high: int) -> list[tuple[int, np.ndarray]]:
        """(half, item << 40 | band of each) of the bands with as many hits as the lemma asks for, counted over the whole text."""
        found, count = [np.zeros(0, np.int64)] * 2, [np.zeros(0, np.int64)] * 2
        alone = int((self.first[i + 1] - self.first[i]).sum()) <= PAIRS  # all hits come in one block
        for at, place, owner in self._pairs(some, i, low, high):
            if alone:
                # an item's hits on all diagonals together must reach its bound first
                live = (np.bincount(owner, minlength=len(self.ids)) >= self.bound)[owner]
                at, place, owner = at[live], place[live], owner[live]
            width, diagonal = self.width[owner], at - place + self.length.max()
            for half in (0, 1):
                new, times = np.unique(owner * np.int64(1 << 40) + (diagonal + half * (width // 2)) // width, return_counts=True)
                if len(found[half]):
                    new, inverse = np.unique(np.concatenate((found[half], new)), return_inverse=True)
                    times = np.bincount(inverse, np.concatenate((count[half], times))).astype(np.int64)
                found[half], count[half] = new, times
        return [(half, found[half][count[half] >= self.bound[found[half] >> 40]]) for half in (0, 1)]

    def _verified(self, x: np.ndarray, some: np.ndarray, i: np.ndarray, o: int, band: int, half: int) -> tuple[int, int, int] | None:
        """The best alignment of an item within a band. The lemma counts each q-gram of the item once; bands short of that go."""
        item, w = self.x[o], int(self.width[o])
        low = band * w - half * (w // 2) - int(self.length.max())
        part = slice(*np.searchsorted(some, (low, low + w - 1 + len(item))))
        met, diagonals = np.zeros(len(item), bool), np.zeros(w, np.int64)
        for at, place, _ in self._pairs(some[part], i[part], o, o + 1):
            inside = (at - place >= low) & (at - place < low + w)
            met[place[inside]] = True
            diagonals += np.bincount((at - place)[inside] - low, minlength=w)
        if met.sum() < self.bound[o]:
            return None
        likely = low + int(diagonals.argmax())
        if likely >= 0 and np.array_equal(x[likely : likely + len(item)], item):
            return likely, likely + len(item), 0
        return align(item, x, low, low + w - 1, int(self.k[o]))


def align(item: np.ndarray, x: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """The best alignment of the whole item with a region of ``x`` on diagonals low to high: (start, end, edits), None beyond k edits.

    Row i holds the cost of item[:i] against a region that ends at i + low + j; a region may start on any diagonal for nothing.
    """
    n, m, wide = len(x), len(item), high - low + 1
    big = m + k + 5
    d = np.arange(low, high + 1)
    cost = np.where((d >= 0) & (d <= n), 0, big).astype(np.int64)
    start = d.copy()
    steps = np.arange(wide)
    for i in range(1, m + 1):
        end = d + i  # places consumed in x
        ok = (end >= 0) & (end <= n)
        prev = np.clip(end - 1, 0, max(0, n - 1))
        replace = cost + np.where((end >= 1) & (end <= n) & (x[prev] == item[i - 1]), 0, 1)
        drop = np.append(cost[1:], big) + 1  # an item character without a partner
        new = np.where(ok, np.minimum(replace, drop), big)
        from_ = np.where(replace <= drop, start, np.append(start[1:], 0))
        # text characters without a partner: a running minimum of cost minus place
        reach = new - steps
        least = np.minimum.accumulate(reach)
        origin = np.maximum.accumulate(np.where(reach == least, steps, 0))
        cost = np.where(ok, np.minimum(least + steps, big), big)
        start = from_[origin]
        if cost.min() > k:
            return None
    j = int(cost.argmin())
    return (int(start[j]), int(d[j] + m), int(cost[j])) if cost[j] <= k else None


def align_many(items: list[np.ndarray], x: np.ndarray, low: np.ndarray, wide: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``align`` of many items, each with the diagonals low to low + wide - 1: (start, end, edits), an end of -1 beyond k edits.

    All go through their rows together. They must be sorted by low and then by their characters, so that neighbours that begin alike have
    one state until they part; those that end or can no more stay within k edits drop out.
    """
    n, m, big = len(x), np.array([len(t) for t in items]), np.int32(k + 100)
    chars = np.zeros((len(items), int(m.max())), np.uint32)
    chars[np.arange(chars.shape[1]) < m[:, None]] = np.concatenate(items)
    padded = np.concatenate((np.zeros(1, np.uint32), x, np.zeros(1, np.uint32)))  # no character before or after
    out = np.zeros(len(items), np.int64), np.full(len(items), -1, np.int64), np.full(len(items), k + 1, np.int64)
    live, steps = np.arange(len(items)), np.arange(wide, dtype=np.int32)
    # how many characters each has in common with the one before it, -1 on other diagonals
    alike = chars[1:] == chars[:-1]
    common = np.concatenate(([-1], np.where(low[1:] != low[:-1], -1, np.where(alike.all(1), chars.shape[1], alike.argmin(1)))))
    opens = np.flatnonzero(common < 0)
    state = np.cumsum(common < 0) - 1
    d = low[opens, None].astype(np.int32) + steps
    cost, start = np.where((d >= 0) & (d <= n), np.int32(0), big), d
    for i in range(1, chars.shape[1] + 1):
        opens = np.flatnonzero(common < i)
        before, char = state[opens], chars[live[opens], i - 1][:, None]
        d, cost, start = d[before], cost[before], start[before]
        state = np.cumsum(common < i) - 1
        end = d + i
        replace = cost + (padded[np.clip(end, 0, n + 1)] != char)
        drop = np.concatenate((cost[:, 1:], np.full((len(opens), 1), big, np.int32)), 1) + 1
        ok = (end >= 0) & (end <= n)
        new = np.where(ok, np.minimum(replace, drop), big)
        source = np.where(replace <= drop, start, np.concatenate((start[:, 1:], start[:, -1:]), 1))
        reach = new - steps
        least = np.minimum.accumulate(reach, axis=1)
        origin = np.maximum.accumulate(np.where(reach == least, steps, np.int32(0)), axis=1)
        cost, start = np.where(ok, np.minimum(least + steps, big), big), np.take_along_axis(source, origin, 1)
        least = cost.min(1)
        ended = m[live] == i
        at = np.flatnonzero(ended & (least[state] <= k))
        if len(at):
            of = state[at]
            j = cost[of].argmin(1)
            out[0][live[at]], out[1][live[at]], out[2][live[at]] = start[of, j], d[of, j] + i, least[of]
        stay = np.flatnonzero(~ended & (least[state] <= k))
        if not len(stay):
            break
        if len(stay) < len(live):
            # what those that stay have in common with the one that now stands before them
            common = np.minimum.reduceat(common, np.concatenate(([0], stay[:-1] + 1)))
            live, state = live[stay], state[stay]
    return out


_OUT = "doc_id bigint, item_id bigint, start bigint, end bigint, edits bigint"


def _searcher(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for b in batches_of(batches):
            rows = [(d, *h) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True) if t.is_valid for h in ix.hits(t.as_py())]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "start", "end", "edits"])

    return run


def blocks(benchmark: DataFrame, limit: int = MAX_INDEX) -> Iterator[Index]:
    """Indexes of at most ``limit`` characters each (one item at least), over all items."""
    items: list[tuple[int, str]] = []
    size = 0
    for r in benchmark.select(benchmark["item_id"].cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).orderBy("item_id", "text").toLocalIterator():
        if items and size + len(r.text) > limit:
            yield Index(items)
            items, size = [], 0
        items.append((r.item_id, r.text))
        size += len(r.text)
    if items:
        yield Index(items)


def contaminated(docs: DataFrame, benchmark: DataFrame, limit: int = MAX_INDEX) -> DataFrame:
    """(doc_id, item_id, start, end, edits) for each document and each item that it holds: the item's best region."""
    modest(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.col("text"))
    out = None
    for index in blocks(benchmark, limit):
        part = rows.mapInArrow(_searcher(sc.broadcast(index)), _OUT)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], _OUT)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, limit: int = MAX_INDEX) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay; no join, one pass a block of the benchmark."""
    modest(docs.sparkSession)
    sc = docs.sparkSession.sparkContext

    def keeper(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = index.value
            for b in batches_of(batches):
                yield b.filter(pa.array([not (t.is_valid and ix.hits(t.as_py())) for t in b.column("text")], pa.bool_()))

        return run

    for index in blocks(benchmark, limit):
        docs = docs.mapInArrow(keeper(sc.broadcast(index)), docs.schema)
    return docs

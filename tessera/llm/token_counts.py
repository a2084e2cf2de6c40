"""Token counts with edit-aware segment trees.

A document's pre-tokens are grouped into leaves that end where no pre-token can cross: before a blank that stands between two
characters that are no white space, or between a letter and a sign. So a leaf's tokens do not depend on other leaves, and a tree
of sums over the leaves gives the count of the document and of any range. An edit touches the leaves that it overlaps; they are
cut anew, together with the neighbour whose boundary context the edit may have changed, encoded again, and the sums on the path to
the root change. All other leaves keep their counts.

Trees are kept: ``build_trees`` writes each text with its leaves, ``apply_edits`` takes such a table and edits and gives the next
one, encoding only the leaves that the edits touch. The sums over the leaves are cheaper laid out anew than read, so the table
holds the leaves alone.

The vocabulary is a public byte-level BPE file; its path is a parameter. Texts are counted whole, one at a time, without a
shuffle; a tree takes 16 bytes for each LEAF characters. A run of letters without any sign or blank is one leaf, however long.

Defined cases: null text counts as empty (0 tokens, one empty leaf); null ids are kept; edits beyond the end are clipped,
null edits skipped; repeated rows are counted alike, and an edit of their id is applied to each; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Saved, batches_of, modest

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-token pattern of the vocabulary (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 400


@functools.cache
def encoder(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: Where a leaf may end: before a blank between words, or after a letter or digit that a sign of ASCII or of East Asian scripts follows.
_END = re.compile(r"(?<=\S)(?= \S)|(?<=[^\W_])(?=[!-/:-@\[-`{-~\u2010-\u2027\u3001-\u3003\u3008-\u3011\uff01-\uff0f\uff1a-\uff20])")


def cuts(text: str, start: int, end: int, size: int = LEAF) -> list[int]:
    """Places in text[start:end] where a leaf may end, at least ``size`` apart; start and end are leaf boundaries themselves."""
    out, at = [], start + size
    while at < end and (m := _END.search(text, at, end)) and m.start() < end:
        out.append(m.start())
        at = m.start() + size
    return out


class TokenTree:
    """Leaves of a document with their lengths and token counts, under a tree of sums (Fenwick layout)."""

    def __init__(self, text: str, encode, size: int = LEAF, leaves: tuple[list[int], list[int]] | None = None):
        """``leaves``: the lengths and counts of a tree that has been kept; without them the text is encoded."""
        self.text, self.encode, self.size = text, encode, size
        self.encoded = 0
        self._build(*(leaves or self._leaves(0, len(text))))

    def _leaves(self, start: int, end: int) -> tuple[list[int], list[int]]:
        edges = [start, *cuts(self.text, start, end, self.size), end]
        pieces = [self.text[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        self.encoded += len(pieces)
        return [len(p) for p in pieces], [len(self.encode(p)) if p else 0 for p in pieces]

    def _build(self, lengths: list[int], counts: list[int]) -> None:
        self.lengths, self.counts = lengths, counts
        self.length_sums, self.count_sums = self._fenwick(lengths), self._fenwick(counts)

    @staticmethod
    def _fenwick(values: list[int]) -> list[int]:
        tree = [0, *values]
        for i in range(1, len(tree)):
            if (j := i + (i & -i)) < len(tree):
                tree[j] += tree[i]
        return tree

    @staticmethod
    def _add(tree: list[int], i: int, by: int) -> None:
        i += 1
        while i < len(tree):
            tree[i] += by
            i += i & -i

    @staticmethod
    def _sum(tree: list[int], n: int) -> int:
        out = 0
        while n:
            out += tree[n]
            n -= n & -n
        return out

    def total(self) -> int:
        return self._sum(self.count_sums, len(self.counts))

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a place, and where it starts."""
        i, rest, step = 0, place, 1 << len(self.lengths).bit_length()
        while step:
            if i + step < len(self.length_sums) and self.length_sums[i + step] <= rest:
                i += step
                rest -= self.length_sums[i]
            step >>= 1
        i = min(i, len(self.lengths) - 1)
        return i, self._sum(self.length_sums, i)

    def edit(self, start: int, delete: int, insert: str) -> None:
        """Replace text[start:start + delete] by ``insert`` and encode only the leaves that this can change."""
        n = len(self.text)
        start = min(max(0, start), n)
        stop = min(n, start + max(0, delete))
        first, _ = self.leaf_at(max(0, start - 1))
        last, _ = self.leaf_at(min(stop, max(0, n - 1)))
        # the boundary context: a cut needs the character on either side
        first, last = max(0, first - 1), min(len(self.lengths) - 1, last + 1)
        low = self._sum(self.length_sums, first)
        high = self._sum(self.length_sums, last + 1)
        self.text = self.text[:start] + insert + self.text[stop:]
        lengths, counts = self._leaves(low, high + len(insert) - (stop - start))
        if len(lengths) == last + 1 - first:
            for k, (a, c) in enumerate(zip(lengths, counts, strict=True), first):
                self._add(self.length_sums, k, a - self.lengths[k])
                self._add(self.count_sums, k, c - self.counts[k])
                self.lengths[k], self.counts[k] = a, c
        else:  # leaves came or went: the sums are laid out anew, nothing else is encoded
            self._build(self.lengths[:first] + lengths + self.lengths[last + 1 :], self.counts[:first] + counts + self.counts[last + 1 :])


_EDITS = "array<struct<start:int,remove:int,insert:string>>"
_LEAVES = "lengths array<int>, counts array<int>"


def _builder(path: str, others: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for b in batches_of(batches):
            trees = [TokenTree(t.as_py() or "", encode) for t in b.column("text")]
            own = [pa.array(v, pa.list_(pa.int32())) for v in ([t.lengths for t in trees], [t.counts for t in trees])]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in others), *own], [*others, "lengths", "counts"])

    return run


def build_trees(docs: DataFrame, edits=None, vocabulary: str = VOCABULARY) -> Saved:
    """The written trees (doc_id, text, edits, lengths, counts) of all texts; ``edits``: a column to keep beside them, or None."""
    modest(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"), (edits if edits is not None else F.lit(None)).cast(_EDITS).alias("edits"))
    return Saved(rows.mapInArrow(_builder(vocabulary, rows.columns), f"doc_id bigint, text string, edits {_EDITS}, {_LEAVES}"), "trees")


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """``trees`` with the rows of ``edits`` (doc_id, seq, start, remove, insert) as their column, by seq; ids without any have none."""
    rows = edits.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("seq", "start", "remove", "insert"))).alias("__e"))
    asked = rows.select("doc_id", F.transform("__e", lambda e: e.dropFields("seq")).cast(_EDITS).alias("edits"))
    return trees.drop("edits").join(asked, "doc_id", "left").select("doc_id", "text", "edits", "lengths", "counts")


def _editor(path: str, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for b in batches_of(batches):
            numbers: tuple[list, ...] = ([], [], [], [], [])
            texts, lengths, counts = [], [], []
            for text, edits, *leaves in zip(b.column("text"), b.column("edits"), b.column("lengths"), b.column("counts"), strict=True):
                tree = TokenTree(text.as_py() or "", encode, leaves=tuple(x.as_py() for x in leaves))
                before, n = tree.total(), len(tree.counts)
                asked = [e for e in edits.as_py() or () if e and e["start"] is not None]
                for e in asked:
                    tree.edit(e["start"], e["remove"] or 0, e["insert"] or "")
                for out, v in zip(numbers, (before, n, tree.total(), tree.encoded, len(tree.text)), strict=True):
                    out.append(v)
                if whole:
                    texts.append(tree.text if asked else text.as_py())
                    lengths.append(tree.lengths)
                    counts.append(tree.counts)
            more = [pa.array(texts, pa.string()), pa.array(lengths, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))] if whole else []
            names = ["doc_id", "n_tokens", "n_leaves", "n_tokens_edited", "n_reencoded", "n_chars_edited", "text", "lengths", "counts"]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(v, pa.int64()) for v in numbers), *more], names[: 6 + len(more)])

    return run


def apply_edits(trees: DataFrame, vocabulary: str = VOCABULARY, whole: bool = True) -> DataFrame:
    """(doc_id, n_tokens, n_leaves, n_tokens_edited, n_reencoded, n_chars_edited) of trees and their edits and, if ``whole``, the new trees' columns."""
    modest(trees.sparkSession)
    out = "doc_id bigint, n_tokens bigint, n_leaves bigint, n_tokens_edited bigint, n_reencoded bigint, n_chars_edited bigint"
    return trees.select("doc_id", "text", "edits", "lengths", "counts").mapInArrow(_editor(vocabulary, whole), out + (f", text string, {_LEAVES}" if whole else ""))


def count_tokens(docs: DataFrame, edits=None, vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokens of every whole text before and after its edits, and how many leaves the edits had to encode again.

    ``edits``: a column of array<struct<start int, remove int, insert string>> in code points, applied in order; None for none.
    The trees are written first, and the edits are applied to what was written.
    """
    return apply_edits(build_trees(docs, edits, vocabulary).df, vocabulary, whole=False)

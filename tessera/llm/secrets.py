"""Secret scans with an incremental blob ledger.

Every version of a text is content-addressed by SHA-256. The ledger is a Parquet table of (blob, rule_version) pairs with
their findings; a scan reads only blobs of which the ledger has no row for the current rules, and joins findings back to
all paths (a document, or a document and a version of it) that hold the blob. The version of the rules is a hash of the kinds and
their patterns, so changed rules scan anew and nothing else does.

Scale: one shuffle of the distinct texts, combined map-side first, so a blob that a third of all rows hold leaves each map
task once. The join back to paths has one row per blob on one side, and only blobs with findings; AQE splits a hot blob.

Defined cases: null text counts as empty; null ids are kept; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches_of, exists, modest, remove, shared_dir

#: The kinds in the order in which spans of one start are listed: the base kinds first, then those the rule set adds.
KINDS = ("assign", "access", "hex", "pem", "github", "slack", "jwt")
#: Findings that redaction may broadcast, and what a row takes besides its texts.
BROADCAST_BYTES, ROW_BYTES = 24_000_000, 64

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ASSIGN_HINTS = ("passw", "secret", "token", "key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # greedy runs: the same matches as [0-9a-f]+ of 32 characters or more
_MORE = (
    ("pem", "-----BEGIN", re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,40}PRIVATE KEY-----")),
    ("github", "gh", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", "xox", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    ("jwt", "eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
)
#: What the rules are, told from their own definition.
RULE_VERSION = hashlib.sha256(repr([KINDS, *((p.pattern, p.flags) for p in (_ASSIGN, _ACCESS, _HEX, *(m[2] for m in _MORE)))]).encode()).hexdigest()[:16]


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) of a text in code points, end exclusive, by start and then kind."""
    out: list[tuple[int, int, str]] = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(h in low for h in _ASSIGN_HINTS):
            out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    for kind, hint, pattern in _MORE:
        if hint in text:
            out += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    out.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return out


FINDINGS = pa.schema(
    [("blob", pa.string()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())]
)
_LEDGER_DDL = "blob string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches):
        rows: dict[str, list] = {n: [] for n in FINDINGS.names}
        for blob, text in zip(batch.column("blob").to_pylist(), batch.column("text"), strict=True):
            spans = find_spans(text.as_py())
            counts = {k: sum(1 for s in spans if s[2] == k) for k in KINDS[:3]}
            base = ",".join(f"{k}:{a}:{b}" for a, b, k in spans if k in counts)
            rows["blob"].append(blob)
            for k in counts:
                rows[f"n_{k}"].append(counts[k])
            rows["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
            rows["spans"].append(",".join(f"{k}:{a}:{b}" for a, b, k in spans))
        yield pa.RecordBatch.from_pydict(rows, schema=FINDINGS)


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def blob_of(text: Column) -> Column:
    """The content address."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


class BlobLedger:
    """A Parquet table of scanned (blob, rule_version) pairs, partitioned by rule version, in a folder that all executors share."""

    def __init__(self, spark, path: str | None = None, rule_version: str = RULE_VERSION):
        import uuid

        self.spark, self.rule_version = spark, rule_version
        self.path = path or f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"

    @property
    def _part(self) -> str:
        return f"{self.path}/rule_version={self.rule_version}"

    def rows(self) -> DataFrame | None:
        """What has been scanned under these rules; None before the first scan. A blob has a row for each scan that wrote it: one, or
        more where two scans ran at once or an append was repeated; they say the same."""
        return self.spark.read.schema(_LEDGER_DDL).parquet(self._part) if exists(self.spark, self._part) else None

    def scan(self, docs: DataFrame) -> None:
        """Scan the blobs of ``docs`` that have no row yet and append their findings; nothing of the texts is kept."""
        modest(self.spark)
        blobs = docs.select(blob_of(_text(docs)).alias("blob"), _text(docs).alias("text")).dropDuplicates(["blob"])
        seen = self.rows()
        if seen is not None:
            blobs = blobs.join(seen.select("blob"), "blob", "left_anti")
        blobs.mapInArrow(scan_batches, _LEDGER_DDL).write.mode("append").parquet(self._part)

    def findings(self) -> DataFrame:
        """The blobs with at least one span, one row each."""
        return self.rows().where(F.col("spans") != "").dropDuplicates(["blob"])

    def drop(self) -> None:
        remove(self.spark, self.path)


def secret_findings(docs: DataFrame, ledger: BlobLedger, paths: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, blob) for every row of ``docs``; scans what the ledger lacks.

    ``paths``: the columns that name a row, such as doc_id and version for a table of all versions of the documents.
    """
    ledger.scan(docs)
    named = [docs[c].cast("bigint").alias(c) if c == "doc_id" else docs[c] for c in paths]
    out = docs.select(*named, blob_of(_text(docs)).alias("__blob")).join(ledger.findings().withColumnRenamed("blob", "__blob"), "__blob", "left")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ("n_assign", "n_access", "n_hex")]
    return out.select(*paths, *counts, F.coalesce("base_sha256", F.lit(_EMPTY_SHA)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.col("__blob").alias("blob"))


#: Merge overlapping spans, then rebuild the text from what lies between them.
_REDACT = """
CASE WHEN __spans IS NULL THEN text ELSE (
  aggregate(
    array_sort(transform(split(__spans, ','), s -> struct(int(split_part(s, ':', 2)) AS a, int(split_part(s, ':', 3)) AS b, split_part(s, ':', 1) AS k))),
    named_struct('at', 0, 'out', ''),
    (acc, s) -> named_struct(
      'at', greatest(acc.at, s.b),
      'out', CASE WHEN s.a >= acc.at THEN concat(acc.out, substring(text, acc.at + 1, s.a - acc.at), '[', upper(s.k), ']') ELSE acc.out END),
    acc -> concat(acc.out, substring(text, acc.at + 1)))
) END"""


def redact_secrets(docs: DataFrame, ledger: BlobLedger) -> DataFrame:
    """``docs`` with every span of a secret replaced by its kind in brackets; all columns and rows stay, n_chars follows the text.

    A row without secrets stays as it is, null text included. A span that overlaps the one before it disappears with it.
    """
    ledger.scan(docs)
    found = ledger.findings().select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    # the ledger is a written table, so that summing its bytes is cheap; beyond the limit the join shuffles
    size = found.agg(F.sum(F.length("__blob") + F.length("__spans") + F.lit(ROW_BYTES)).alias("size")).first().size or 0
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    names = docs.columns
    joined = docs.withColumn("__blob", blob_of(_text(docs))).join(found, "__blob", "left")
    out = {"text": F.expr(_REDACT)}
    if "n_chars" in names:
        out["n_chars"] = F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length(F.expr(_REDACT)).cast(docs.schema["n_chars"].dataType))
    return joined.withColumns(out).select(*names)

"""A Spark data source for landed bodies: what an ingester fetched, in folders by hour, read in parallel and as a stream.

    bodies.register(spark)
    df.write.format("landed").mode("append").save(path)            # outlet_id, landed_at, body
    spark.read.format("landed").load(path).where("landed_at >= '2024-01-05'")
    spark.readStream.format("landed").load(path)

Below the path lies a folder for each hour of landing (``20240105T07``), and in it files of JSON lines. Any store that Arrow's file systems
know by its address will do. A write puts its files under ``_writing`` and moves them into place when all tasks have ended, so readers
never see half of one; files that were there stay. A reader's task takes files of up to ``partBytes`` (32 MB) together, or one larger
file, and streams through it. Bounds on ``landed_at`` are pushed down to the folders, equalities and lists of ``outlet_id`` into the
tasks; Spark checks all filters again. Rows without a time land in the folder ``unknown``.

A stream's offset is the last finished hour: an hour is read when a later one has begun, so each body is read once. ``unknown`` is left to
batch reads.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("outlet_id", T.StringType()), T.StructField("landed_at", T.TimestampType()), T.StructField("body", T.StringType())])
_ARROW = pa.schema([("outlet_id", pa.string()), ("landed_at", pa.timestamp("us", tz="UTC")), ("body", pa.string())])
PART_BYTES = 32 << 20
#: Rows and bytes of text in an Arrow batch.
ROWS, BATCH_BYTES = 1000, 8 << 20


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


def _hour(at: datetime | None) -> str:
    return at.astimezone(UTC).strftime("%Y%m%dT%H") if at else "unknown"


@dataclass
class Files(D.InputPartition):
    names: list[str]

    def __init__(self, names: list[str]):
        super().__init__(0)
        self.names = names


@dataclass
class Wanted:
    """What the pushed filters leave: hours from ``first`` to ``last``, and ids (None: all)."""

    first: str = ""
    last: str = "~"
    ids: set[str] | None = None
    known: bool = False

    def take(self, f: D.Filter) -> None:
        column, value = getattr(f, "attribute", None), getattr(f, "value", None)
        if column == ("landed_at",) and isinstance(value, datetime):
            hour = _hour(value if value.tzinfo else value.replace(tzinfo=UTC))
            if isinstance(f, D.GreaterThan | D.GreaterThanOrEqual | D.EqualTo):
                self.first, self.known = max(self.first, hour), True
            if isinstance(f, D.LessThan | D.LessThanOrEqual | D.EqualTo):
                self.last, self.known = min(self.last, hour), True
        elif column == ("outlet_id",) and isinstance(f, D.EqualTo | D.In):
            ids = set(value if isinstance(f, D.In) else [value])
            self.ids = ids if self.ids is None else self.ids & ids

    def hour(self, name: str) -> bool:
        return not self.known if name == "unknown" else self.first <= name <= self.last


def _hours(path: str) -> list[str]:
    store, root = _store(path)
    found = store.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return sorted(i.base_name for i in found if i.type == pafs.FileType.Directory and not i.base_name.startswith("_"))


def _parts(path: str, hours: list[str], part_bytes: int) -> list[Files]:
    store, root = _store(path)
    out, held, size = [], [], 0
    for hour in hours:
        for i in sorted(store.get_file_info(pafs.FileSelector(posixpath.join(root, hour))), key=lambda i: i.path):
            if held and size + i.size > part_bytes:
                out.append(Files(held))
                held, size = [], 0
            held.append(i.path)
            size += i.size
    return [*out, Files(held)] if held else out


def _rows(path: str, files: Files, wanted: Wanted) -> Iterator[pa.RecordBatch]:
    store, _ = _store(path)
    held: list[dict] = []
    size = 0
    for name in files.names:
        with pa.PythonFile(store.open_input_stream(name), mode="r") as raw, pa.BufferedInputStream(raw, 1 << 20) as f:
            for line in _lines(f):
                r = json.loads(line)
                if wanted.ids is not None and r["outlet_id"] not in wanted.ids:
                    continue
                held.append(r | {"landed_at": r["landed_at"] and datetime.fromisoformat(r["landed_at"])})
                size += len(line)
                if len(held) >= ROWS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(held, _ARROW)
                    held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _ARROW)


def _lines(f) -> Iterator[bytes]:
    rest = b""
    while block := f.read(1 << 20):
        *lines, rest = (rest + block).split(b"\n") if b"\n" in block else ([rest + block])
        yield from (x for x in lines if x)
    if rest:
        yield rest


class Reader(D.DataSourceReader):
    def __init__(self, path: str, part_bytes: int):
        self.path, self.part_bytes, self.wanted = path, part_bytes, Wanted()

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:  # noqa: N802
        for f in filters:
            self.wanted.take(f)
            yield f

    def partitions(self) -> list[D.InputPartition]:
        return _parts(self.path, [h for h in _hours(self.path) if self.wanted.hour(h)], self.part_bytes) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        yield from _rows(self.path, partition, self.wanted)


class StreamReader(D.DataSourceStreamReader):
    def __init__(self, path: str, part_bytes: int):
        self.path, self.part_bytes = path, part_bytes

    def initialOffset(self) -> dict:  # noqa: N802
        return {"hour": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        done = [h for h in _hours(self.path) if h != "unknown"][:-1]
        return {"hour": done[-1] if done else ""}

    def partitions(self, start: dict, end: dict) -> list[D.InputPartition]:
        return _parts(self.path, [h for h in _hours(self.path) if start["hour"] < h <= end["hour"] and h != "unknown"], self.part_bytes)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        yield from _rows(self.path, partition, Wanted())

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Written(D.WriterCommitMessage):
    #: (file under _writing, its hour)
    files: list[tuple[str, str]] = field(default_factory=list)


class Writer(D.DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.run = path, uuid.uuid4().hex

    def write(self, rows: Iterator[T.Row]) -> Written:
        store, root = _store(self.path)
        folder = posixpath.join(root, "_writing", self.run)
        store.create_dir(folder, recursive=True)
        open_files: dict[str, tuple[str, pa.NativeFile]] = {}
        out = Written()
        for r in rows:
            hour = _hour(r["landed_at"] and (r["landed_at"] if r["landed_at"].tzinfo else r["landed_at"].replace(tzinfo=UTC)))
            if hour not in open_files:
                if len(open_files) >= 64:  # rows of many hours in no order
                    open_files.pop(next(iter(open_files)))[1].close()
                name = f"{uuid.uuid4().hex}.jsonl"
                open_files[hour] = (name, store.open_output_stream(posixpath.join(folder, name)))
                out.files.append((name, hour))
            at = r["landed_at"] and (r["landed_at"] if r["landed_at"].tzinfo else r["landed_at"].replace(tzinfo=UTC)).astimezone(UTC).isoformat()
            open_files[hour][1].write(json.dumps({"outlet_id": r["outlet_id"], "landed_at": at, "body": r["body"]}).encode() + b"\n")
        for _, f in open_files.values():
            f.close()
        return out

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        for m in messages:
            for name, hour in m.files if m else ():
                store.create_dir(posixpath.join(root, hour), recursive=True)
                store.move(posixpath.join(root, "_writing", self.run, name), posixpath.join(root, hour, name))
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        left = posixpath.join(root, "_writing", self.run)
        if store.get_file_info(left).type == pafs.FileType.Directory:
            store.delete_dir(left)


class LandedBodies(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> T.StructType:
        return SCHEMA

    def _at(self) -> tuple[str, int]:
        return self.options["path"].rstrip("/"), int(self.options.get("partBytes", PART_BYTES))

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(*self._at())

    def streamReader(self, schema: T.StructType) -> StreamReader:  # noqa: N802
        return StreamReader(*self._at())

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("landed bodies are only appended to")
        return Writer(self._at()[0])




def register(spark: SparkSession) -> None:
    """Makes the format known to the session, with its filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedBodies)

"""The topic log as a Spark data source whose reader prunes.

Conditions on topic, file, base offset and stream offset decide which folders are listed and which files are opened; those
on time, record offset and stream offset select strides of a file by its sparse index. A file that is cut into parts has
its index read once, when the parts are made, and what may not pass becomes no part. Only the columns of the schema are decoded.

The conditions are an option of the read, not filters that Spark pushes: in PySpark 4.1.2 all uses of a loaded DataFrame
share what was pushed last, so the union of two filtered halves of a log would return one of them twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from operator import eq, ge, gt, le, lt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tailrace.sources.batch import BLOBS, RECORDS, blob_reader, envelope_reader, placer
from tailrace.sources.files import locate
from tailrace.sources.index import SparseIndex, read_index
from tailrace.sources.listing import full_path, packed, topic_files

Condition = tuple[str, str, object]  # column, operator, value

_COMPARED = {"=": eq, "<": lt, "<=": le, ">": gt, ">=": ge}
_ABOUT_FILES = ("topic", "file", "base_offset")


def holds(condition: Condition, value) -> bool:
    """Whether a condition is true of ``value``; nothing is true of a null."""
    _, op, wanted = condition
    if value is None:
        return False
    if op == "in":
        return value in wanted
    return value.startswith(wanted) if op == "startswith" else _COMPARED[op](value, wanted)


def as_column(condition: Condition) -> Column:
    name, op, wanted = condition
    if op == "in":
        return F.col(name).isin(*wanted) if wanted else F.lit(False)
    if op == "startswith":
        return F.col(name).startswith(wanted)
    if op not in _COMPARED:
        raise ValueError(f"unknown operator {op}")
    return F.col(name) == wanted if op == "=" else _COMPARED[op](F.col(name), F.lit(wanted))


class _Bounds:
    """Smallest and largest value that passes all conditions on a column, as far as they tell."""

    def __init__(self, conditions: list[Condition]):
        self.low = self.high = None
        self.known = bool(conditions)
        for _, op, value in conditions:
            if op in ("=", ">", ">="):
                self.low = value if self.low is None else max(self.low, value)
            if op in ("=", "<", "<="):
                self.high = value if self.high is None else min(self.high, value)
            if op == "in" and value:
                self.low = min(value) if self.low is None else max(self.low, min(value))
                self.high = max(value) if self.high is None else min(self.high, max(value))

    def meets(self, first, last) -> bool:
        """Whether some value from ``first`` to ``last`` may pass; without values none does."""
        if not self.known:
            return True
        if first is None:
            return False
        return (self.low is None or last >= self.low) and (self.high is None or first <= self.high)


class TopicLogRecords(DataSource):
    """Records of a topic log."""

    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return RECORDS if dict(self.options).get("kind", "envelope") == "envelope" else BLOBS

    def reader(self, schema):
        return _RecordReader({k.lower(): v for k, v in self.options.items()}, schema.names)


class _Parts(InputPartition):
    """Parts of files: topic, path, base offset, size, first byte, end, and whether an index has left out what may not pass."""

    def __init__(self, parts: list[tuple]):
        self.parts = parts


class _RecordReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.base = options["path"]
        self.pattern = options["pattern"]
        self.topic_dirs = options.get("topicdirs", "true") == "true"
        self.topics = options.get("topics")
        self.tasks = int(options.get("tasks", 1))
        self.part_bytes = int(options["partbytes"])
        self.kind = options.get("kind", "envelope")
        self.starts: dict[str, int] = json.loads(options.get("startingoffsets", "{}"))
        self.columns = columns
        conditions = [tuple(c) for c in json.loads(options.get("conditions", "[]"))]
        self.about_files = [c for c in conditions if c[0] in _ABOUT_FILES]
        self.times, self.places, self.streams = (_Bounds([c for c in conditions if c[0] == name]) for name in ("time", "record_offset", "stream_offset"))

    def _passes(self, **known) -> bool:
        return all(holds(c, known[c[0]]) for c in self.about_files if c[0] in known)

    def partitions(self):
        found = topic_files(self.base, self.pattern, self.topic_dirs, self.topics, lambda topic: self._passes(topic=topic))
        paths = (full_path(self.base, f.topic, f.physical, self.topic_dirs) for f in found)
        parts = [part for f, path in zip(found, paths) for part in self.parts(f.topic, path, f.base_offset, f.size)]
        return [_Parts(p) for p in packed(parts, lambda p: p[5] - p[4], self.tasks)]

    def parts(self, topic: str, path: str, base_offset: int | None, size: int) -> list[tuple]:
        """Parts of a file in which records may pass."""
        if not (self._passes(topic=topic, file=path, base_offset=base_offset) and self._meets(base_offset, 0, size)):
            return []
        start = min(self.starts.get(path, 0), size)
        return [(topic, path, base_offset, size, *cut) for cut in self._cuts(path, base_offset, size, start)]

    def _meets(self, base_offset: int | None, a: int, b: int) -> bool:
        """Whether a record that begins in bytes [a, b) of a file may pass by its offsets."""
        first, last = (None, None) if base_offset is None else (base_offset + a, base_offset + b - 1)
        return self.places.meets(a, b - 1) and self.streams.meets(first, last)

    def _ranges(self, index: SparseIndex, base_offset: int | None, start: int, end: int) -> list[tuple[int, int]]:
        return index.ranges(start, end, lambda a, b, first, last: self._meets(base_offset, a, b) and self.times.meets(first, last))

    def _cuts(self, path: str, base_offset: int | None, size: int, start: int) -> list[tuple[int, int, bool]]:
        if size - start > 2 * self.part_bytes:
            system, name = locate(path)
            index = read_index(system, name, size)
            if index is not None:
                return [(*cut, True) for a, b in self._ranges(index, base_offset, start, size) for cut in index.cuts(a, b, self.part_bytes)]
        return [(start, size, False)]

    def _wanted(self, path: str, size: int, start: int, end: int, base_offset: int | None = None) -> list[tuple[int, int]]:
        """What of a part may hold records that pass, by the index of its file."""
        if not (self.times.known or self.places.known or self.streams.known):
            return [(start, end)]
        system, name = locate(path)
        index = read_index(system, name, size)
        return [(start, end)] if index is None else self._ranges(index, base_offset, start, end)

    def read(self, partition: _Parts) -> Iterator[pa.RecordBatch]:
        reader = envelope_reader if self.kind == "envelope" else blob_reader
        for topic, path, base_offset, size, start, end, pruned in partition.parts:
            place = placer({"topic": topic, "file": path, "base_offset": base_offset}, self.columns)
            for a, b in [(start, end)] if pruned else self._wanted(path, size, start, end, base_offset):
                yield from reader(path, a, b, place, columns=self.columns)


_PARTS = "topic string, path string, base_offset bigint, size bigint, start bigint, end bigint, pruned boolean"


def read_spread(files: DataFrame, options: dict, schema: T.StructType, tasks: int) -> DataFrame:
    """Records of files that tasks have listed. Their parts are shuffled; none is known to the driver."""
    reader = _RecordReader({k.lower(): v for k, v in options.items()}, schema.names)
    names = [part.split(" ")[0] for part in _PARTS.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("topic", "file", "base_offset", "length")))
            parts = [part for place in places for part in reader.parts(*place)]
            columns = [pa.array([part[i] for part in parts], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from reader.read(_Parts(list(zip(*(c.to_pylist() for c in batch.columns)))))

    kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.bool_()]
    return files.mapInArrow(cut, _PARTS).repartition(tasks, "path", "start").mapInArrow(read, schema)

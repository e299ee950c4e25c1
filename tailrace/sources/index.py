"""Sparse index of a topic file: where records begin, every few megabytes, and which times lie between.

It stands in a hidden file next to the log file, so a reader can begin near an offset or a time and can split a large
file at record starts. Without it, or when it does not fit the file any more, files are read from their start.
"""

from __future__ import annotations

import io
from bisect import bisect_left
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs

STRIDE_BYTES = 4 << 20
_HEAD = 64
_FIELDS = pa.schema([("byte", pa.int64()), ("record", pa.int64()), ("first_time", pa.int64()), ("last_time", pa.int64())])


def index_path(path: str) -> str:
    folder, _, name = path.rpartition("/")
    return f"{folder}/.{name}.index"


@dataclass
class SparseIndex:
    """Strides of a file: first byte, records before it, smallest and largest time in it (None without any)."""

    stride: int = STRIDE_BYTES
    rows: list[list] = field(default_factory=list)
    covered: int = 0
    records: int = 0
    head: bytes = b""

    def add(self, sizes: np.ndarray, times: pa.Array | None, head: bytes = b"") -> None:
        """Takes in whole records that follow each other in the file."""
        if len(self.head) < _HEAD:
            self.head = (self.head + head)[:_HEAD]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            if not self.rows or self.covered - self.rows[-1][0] >= self.stride:
                self.rows.append([self.covered, self.records, None, None])
            row, done = self.rows[-1], int(ends[at - 1]) if at else 0
            room = row[0] + self.stride - self.covered  # the record that fills a stride is its last
            upto = min(len(sizes), int(np.searchsorted(ends, done + room)) + 1)
            if times is not None:
                part = times.slice(at, upto - at).drop_null().to_numpy()
                if part.size:
                    low, high = int(part.min()), int(part.max())
                    row[2] = low if row[2] is None else min(row[2], low)
                    row[3] = high if row[3] is None else max(row[3], high)
            self.covered += int(ends[upto - 1]) - done
            self.records += upto - at
            at = upto

    def ranges(self, start: int, end: int, wanted) -> list[tuple[int, int]]:
        """Parts of [start, end) in strides for which ``wanted(first byte, end, first time, last time)``; what the index
        does not cover is one of them."""
        out: list[tuple[int, int]] = []
        ends = [r[0] for r in self.rows[1:]] + [self.covered]
        parts = [(r[0], e) for r, e in zip(self.rows, ends) if wanted(r[0], e, r[2], r[3])]
        for a, b in [*parts, (self.covered, max(end, self.covered))]:
            a, b = max(a, start), min(b, end)
            if a >= b:
                continue
            if out and out[-1][1] == a:
                out[-1] = out[-1][0], b
            else:
                out.append((a, b))
        return out

    def cuts(self, start: int, end: int, part_bytes: int) -> list[tuple[int, int]]:
        """[start, end) in parts of about ``part_bytes`` that begin at record starts."""
        bounds = [start]
        low, high = (bisect_left(self.rows, at, key=itemgetter(0)) for at in (start, end))
        for row in self.rows[low:high]:
            if row[0] - bounds[-1] >= part_bytes:
                bounds.append(row[0])
        return list(zip(bounds, [*bounds[1:], end]))

    def to_bytes(self) -> bytes:
        table = pa.Table.from_pylist([dict(zip(_FIELDS.names, r)) for r in self.rows], _FIELDS)
        table = table.replace_schema_metadata({"covered": str(self.covered), "records": str(self.records), "head": self.head.hex()})
        out = io.BytesIO()
        with pa.ipc.new_file(out, table.schema) as writer:
            writer.write_table(table)
        return out.getvalue()


def read_index(system: pafs.FileSystem, path: str, length: int) -> SparseIndex | None:
    """The index of the file at ``path``, if there is one that fits its length and first bytes."""
    try:
        with system.open_input_file(index_path(path)) as source:
            table = pa.ipc.open_file(source.read_buffer()).read_all()
        with system.open_input_file(path) as source:
            head = source.read(_HEAD)
    except (FileNotFoundError, OSError, pa.ArrowInvalid):
        return None
    about = table.schema.metadata
    index = SparseIndex(rows=[list(r.values()) for r in table.to_pylist()], covered=int(about[b"covered"]), records=int(about[b"records"]), head=bytes.fromhex(about[b"head"].decode()))
    return index if index.covered <= length and head.startswith(index.head) else None


def write_index(system: pafs.FileSystem, path: str, index: SparseIndex, attempt: str) -> None:
    """Puts an index next to its file; two tasks that do so write the same."""
    hidden = f"{index_path(path)}.{attempt}"
    with system.open_output_stream(hidden) as out:
        out.write(index.to_bytes())
    system.move(hidden, index_path(path))

"""Endless reading of growing topic files.

The source plans byte ranges only: its offsets stand for file sizes, so a batch that runs again reads the same
bytes; see ``positions`` for how they stay small. The ranges go to a stateful operator keyed by file, whose state is where the next record begins. It
reads the new bytes itself, which keeps payloads out of the shuffle and the state at a few bytes per file;
an unfinished record stays in the file until the rest of it has arrived.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tailrace.functions.columns import OFFSET_NAME_PATTERN
from tailrace.sources.batch import BLOBS, RECORDS, Framing, blob_reader, envelope_reader, framed_reader, placer
from tailrace.sources.files import locate
from tailrace.sources.listing import base_offset_of, full_path, topic_files
from tailrace.sources.manifest import Manifest
from tailrace.streaming.positions import MOST_CHANGED, Positions, replaced

_GONE = -1
# Without this, pandas turns whole numbers with gaps into doubles.
_WHOLE_NUMBERS = {pa.int64(): pd.Int64Dtype()}
_RANGES_PER_TASK = 1000


def tail_topic_log(
    spark: SparkSession,
    base: str,
    pattern: str = OFFSET_NAME_PATTERN,
    starting_offsets: dict[str, int] | None = None,
    topic_dirs: bool = True,
    topics: str | None = None,
) -> DataFrame:
    """Streaming messages of a topic log, including new topics, new files and growth of any file.

    ``starting_offsets`` (file to offset) seeds a query without checkpoint. A file that vanishes is forgotten; one that
    becomes shorter or begins with other bytes is read from its start.
    """
    ranges = _ranges(spark, base, pattern, starting_offsets, topic_dirs, topics)
    return _follow(ranges, envelope_reader, RECORDS)


def tail_count_blob(spark: SparkSession, base: str, pattern: str = ".*", **options) -> DataFrame:
    """Streaming length-prefixed records without envelope."""
    return _follow(_ranges(spark, base, pattern, **options), blob_reader, BLOBS)


def tail_framed(spark: SparkSession, base: str, framing: Framing, fields: str, pattern: str = ".*", **options) -> DataFrame:
    """Streaming records in the user's own framing; see ``read_framed``."""
    reader, schema = framed_reader(framing, fields)
    return _follow(_ranges(spark, base, pattern, **options), reader, schema)


def _ranges(spark, base, pattern, starting_offsets=None, topic_dirs=True, topics=None) -> DataFrame:
    spark.dataSource.register(TopicLogRanges)
    options = {
        "path": base.rstrip("/"),
        "pattern": pattern,
        "topicDirs": str(topic_dirs).lower(),
        "startingOffsets": json.dumps(starting_offsets or {}),
    }
    if topics is not None:
        options["topics"] = topics
    return spark.readStream.format("topic_log_ranges").options(**options).load()


def _follow(ranges: DataFrame, reader, schema: str) -> DataFrame:
    def follow(key, rows: Iterator, state) -> Iterator:
        topic, file = key
        for row in (r for pdf in rows for r in pdf.itertuples(index=False)):
            if row.until == _GONE:
                if state.exists:
                    state.remove()
                continue
            at, seen = state.get if state.exists else (row.first, row.first)
            if row.other or row.until < seen:
                at = 0  # the file was deleted and created again
            base_offset = None if pd.isna(row.base_offset) else int(row.base_offset)
            place = placer({"topic": topic, "file": file, "base_offset": base_offset})
            position = _Position(at)
            try:
                for batch in reader(file, at, row.until, place, position):
                    yield batch.to_pandas(types_mapper=_WHOLE_NUMBERS.get)
            except FileNotFoundError:  # deleted after the batch was planned: forget it and go on
                if state.exists:
                    state.remove()
                continue
            state.update((position.at, row.until))

    keyed = ranges.groupBy("topic", "file")
    return keyed.applyInPandasWithState(follow, schema, "at bigint, seen bigint", "append", "NoTimeout")


class _Position:
    """Where the record after the last complete one begins."""

    def __init__(self, at: int):
        self.at = at


# --- source -------------------------------------------------------------------------------------------


class TopicLogRanges(DataSource):
    """Ranges of bytes that were added to the files of a topic log."""

    @classmethod
    def name(cls) -> str:
        return "topic_log_ranges"

    def schema(self) -> str:
        return "topic string, file string, base_offset bigint, first bigint, until bigint, other boolean"

    def streamReader(self, schema):
        return _RangeReader(dict(self.options))


class _Ranges(InputPartition):
    def __init__(self, rows: list[tuple]):
        self.rows = rows


class _RangeReader(DataSourceStreamReader):
    """Offsets stand for the bytes of each file, with files named from the base directory on."""

    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}
        self.root = options["path"]
        self.pattern = options["pattern"]
        self.topic_dirs = options["topicdirs"] == "true"
        self.topics = options.get("topics")
        self.starting = json.loads(options["startingoffsets"])
        view = json.dumps([self.pattern, self.topic_dirs, self.topics])
        self.positions = Positions(self.root, view, self.topic_dirs, int(options.get("mostchanged", MOST_CHANGED)))

    def initialOffset(self) -> dict:
        prefix = full_path(self.root, "", "", False)
        return {"parts": [], "changed": {f.removeprefix(prefix): [n, "", 0] for f, n in self.starting.items()}}

    def latestOffset(self) -> dict:
        return self.positions.offset(topic_files(self.root, self.pattern, self.topic_dirs, self.topics))

    def partitions(self, start: dict, end: dict):
        before, now = self.positions.files(start), self.positions.files(end)
        on_disk = self._listed_names()
        rows = [
            self._row(f, before[f][0] if f in before else 0, e[0], f in before and replaced(before[f], e), on_disk)
            for f, e in now.items()
            if f not in before or before[f][:2] != e[:2]
        ]
        rows += [self._row(f, 0, _GONE, False, on_disk) for f in before if f not in now]
        cuts = range(0, len(rows), _RANGES_PER_TASK)
        return [_Ranges(rows[i : i + _RANGES_PER_TASK]) for i in cuts] or [_Ranges([])]

    def read(self, partition):
        yield from partition.rows

    def _listed_names(self) -> dict[str, str]:
        """Names on disk of the files that the manifest adds."""
        system, path = locate(self.root)
        if self.topic_dirs:
            return {f"{f.topic}/{f.base_offset:016x}": f.file for f in Manifest(system, path).files()}
        above, topic = path.rsplit("/", 1)
        return {f"{f.base_offset:016x}": f.file for f in Manifest(system, above).files() if f.topic == topic}

    def _row(self, file: str, first: int, until: int, other: bool, on_disk: dict[str, str]) -> tuple:
        topic, _, name = file.rpartition("/")
        path = full_path(self.root, topic, on_disk.get(file, name), self.topic_dirs)
        return topic or self.root.rsplit("/", 1)[-1], path, base_offset_of(name), first, until, other

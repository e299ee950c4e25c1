"""Batch readers of topic logs.

The files are listed and packed into tasks by size; each task then streams its files in chunks, so memory
does not grow with a file. The bytes of a file have no marks at which it could be split; its sparse index tells
where records begin, so a file far above the usual size is cut there and its parts are spread out.

The files of a log whose manifest has very many are not listed on the driver: tasks read the manifest's lists and the
folders, and the files they find are shuffled.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailrace.functions.codec import decode_data_point, decode_envelopes, frame_bodies, split_frames
from tailrace.functions.columns import METRICS_TOPIC, OFFSET_NAME_PATTERN
from tailrace.sources.files import locate, read_complete
from tailrace.sources.index import STRIDE_BYTES, SparseIndex, read_index, write_index
from tailrace.sources.listing import FILES, TASK_BYTES, ManifestFiles, TopicLogFiles, TopicLogTopics, list_folders, manifest_of

PART_BYTES = 256 << 20
MAX_PLANNED_FILES = 10_000
FILES_PER_TASK = 4096

_PLACE = "topic string, file string, base_offset bigint"
_PLACE_NAMES = ("topic", "file", "base_offset")
RECORDS = f"{_PLACE}, record_offset bigint, stream_offset bigint, time bigint, payload binary"
BLOBS = f"{_PLACE}, record_offset bigint, content binary"

Framing = Callable[[bytes], tuple[list[tuple], int]]


def list_files(
    spark: SparkSession, base: str, pattern: str = ".*", topic_dirs: bool = True, topics: str | None = None
) -> DataFrame:
    """Files of a topic log whose whole name matches ``pattern``: ``topic, file, name, base_offset, length``.

    With ``topic_dirs`` every directory below ``base`` is a topic; otherwise ``base`` itself is one. A pattern
    for ``topics`` keeps the others from being listed and read at all. ``base_offset`` is NULL for names that
    are not offsets. Files whose names begin with a dot or an underscore are hidden, as everywhere in Spark;
    topics may begin with an underscore.
    """
    if tasks := _listing_tasks(spark, base, topic_dirs):
        return _listed_by_tasks(spark, base, pattern, topic_dirs, topics, tasks)
    spark.dataSource.register(TopicLogFiles)
    tasks = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism
    options = {"path": base, "pattern": pattern, "topicDirs": str(topic_dirs).lower(), "tasks": str(tasks)}
    if topics is not None:
        options["topics"] = topics
    return spark.read.format("topic_log_files").options(**options).load()


def _listing_tasks(spark: SparkSession, base: str, topic_dirs: bool) -> int:
    """Tasks for the files of a log whose manifest has too many for the driver to hold; 0 for others."""
    now = manifest_of(base, topic_dirs).snapshot()
    return tasks_for_files(spark, now.count, now.bytes) if now.count > MAX_PLANNED_FILES else 0


def tasks_for_files(spark: SparkSession, files: int, size: int = 0) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-files // FILES_PER_TASK), -(-size // TASK_BYTES))


def _listed_by_tasks(spark, base, pattern, topic_dirs, topics, tasks, kept: Column | None = None) -> DataFrame:
    """As ``list_files``, with no more than the names of lists on the driver; ``kept`` is a condition on the topic."""
    spark.dataSource.register(TopicLogTopics)
    spark.dataSource.register(ManifestFiles)
    options = {"path": base, "pattern": pattern, "topicDirs": str(topic_dirs).lower(), "tasks": str(tasks)}
    if topics is not None:
        options["topics"] = topics
    kept = F.lit(True) if kept is None else kept
    folders = spark.read.format("topic_log_topics").options(**options).load().where(kept).repartition(tasks, "topic")
    listed = spark.read.format("topic_log_manifest").options(**options).load().where(kept)
    return folders.mapInArrow(list_folders(base, pattern, topic_dirs), FILES).unionByName(listed)


def read_topic_log(
    spark: SparkSession,
    base: str,
    pattern: str = OFFSET_NAME_PATTERN,
    starting_offsets: DataFrame | dict[str, int] | None = None,
    topic_dirs: bool = True,
    topics: str | None = None,
    part_bytes: int = PART_BYTES,
    columns: list[str] | None = None,
    where: list[tuple[str, str, object]] | None = None,
) -> DataFrame:
    """Messages of a topic log; an unfinished record at the end of a file is left out.

    ``columns`` are decoded and nothing else. ``where`` has conditions (column, operator, value) that all have to be true,
    with ``=``, ``<``, ``<=``, ``>``, ``>=``, ``in`` or ``startswith``. Those on topic, file, base_offset and stream_offset keep
    folders from being listed and files from being opened; those on time, record_offset and stream_offset skip strides of indexed files.
    """
    return _read(spark, base, "envelope", pattern, starting_offsets, topic_dirs, topics, part_bytes, columns, where)


def read_count_blob(
    spark: SparkSession,
    base: str,
    pattern: str = ".*",
    starting_offsets: DataFrame | dict[str, int] | None = None,
    topic_dirs: bool = True,
    topics: str | None = None,
    part_bytes: int = PART_BYTES,
    columns: list[str] | None = None,
    where: list[tuple[str, str, object]] | None = None,
) -> DataFrame:
    """Length-prefixed records without envelope; see ``read_topic_log``."""
    return _read(spark, base, "blob", pattern, starting_offsets, topic_dirs, topics, part_bytes, columns, where)


def _read(spark, base, kind, pattern, starting_offsets, topic_dirs, topics, part_bytes, columns, where) -> DataFrame:
    from tailrace.sources.scan import TopicLogRecords, as_column, read_spread  # which uses the readers below

    schema = T._parse_datatype_string(RECORDS if kind == "envelope" else BLOBS)
    columns, where = columns or schema.names, where or []
    kept = reduce(and_, map(as_column, where), F.lit(True))
    if isinstance(starting_offsets, DataFrame):  # of any size, so they are joined
        files = _with_start(list_files(spark, base, pattern, topic_dirs, topics), starting_offsets)
        recs = _parts_of(files, envelope_reader if kind == "envelope" else blob_reader, RECORDS if kind == "envelope" else BLOBS, part_bytes)
        return recs.where(kept).select(columns)
    spark.dataSource.register(TopicLogRecords)
    tasks = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism
    options = {"path": base, "kind": kind, "pattern": pattern, "topicDirs": str(topic_dirs).lower(), "tasks": str(tasks)}
    options |= {"partBytes": str(part_bytes), "startingOffsets": json.dumps(starting_offsets or {}), "conditions": json.dumps(where)}
    if topics is not None:
        options["topics"] = topics
    decoded = T.StructType([schema[c] for c in schema.names if c in columns or c in {name for name, _, _ in where}])
    if tasks := _listing_tasks(spark, base, topic_dirs):
        about_topics = reduce(and_, [as_column(c) for c in where if c[0] == "topic"], F.lit(True))
        files = _listed_by_tasks(spark, base, pattern, topic_dirs, topics, tasks, about_topics)
        return read_spread(files, options, decoded, tasks).where(kept).select(columns)
    recs = spark.read.format("topic_log").schema(decoded).options(**options).load()
    return recs.where(kept).select(columns)


def index_topic_log(
    spark: SparkSession,
    base: str,
    pattern: str = OFFSET_NAME_PATTERN,
    topic_dirs: bool = True,
    topics: str | None = None,
    envelope: bool = True,
    stride_bytes: int = STRIDE_BYTES,
) -> int:
    """Write the sparse index of every file that is longer than a stride and has none; returns how many were written.

    The writers of this package index their files themselves. Others' files are walked here, one per task at a time.
    """
    files = list_files(spark, base, pattern, topic_dirs, topics).where(F.col("length") > stride_bytes)

    def build(batches):
        for batch in batches:
            done = 0
            for f in batch.to_pylist():
                system, path = locate(f["file"])
                if read_index(system, path, f["length"]) is not None:
                    continue
                index = SparseIndex(stride_bytes)
                for buf, at, starts, used in _frames(f["file"], 0, f["length"]):
                    times = decode_envelopes(buf, starts, used, f"after byte {at} of {path}")[0] if envelope else None
                    index.add(np.diff(np.append(starts, used)), times, buf[:64])
                write_index(system, path, index, uuid.uuid4().hex)
                done += 1
            yield pa.RecordBatch.from_pydict({"written": pa.array([done], pa.int64())})

    return files.mapInArrow(build, "written bigint").agg(F.sum("written")).first()[0] or 0


def read_framed(
    spark: SparkSession,
    base: str,
    framing: Framing,
    fields: str,
    pattern: str = ".*",
    starting_offsets: DataFrame | dict[str, int] | None = None,
    topic_dirs: bool = True,
    topics: str | None = None,
) -> DataFrame:
    """Records in a format of the user's own.

    ``framing(bytes)`` returns the complete records it found, each ``(position, *fields)``, and how many
    bytes they take; what it leaves is offered again with more bytes behind it.
    """
    files = _with_start(list_files(spark, base, pattern, topic_dirs, topics), starting_offsets)
    return _whole_files(files, *framed_reader(framing, fields))


def framed_reader(framing: Framing, fields: str):
    """Reader of a user's framing, and the schema of what it returns."""
    types = [(f.name, _arrow_type(f.dataType)) for f in T._parse_datatype_string(fields)]

    def reader(path: str, start: int, end: int, place, position=None) -> Iterator[pa.RecordBatch]:
        def consume(buf: bytes, at: int):
            rows, used = framing(buf)
            return (at, rows, used), used

        for at, rows, used in read_complete(path, start, end, consume):
            offsets = np.array([at + r[0] for r in rows], dtype=np.int64)
            columns = {name: pa.array([r[i + 1] for r in rows], t) for i, (name, t) in enumerate(types)}
            yield place(offsets, columns)
            _advance(position, at + used)

    return reader, f"{_PLACE}, record_offset bigint, {fields}"


def _advance(position, at: int) -> None:
    if position is not None:
        position.at = at


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def torn_tails(spark: SparkSession, base: str, pattern: str = OFFSET_NAME_PATTERN, topic_dirs: bool = True) -> DataFrame:
    """Files that end in an unfinished record, and how many bytes of it are there."""
    files = _with_start(list_files(spark, base, pattern, topic_dirs), None)
    schema = "topic string, file string, complete_bytes bigint, torn_bytes bigint"

    def walk(batches):
        for batch in batches:
            rows = []
            for f in batch.to_pylist():
                complete = f["start"]
                for _, complete in _cuts(f["file"], f["start"], f["length"], PART_BYTES):
                    pass
                if complete < f["length"]:
                    rows.append((f["topic"], f["file"], complete, f["length"] - complete))
            yield _batch(schema, rows)

    return files.mapInArrow(walk, schema)


def _with_start(files: DataFrame, starting_offsets) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    if starting_offsets is None:
        return files.withColumn("start", zero)
    if isinstance(starting_offsets, dict):
        rows = list(starting_offsets.items())
        starting_offsets = files.sparkSession.createDataFrame(rows, "file string, record_offset bigint")
    start = starting_offsets.select("file", F.col("record_offset").alias("_from"))
    return files.join(start, "file", "left").withColumn("start", F.coalesce("_from", zero)).drop("_from")


def _parts_of(files: DataFrame, reader, schema: str, part_bytes: int) -> DataFrame:
    """Records of ``files`` from their start on. One listing makes the parts, and only these are shuffled."""
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = files.select(*_PLACE_NAMES, "start", "length").mapInArrow(_cut_files(part_bytes), f"{_PLACE}, start bigint, length bigint")
    return _whole_files(parts.repartition(tasks, "file", "start"), reader, schema)


def _whole_files(files: DataFrame, reader, schema: str) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                yield from reader(f["file"], f["start"], f["length"], placer(f))

    return files.select("topic", "file", "base_offset", "start", "length").mapInArrow(read, schema)


def placer(f: dict, columns: list[str] | None = None):
    """Adds where records come from; with ``columns`` the batch has these, in this order."""

    def place(offsets: np.ndarray, values: dict[str, pa.Array], stream: bool = False) -> pa.RecordBatch:
        n = len(offsets)
        out = {
            "topic": pa.repeat(pa.scalar(f["topic"], pa.string()), n),
            "file": pa.repeat(pa.scalar(f["file"], pa.string()), n),
            "base_offset": pa.repeat(pa.scalar(f["base_offset"], pa.int64()), n),
            "record_offset": pa.array(offsets, pa.int64()),
        }
        if stream:
            known = f["base_offset"] is not None
            out["stream_offset"] = pa.array(offsets + f["base_offset"]) if known else pa.nulls(n, pa.int64())
        batch = pa.RecordBatch.from_pydict(out | values)
        return batch.select(columns) if columns is not None else batch

    return place


def _frames(path: str, start: int, end: int):
    def consume(buf: bytes, at: int):
        starts, used = split_frames(buf, f"after byte {at} of {path}")
        return (buf, at, starts, used), used

    return read_complete(path, start, end, consume)


def envelope_reader(path: str, start: int, end: int, place, position=None, columns=("time", "payload")) -> Iterator[pa.RecordBatch]:
    decoded = "time" in columns or "payload" in columns
    for buf, at, starts, used in _frames(path, start, end):
        time, payload = decode_envelopes(buf, starts, used, f"after byte {at} of {path}") if decoded else (None, None)
        yield place(starts + at, {"time": time, "payload": payload} if decoded else {}, stream=True)
        _advance(position, at + used)


def blob_reader(path: str, start: int, end: int, place, position=None, columns=("content",)) -> Iterator[pa.RecordBatch]:
    for buf, at, starts, used in _frames(path, start, end):
        yield place(starts + at, {"content": frame_bodies(buf, starts, used)} if "content" in columns else {})
        _advance(position, at + used)


def _cuts(path: str, start: int, end: int, part_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``part_bytes`` that begin and end at record starts."""
    first = last = start
    for _, at, _, used in _frames(path, start, end):
        last = at + used
        if last - first >= part_bytes:
            yield first, last
            first = last
    if last > first:
        yield first, last


def _cut_files(part_bytes: int):
    """Parts of files; without an index, a file far above ``part_bytes`` is walked from header to header."""

    def parts(f: dict) -> list[tuple[int, int]]:
        if f["length"] - f["start"] <= 2 * part_bytes:
            return [(f["start"], f["length"])]
        system, path = locate(f["file"])
        index = read_index(system, path, f["length"])
        return index.cuts(f["start"], f["length"], part_bytes) if index else list(_cuts(f["file"], f["start"], f["length"], part_bytes))

    def cut(batches):
        for batch in batches:
            for f in batch.to_pylist():
                rows = [(f["topic"], f["file"], f["base_offset"], a, b) for a, b in parts(f)]
                yield _batch(f"{_PLACE}, start bigint, length bigint", rows)

    return cut


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [c.strip().split(" ") for c in schema.split(",")]
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return pa.RecordBatch.from_pydict(
        {name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)}
    )


def parse_payload(recs: DataFrame, fields: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Adds the columns that ``fields`` makes from the payload; an absent payload counts as empty."""
    return recs.withColumns(fields(F.coalesce("payload", F.lit(b""))))


def split_words(payload: Column, names: list[str]) -> dict[str, Column]:
    """Fields of a UTF-8 payload whose parts are divided by single spaces."""
    words = F.split(F.decode(payload, "UTF-8"), " ")
    return {name: F.get(words, F.lit(i)) for i, name in enumerate(names)}


def read_metrics(spark: SparkSession, base: str) -> DataFrame:
    """Data points that were logged to the metrics topic."""
    path = f"{base.rstrip('/')}/{METRICS_TOPIC}"
    points = read_topic_log(spark, path, topic_dirs=False)
    schema = T._parse_datatype_string("time double, interval int, unique_topics bigint, messages bigint")

    @F.pandas_udf(schema)
    def decoded(payload):
        import pandas as pd

        rows = [decode_data_point(p or b"") for p in payload]
        return pd.DataFrame(rows, columns=["time", "interval", "unique_topics", "messages"])

    return points.select(decoded("payload").alias("p")).select("p.*")

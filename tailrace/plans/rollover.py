"""Which file each record goes to when files roll over at a size limit.

A new file begins at the first record that starts more than ``max_file_bytes`` after the start of the
open file, so every boundary depends on the one before it. A topic of moderate size is folded in one
group. A larger one is cut into segments of equal record counts, and each segment is summed up as a step
function from "start of the file that is open on entry" to "start of the file that is open on exit". Such
functions compose, so a tree of them, each node a small group, finds the open file at the entry of every
segment; then all segments are folded at once. Only offsets travel, never payloads.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tailrace.operators.audit import MAX_FILE_BYTES, TAKEOVER_PAD
from tailrace.operators.offsets import exclusive_prefix, required, tasks_for

SEGMENT_ROWS = 1 << 17
FAN_OUT_BITS = 3

_UNCHANGED = -1
_NO_FLOOR = np.iinfo(np.int64).min

PLAN_SCHEMA = "topic string, seq bigint, size bigint, base_offset bigint, record_offset bigint"
SPAN_SCHEMA = (
    "topic string, base_offset bigint, block bigint, first_seq bigint, last_seq bigint, records bigint, bytes bigint"
)


def rollover_plan(
    msgs_sizes: DataFrame,
    ends: DataFrame | None = None,
    max_file_bytes: int = MAX_FILE_BYTES,
    pad: int = TAKEOVER_PAD,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """File (``base_offset``) and position in it (``record_offset``) for every record.

    ``msgs_sizes`` has ``topic``, ``seq`` (unique in a topic) and ``size``; ``ends`` is the end of what each
    topic already holds. Existing files are never reopened: a topic goes on ``pad`` bytes after its end.

    Runs one small job when called, to see whether any topic needs more than one segment.
    """
    light = required(msgs_sizes.select("topic", "seq", "size"), "topic", "seq")
    largest, records = largest_topic(light)
    return plan_records(light, ends, max_file_bytes, pad, largest, segment_rows, records)


def largest_topic(sizes: DataFrame) -> tuple[int, int]:
    """Records of the largest topic, and of all."""
    counts = sizes.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.max("n"), F.sum("n")).first()
    return row[0] or 0, row[1] or 0


def plan_records(sizes, ends, max_file_bytes, pad, largest, segment_rows=SEGMENT_ROWS, records=0) -> DataFrame:
    placed = _placed(sizes, ends, max_file_bytes, pad, largest, segment_rows, records)
    return placed.mapInArrow(_fold(max_file_bytes, _record_rows), PLAN_SCHEMA)


def plan_spans(
    sizes, ends, max_file_bytes, pad, largest, block_bits, segment_rows=SEGMENT_ROWS, records=0
) -> DataFrame:
    """The plan as ranges: one row per file and block of ``2**block_bits`` sequence numbers."""

    def spans(*columns):
        return _span_rows(*columns, block_bits)

    placed = _placed(sizes, ends, max_file_bytes, pad, largest, segment_rows, records)
    # A file that crosses a batch or a segment yields a partial row on either side.
    return (
        placed.mapInArrow(_fold(max_file_bytes, spans), SPAN_SCHEMA)
        .groupBy("topic", "base_offset", "block")
        .agg(
            F.min("first_seq").alias("first_seq"),
            F.max("last_seq").alias("last_seq"),
            F.sum("records").alias("records"),
            F.sum("bytes").alias("bytes"),
        )
    )


def _placed(sizes, ends, max_file_bytes, pad, largest, segment_rows, records) -> DataFrame:
    """Records with their start in the topic, the file that is open when their segment begins, and the
    topic's begin; each segment in one partition and in order."""
    zero = F.lit(0).cast("bigint")
    columns = ["topic", "segment", "seq", "size", "start", "open", "begin"]
    tasks = tasks_for(sizes.sparkSession, max(largest, records))
    if largest <= segment_rows:
        in_topic = Window.partitionBy("topic").orderBy("seq")
        before = F.sum("size").over(in_topic.rowsBetween(Window.unboundedPreceding, -1))
        placed = (
            _with_begin(sizes.repartition(tasks, "topic"), ends, pad)
            .withColumns({"segment": zero, "start": F.coalesce(before, zero), "open": zero})
            .select(*columns)
        )
        return placed.sortWithinPartitions("topic", "seq")
    segment_bits = segment_rows.bit_length() - 1
    placed = exclusive_prefix(sizes, "topic", "seq", {"start": F.col("size"), "nth": F.lit(1)}, records=records)
    placed = placed.withColumn("segment", F.shiftright("nth", segment_bits)).drop("nth")
    placed = placed.repartition(tasks, "topic", "segment")
    entries = _segment_entries(placed, _with_begin(sizes.select("topic").distinct(), ends, pad), max_file_bytes, (largest - 1) >> segment_bits)
    # Only a window makes Spark keep a segment in one partition: it may leave out a repartition before a map, or read its
    # parts as they were written, once the join turns out to be small.
    in_segment = Window.partitionBy("topic", "segment").orderBy("seq")
    twice = F.raise_error(F.concat(F.lit("seq is not unique in topic "), F.col("topic"))).cast("bigint")
    checked = F.when(F.lag("seq").over(in_segment) == F.col("seq"), twice).otherwise(F.col("open"))
    return placed.join(entries, ["topic", "segment"]).withColumn("open", checked).select(*columns).sortWithinPartitions("topic", "segment", "seq")


def _with_begin(df: DataFrame, ends: DataFrame | None, pad: int) -> DataFrame:
    """Adds the offset at which each topic goes on; topics without files begin at 0."""
    zero = F.lit(0).cast("bigint")
    if ends is None:
        return df.withColumn("begin", zero)
    begins = ends.select("topic", (F.col("end_offset") + pad).alias("begin"))
    return df.join(begins, "topic", "left").withColumn("begin", F.coalesce("begin", zero))


def _segment_entries(placed, begins, max_file_bytes, last_segment) -> DataFrame:
    """Start of the file that is open when each segment begins, relative to the topic's begin."""
    keys = ["topic", "segment"]
    tree = [
        placed.groupBy(*keys).applyInArrow(
            _summarise(max_file_bytes), "topic string, segment bigint, floor bigint, exit bigint"
        )
    ]
    depth = 0
    while last_segment >> (FAN_OUT_BITS * (depth + 1)):
        depth += 1
        parent = tree[-1].withColumn("parent", F.shiftright("segment", FAN_OUT_BITS))
        tree.append(
            parent.groupBy("topic", "parent").applyInArrow(
                _compose_children, "topic string, segment bigint, floor bigint, exit bigint"
            )
        )
    zero = F.lit(0).cast("bigint")
    entries = begins.select("topic", zero.alias("parent"), zero.alias("open"), "begin")
    for level in reversed(tree):
        children = level.withColumn("parent", F.shiftright("segment", FAN_OUT_BITS))
        by = ["topic", "parent"]
        entries = (
            children.groupBy(*by)
            .cogroup(entries.groupBy(*by))
            .applyInArrow(_descend, "topic string, parent bigint, open bigint, begin bigint")
        )
    return entries.withColumnRenamed("parent", "segment")


# --- what runs inside a group -------------------------------------------------------------------------


def _ints(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64, copy=False)


def _sorted(table: pa.Table, by: str, *names: str) -> list[np.ndarray]:
    order = np.argsort(_ints(table, by), kind="stable")
    return [_ints(table, n)[order] for n in (by, *names)]


def _boundaries(starts: np.ndarray, open_at: int, limit: int) -> np.ndarray:
    """Indexes of the records that begin a new file."""
    found = []
    i = int(np.searchsorted(starts, open_at + limit, side="right"))
    while i < len(starts):
        found.append(i)
        i = int(np.searchsorted(starts, starts[i] + limit, side="right"))
    return np.array(found, dtype=np.int64)


def _fold(limit: int, output):
    """Walks over sorted records, batch by batch, carrying the open file of the segment at hand."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_at, last_seq = None, 0, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            topic = batch.column("topic").dictionary_encode()
            segment, seq, size, start, entry, begin = (
                _ints(batch, n) for n in ("segment", "seq", "size", "start", "open", "begin")
            )
            code = topic.indices.to_numpy()
            cuts = np.flatnonzero((np.diff(code) != 0) | (np.diff(segment) != 0)) + 1
            base = np.empty_like(start)
            for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(seq)]):
                key = (topic.dictionary[code[first]].as_py(), int(segment[first]))
                if key != current:
                    current, open_at, last_seq = key, int(entry[first]), None
                run = start[first:end]
                if seq[first] == last_seq or (seq[first + 1 : end] == seq[first : end - 1]).any():
                    raise ValueError(f"seq is not unique in topic {key[0]}")
                bounds = _boundaries(run, open_at, limit)
                bases = np.concatenate(([open_at], run[bounds]))
                base[first:end] = bases[np.searchsorted(bounds, np.arange(end - first), side="right")]
                open_at, last_seq = int(bases[-1]), seq[end - 1]
            yield output(batch.column("topic"), code, seq, size, base + begin, start - base)

    return fold


def _topic_column(topic, n: int) -> pa.Array:
    return pa.repeat(pa.scalar(topic, pa.string()), n)


def _record_rows(topic, code, seq, size, base, position) -> pa.RecordBatch:
    names = ["topic", "seq", "size", "base_offset", "record_offset"]
    return pa.RecordBatch.from_arrays([topic, *map(pa.array, (seq, size, base, position))], names)


def _span_rows(topic, code, seq, size, base, position, block_bits) -> pa.RecordBatch:
    block = seq >> block_bits
    change = np.ones(len(seq), dtype=bool)
    change[1:] = (np.diff(block) != 0) | (np.diff(base) != 0) | (np.diff(code) != 0)
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(seq)) - 1
    columns = (base[first], block[first], seq[first], seq[last], last - first + 1, np.add.reduceat(size, first))
    names = ["topic", "base_offset", "block", "first_seq", "last_seq", "records", "bytes"]
    return pa.RecordBatch.from_arrays([topic.take(pa.array(first)), *map(pa.array, columns)], names)


# A step function is a pair of arrays: for an open file at f, the last k with floor[k] <= f counts, and
# exit[k] is the answer, _UNCHANGED standing for f itself. Only the last step can be _UNCHANGED.


def _apply(floor: np.ndarray, exit_: np.ndarray, at):
    found = exit_[np.searchsorted(floor, at, side="right") - 1]
    return np.where(found == _UNCHANGED, at, found)


def _segment_steps(starts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(starts)
    following = np.searchsorted(starts, starts + limit, side="right")
    last = np.where(following == n, np.arange(n), following)
    while True:
        further = last[last]
        if (further == last).all():
            break
        last = further
    # The open file began at or before this segment, so the first boundary lies at or before `reach`.
    reach = int(np.searchsorted(starts, starts[0] + limit, side="right"))
    floor = np.concatenate(([_NO_FLOOR], starts[: min(reach, n)] - limit))
    exit_ = np.append(starts[last], _UNCHANGED)[: len(floor)]
    return _trimmed(floor, exit_)


def _trimmed(floor: np.ndarray, exit_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drop steps below offset 0, which no file has, and steps that change nothing."""
    lowest = int(np.searchsorted(floor, 0, side="right")) - 1
    floor, exit_ = floor[lowest:].copy(), exit_[lowest:]
    floor[0] = _NO_FLOOR
    keep = np.ones(len(floor), dtype=bool)
    keep[1:] = exit_[1:] != exit_[:-1]
    return floor[keep], exit_[keep]


def _composed(first, second) -> tuple[np.ndarray, np.ndarray]:
    floor, exit_ = first
    if exit_[-1] != _UNCHANGED:
        return _trimmed(floor, _apply(*second, exit_))
    open_from = floor[-1]
    later_floor, later_exit = second
    k = int(np.searchsorted(later_floor, open_from, side="right")) - 1
    joined_floor = np.concatenate((floor[:-1], [open_from], later_floor[k + 1 :]))
    joined_exit = np.concatenate((_apply(*second, exit_[:-1]), later_exit[k:]))
    return _trimmed(joined_floor, joined_exit)


def _steps_table(topic, segment: int, steps) -> pa.Table:
    floor, exit_ = steps
    n = len(floor)
    return pa.table(
        {
            "topic": _topic_column(topic, n),
            "segment": np.full(n, segment, dtype=np.int64),
            "floor": floor,
            "exit": exit_,
        }
    )


def _summarise(limit: int):
    def summarise(records: pa.Table) -> pa.Table:
        (starts,) = _sorted(records, "start")
        segment = records.column("segment")[0].as_py()
        return _steps_table(records.column("topic")[0].as_py(), segment, _segment_steps(starts, limit))

    return summarise


def _children(table: pa.Table):
    """The step functions of a group's segments, in segment order."""
    segment, floor, exit_ = (_ints(table, n) for n in ("segment", "floor", "exit"))
    order = np.lexsort((floor, segment))
    segment, floor, exit_ = segment[order], floor[order], exit_[order]
    cuts = np.flatnonzero(np.diff(segment)) + 1
    parts = zip(np.split(segment, cuts), np.split(floor, cuts), np.split(exit_, cuts))
    return [(int(s[0]), (f, e)) for s, f, e in parts]


def _compose_children(table: pa.Table) -> pa.Table:
    children = _children(table)
    steps = children[0][1]
    for _, following in children[1:]:
        steps = _composed(steps, following)
    return _steps_table(table.column("topic")[0].as_py(), table.column("parent")[0].as_py(), steps)


def _descend(children: pa.Table, entry: pa.Table) -> pa.Table:
    open_at = entry.column("open")[0].as_py()
    segments, opens = [], []
    for segment, steps in _children(children):
        segments.append(segment)
        opens.append(open_at)
        open_at = int(_apply(*steps, open_at))
    n = len(segments)
    return pa.table(
        {
            "topic": _topic_column(entry.column("topic")[0].as_py(), n),
            "parent": pa.array(segments, pa.int64()),
            "open": pa.array(opens, pa.int64()),
            "begin": pa.repeat(pa.scalar(entry.column("begin")[0].as_py(), pa.int64()), n),
        }
    )

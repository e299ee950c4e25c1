"""Writers of topic logs.

Tasks write each planned file under a hidden name. When all are done, the driver gives the files their final names, or,
with a manifest, adds them to the log by one new file that names the tasks' lists of them. A task that runs twice leaves a
hidden file that is removed, never a doubled record. Files do not hold their own offset, so those of a writer that comes second
to a topic are placed behind the other's without being written again. With a manifest, what the driver holds grows with the
tasks, not with the files.
"""

from __future__ import annotations

import json
import math
import os
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tailrace.functions.codec import encode_data_point, encode_frames, frame_bytes
from tailrace.functions.columns import METRICS_TOPIC, OFFSET_NAME_PATTERN, TOPIC_PATTERN, frame_size, full_match
from tailrace.operators.audit import MAX_FILE_BYTES, TAKEOVER_PAD, topic_end_offset
from tailrace.plans.rollover import plan_spans
from tailrace.session import written
from tailrace.sources.batch import MAX_PLANNED_FILES, list_files, tasks_for_files
from tailrace.sources.files import locate
from tailrace.sources.index import STRIDE_BYTES, SparseIndex, index_path, write_index
from tailrace.sources.manifest import INLINE_FILES, FileList, Manifest, ManifestFile, Snapshot, moved

TASK_BYTES = 128 << 20
TASK_RECORDS = 1 << 20
MAX_NUMBERED_FILES = 100_000
MAX_BROADCAST_SPANS = 500_000
LISTED = "topic string, base_offset bigint, file string, bytes bigint, records bigint"
_LIST = pa.schema([("name", pa.string()), ("files", pa.int64()), ("bytes", pa.int64())])
_COMMITS = ".commits"
_KEPT_BATCHES = 10


def valid_topics(msgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages with a valid topic name, and the others."""
    good = F.coalesce(full_match("topic", TOPIC_PATTERN), F.lit(False))
    return msgs.where(good), msgs.where(~good)


def write_topic_log(
    msgs: DataFrame,
    base: str,
    max_file_bytes: int = MAX_FILE_BYTES,
    pad: int = TAKEOVER_PAD,
    sink: str | None = None,
    batch_id: int | None = None,
    manifest: bool = False,
    stride_bytes: int = STRIDE_BYTES,
) -> None:
    """Append ``msgs`` (``topic, seq, payload``, optional ``time``) to the topic log at ``base``.

    Records of a topic are written in ``seq`` order. A topic that holds files already goes on ``pad`` bytes
    after their end. With ``sink`` and ``batch_id`` a batch that was written before is not written again. With
    ``manifest`` files keep names of their own and one list adds them all at once; the readers here know such files, others
    that go by names do not. Files longer than ``stride_bytes`` get a sparse index.
    """
    _append(msgs, base, max_file_bytes, pad, True, sink, batch_id, manifest, stride_bytes)


def write_count_blob(
    msgs: DataFrame,
    base: str,
    max_file_bytes: int = MAX_FILE_BYTES,
    pad: int = 0,
    sink: str | None = None,
    batch_id: int | None = None,
    manifest: bool = False,
    stride_bytes: int = STRIDE_BYTES,
) -> None:
    """As ``write_topic_log``, but the payload alone is the record.

    Every run adds files that go on where the topic ended; one file that all runs append to could not be
    written safely by tasks that may be repeated.
    """
    _append(msgs, base, max_file_bytes, pad, False, sink, batch_id, manifest, stride_bytes)


def write_metrics(metrics: DataFrame, base: str, t0: int | None = None, **options) -> None:
    """Log data points to the metrics topic; ``t0`` is the epoch millisecond from which they count."""

    @F.pandas_udf("binary")
    def encoded(time, interval, unique_topics, messages):
        import pandas as pd

        rows = zip(time, interval, unique_topics, messages)
        return pd.Series([encode_data_point(float(t), int(i), int(u), int(m)) for t, i, u, m in rows])

    millis = (F.col("time") * 1000).cast("bigint")
    # Points are ordered by the end of their tick, then by interval (below 2**20 seconds).
    msgs = metrics.select(
        F.lit(METRICS_TOPIC).alias("topic"),
        (F.shiftleft(millis, 20) + F.col("interval")).alias("seq"),
        (millis + t0 if t0 is not None else F.unix_millis(F.current_timestamp())).alias("time"),
        encoded("time", "interval", "unique_topics", "messages").alias("payload"),
    )
    write_topic_log(msgs, base, **options)


def _append(msgs, base, max_file_bytes, pad, envelope, sink, batch_id, manifest, stride_bytes) -> None:
    spark = msgs.sparkSession
    root = base.rstrip("/")
    journal = _Journal(root, sink, batch_id)
    options = {"pad": pad, "stride": stride_bytes, "run": uuid.uuid4().hex, "listed": manifest} | journal.options()
    if manifest:
        listed = Manifest(*locate(root)).snapshot()
        if journal.active and journal.batch_id in listed.batches.get(sink, []):
            return
    elif journal.finish_earlier_try(pad):
        return
    if envelope and "time" not in msgs.columns:
        msgs = msgs.withColumn("time", F.unix_millis(F.current_timestamp()))
    if not envelope:
        msgs = msgs.withColumn("time", F.lit(None).cast("bigint"))
    msgs = msgs.select(_checked_topic().alias("topic"), _checked_seq().alias("seq"), "time", "payload")

    # Payloads are read twice: for their sizes, which are kept as a light table, and to be written.
    with written(msgs.select("topic", "seq", frame_size("time", "payload", envelope).alias("size")), "sizes") as sizes:
        total = _totals(sizes)
        if not total.records:
            return None if manifest else journal.close()
        system, path = locate(root)
        system.create_dir(path, recursive=True)
        ends = topic_end_offset(list_files(spark, root, OFFSET_NAME_PATTERN))
        # Blocks as long as a file: a record then finds its file among one or two candidates.
        per_file = max(1.0, max_file_bytes * total.records / total.bytes)
        block_bits = min(62, max(0, int(math.log2(per_file * total.span / total.records))))
        plan = plan_spans(sizes, ends, max_file_bytes, pad, total.largest, block_bits, records=total.records)
        with written(plan, "spans") as spans:
            _write_files(msgs, spans, block_bits, total, root, envelope, options)
    if manifest:
        _list(spark, root, options["run"], listed, pad, journal)


def _write_files(msgs, spans, block_bits, total, root, envelope, options) -> None:
    spark = msgs.sparkSession
    count, files = spans.agg(F.count(F.lit(1)), F.count_distinct("topic", "base_offset")).first()
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(max(math.ceil(total.bytes / TASK_BYTES), math.ceil(total.records / TASK_RECORDS), parallel), files)
    index = _dealt(spans, files, tasks).select("topic", "block", "base_offset", "first_seq", "last_seq", "task")
    if count <= MAX_BROADCAST_SPANS:
        index = F.broadcast(index)
    in_block = msgs.withColumn("block", F.shiftright("seq", block_bits))
    in_file = F.col("seq").between(F.col("first_seq"), F.col("last_seq"))
    spark.dataSource.register(TopicLogSink)
    (
        in_block.join(index, ["topic", "block"])
        .where(in_file)
        .repartitionById(tasks, F.col("task"))
        .sortWithinPartitions("topic", "base_offset", "seq")
        .select("topic", "base_offset", "time", "payload")
        .write.format("topic_log_sink")
        .mode("append")
        .options(path=root, envelope=envelope, **options)
        .options(records=total.records, bytes=total.bytes)
        .save()
    )


def _dealt(spans: DataFrame, files: int, tasks: int) -> DataFrame:
    """Spans with the task that writes their file. Files are dealt in turn, since a few that a hash deals often meet in one
    task; many are dealt evenly enough by a hash."""
    if files > MAX_NUMBERED_FILES:
        return spans.withColumn("task", F.pmod(F.xxhash64("topic", "base_offset"), F.lit(tasks)).cast("int"))
    nth = F.row_number().over(Window.orderBy("topic", "base_offset")) - 1
    numbered = spans.select("topic", "base_offset").distinct().withColumn("task", F.pmod(nth, F.lit(tasks)).cast("int"))
    return spans.join(F.broadcast(numbered), ["topic", "base_offset"])


def _checked_topic():
    bad = F.raise_error(F.concat(F.lit("Invalid topic name "), F.coalesce("topic", F.lit("NULL"))))
    return F.when(full_match("topic", TOPIC_PATTERN), F.col("topic")).otherwise(bad)


def _checked_seq():
    return F.coalesce(F.col("seq").cast("bigint"), F.raise_error(F.lit("seq must not be NULL")).cast("bigint"))


@dataclass
class _Totals:
    records: int
    bytes: int
    largest: int
    span: int


def _totals(sizes: DataFrame) -> _Totals:
    per_topic = sizes.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("size").alias("bytes"),
        # In doubles: the range of a topic may exceed a BIGINT.
        (F.max("seq").cast("double") - F.min("seq").cast("double") + 1).alias("span"),
    )
    row = per_topic.agg(F.sum("n"), F.sum("bytes"), F.max("n"), F.sum("span")).first()
    return _Totals(row[0] or 0, row[1] or 0, row[2] or 0, row[3] or 0)


# --- files --------------------------------------------------------------------------------------------


@dataclass
class _File:
    topic: str
    base_offset: int
    hidden: str
    final: str
    bytes: int = 0
    records: int = 0
    indexed: bool = False


@dataclass
class _Written(WriterCommitMessage):
    """What a task wrote: its files or, with a manifest, lists of them."""

    files: list[_File]
    lists: list[FileList]
    records: int
    bytes: int


class TopicLogSink(DataSource):
    """Writes rows ``(topic, base_offset, time, payload)``, already in file order within a partition."""

    @classmethod
    def name(cls) -> str:
        return "topic_log_sink"

    def schema(self) -> str:
        return "topic string, base_offset bigint, time bigint, payload binary"

    def writer(self, schema, overwrite):
        return _Writer(dict(self.options))


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}
        self.root = options["path"]
        self.envelope = options["envelope"] == "true"
        self.run = options["run"]
        self.pad, self.stride = int(options["pad"]), int(options["stride"])
        self.planned = int(options["records"]), int(options["bytes"])
        self.listed = options["listed"] == "true"
        self.journal = _Journal(self.root, options.get("sink"), options.get("batchid"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, root = locate(self.root)
        attempt = uuid.uuid4().hex
        done: list[_File] = []
        current, out, index = None, None, None

        def finish() -> None:
            out.close()
            if len(index.rows) > 1:
                write_index(system, done[-1].hidden, index, attempt)
                done[-1].indexed = True

        try:
            for batch in iterator:
                frames = encode_frames(batch.column("time") if self.envelope else None, batch.column("payload"))
                sizes = pa.compute.binary_length(frames).to_numpy()
                for key, first, last in _runs(batch):
                    if key != current:
                        if out is not None:
                            finish()
                        current, index = key, SparseIndex(self.stride)
                        folder, name = f"{root}/{key[0]}", f"{key[1]:016x}"
                        hidden = f"{folder}/.{name}.{self.run}.{attempt}"
                        system.create_dir(folder, recursive=True)
                        out = system.open_output_stream(hidden)
                        done.append(_File(*key, hidden, f"{folder}/{name}"))
                    data = frame_bytes(frames.slice(first, last - first))
                    index.add(sizes[first:last], batch.column("time").slice(first, last - first) if self.envelope else None, bytes(data[:64]))
                    done[-1].bytes += out.write(data)
                    done[-1].records += last - first
            if out is not None:
                finish()
        finally:
            if out is not None and not out.closed:
                out.close()
        written = sum(f.records for f in done), sum(f.bytes for f in done)
        if not self.listed:
            return _Written(done, [], *written)
        rows = [ManifestFile(f.topic, f.base_offset, f.hidden.rsplit("/", 1)[1], f.bytes, f.records) for f in done]
        return _Written([], Manifest(system, root).put_lists(f"{self.run}/{attempt}", rows), *written)

    def commit(self, messages) -> None:
        done = [m for m in messages if m is not None]
        written = sum(m.records for m in done), sum(m.bytes for m in done)
        if written != self.planned:
            raise RuntimeError(
                f"planned {self.planned} but wrote {written} records and bytes: the messages changed between two reads"
            )
        if self.listed:  # the rest needs the session
            return Manifest(*locate(self.root)).put_run(self.run, [x for m in done for x in m.lists])
        files = [f for m in done for f in m.files]
        indexed = {f.hidden for f in files if f.indexed}
        _publish_behind(self.root, [(f.hidden, f.final) for f in files], self.pad, self.journal, indexed)
        self.journal.close()
        self._sweep({f.final.rsplit("/", 1)[0] for f in files})

    def abort(self, messages) -> None:
        system, root = locate(self.root)
        if system.get_file_info(root).type == pafs.FileType.Directory:
            entries = system.get_file_info(pafs.FileSelector(root))
            # What a plan names is left for the next try of the batch, which completes it.
            kept = {h for h, _ in self.journal.intended()}
            self._sweep({e.path for e in entries if e.type == pafs.FileType.Directory}, kept | {index_path(p) for p in kept})
            Manifest(system, root).sweep_lists(self.run, set())

    def _sweep(self, folders: set[str], keep: set[str] = frozenset()) -> None:
        """Remove hidden files that repeated or failed tasks of this run left behind."""
        system, _ = locate(self.root)

        def sweep(folder: str) -> None:
            for entry in system.get_file_info(pafs.FileSelector(folder)):
                if entry.base_name.startswith(".") and f".{self.run}." in entry.base_name and entry.path not in keep:
                    system.delete_file(entry.path)

        _in_parallel(sweep, folders)


# --- manifest -----------------------------------------------------------------------------------------


def _list(spark: SparkSession, root: str, run: str, base: Snapshot, pad: int, journal: _Journal) -> None:
    """Add the files of a run to the manifest, under the names they have."""
    manifest = Manifest(*locate(root))
    lists = manifest.of_run(run)
    few = sum(x.files for x in lists) <= INLINE_FILES
    files = [f for x in lists for f in manifest.read_list(x.name)] if few else []

    def behind(files: list[ManifestFile], lists: list[FileList], since: Snapshot):
        if not lists and since.count <= MAX_PLANNED_FILES:
            return moved(files, since.ends(), pad), lists
        if not since.count:
            return files, lists
        lists = lists + manifest.put_lists(f"{run}/{uuid.uuid4().hex}", files)
        others = since.lists + manifest.put_lists(f"{run}/{uuid.uuid4().hex}", since.inline)
        return [], _moved_lists(spark, root, run, lists, others, pad)

    named = (journal.sink, journal.batch_id) if journal.active else (None, None)
    try:
        manifest.add(files, [] if few else lists, base, behind, *named)
    finally:
        added = manifest.between(base.version, manifest.snapshot().version)
        there = {x.name for x in added.lists if x.name.startswith(f"{run}/")}
        whole = there or any(f".{run}." in f.file for f in added.inline)
        attempts = {x.name.rpartition("/")[2].partition(".")[0] for x in lists} if whole else set()
        if few:
            _in_parallel(lambda topic: _sweep_folder(root, topic, run, attempts), {f.topic for f in files})
        else:
            _sweep_by_tasks(spark, root, run, lists, attempts)
        manifest.sweep_lists(run, there)


def _listed_files(spark: SparkSession, root: str, lists: list[FileList]) -> DataFrame:
    """Files of lists that are on their way into the manifest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        manifest = Manifest(*locate(root))
        for batch in batches:
            for name in batch.column("name").to_pylist():
                columns = zip(*manifest.read_list(name))
                yield pa.RecordBatch.from_pydict(dict(zip(ManifestFile._fields, map(list, columns))))

    names = spark.createDataFrame([(x.name,) for x in lists], "name string")
    return names.repartition(len(lists), "name").mapInArrow(read, LISTED)


def _moved_lists(spark: SparkSession, root: str, run: str, lists: list[FileList], others: list[FileList], pad: int) -> list[FileList]:
    """New lists of the same files, in which topics that ``others`` have grown go on behind their new end."""
    end = F.max(F.col("base_offset") + F.col("bytes")) + pad
    ends = _listed_files(spark, root, others).groupBy("topic").agg(end.alias("begin"))
    files = _listed_files(spark, root, lists)
    first = files.groupBy("topic").agg(F.min("base_offset").alias("first"))
    shift = first.join(ends, "topic").where("begin > first").select("topic", (F.col("begin") - F.col("first")).alias("shift"))
    placed = files.join(shift, "topic", "left").withColumn("base_offset", F.col("base_offset") + F.coalesce("shift", F.lit(0)))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (ManifestFile(*r) for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        done = Manifest(*locate(root)).put_lists(f"{run}/{uuid.uuid4().hex}", rows)
        yield pa.RecordBatch.from_pylist([x._asdict() for x in done], _LIST)

    return [FileList(*r) for r in placed.select(*ManifestFile._fields).mapInArrow(put, "name string, files bigint, bytes bigint").collect()]


def _sweep_by_tasks(spark: SparkSession, root: str, run: str, lists: list[FileList], attempts: set[str]) -> None:
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for topic in batch.column("topic").to_pylist():
                _sweep_folder(root, topic, run, attempts)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    tasks = tasks_for_files(spark, sum(x.files for x in lists))
    topics = _listed_files(spark, root, lists).select("topic").repartition(tasks, "topic").distinct()
    topics.mapInArrow(sweep, "n bigint").agg(F.sum("n")).first()


def _sweep_folder(root: str, topic: str, run: str, attempts: set[str]) -> None:
    """Remove what tasks of a run left in a topic's folder, but the files and indexes of ``attempts``."""
    system, path = locate(f"{root}/{topic}")
    for entry in system.get_file_info(pafs.FileSelector(path)):
        _, of_run, attempt = entry.base_name.removesuffix(".index").rpartition(f".{run}.")
        if of_run and attempt not in attempts:
            system.delete_file(entry.path)


# --- names --------------------------------------------------------------------------------------------


def _runs(batch: pa.RecordBatch):
    """Stretches of rows that go to the same file."""
    if batch.num_rows == 0:
        return
    topic, base = batch.column("topic"), batch.column("base_offset").to_numpy()
    codes = topic.dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(base) != 0)) + 1
    for first, last in zip(np.append(0, cuts).tolist(), np.append(cuts, len(base)).tolist()):
        yield (topic[first].as_py(), int(base[first])), first, last


def _in_parallel(fn, items) -> None:
    with ThreadPoolExecutor(32) as pool:
        for some in _chunks(list(items)):  # a pool holds an object for every call it was given
            list(pool.map(fn, some))


def _exists(system: pafs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != pafs.FileType.NotFound


def _publish(root: str, files: list[tuple[str, str]], resumed: bool = False, indexed: set[str] | None = None) -> None:
    """Give files their final names. An existing file is never replaced."""
    system, _ = locate(root)

    def check(pair):
        if _exists(system, pair[1]):
            raise FileExistsError(f"another writer has created {pair[1]}")

    def move(pair):
        hidden, final = pair
        if resumed and not _exists(system, hidden):
            if not _exists(system, final):
                raise FileNotFoundError(f"neither {hidden} nor {final} is there")
            return
        if indexed is None or hidden in indexed:
            if _exists(system, index_path(hidden)):
                system.copy_file(index_path(hidden), index_path(final))
        if isinstance(system, pafs.LocalFileSystem):
            try:
                os.link(hidden, final)  # unlike a rename, fails if the name is taken
            except FileExistsError:
                if not (resumed and os.path.samefile(hidden, final)):
                    raise FileExistsError(f"another writer has created {final}") from None
            os.unlink(hidden)
            return
        check(pair)
        system.move(hidden, final)

    if not resumed:
        _in_parallel(check, files)
    _in_parallel(move, files)


def _publish_behind(root: str, files: list[tuple[str, str]], pad: int, journal: _Journal, indexed: set[str] | None, resumed: bool = False) -> None:
    """Publish files; where another writer has taken a name, the topic's files that are left go behind that writer's."""
    while True:
        files = _behind_others(root, files, pad)
        journal.intend(files)
        try:
            return _publish(root, files, resumed, indexed)
        except FileExistsError:
            resumed = True
            if _behind_others(root, files, pad) == files:  # what stands there is no file of a log
                raise


def _behind_others(root: str, files: list[tuple[str, str]], pad: int) -> list[tuple[str, str]]:
    """``files`` with new names for those that cannot have theirs any more, and for all that follow them in the topic."""
    system, _ = locate(root)
    there = {i.path: i.type for f in _chunks([p for pair in files for p in pair]) for i in system.get_file_info(f)}
    same = lambda hidden, final: isinstance(system, pafs.LocalFileSystem) and os.path.samefile(hidden, final)
    waiting = [(h, f) for h, f in files if there[h] == pafs.FileType.File and not (there[f] == pafs.FileType.File and same(h, f))]
    new_names: dict[str, str] = {}
    for folder in {f.rpartition("/")[0] for _, f in waiting if there[f] == pafs.FileType.File}:
        left = [(h, int(f.rpartition("/")[2], 16)) for h, f in waiting if f.rpartition("/")[0] == folder]
        entries = [e for e in system.get_file_info(pafs.FileSelector(folder)) if e.type == pafs.FileType.File]
        end = max(int(e.base_name, 16) + e.size for e in entries if re.fullmatch(OFFSET_NAME_PATTERN, e.base_name))
        shift = end + pad - min(b for _, b in left)
        new_names |= {h: f"{folder}/{b + shift:016x}" for h, b in left}
    return [(h, new_names.get(h, f)) for h, f in files]


def _chunks(items: list, size: int = 1000) -> Iterator[list]:
    for i in range(0, len(items), size):
        yield items[i : i + size]


class _Journal:
    """Remembers which batches of a sink were published, so that a repeated batch adds nothing."""

    def __init__(self, root: str, sink: str | None, batch_id):
        self.root, self.sink = root, sink
        self.batch_id = None if batch_id is None else int(batch_id)
        self.active = sink is not None and batch_id is not None

    def options(self) -> dict[str, str]:
        return {"sink": self.sink, "batchId": str(self.batch_id)} if self.active else {}

    def _folder(self) -> tuple[pafs.FileSystem, str]:
        system, root = locate(self.root)
        return system, f"{root}/{_COMMITS}/{self.sink}"

    def _put(self, name: str, text: str) -> None:
        system, folder = self._folder()
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{name}.tmp") as out:
            out.write(text.encode())
        system.move(f"{folder}/{name}.tmp", f"{folder}/{name}")

    def finish_earlier_try(self, pad: int = TAKEOVER_PAD) -> bool:
        """True when the batch is already there; completes one that stopped while being published."""
        if not self.active:
            return False
        system, folder = self._folder()
        if _exists(system, f"{folder}/{self.batch_id}.done"):
            return True
        files = self.intended()
        if not files:
            return False
        if not any(_exists(system, f) for pair in files for f in pair):  # nothing is left of that try: write anew
            system.delete_file(f"{folder}/{self.batch_id}.plan")
            return False
        _publish_behind(self.root, files, pad, self, None, resumed=True)
        self.close()
        return True

    def intended(self) -> list[tuple[str, str]]:
        """Hidden and final names in the plan of this batch, if one was written."""
        if not self.active:
            return []
        system, folder = self._folder()
        planned = f"{folder}/{self.batch_id}.plan"
        if not _exists(system, planned):
            return []
        with system.open_input_stream(planned) as source:
            return [tuple(f) for f in json.loads(source.read())]

    def intend(self, files: list[tuple[str, str]]) -> None:
        if self.active:
            self._put(f"{self.batch_id}.plan", json.dumps(files))

    def close(self) -> None:
        if not self.active:
            return
        self._put(f"{self.batch_id}.done", "")
        system, folder = self._folder()
        for entry in system.get_file_info(pafs.FileSelector(folder)):
            batch, _, kind = entry.base_name.partition(".")
            old = batch.isdigit() and int(batch) < self.batch_id - _KEPT_BATCHES
            if old or (kind == "plan" and batch == str(self.batch_id)):
                system.delete_file(entry.path)

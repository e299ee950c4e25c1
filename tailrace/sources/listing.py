"""Which files a topic log has, for batch and streaming readers alike."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tailrace.functions.columns import OFFSET_NAME_PATTERN, TOPIC_PATTERN
from tailrace.sources.files import locate
from tailrace.sources.manifest import FileList, Manifest, ManifestFile

FILES = "topic string, file string, name string, base_offset bigint, length bigint"

TASK_BYTES = 128 << 20
# What opening a file costs, in bytes that could be read meanwhile; keeps tasks of tiny files short.
OPEN_COST_BYTES = 4 << 20
# What a file takes in a list of the manifest, about.
LISTED_BYTES = 200
_BATCH_ROWS = 10_000


class LogFile(NamedTuple):
    """A file of a log: its name by offset, bytes, name on disk, offset of its first byte and time of its last change.

    A file of the manifest never changes; its time is 0.
    """

    topic: str
    name: str
    size: int
    physical: str
    base_offset: int | None
    changed: int


def topic_files(
    base: str, pattern: str, topic_dirs: bool, topics: str | None = None, keep: Callable[[str], bool] = lambda topic: True
) -> list[LogFile]:
    """Files whose whole name matches, by topic and name: those in the folders and those of the log's manifest.

    With ``topic_dirs`` every directory below ``base`` is a topic, or those whose whole name matches
    ``topics`` and that ``keep`` lets through; no other is listed. Otherwise ``base`` itself is one.
    """
    system, root = locate(base.rstrip("/"))
    wanted = re.compile(pattern)
    wanted_topics = re.compile(topics or TOPIC_PATTERN)

    def files(topic: str, folder: str, missing_ok: bool = False) -> list[LogFile]:
        return _folder_files(system, topic, folder, wanted, missing_ok)

    if not topic_dirs:
        topic, above = root.rsplit("/", 1)[-1], root.rsplit("/", 1)[0]
        listed = _manifest_files(Manifest(system, above), wanted, lambda t: t == topic)
        return sorted(files(topic, root) + listed, key=_order) if keep(topic) else []
    chosen = lambda t: bool(re.fullmatch(TOPIC_PATTERN, t) and wanted_topics.fullmatch(t) and keep(t))
    folders = [e.base_name for e in system.get_file_info(pafs.FileSelector(root)) if e.type == pafs.FileType.Directory and chosen(e.base_name)]
    with ThreadPoolExecutor(32) as pool:
        found = list(pool.map(lambda t: files(t, f"{root}/{t}", missing_ok=True), folders))
    return sorted([f for part in found for f in part] + _manifest_files(Manifest(system, root), wanted, chosen), key=_order)


def _folder_files(system: pafs.FileSystem, topic: str, folder: str, wanted: re.Pattern, missing_ok: bool) -> list[LogFile]:
    return [
        LogFile(topic, e.base_name, e.size, e.base_name, base_offset_of(e.base_name), e.mtime_ns or 0)
        for e in system.get_file_info(pafs.FileSelector(folder, allow_not_found=missing_ok))
        if e.type == pafs.FileType.File and e.base_name[0] not in "._" and wanted.fullmatch(e.base_name)
    ]


def _order(f: LogFile) -> tuple:
    return f.topic, f.name, f.physical


def _manifest_files(manifest: Manifest, wanted: re.Pattern, chosen: Callable[[str], bool]) -> list[LogFile]:
    return [f for f in map(_listed_file, manifest.files()) if chosen(f.topic) and wanted.fullmatch(f.name)]


def _listed_file(f: ManifestFile) -> LogFile:
    return LogFile(f.topic, f"{f.base_offset:016x}", f.bytes, f.file, f.base_offset, 0)


def packed(items: list, size: Callable[[object], int], tasks: int) -> list[list]:
    """Items in order, in groups of about equal cost for ``tasks`` tasks or more."""
    cost = sum(size(i) + OPEN_COST_BYTES for i in items)
    room = min(TASK_BYTES, max(OPEN_COST_BYTES, cost // tasks))
    groups: list[list] = [[]]
    filled = 0
    for item in items:
        if groups[-1] and filled + size(item) + OPEN_COST_BYTES > room:
            groups.append([])
            filled = 0
        groups[-1].append(item)
        filled += size(item) + OPEN_COST_BYTES
    return groups


def full_path(base: str, topic: str, name: str, topic_dirs: bool) -> str:
    base = base.rstrip("/")
    if base.startswith("file:"):
        base = locate(base)[1]
    return f"{base}/{topic}/{name}" if topic_dirs else f"{base}/{name}"


def base_offset_of(name: str) -> int | None:
    if re.fullmatch(OFFSET_NAME_PATTERN, name):
        offset = int(name, 16)
        return offset if offset < 1 << 63 else None
    return None


class TopicLogFiles(DataSource):
    """The files themselves, one row each, packed into partitions by their bytes."""

    @classmethod
    def name(cls) -> str:
        return "topic_log_files"

    def schema(self) -> str:
        return FILES

    def reader(self, schema):
        return _FileReader({k.lower(): v for k, v in self.options.items()})


class _Files(InputPartition):
    def __init__(self, files: list[LogFile]):
        self.files = files


class _FileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.base = options["path"]
        self.pattern = options["pattern"]
        self.topic_dirs = options["topicdirs"] == "true"
        self.topics = options.get("topics")
        self.tasks = int(options["tasks"])

    def partitions(self):
        found = topic_files(self.base, self.pattern, self.topic_dirs, self.topics)
        return [_Files(p) for p in packed(found, lambda f: f.size, self.tasks)]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for f in partition.files:
            yield f.topic, full_path(self.base, f.topic, f.physical, self.topic_dirs), f.name, f.base_offset, f.size


# --- listing by tasks ---------------------------------------------------------------------------------


class TopicLogTopics(DataSource):
    """Topics that have a folder. One task lists these, since only the folder above knows them."""

    @classmethod
    def name(cls) -> str:
        return "topic_log_topics"

    def schema(self) -> str:
        return "topic string"

    def reader(self, schema):
        return _TopicReader({k.lower(): v for k, v in self.options.items()})


class _TopicReader(DataSourceReader):
    def __init__(self, options: dict):
        self.base = options["path"].rstrip("/")
        self.topic_dirs = options["topicdirs"] == "true"
        self.topics = options.get("topics", TOPIC_PATTERN)

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, root = locate(self.base)
        wanted, wanted_topics = re.compile(TOPIC_PATTERN), re.compile(self.topics)
        topics = iter([root.rsplit("/", 1)[-1]])
        if self.topic_dirs:
            topics = (t for t in _folders(system, root) if wanted.fullmatch(t) and wanted_topics.fullmatch(t))
        while some := list(islice(topics, _BATCH_ROWS)):
            yield pa.RecordBatch.from_pydict({"topic": pa.array(some, pa.string())})


def _folders(system: pafs.FileSystem, root: str) -> Iterator[str]:
    if not isinstance(system, pafs.LocalFileSystem):
        yield from (e.base_name for e in system.get_file_info(pafs.FileSelector(root)) if e.type == pafs.FileType.Directory)
        return
    with os.scandir(root) as entries:  # Arrow would list all before the first
        yield from (e.name for e in entries if e.is_dir())


def list_folders(base: str, pattern: str, topic_dirs: bool):
    """Lists the folders of topics, for a map over batches of them."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = locate(base.rstrip("/"))
        wanted = re.compile(pattern)
        files = lambda t: _folder_files(system, t, f"{root}/{t}" if topic_dirs else root, wanted, topic_dirs)
        found: list[LogFile] = []
        with ThreadPoolExecutor(8) as pool:
            for batch in batches:
                for part in pool.map(files, batch.column("topic").to_pylist()):
                    found += part
                    while len(found) >= _BATCH_ROWS:
                        yield _as_batch(found[:_BATCH_ROWS], base, topic_dirs)
                        found = found[_BATCH_ROWS:]
        if found:
            yield _as_batch(found, base, topic_dirs)

    return listed


def _as_batch(files: list[LogFile], base: str, topic_dirs: bool) -> pa.RecordBatch:
    columns = {
        "topic": pa.array([f.topic for f in files], pa.string()),
        "file": pa.array([full_path(base, f.topic, f.physical, topic_dirs) for f in files], pa.string()),
        "name": pa.array([f.name for f in files], pa.string()),
        "base_offset": pa.array([f.base_offset for f in files], pa.int64()),
        "length": pa.array([f.size for f in files], pa.int64()),
    }
    return pa.RecordBatch.from_pydict(columns)


class ManifestFiles(DataSource):
    """Files of a log's manifest, whose lists are read by the tasks."""

    @classmethod
    def name(cls) -> str:
        return "topic_log_manifest"

    def schema(self) -> str:
        return FILES

    def reader(self, schema):
        return _ManifestReader({k.lower(): v for k, v in self.options.items()})


class _Lists(InputPartition):
    def __init__(self, lists: list[FileList], files: list[ManifestFile]):
        self.lists, self.files = lists, files


class _ManifestReader(DataSourceReader):
    def __init__(self, options: dict):
        self.base = options["path"].rstrip("/")
        self.pattern = options["pattern"]
        self.topic_dirs = options["topicdirs"] == "true"
        self.topics = options.get("topics", TOPIC_PATTERN)
        self.tasks = int(options["tasks"])

    def partitions(self):
        now = manifest_of(self.base, self.topic_dirs).snapshot()
        groups = packed(now.lists, lambda x: x.files * LISTED_BYTES, self.tasks)
        inline = [_Lists([], now.inline[i : i + _BATCH_ROWS]) for i in range(0, len(now.inline), _BATCH_ROWS)]
        return [_Lists(g, []) for g in groups] + inline

    def read(self, partition: _Lists) -> Iterator[pa.RecordBatch]:
        manifest = manifest_of(self.base, self.topic_dirs)
        wanted, wanted_topics = re.compile(self.pattern), re.compile(self.topics)
        only = None if self.topic_dirs else self.base.rsplit("/", 1)[-1]
        chosen = lambda t: bool(re.fullmatch(TOPIC_PATTERN, t) and wanted_topics.fullmatch(t)) if self.topic_dirs else t == only
        for files in [partition.files, *(manifest.read_list(x.name) for x in partition.lists)]:
            found = [f for f in map(_listed_file, files) if chosen(f.topic) and wanted.fullmatch(f.name)]
            if found:
                yield _as_batch(found, self.base, self.topic_dirs)


def manifest_of(base: str, topic_dirs: bool) -> Manifest:
    system, root = locate(base.rstrip("/"))
    return Manifest(system, root if topic_dirs else root.rsplit("/", 1)[0])

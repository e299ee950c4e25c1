"""Pruned reads, the sparse index, the manifest, and what a tail remembers of many files."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

import test_topic_log as logs
from test_streaming import drain
from tailrace.sinks import topic_log
from tailrace.sinks.topic_log import write_count_blob, write_topic_log
from tailrace.sources.batch import index_topic_log, list_files, read_count_blob, read_topic_log
from tailrace.sources import scan
from tailrace.sources.files import locate
from tailrace.sources.index import SparseIndex, index_path, read_index
from tailrace.sources.listing import topic_files
from tailrace.sources.manifest import Manifest, ManifestFile
from tailrace.sources.scan import TopicLogRecords
from tailrace.streaming.positions import Positions, replaced
from tailrace.streaming.tail import tail_topic_log


def spoil(path):
    with open(path, "wb") as f:
        f.write(b"\xff\xff\xff\xff no record")


def test_conditions_open_no_other_file(spark, tmp_path):
    base = str(tmp_path / "log")
    write_topic_log(logs.numbered(spark, 4, 400), base, max_file_bytes=500)
    files = sorted(os.listdir(f"{base}/topic-1"))
    for topic in ("topic-0", "topic-2"):
        for name in os.listdir(f"{base}/{topic}"):
            spoil(f"{base}/{topic}/{name}")
    spoil(f"{base}/topic-3/{files[0]}")
    count = lambda *where, **options: read_topic_log(spark, base, where=list(where), **options).count()
    assert count(("topic", "=", "topic-1")) == 100
    assert count(("topic", "in", ["topic-1", "none"])) == 100
    assert count(("topic", "startswith", "topic-1"), columns=["time"]) == 100
    assert 0 < count(("topic", ">=", "topic-3"), ("base_offset", ">", 0)) < 100
    assert count(("file", "=", f"{base}/topic-1/{files[2]}")) > 0
    with pytest.raises(Exception, match="negative record length"):
        count(("topic", ">", "topic-1"))
    with pytest.raises(ValueError, match="unknown operator"):
        count(("topic", "like", "x"))
    only = read_topic_log(spark, base, columns=["payload"], where=[("topic", "=", "topic-1")])
    assert only.columns == ["payload"] and only.distinct().count() == 100


def test_conditions_keep_their_meaning(spark, tmp_path):
    base = str(tmp_path / "log")
    rows = [("a", i, None if i % 5 == 0 else i, b"x" * (i % 7)) for i in range(200)] + [("b", 1, 7, b"")]
    write_topic_log(spark.createDataFrame(rows, logs.MSGS), base, max_file_bytes=300, stride_bytes=64)
    every = read_topic_log(spark, base).toPandas()
    assert any(n.endswith(".index") for n in os.listdir(f"{base}/a"))
    for where, keep in (
        ([("time", ">=", 50), ("time", "<", 60)], every.time.between(50, 59)), ([("time", "in", [3, 4, 150])], every.time.isin([3, 4, 150])),
        ([("time", "=", 7)], every.time == 7), ([("record_offset", "=", 0)], every.record_offset == 0), ([("time", "in", [])], every.time > 1e9),
        ([("record_offset", ">", 100), ("time", "<", 120)], (every.record_offset > 100) & (every.time < 120)),
    ):
        assert read_topic_log(spark, base, where=where).count() == int(keep.sum()), where
    halves = [read_topic_log(spark, base, where=[("topic", "=", t)]) for t in "ab"]
    assert halves[0].union(halves[1]).count() == 201 and read_topic_log(spark, base).where("topic = 'a'").count() == 200


def test_index_bounds_what_is_read(spark, tmp_path):
    base, stride = str(tmp_path / "log"), 2000
    write_topic_log(logs.numbered(spark, 1, 3000), base, stride_bytes=1 << 40)
    path = f"{base}/topic-0/{0:016x}"
    size = os.path.getsize(path)
    assert not os.path.exists(index_path(path))
    assert index_topic_log(spark, base, stride_bytes=stride) == 1 and index_topic_log(spark, base, stride_bytes=stride) == 0
    index = read_index(*locate(path), size)
    by_writer = str(tmp_path / "other")
    write_topic_log(logs.numbered(spark, 1, 3000), by_writer, stride_bytes=stride)
    other = read_index(*locate(f"{by_writer}/topic-0/{0:016x}"), size)
    assert (index.rows, index.covered, index.records) == (other.rows, other.covered, other.records) and index.records == 3000

    options = {"path": base, "kind": "envelope", "pattern": ".*", "partBytes": "5000", "tasks": "4"}
    reader = TopicLogRecords(options).reader(read_topic_log(spark, base).schema)
    parts = [p for group in reader.partitions() for p in group.parts]
    assert len(parts) > 10 and [p[4] for p in parts[1:]] == [p[5] for p in parts[:-1]] and parts[-1][5] == size
    late = [("record_offset", ">=", 40_000), ("time", "<", 1_700_000_000_000 + 2500)]
    ranges = TopicLogRecords(options | {"conditions": json.dumps(late)}).reader(read_topic_log(spark, base).schema)._wanted(path, size, 0, size)
    recs = read_topic_log(spark, base)
    found = read_topic_log(spark, base, where=late).agg(F.min("record_offset"), F.max("record_offset"), F.count("*")).first()
    assert len(ranges) == 1 and found[0] - stride - 50 <= ranges[0][0] <= found[0] and found[1] < ranges[0][1] <= found[1] + stride + 50
    assert found[2] == recs.where("record_offset >= 40000 and time < 1700000002500").count() > 0
    assert recs.count() == read_topic_log(spark, base, part_bytes=5000).count() == 3000
    with open(path, "ab") as f:  # growth is read, a file with another beginning has no index
        f.write(logs.frame(5, b"late"))
    assert read_topic_log(spark, base, where=[("time", "=", 5)]).count() == 1
    with open(path, "wb") as f:
        f.write(b"".join(logs.frame(i, b"new" * 9) for i in range(3000)))
    assert read_index(*locate(path), os.path.getsize(path)) is None and read_topic_log(spark, base, where=[("time", "=", 2999)]).count() == 1


def test_stream_offsets_select_files_and_parts(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "log")
    write_topic_log(logs.numbered(spark, 1, 3000), base, max_file_bytes=20_000, stride_bytes=1 << 40)
    assert index_topic_log(spark, base, stride_bytes=500) > 2
    recs = read_topic_log(spark, base)
    where = [("stream_offset", ">=", 30_000), ("stream_offset", "<", 45_000)]
    expected = sorted(recs.where("stream_offset >= 30000 and stream_offset < 45000").select("stream_offset", "payload").collect())
    assert len(expected) > 100 and expected == sorted(read_topic_log(spark, base, part_bytes=1000, where=where).select("stream_offset", "payload").collect())

    opened = []
    monkeypatch.setattr(scan, "read_index", lambda system, path, size: opened.append(path) or read_index(system, path, size))
    options = {"path": base, "kind": "envelope", "pattern": ".*", "partBytes": "1000", "tasks": "4", "conditions": json.dumps(where)}
    reader = TopicLogRecords(options).reader(recs.schema)
    groups = reader.partitions()
    parts = [p for group in groups for p in group.parts]
    rows = sum(batch.num_rows for group in groups for batch in reader.read(group))
    assert len(parts) > 10 and len(opened) == len({p[1] for p in parts}) == 2  # an index is read once, not once a part
    assert len(expected) <= rows < len(expected) + 60
    assert all(p[2] + p[5] > 30_000 and p[2] + p[4] < 45_000 for p in parts)


def test_index_of_long_records_and_blobs(spark, tmp_path):
    base = str(tmp_path / "blobs")
    rows = [("t", i, None, bytes([65 + i]) * n) for i, n in enumerate((10, 5000, 0, 20, 7000, 1, 1, 3000))]
    write_count_blob(spark.createDataFrame(rows, logs.MSGS), base, stride_bytes=1000)
    index = SparseIndex(1000)
    import numpy as np

    for sizes in ([14, 5004, 4, 24], [7004], [5, 5, 3004]):
        index.add(np.array(sizes), None)
    assert read_index(*locate(f"{base}/t/{0:016x}"), index.covered).rows == index.rows
    got = read_count_blob(spark, base, part_bytes=1000).orderBy("record_offset").collect()
    assert [bytes(r.content) for r in got] == [r[3] for r in rows]
    assert [bytes(r.content) for r in read_count_blob(spark, base, where=[("record_offset", ">", 5046)]).collect()] == [r[3] for r in rows[5:]]


def test_two_writers_race_for_a_manifest(spark, tmp_path):
    base = str(tmp_path / "log")
    write_topic_log(logs.numbered(spark, 2, 40), base, max_file_bytes=300, manifest=True, pad=10)
    errors = []

    def write(first):
        try:
            write_topic_log(logs.numbered(spark, 3, 60, first=first), base, max_file_bytes=300, manifest=True, pad=10, sink="s", batch_id=first)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    writers = [threading.Thread(target=write, args=(first,)) for first in (100, 200, 300)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    write(200)  # again: nothing is added
    assert not errors
    recs = read_topic_log(spark, base).collect()
    assert sorted(int(bytes(r.payload)) - 10**9 for r in recs) == sorted([*range(40), *range(100, 160), *range(200, 260), *range(300, 360)])
    files = sorted((f.topic, f.base_offset, f.bytes) for f in Manifest(*locate(base)).files())
    for (t, a, n), (u, b, _) in zip(files, files[1:]):
        assert t != u or a + n == b or a + n + 10 <= b
    assert all(r.stream_offset == r.base_offset + r.record_offset for r in recs)
    hidden = [n for t in os.listdir(base) if t.startswith("topic") for n in os.listdir(f"{base}/{t}")]
    assert len(hidden) == len(files)
    seen = drain(tail_topic_log(spark, base), tmp_path).collect()
    assert sorted(r.stream_offset for r in seen) == sorted(r.stream_offset for r in recs)
    assert {r.name for r in list_files(spark, base).collect()} == {f"{b:016x}" for _, b, _ in files}


def test_manifest_versions_and_checkpoints(tmp_path):
    manifest = Manifest(*locate(str(tmp_path)))
    stale = manifest.snapshot()
    for i in range(70):
        assert manifest.append([ManifestFile("t", 0, f"f{i}", 10, 1)], stale, pad=5, sink="s", batch_id=i)
    assert not manifest.append([ManifestFile("t", 0, "again", 10, 1)], stale, 5, "s", 69)
    assert [(f.base_offset, f.file) for f in manifest.files()] == [(15 * i, f"f{i}") for i in range(70)]
    assert len(manifest.snapshot(40).files) == 41 and any(n.endswith(".checkpoint") for n in os.listdir(tmp_path / ".manifest"))


def test_batch_whose_name_was_taken_is_published_behind(spark, tmp_path):
    base = str(tmp_path / "log")
    os.makedirs(f"{base}/t")
    pairs = [(f"{base}/t/.h{i}", f"{base}/t/{i * 100:016x}") for i in range(2)]
    for hidden, _ in pairs:
        with open(hidden, "wb") as f:
            f.write(logs.frame(1, hidden[-1].encode()))
    topic_log._Journal(base, "s", 3).intend(pairs)
    with open(pairs[0][1], "wb") as f:
        f.write(logs.frame(9, b"other"))
    for _ in range(2):
        write_topic_log(logs.numbered(spark, 1, 10), base, sink="s", batch_id=3, pad=50)
    got = read_topic_log(spark, base).orderBy("stream_offset").collect()
    end = len(logs.frame(9, b"other"))
    assert [(r.stream_offset, bytes(r.payload)) for r in got] == [(0, b"other"), (end + 50, b"0"), (end + 150, b"1")]


def test_offsets_stay_small(tmp_path):
    for i in range(2000):
        (tmp_path / f"t{i % 3}").mkdir(exist_ok=True)
        (tmp_path / f"t{i % 3}" / f"{i * 10:016x}").write_bytes(bytes([i % 200]) * 10)
    listed = lambda: topic_files(str(tmp_path), ".*", True)
    first = Positions(str(tmp_path), "v", True)
    offsets = [first.offset(listed())]
    assert len(first.files(offsets[0])) == 2000 and len(json.dumps(offsets[0])) < 500
    old = tmp_path / "t0" / f"{0:016x}"
    old.write_bytes(old.read_bytes() + b"late")
    for i in range(1, 400):  # new files, one by one as after restarts, and one that goes
        (tmp_path / "t1" / f"{10**6 + i:016x}").write_bytes(b"n" * 5)
        if i % 40 == 0:
            later = Positions(str(tmp_path), "v", True)
            offsets.append(later.offset(listed()))
    (tmp_path / "t1" / f"{10:016x}").unlink()
    offsets.append(later.offset(listed()))
    assert all(len(o["changed"]) <= 256 and len(o["parts"]) < 8 for o in offsets)
    again = Positions(str(tmp_path), "v", True)
    assert [len(again.files(o)) for o in offsets] == [2000, *(2000 + 40 * i for i in range(1, 10)), 2398]
    assert again.files(offsets[1])[f"t0/{0:016x}"][0] == 14 and again.files(offsets[0])[f"t0/{0:016x}"][0] == 10
    assert again.files({"t0/x": 7}) == {"t0/x": [7, "", 0]}  # written by an earlier version


def test_generations():
    assert replaced([10, "aabb", 1], [9, "aabb", 2]) and replaced([10, "aabb", 1], [20, "aacc", 2])
    assert not replaced([2, "aabb", 1], [20, "aabbccdd", 2]) and not replaced([5, "", 0], [9, "aa", 1])


def test_tail_of_many_files_sees_late_growth_and_longer_replacements(spark, tmp_path):
    base = tmp_path / "log"
    (base / "t").mkdir(parents=True)
    for i in range(300):
        (base / "t" / f"{i * 1000:016x}").write_bytes(logs.frame(i, b"old"))
    drain(tail_topic_log(spark, str(base)), tmp_path)
    with open(base / "t" / f"{0:016x}", "ab") as f:
        f.write(logs.frame(1000, b"late"))
    (base / "t" / f"{1000:016x}").write_bytes(logs.frame(2000, b"a longer one") + logs.frame(2001, b"with two"))
    (base / "t" / f"{2000:016x}").write_bytes(logs.frame(2, b"old") + logs.frame(3000, b"same beginning: grown"))
    got = drain(tail_topic_log(spark, str(base)), tmp_path)
    assert sorted(r.time for r in got.collect()) == [*range(300), 1000, 2000, 2001, 3000]
    newest = max(os.listdir(tmp_path / "q-ckpt" / "offsets"), key=lambda n: int(n) if n.isdigit() else -1)
    assert os.path.getsize(tmp_path / "q-ckpt" / "offsets" / newest) < 3000

import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from tailrace.functions.codec import encode_frames
from tailrace.sinks.topic_log import valid_topics, write_count_blob, write_metrics, write_topic_log
from tailrace.sources.batch import (
    list_files,
    parse_payload,
    read_count_blob,
    read_framed,
    read_metrics,
    read_topic_log,
    split_words,
    torn_tails,
)

MSGS = "topic string, seq bigint, time bigint, payload binary"


def frame(time, payload):
    import pyarrow as pa

    return encode_frames(pa.array([time], pa.int64()), pa.array([payload], pa.binary()))[0].as_py()


def numbered(spark, topics, n, first=0):
    rows = [(f"topic-{i % topics}", i, 1_700_000_000_000 + i, str(10**9 + i).encode()) for i in range(first, first + n)]
    return spark.createDataFrame(rows, MSGS)


def sequential_files(msgs, limit):
    """What one writer would do: (topic, base) -> bytes."""
    files, open_file = {}, {}
    for topic, _, time, payload in sorted(msgs, key=lambda r: (r[0], r[1])):
        base = open_file.get(topic, 0)
        if (topic, base) in files and len(files[topic, base]) > limit:
            base += len(files[topic, base])
        open_file[topic] = base
        files[topic, base] = files.get((topic, base), b"") + frame(time, payload)
    return files


def on_disk(base):
    found = {}
    for topic in os.listdir(base):
        if not topic.startswith("."):
            for name in os.listdir(f"{base}/{topic}"):
                with open(f"{base}/{topic}/{name}", "rb") as f:
                    found[topic, int(name, 16)] = f.read()
    return found


def test_ten_topics_in_small_files(spark, tmp_path):
    base = str(tmp_path / "log")
    msgs = numbered(spark, 10, 4000)
    write_topic_log(msgs, base, max_file_bytes=200)
    files = on_disk(base)
    assert files == sequential_files([tuple(r) for r in msgs.collect()], 200)
    for topic in {t for t, _ in files}:
        offset = 0
        short = 0
        for base_offset in sorted(b for t, b in files if t == topic):
            assert base_offset == offset
            size = len(files[topic, base_offset])
            assert size < 250
            short += size <= 200
            offset += size
        assert short <= 1


def test_rollover_round_trip_in_order(spark, tmp_path):
    base = str(tmp_path / "log")
    rows = [("topic-1", i, i + 5, str(i).encode()) for i in range(1000)]
    write_topic_log(spark.createDataFrame(rows, MSGS), base, max_file_bytes=500)
    back = read_topic_log(spark, base).orderBy("topic", "stream_offset").collect()
    assert [(r.time, bytes(r.payload)) for r in back] == [(i + 5, str(i).encode()) for i in range(1000)]
    assert all(r.stream_offset == r.base_offset + r.record_offset for r in back)
    one_dir = read_topic_log(spark, f"{base}/topic-1", topic_dirs=False)
    assert one_dir.count() == 1000


@pytest.mark.parametrize("part_bytes", [1 << 28, 300])
def test_sizes_nulls_and_big_files(spark, tmp_path, part_bytes):
    base = str(tmp_path / "log")
    rng = random.Random(4)
    rows = []
    for i in range(600):
        payload = rng.choice([None, b"", b"x" * rng.randrange(400), "é✓".encode() * rng.randrange(20)])
        rows.append((rng.choice(["_a", "b-", "C"]), i, rng.choice([None, 0, -3, 2**45]), payload))
    write_topic_log(spark.createDataFrame(rows, MSGS), base, max_file_bytes=5000)
    back = read_topic_log(spark, base, part_bytes=part_bytes).orderBy("topic", "stream_offset").collect()
    got = [(r.topic, r.time, None if r.payload is None else bytes(r.payload)) for r in back]
    want = [(t, m, p) for t, s, m, p in sorted(rows, key=lambda r: (r[0], r[1]))]
    assert got == want


def test_second_run_leaves_a_gap_and_never_reopens(spark, tmp_path):
    base = str(tmp_path / "log")
    write_topic_log(numbered(spark, 2, 100), base, max_file_bytes=300)
    first = on_disk(base)
    write_topic_log(numbered(spark, 3, 90, first=100), base, max_file_bytes=300, pad=1000)
    both = on_disk(base)
    assert all(both[k] == v for k, v in first.items())
    end = max(b + len(v) for (t, b), v in first.items() if t == "topic-0")
    assert min(b for t, b in both if t == "topic-0" and (t, b) not in first) == end + 1000
    assert min(b for t, b in both if t == "topic-2") == 0
    assert read_topic_log(spark, base).count() == 190


def test_repeated_batch_is_written_once(spark, tmp_path):
    base = str(tmp_path / "log")
    msgs = numbered(spark, 2, 50)
    for _ in range(2):
        write_topic_log(msgs, base, sink="s", batch_id=7)
    assert read_topic_log(spark, base).count() == 50


def test_interrupted_publish_is_completed(spark, tmp_path):
    from tailrace.sinks import topic_log

    base = str(tmp_path / "log")
    os.makedirs(f"{base}/t")
    pairs = [(f"{base}/t/.h{i}", f"{base}/t/{i:016x}") for i in range(2)]
    open(pairs[0][1], "wb").close()  # the first file had been moved
    with open(pairs[1][0], "wb") as f:
        f.write(frame(1, b"x"))
    topic_log._Journal(base, "s", 3).intend(pairs)
    write_topic_log(numbered(spark, 1, 10), base, sink="s", batch_id=3)
    assert [bytes(r.payload) for r in read_topic_log(spark, base).collect()] == [b"x"]


def test_failed_commit_is_completed_by_the_next_try(spark, tmp_path):
    base = str(tmp_path / "log")
    write_topic_log(spark.createDataFrame([("a", 1, 1, b"old")], MSGS), base)
    msgs = spark.createDataFrame([("a", 2, 1, b"x"), ("b", 3, 1, b"y")], MSGS)
    os.makedirs(f"{base}/b/{0:016x}")  # stands where the new file is to be
    with pytest.raises(Exception, match="another writer"):
        write_topic_log(msgs, base, sink="s", batch_id=1)
    os.rmdir(f"{base}/b/{0:016x}")
    for _ in range(2):
        write_topic_log(msgs, base, sink="s", batch_id=1)
    assert sorted(bytes(r.payload) for r in read_topic_log(spark, base).collect()) == [b"old", b"x", b"y"]


def test_plan_without_files_is_dropped(spark, tmp_path):
    from tailrace.sinks import topic_log

    base = str(tmp_path / "log")
    topic_log._Journal(base, "s", 3).intend([(f"{base}/t/.gone", f"{base}/t/{0:016x}")])
    write_topic_log(numbered(spark, 1, 10), base, sink="s", batch_id=3)
    assert read_topic_log(spark, base).count() == 10


def test_published_file_is_never_replaced(tmp_path):
    from tailrace.sinks import topic_log

    hidden, final = str(tmp_path / ".h"), str(tmp_path / "f")
    for path in (hidden, final):
        with open(path, "w") as f:
            f.write(path)
    with pytest.raises(FileExistsError):
        topic_log._publish(str(tmp_path), [(hidden, final)], resumed=True)
    assert open(final).read() == final


def test_large_counts_and_nulls(spark, tmp_path):
    from tailrace.functions.codec import decode_data_point, encode_data_point
    from tailrace.operators.offsets import running_offset
    from tailrace.plans.rollover import rollover_plan

    assert decode_data_point(encode_data_point(1.0, 60, 2, 8_589_934_597))[3] == 8_589_934_597
    sizes = spark.createDataFrame([("t", i, 10) for i in range(40)] + [("t", None, 10)], "topic string, seq bigint, size bigint")
    for plan in (running_offset(sizes), rollover_plan(sizes), rollover_plan(sizes, segment_rows=8)):
        with pytest.raises(Exception, match="seq is null"):
            plan.collect()


def test_invalid_topic(spark, tmp_path):
    msgs = spark.createDataFrame([("ok", 1, 1, b"a"), ("no/slash", 2, 1, b"b"), ("", 3, 1, b"c"), (None, 4, 1, b"d"), ("x\n", 5, 1, b"")], MSGS)
    good, bad = valid_topics(msgs)
    assert [r.seq for r in good.collect()] == [1] and sorted(r.seq for r in bad.collect()) == [2, 3, 4, 5]
    with pytest.raises(Exception, match="Invalid topic name"):
        write_topic_log(msgs, str(tmp_path / "log"))


def test_torn_record_is_held_back_at_every_cut(spark, tmp_path):
    records = [frame(i, f"test {i}".encode()) for i in (1, 2, 3)]
    whole = b"".join(records)
    edges = [0, len(records[0]), len(records[0]) + len(records[1]), len(whole)]
    for cut in range(len(whole) + 1):
        topic = tmp_path / f"t{cut}"
        topic.mkdir()
        (topic / ("0" * 16)).write_bytes(whole[:cut])
    recs = parse_payload(read_topic_log(spark, str(tmp_path)), lambda p: split_words(p, ["word", "n"]))
    found = {}
    for r in recs.collect():
        assert r.word == "test" and int(r.n) == r.time
        found.setdefault(r.topic, []).append(int(r.n))
    torn = {r.topic: (r.complete_bytes, r.torn_bytes) for r in torn_tails(spark, str(tmp_path)).collect()}
    for cut in range(len(whole) + 1):
        n = sum(e <= cut for e in edges[1:])
        assert sorted(found.get(f"t{cut}", [])) == list(range(1, n + 1))
        assert torn.get(f"t{cut}") == (None if cut == edges[n] else (edges[n], cut - edges[n]))


def test_broken_length_is_reported(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "0").write_bytes(struct.pack(">i", -5) + b"abc")
    with pytest.raises(Exception, match="negative record length"):
        read_topic_log(spark, str(tmp_path)).collect()


def test_blobs_with_name_pattern(spark, tmp_path):
    def blob(*parts):
        return b"".join(struct.pack(">i", len(p)) + p for p in parts)

    (tmp_path / "x-1").write_bytes(blob(b"1", b"", b"3"))
    (tmp_path / "x-10").write_bytes(blob(b"4") + b"\x00\x00")
    (tmp_path / "y-1").write_bytes(blob(b"9"))
    (tmp_path / "ax-1").write_bytes(blob(b"8"))
    recs = read_count_blob(spark, str(tmp_path), "x-.*", topic_dirs=False).collect()
    got = sorted((os.path.basename(r.file), r.record_offset, bytes(r.content)) for r in recs)
    assert got == [("x-1", 0, b"1"), ("x-1", 5, b""), ("x-1", 9, b"3"), ("x-10", 0, b"4")]


def test_blob_round_trip(spark, tmp_path):
    base = str(tmp_path / "log")
    write_count_blob(numbered(spark, 3, 300), base, max_file_bytes=100)
    write_count_blob(numbered(spark, 3, 30, first=300), base, max_file_bytes=100)
    back = read_count_blob(spark, base).orderBy("topic", F.col("base_offset") + F.col("record_offset")).collect()
    want = [(r.topic, bytes(r.payload)) for r in numbered(spark, 3, 330).orderBy("topic", "seq").collect()]
    assert [(r.topic, bytes(r.content)) for r in back] == want


def test_positioned_read(spark, tmp_path):
    base = str(tmp_path / "log")
    write_topic_log(numbered(spark, 2, 40), base, max_file_bytes=200)
    every = read_topic_log(spark, base)
    offsets = every.groupBy("file").agg(F.max("record_offset").alias("record_offset"))
    last = read_topic_log(spark, base, starting_offsets=offsets)
    assert last.count() == list_files(spark, base).count()
    first_file = every.orderBy("topic", "base_offset").first().file
    skipped = read_topic_log(spark, base, starting_offsets={first_file: 10**6})
    assert skipped.count() == 40 - every.where(F.col("file") == first_file).count()


def test_own_framing(spark, tmp_path):
    (tmp_path / "x-2").write_text("4\n5\n6\n")
    (tmp_path / "x-1").write_text("1\n2\n3")

    def lines(buf):
        rows, at = [], 0
        while (end := buf.find(b"\n", at)) >= 0:
            rows.append((at, buf[at:end].decode()))
            at = end + 1
        return rows, at

    recs = read_framed(spark, str(tmp_path), lines, "value string", "x-.*", topic_dirs=False)
    got = [(os.path.basename(r.file), r.record_offset, r.value) for r in recs.orderBy("file", "record_offset").collect()]
    assert got == [("x-1", 0, "1"), ("x-1", 2, "2"), ("x-2", 0, "4"), ("x-2", 2, "5"), ("x-2", 4, "6")]


def test_metrics_topic(spark, tmp_path):
    base = str(tmp_path / "log")
    points = [(1.0, 1, 3, 10), (2.0, 1, 0, 0), (10.0, 10, 4, 300), (10.0, 1, 4, 2**31)]
    write_metrics(spark.createDataFrame(points, "time double, interval int, unique_topics bigint, messages bigint"), base, t0=0)
    assert sorted(map(tuple, read_metrics(spark, base).collect())) == sorted(points)


def test_empty_log(spark, tmp_path):
    assert read_topic_log(spark, str(tmp_path)).count() == 0
    write_topic_log(numbered(spark, 1, 0), str(tmp_path / "new"))
    with pytest.raises(Exception, match="FileNotFoundError"):
        list_files(spark, str(tmp_path / "absent")).collect()


def test_topics_can_be_chosen(spark, tmp_path):
    base = str(tmp_path / "log")
    write_topic_log(numbered(spark, 12, 120), base, max_file_bytes=100)
    got = read_topic_log(spark, base, topics="topic-1|topic-1[0-9]").groupBy("topic").count().collect()
    assert sorted(map(tuple, got)) == [("topic-1", 10), ("topic-10", 10), ("topic-11", 10)]


def test_messages_that_change_between_reads_are_not_published(spark, tmp_path):
    base = str(tmp_path / "log")
    flag = tmp_path / "read-before"

    def once(batches):
        seen = flag.exists()
        flag.touch()
        for batch in batches:
            yield batch.slice(1) if seen else batch

    msgs = numbered(spark, 1, 50).coalesce(1).mapInArrow(once, MSGS)
    with pytest.raises(Exception, match="changed between two reads"):
        write_topic_log(msgs, base)
    assert list_files(spark, base).count() == 0
    assert [n for _, _, names in os.walk(base) for n in names] == []


def test_files_are_dealt_evenly_to_tasks(spark):
    from tailrace.sinks import topic_log

    spans = spark.createDataFrame([(t, 100 * i, b) for t in "ab" for i in range(4) for b in (0, 1)], "topic string, base_offset bigint, block bigint")
    for tasks in (8, 4):
        dealt = topic_log._dealt(spans, 8, tasks).select("topic", "base_offset", "task").distinct().collect()
        assert len(dealt) == 8
        assert sorted(r.task for r in dealt) == sorted(i % tasks for i in range(8))

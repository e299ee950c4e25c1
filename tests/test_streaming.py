import os
import random
import time

import pytest

from pyspark.sql import functions as F

import test_topic_log as batch_tests
from tailrace.operators.metrics import interval_metrics
from tailrace.operators.status import counter_changes, fold_status_counters
from tailrace.sinks.topic_log import write_topic_log
from tailrace.sources.batch import read_topic_log
from tailrace.streaming.metrics import on_tick, stream_interval_metrics
from tailrace.streaming.sink import append_topic_log
from tailrace.streaming import status
from tailrace.streaming.status import stream_status_counters
from tailrace.streaming.tail import tail_count_blob, tail_framed, tail_topic_log

frame = batch_tests.frame


def drain(stream, tmp_path, name="q", mode="append"):
    """Run the query over what is there now, as a restart from the same checkpoint would."""
    out = str(tmp_path / f"{name}-out")

    def keep(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(keep)
        .option("checkpointLocation", str(tmp_path / f"{name}-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return stream.sparkSession.read.parquet(out)


def test_tail_over_restarts_with_cuts_inside_records(spark, tmp_path):
    base = tmp_path / "log"
    (base / "t").mkdir(parents=True)
    path = base / "t" / ("0" * 16)
    records = [frame(i, f"test {i}".encode()) for i in range(6)]
    whole = b"".join(records)
    starts = [sum(map(len, records[:i])) for i in range(6)]
    written = 0
    for end in (starts[1] + 2, starts[2] + 9, starts[2] + 9, starts[4], len(whole)):
        with open(path, "ab") as f:
            f.write(whole[written:end])
        written = end
        got = drain(tail_topic_log(spark, str(base)), tmp_path)
        complete = sum(s + len(r) <= end for s, r in zip(starts, records))
        rows = sorted((r.record_offset, r.time, bytes(r.payload)) for r in got.collect())
        assert rows == [(starts[i], i, f"test {i}".encode()) for i in range(complete)]


def test_tail_sees_new_topics_files_and_growth_of_older_ones(spark, tmp_path):
    base = str(tmp_path / "log")
    write_topic_log(batch_tests.numbered(spark, 3, 60), base, max_file_bytes=200)
    drain(tail_topic_log(spark, base), tmp_path)
    write_topic_log(batch_tests.numbered(spark, 4, 40, first=60), base, max_file_bytes=200)
    oldest = f"{base}/topic-0/{0:016x}"
    with open(oldest, "ab") as f:
        f.write(frame(2**60 + 1, b"late") + frame(None, None))
    os.makedirs(f"{base}/not a topic")
    open(f"{base}/topic-0/ignored.tmp", "wb").close()
    got = drain(tail_topic_log(spark, base), tmp_path)
    same = ["topic", "file", "stream_offset", "time", "payload"]
    want = read_topic_log(spark, base)
    assert sorted(map(repr, got.select(*same).collect())) == sorted(map(repr, want.select(*same).collect()))
    assert got.count() == 102


def test_tail_rereads_a_file_that_was_created_again(spark, tmp_path):
    blob = (lambda *p: b"".join(len(x).to_bytes(4, "big") + x for x in p))
    base = tmp_path / "dir"
    base.mkdir()
    seen = []
    steps = [
        lambda: ((base / "x-1").write_bytes(blob(b"1", b"2")), (base / "y-1").write_bytes(blob(b"no"))),
        lambda: ((base / "x-2").write_bytes(blob(b"4", b"5", b"6")), (base / "x-1").unlink()),
        lambda: (base / "x-1").write_bytes(blob(b"11", b"12", b"13", b"14")),
        lambda: (base / "x-1").write_bytes(blob(b"21")),
    ]
    for step in steps:
        step()
        got = drain(tail_count_blob(spark, str(base), "x-.*", topic_dirs=False), tmp_path)
        seen.append(sorted(bytes(r.content).decode() for r in got.collect()))
    assert seen[0] == ["1", "2"]
    assert seen[1] == sorted(seen[0] + ["4", "5", "6"])
    assert seen[2] == sorted(seen[1] + ["11", "12", "13", "14"])
    assert seen[3] == sorted(seen[2] + ["21"])


def test_tail_own_framing_from_offsets(spark, tmp_path):
    base = tmp_path / "dir"
    base.mkdir()
    (base / "x-1").write_text("skip\nb\nc\ntorn")

    def lines(buf):
        rows, at = [], 0
        while (end := buf.find(b"\n", at)) >= 0:
            rows.append((at, buf[at:end].decode()))
            at = end + 1
        return rows, at

    stream = tail_framed(spark, str(base), lines, "value string", topic_dirs=False, starting_offsets={str(base / "x-1"): 5})
    assert sorted((r.record_offset, r.value) for r in drain(stream, tmp_path).collect()) == [(5, "b"), (7, "c")]


def test_file_deleted_after_it_was_planned(spark, tmp_path):
    base, ckpt = tmp_path / "log", str(tmp_path / "ckpt")
    write_topic_log(spark.createDataFrame([(t, 1, 1, t.encode()) for t in ("a", "b")], batch_tests.MSGS), str(base))
    got = []

    def once(sink):
        q = tail_topic_log(spark, str(base)).writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()

    def fail(df, _):
        raise RuntimeError("down")

    with pytest.raises(Exception, match="down"):
        once(fail)
    next((base / "a").iterdir()).unlink()
    once(lambda df, _: got.extend(r.topic for r in df.collect()))
    assert got == ["b"]


def test_listener_hears_the_ticks_of_the_batch_metrics(spark, tmp_path):
    base, t0 = str(tmp_path / "log"), 1_700_000_000_500
    rng = random.Random(5)
    rows = [(f"t{rng.randrange(4)}", i, t0 + 300 * i + rng.randrange(50), b"") for i in range(400)]
    msgs = spark.createDataFrame(rows, batch_tests.MSGS)
    # Two much later messages: the first moves the watermark, the second's batch reports what it closed.
    late = [[("late", i, t0 + 10**6 * i, b"")] for i in (1, 2)]
    heard = []
    for part in (msgs, *[spark.createDataFrame(r, batch_tests.MSGS) for r in late]):
        write_topic_log(part, base)
        ticks = stream_interval_metrics(tail_topic_log(spark, base), (10, 60), late_seconds=1, t0=t0)
        q = on_tick(ticks, lambda df: heard.extend(map(tuple, df.collect())))
        q.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    want = interval_metrics(msgs, (10, 60), t0=t0, fill=False)
    assert sorted(heard) == sorted(map(tuple, want.collect()))


def test_stream_sink_copies_a_log_once(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    for first in (0, 50):
        write_topic_log(batch_tests.numbered(spark, 3, 50, first=first), source, max_file_bytes=300)
        msgs = tail_topic_log(spark, source).withColumn("seq", F.col("stream_offset"))
        q = append_topic_log(msgs, target, "copy", max_file_bytes=300)
        q.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    same = ["topic", "time", "payload"]
    back = read_topic_log(spark, target).orderBy("topic", "stream_offset").select(*same)
    want = read_topic_log(spark, source).orderBy("topic", "stream_offset").select(*same)
    assert list(map(tuple, back.collect())) == list(map(tuple, want.collect()))


NOTES = (
    "id int, time bigint, count array<struct<key string, integerIncrement int, doubleIncrement double, ivalue bigint, dvalue double>>"
)


def brute_counters(notes):
    out = {}
    for id_, _, count in sorted(notes, key=lambda n: n[1]):
        for key, ia, da, iv, dv in count:
            i, d = out.get((id_, key), (None, None))
            i = iv if iv is not None else i
            d = dv if dv is not None else d
            i = (i or 0) + ia if ia is not None else i
            d = (d or 0) + da if da is not None else d
            out[id_, key] = (i, d)
    return out


def random_notes(n, seed):
    rng = random.Random(seed)
    maybe = (lambda p, v: v if rng.random() < p else None)
    notes = []
    for i in range(n):
        count = [
            (rng.choice("abc"), maybe(0.6, rng.randrange(9)), maybe(0.4, rng.randrange(9) / 4), maybe(0.05, 2**60 + rng.randrange(9)), maybe(0.05, rng.randrange(99) / 8))
            for _ in range(rng.randrange(4))
        ]
        notes.append((rng.randrange(3), i * rng.choice([700]), count))
    return notes


def test_counters_in_batch_and_stream(spark, tmp_path):
    notes = random_notes(500, 6)
    want = brute_counters(notes)
    got = fold_status_counters(spark.createDataFrame(notes, NOTES))
    assert {(r.id, r.key): (r.ivalue, r.dvalue) for r in got.collect()} == want
    log = tmp_path / "notes"
    current = {}
    for part in (notes[:200], notes[200:350], notes[350:]):
        spark.createDataFrame(part, NOTES).coalesce(1).write.mode("append").parquet(str(log))
        stream = stream_status_counters(spark.readStream.schema(NOTES).parquet(str(log)))
        changed = drain(stream, tmp_path, mode="update")
        newest = changed.groupBy("id", "key").agg(F.max_by(F.struct("ivalue", "dvalue"), "batch").alias("v"))
        current = {(r.id, r.key): tuple(r.v) for r in newest.collect()}
    assert current == want


def test_a_busy_counter_reaches_its_state_as_few_rows(spark):
    notes = [(1, 7 * i, [("k", 1, 0.5, 100 if i == 900 else None, None)]) for i in range(3000)]
    changes = status.folded_in_blocks(counter_changes(spark.createDataFrame(notes, NOTES).repartition(5)))
    assert [(r.int_set, r.int_add, r.double_set, r.double_add) for r in changes.collect()] == [(100, 2100, None, 1500.0)]


def test_counters_are_folded_side_by_side(spark, monkeypatch):
    calls, one_each = spark.sparkContext.accumulator(0), status._as_one_each

    def counted(changes):
        calls.add(1)
        return one_each(changes)

    monkeypatch.setattr(status, "_as_one_each", counted)
    notes = [(i % 500, 8 * i, [("k", 1, 0.25, 7 if i == 2100 else None, None)]) for i in range(4000)]
    changes = status.folded_in_blocks(counter_changes(spark.createDataFrame(notes, NOTES)))
    got = {r.id: (r.int_set, r.int_add, r.double_add) for r in changes.collect()}
    assert got == {i: (7, 4, 2.0) if i == 100 else (None, 8, 2.0) for i in range(500)}
    assert calls.value < 1000  # a group for each counter and stretch would make 4,500

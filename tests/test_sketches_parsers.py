import math

import pytest
from pyspark.sql import functions as F

from test_streaming import drain
from tailrace.functions.columns import METRICS_TOPIC
from tailrace.operators.metrics import interval_metrics
from tailrace.operators.sketches import metrics_from_sketches, sketch_error, topic_sketches
from tailrace.sources.parsers import fields_of, json_lines, register_parser, split_at_spaces
from tailrace.streaming.metrics import stream_interval_metrics, stream_topic_sketches, timers


def many_topics(spark):
    """60,000 topics in three minutes; one topic has a third of all messages."""
    topic = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id") % 60000))
    return spark.range(180_000).select(topic.alias("topic"), (F.col("id") - 5000).alias("time"))


def test_sketches_roll_up_within_the_stated_error(spark):
    msgs = many_topics(spark).union(spark.createDataFrame([("x", None), (METRICS_TOPIC, 5)], "topic string, time bigint"))
    keys = ["interval", "tick"]
    slots = topic_sketches(msgs, 10)
    got = {(r.interval, r.tick): r for r in metrics_from_sketches(slots, 10, (10, 60, 300)).collect()}
    want = {(r.interval, r.tick): r for r in interval_metrics(msgs, (10, 60, 300), t0=0, fill=False).collect()}
    assert got.keys() == want.keys() and (10, -1) in got and (300, None) in got
    for key, r in want.items():
        assert (got[key].messages, got[key].time) == (r.messages, r.time)
        assert abs(got[key].unique_topics - r.unique_topics) <= sketch_error() * r.unique_topics
    assert want[300, 0].unique_topics > 30_000


def test_slots_of_several_runs_add_up(spark):
    msgs = many_topics(spark)
    halves = [topic_sketches(msgs.where(f"time % 2 {sign} 0"), 10) for sign in ("=", "<>")]
    both = metrics_from_sketches(halves[0].union(halves[1]), 10, (60,)).select("tick", "messages")
    whole = interval_metrics(msgs, (60,), t0=0, fill=False).select("tick", "messages")
    assert sorted(both.collect()) == sorted(whole.collect())
    assert metrics_from_sketches(topic_sketches(msgs.limit(0)), 1, (1,)).count() == 0
    with pytest.raises(ValueError, match="no multiples"):
        metrics_from_sketches(halves[0], 10, (10, 25))


def streamed(spark, tmp_path, name, batches, stream, mode="append"):
    """Runs the stream after each batch of (topic, time) rows; gives all rows it reported."""
    source = str(tmp_path / f"{name}-in")
    seen = []
    for rows in batches:
        spark.createDataFrame(rows, "topic string, time bigint").coalesce(1).write.mode("append").parquet(source)
        recs = spark.readStream.schema("topic string, time bigint").parquet(source)
        out = drain(stream(recs), tmp_path, name, mode)
        seen.append(sorted(tuple(r)[:-1] for r in out.collect()))
    return seen


def test_stream_reports_empty_ticks_up_to_the_watermark(spark, tmp_path):
    batches = [
        [("a", 2_000), ("b", 2_500), ("a", 9_000)],
        [("a", 60_100)],  # a long gap
        [("b", 61_000), ("c", 180_000)],
        [("a", 181_000)],
        [("a", 400_000)],
    ]
    intervals, late = (1, 20), 5
    with timers(spark):
        stream = lambda recs: stream_interval_metrics(recs, intervals, late, fill=True)
        seen = streamed(spark, tmp_path, "filled", batches, stream)
    rows = []
    for batch, got in zip(batches, seen):
        rows += batch
        mark = max((time // (i * 1000) + 1) * i for _, time in rows for i in intervals) - late - max(intervals)
        msgs = spark.createDataFrame(rows, "topic string, time bigint")
        # Filled from t0 on, and past the last message of an interval up to the watermark.
        counted = {(r.interval, r.tick): (r.unique_topics, r.messages) for r in interval_metrics(msgs, intervals, t0=0).collect()}
        want = []
        for i in intervals:
            if any((tick + 1) * i <= mark for (k, tick), (_, n) in counted.items() if k == i and n):
                want += [(i, tick, (tick + 1.0) * i, *counted.get((i, tick), (0, 0))) for tick in range(mark // i)]
        assert got == sorted(want)
    assert len(seen[-1]) > 380


def test_streamed_sketches_equal_stored_ones(spark, tmp_path):
    batches = [[(f"t{i % 700}", i * 10) for i in range(2000)], [("late", 90_000)], [("last", 200_000)]]
    seen = streamed(spark, tmp_path, "slots", batches, lambda recs: stream_topic_sketches(recs, 5).select("slot", "messages", F.hll_sketch_estimate("topics")))
    rows = [r for batch in batches for r in batch]
    exact = {}
    for topic, time in rows:
        exact.setdefault(time // 5000, []).append(topic)
    closed = {s: t for s, t in exact.items() if (s + 1) * 5 <= (200 + 5) - 15}
    assert [(s, n) for s, n, _ in seen[-1]] == [(s, len(t)) for s, t in sorted(closed.items())]
    for s, _, topics in seen[-1]:
        assert abs(topics - len(set(closed[s]))) <= sketch_error() * len(set(closed[s]))


def test_parser_functions_take_their_columns_from_the_call(spark):
    rows = [(1, b"a 5"), (2, b"b x c"), (3, b""), (4, None), (5, "é 9223372036854775808".encode())]
    recs = spark.createDataFrame(rows, "id int, payload binary")
    register_parser(spark, "words_of", split_at_spaces)
    got = spark.sql("SELECT * FROM words_of(TABLE(SELECT * FROM {recs}), 'word string, n bigint')", recs=recs)
    assert got.schema.simpleString() == "struct<id:int,word:string,n:bigint>"
    assert sorted(map(tuple, got.collect())) == [(1, "a", 5), (2, "b", None), (3, "", None), (4, "", None), (5, "é", None)]
    for fields in ("id int", "id string", "word"):
        with pytest.raises(Exception, match="words_of|not of the form"):
            spark.sql(f"SELECT * FROM words_of(TABLE(SELECT * FROM {{recs}}), '{fields}')", recs=recs).collect()


def test_a_payload_may_hold_several_records_or_none(spark):
    lines = b'{"a": 1, "b": 0.5}\nnot json\n[1]\n{"a": true, "b": "2.5", "c": {"d": 1}}\n'
    recs = spark.createDataFrame([("x", lines), ("y", b"")], "topic string, payload binary")
    register_parser(spark, "json_of", json_lines)
    got = spark.sql("SELECT * FROM json_of(TABLE(SELECT * FROM {recs}), 'a bigint, b double, c string')", recs=recs).collect()
    assert list(map(tuple, got)) == [("x", 1, 0.5, None), ("x", None, 2.5, '{"d": 1}')]


def test_fields_and_error_bound():
    assert fields_of("word string,  n BIGINT") == [("word", "string"), ("n", "bigint")]
    assert math.isclose(sketch_error(12, 1), 0.01625)

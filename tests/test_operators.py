import random

import pytest
from pyspark.sql import functions as F

from tailrace.functions.columns import frame_size, full_match, java_string_hash, message_id, name_offset, offset_name, server_key
from tailrace.functions.columns import ID_MULTIPLIER
from tailrace.operators import delivery, metrics, offsets, routing
from tailrace.plans import rollover
from tailrace.sources.progress import progress_scope, read_progress, write_progress


def sequential_plan(rows, limit, ends, pad):
    plan, state = {}, {}
    for topic, seq, size in sorted(rows):
        if topic not in state:
            state[topic] = [ends[topic] + pad if topic in ends else 0, 0]
        elif state[topic][1] > limit:
            state[topic] = [sum(state[topic]), 0]
        plan[topic, seq] = tuple(state[topic])
        state[topic][1] += size
    return plan


@pytest.fixture(scope="module")
def uneven(spark):
    """One topic holds most records; sizes vary, with a stretch of equal ones and an oversized record."""
    rng = random.Random(1)
    rows = [("hot", i * 3 - 500, 20 if 300 < i < 600 else rng.randint(4, 60)) for i in range(1500)]
    rows[700] = ("hot", rows[700][1], 5000)
    rows += [("flat", i, 20) for i in range(400)] + [("one", 5, 9)]
    return rows, spark.createDataFrame(rows, "topic string, seq bigint, size bigint").cache()


@pytest.mark.parametrize("limit,segment_rows", [(10, 1 << 20), (700, 1 << 20), (100, 16), (700, 64), (10**6, 64)])
def test_rollover_in_segments_equals_one_pass(spark, uneven, limit, segment_rows):
    rows, df = uneven
    ends = spark.createDataFrame([("flat", 500)], "topic string, end_offset bigint")
    plan = rollover.rollover_plan(df, ends, limit, 1000, segment_rows=segment_rows)
    got = {(r.topic, r.seq): (r.base_offset, r.record_offset) for r in plan.collect()}
    assert got == sequential_plan(rows, limit, {"flat": 500}, 1000)


@pytest.mark.parametrize("segment_rows", [1 << 20, 64])
def test_spans_cover_the_plan(spark, uneven, segment_rows):
    rows, df = uneven
    spans = rollover.plan_spans(df, None, 300, 0, 2000, 6, segment_rows).collect()
    plan = sequential_plan(rows, 300, {}, 0)
    found = {}
    for topic, seq, _ in rows:
        (span,) = [s for s in spans if s.topic == topic and s.block == seq >> 6 and s.first_seq <= seq <= s.last_seq]
        found[topic, seq] = span.base_offset
    assert found == {k: v[0] for k, v in plan.items()}
    assert sum(s.records for s in spans) == len(rows)


@pytest.mark.parametrize("bits", [22, 3])
def test_running_offset_in_blocks(uneven, bits):
    rows, df = uneven
    want, total = {}, {}
    for topic, seq, size in sorted(rows):
        want[topic, seq] = total.get(topic, 0)
        total[topic] = want[topic, seq] + size
    got = offsets.running_offset(df, bits).collect()
    assert {(r.topic, r.seq): r.stream_offset for r in got} == want


def test_repeated_seq_is_refused(spark):
    df = spark.createDataFrame([("t", 1, 5), ("t", 1, 6)], "topic string, seq bigint, size bigint")
    with pytest.raises(Exception, match="not unique"):
        rollover.rollover_plan(df).collect()
    with pytest.raises(Exception, match="not unique"):
        offsets.running_offset(df).collect()


def java_hash(s):
    h, units = 0, s.encode("utf-16-be")
    for i in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >> 31 else h


def test_scalar_functions(spark):
    words = ["foo", "", "topic-149", "a\U0001F600é", "z" * 100]
    got = spark.createDataFrame([(w,) for w in words], "s string").select("s", java_string_hash("s").alias("h")).collect()
    assert {r.s: r.h for r in got} == {w: java_hash(w) for w in words}
    ids = [(c, n) for c in (0, -5, 2**63 - 1) for n in (0, 1, 200_000, 2**62)]
    got = spark.createDataFrame(ids, "c bigint, n bigint").select("c", "n", message_id("c", "n").alias("m")).collect()
    mask = (1 << 64) - 1
    assert all(r.m == ((r.c & mask) ^ (r.n * ID_MULTIPLIER & mask)) >> 1 for r in got)
    row = spark.range(1).select(
        offset_name(F.lit(255)).alias("name"),
        name_offset(F.lit("00000000000000ff")).alias("offset"),
        name_offset(F.lit("x-1")).alias("none"),
        name_offset(F.lit("f" * 16)).alias("large"),
        (server_key(F.lit(-1)) > server_key(F.lit(1))).alias("unsigned"),
        full_match(F.lit("x-1\n"), "x-.").alias("newline"),
        frame_size(F.lit(None).cast("bigint"), F.lit(None).cast("binary")).alias("empty"),
    ).first()
    assert tuple(row) == ("00000000000000ff", 255, None, None, True, False, 4)


def members(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "server_id bigint")


def test_thousand_topics_over_two_servers(spark):
    topics = spark.range(1000).select(F.col("id").cast("string").alias("topic"))
    both = members(spark, [25, 23])
    assigned = {r.topic: r.server_id for r in routing.assign_topics(topics, both).collect()}
    assert assigned == {str(i): [23, 25][java_hash(str(i)) % 2] for i in range(1000)}
    rounds = topics.crossJoin(both.withColumnRenamed("server_id", "received_by"))
    totals = routing.redirect_totals(routing.redirect_audit(rounds, both)).collect()
    assert sum(r.redirects for r in totals) == 1000
    assert routing.redirect_audit(topics.withColumn("received_by", F.lit(23)), members(spark, [23])).where("redirect").count() == 0
    assert routing.reassignment_diff(topics, both, members(spark, [25, 23])).count() == 0
    assert routing.reassignment_diff(topics, both, members(spark, [23])).count() == sum(v == 25 for v in assigned.values())


def test_balance_before_and_after_failures(spark):
    sent = spark.range(600).select(F.concat(F.lit("topic-"), F.col("id") % 30).alias("topic"))
    for alive in (range(10), range(4, 10)):
        loads = {r.server_id: r.messages for r in routing.server_load(sent, members(spark, alive)).collect()}
        want = {}
        for i in range(600):
            owner = alive[java_hash(f"topic-{i % 30}") % len(alive)]
            want[owner] = want.get(owner, 0) + 1
        assert loads == want


def test_negative_ids_sort_unsigned_and_long_lists_are_joined(spark, monkeypatch):
    ranks = {r.server_id: r.pos for r in routing.server_rank(members(spark, [-1, 5, 2**62])).collect()}
    assert ranks == {5: 0, 2**62: 1, -1: 2}
    sent = spark.range(300).select(F.concat(F.lit("topic-"), F.col("id") % 30).alias("topic"), F.col("id").alias("received_by"))
    alive, other = members(spark, [7, 1, 2**62, -5]), members(spark, [1, 2])

    def all_of_them():
        found = (routing.assign_topics(sent, alive), routing.redirect_audit(sent, alive), routing.server_load(sent, alive), routing.reassignment_diff(sent, alive, other))
        return [sorted(map(repr, (r.asDict() for r in df.select(*sorted(df.columns)).collect()))) for df in found]

    small = all_of_them()
    monkeypatch.setattr(routing, "MAX_SERVERS", 1)
    assert all_of_them() == small


def test_rank_of_many_servers(spark):
    ids = [*range(-300, 0), *range(50_000), *(2**62 + i * 10**9 for i in range(300))]
    ranks = {r.server_id: r.pos for r in routing.server_rank(members(spark, ids)).collect()}
    assert ranks == {s: i for i, s in enumerate(sorted(ids, key=lambda s: s % 2**64))}


def test_no_empty_ticks_before_the_start(spark):
    msgs = spark.createDataFrame([("a", 1000), ("a", 2500)], "topic string, time bigint")
    assert {(r.tick, r.messages) for r in metrics.interval_metrics(msgs, (1,), t0=10000).collect()} == {(-9, 1), (-8, 1)}


def test_metrics_skip_their_own_topic_and_keep_empty_ticks(spark):
    rows = [("a", 1000), ("b", 1999), ("a", 2000), ("-metrics-", 3000), ("a", 5000), ("a", None)]
    got = metrics.interval_metrics(spark.createDataFrame(rows, "topic string, time bigint"), (1, 2)).collect()
    untimed = [(r.interval, r.unique_topics, r.messages) for r in got if r.tick is None and r.time is None]
    assert sorted(untimed) == [(1, 1, 1), (2, 1, 1)]
    found = sorted((r.interval, r.tick, r.time, r.unique_topics, r.messages) for r in got if r.tick is not None)
    assert found == [
        (1, 0, 1.0, 2, 2), (1, 1, 2.0, 1, 1), (1, 2, 3.0, 0, 0), (1, 3, 4.0, 0, 0), (1, 4, 5.0, 1, 1),
        (2, 0, 2.0, 2, 3), (2, 1, 4.0, 0, 0), (2, 2, 6.0, 1, 1),
    ]
    none = spark.createDataFrame([], "topic string, time bigint")
    assert metrics.interval_metrics(none).count() == 0


def test_smallest_pending_offset_does_not_depend_on_id_order(spark):
    pending = spark.createDataFrame([(1, "f", 90), (2, "f", 30), (3, "g", 7)], "msg_id bigint, file string, record_offset bigint")
    live = spark.createDataFrame([("f", 200), ("h", 10247)], "file string, record_offset bigint")
    got = {r.file: r.record_offset for r in delivery.checkpoint_offsets(pending, live).collect()}
    assert got == {"f": 30, "g": 7, "h": 10247}


def test_progress_state(spark, tmp_path, monkeypatch):
    offsets_ = spark.createDataFrame([("/d/test", 10247)], "file string, record_offset bigint")
    nothing = spark.createDataFrame([], "file string")
    path = str(tmp_path / "state")
    write_progress(offsets_, nothing, path, "/d", r".*\.log")
    got, seen = read_progress(spark, path)
    assert [tuple(r) for r in got.collect()] == [("/d/test", 10247)] and seen.count() == 0
    assert [tuple(r) for r in progress_scope(spark, path).collect()] == [("/d", r".*\.log")]
    # A later state replaces the earlier one and may take many documents.
    monkeypatch.setattr("tailrace.sources.progress.ENTRIES_PER_DOCUMENT", 10)
    many = spark.range(95).select(F.concat(F.lit("/d/"), "id").alias("file"), F.col("id").alias("record_offset"))
    write_progress(many, many.select("file"), path, "/d", "x")
    got, seen = read_progress(spark, path)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, many.collect())) and seen.count() == 95
    write_progress(offsets_.limit(0), nothing, path, "/d", "x")
    assert read_progress(spark, path)[0].count() == 0
    plain = tmp_path / "status.json"
    plain.write_text('{"oldFiles":[{"path":"/d/a"},"/d/b"],\n"inputDirectory":"/d","filePattern":".*","offsets":{"/d/a":12}}')
    got, seen = read_progress(spark, str(plain))
    assert [tuple(r) for r in got.collect()] == [("/d/a", 12)] and sorted(r.file for r in seen.collect()) == ["/d/a", "/d/b"]


def test_interval_metrics_counts_messages_before_the_start(spark):
    msgs = spark.createDataFrame([("a", -1500), ("a", 200), ("b", 2200)], "topic string, time bigint")
    rows = {(r.tick, r.messages) for r in metrics.interval_metrics(msgs, (1,), t0=0).collect()}
    assert rows == {(-2, 1), (0, 1), (1, 0), (2, 1)}


def test_a_segment_stays_whole_where_blocks_of_seq_meet(spark):
    rng = random.Random(4)
    rows = [(t, (1 << 22) + i, rng.randint(4, 60)) for t in ("a", "b", "c") for i in range(-700, 700)]
    # As with large tables: many parts, and a join whose smaller side can be broadcast, as turns out when it runs.
    conf = {"adaptive.coalescePartitions.enabled": "false", "autoBroadcastJoinThreshold": "1", "adaptive.autoBroadcastJoinThreshold": "30k"}
    try:
        for name, value in conf.items():
            spark.conf.set(f"spark.sql.{name}", value)
        plan = rollover.rollover_plan(spark.createDataFrame(rows, "topic string, seq bigint, size bigint"), None, 900, 0, segment_rows=64)
        got = {(r.topic, r.seq): (r.base_offset, r.record_offset) for r in plan.collect()}
    finally:
        for name in conf:
            spark.conf.unset(f"spark.sql.{name}")
    assert got == sequential_plan(rows, 900, {}, 0)

"""Message and unique-topic counts per interval, and totals per topic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailrace.functions.columns import METRICS_TOPIC, floor_div

# The intervals of a server, in seconds.
SERVER_INTERVALS = (1, 10, 60, 300)

_SPINE_BLOCK = 4096


def interval_metrics(
    msgs: DataFrame,
    intervals: Sequence[int] = SERVER_INTERVALS,
    t0: int | None = None,
    fill: bool = True,
) -> DataFrame:
    """Count messages and exact unique topics at several intervals (seconds) at once.

    ``msgs`` has ``topic`` and ``time`` (epoch milliseconds). A message belongs to tick
    ``floor((time - t0) / interval)``; ``time`` of the result is the tick's end in seconds since
    ``t0``, which defaults to the first message; ticks before ``t0`` are negative. Messages without a time are counted in
    a tick of their own, whose number and time are null. ``fill`` adds ticks from ``t0`` to the last message in which
    nothing arrived; there are none if it came before ``t0``.

    Messages are first counted per topic and greatest common interval, so only those counts, not the
    messages, are multiplied by the number of intervals. Both the counts and the empty ticks then meet
    in one aggregate; the empty ticks need no join.
    """
    intervals = sorted(set(intervals))
    step = reduce(gcd, intervals)
    msgs = msgs.where(F.col("topic") != METRICS_TOPIC).select("topic", "time")
    ends = F.struct(F.min("time").alias("first"), F.max("time").alias("last"))
    bounds = msgs.agg(ends).scalar()
    origin = bounds["first"] if t0 is None else F.lit(t0).cast("bigint")

    per_slot = (
        msgs.select("topic", floor_div(F.col("time") - origin, step * 1000).alias("slot"))
        .groupBy("slot", "topic")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = F.explode(F.array(*[F.lit(i) for i in intervals])).alias("interval")
    ticks_per = F.call_function("div", F.col("interval"), F.lit(step))
    per_topic = (
        per_slot.select("topic", "n", "slot", every)
        .withColumn("tick", floor_div(F.col("slot"), ticks_per))
        .groupBy("interval", "tick", "topic")
        .agg(F.sum("n").alias("messages"))
        .select("interval", "tick", "messages", F.lit(1).cast("bigint").alias("topics"))
    )
    counted = per_topic.unionByName(_empty_ticks(msgs.sparkSession, origin, bounds["last"], every)) if fill else per_topic
    return (
        counted.groupBy("interval", "tick")
        .agg(F.sum("topics").alias("unique_topics"), F.sum("messages").alias("messages"))
        .select(
            "interval",
            "tick",
            ((F.col("tick") + 1) * F.col("interval")).cast("double").alias("time"),
            "unique_topics",
            "messages",
        )
    )


def _empty_ticks(spark: SparkSession, origin: Column, last_time: Column, every: Column) -> DataFrame:
    """One zero row per tick up to the last message; built in blocks so no array grows with the span."""
    last = F.call_function("div", last_time - origin, F.col("interval").cast("bigint") * 1000)
    last_block = F.call_function("div", F.col("last"), F.lit(_SPINE_BLOCK))
    zero = F.lit(0).cast("bigint")
    blocks = (
        spark.range(1)
        .where(last_time >= origin)
        .select(every)
        .select("interval", last.alias("last"))
        .select("interval", "last", F.explode(F.sequence(zero, last_block)).alias("block"))
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("block") * _SPINE_BLOCK
    ticks = F.sequence(first, F.least(first + (_SPINE_BLOCK - 1), F.col("last")))
    return blocks.repartition(tasks, "interval", "block").select(
        "interval", F.explode(ticks).alias("tick"), zero.alias("messages"), zero.alias("topics")
    )


def topic_stats(msgs: DataFrame) -> DataFrame:
    """Messages, payload bytes and distinct clients per topic."""
    return msgs.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(F.octet_length("payload").cast("bigint")), F.lit(0)).alias("bytes"),
        F.countDistinct("client").alias("clients"),
    )

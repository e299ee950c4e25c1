"""Interval metrics on a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tailrace.functions.columns import METRICS_TOPIC
from tailrace.operators.metrics import SERVER_INTERVALS
from tailrace.operators.sketches import LG_K, slot_columns

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ZERO_ROWS = 1 << 16


def stream_interval_metrics(
    recs: DataFrame, intervals: Sequence[int] = SERVER_INTERVALS, late_seconds: int = 10, t0: int = 0, fill: bool = False
) -> DataFrame:
    """Messages and exact unique topics per tick, each tick once it is complete (append mode).

    ``recs`` has ``topic`` and ``time`` (epoch milliseconds); ticks count from ``t0``. Messages may come
    ``late_seconds`` after newer ones; later ones are dropped.

    ``fill`` adds the ticks from ``t0`` to the watermark in which nothing arrived, with zeros: those of an interval follow
    its first tick with messages, and further ones come when the watermark passes them, by a timer. Choose ``t0`` near the first message
    then. It needs the state store that ``timers`` sets. Without it, ticks without messages are not reported.

    All intervals share one pass. Event time is the end of a tick, which lies up to the longest interval
    ahead of its messages, so the watermark waits that much longer. The first aggregate counts per topic,
    which makes the topics of a tick countable without a distinct count.
    """
    intervals = sorted(set(intervals))
    width = F.col("interval").cast("bigint") * 1000
    ends = (
        recs.where((F.col("topic") != METRICS_TOPIC) & (F.col("time") >= t0))
        .select("topic", "time", F.explode(F.array(*[F.lit(i) for i in intervals])).alias("interval"))
        .withColumn("tick", F.call_function("div", F.col("time") - t0, width))
        .select("topic", "interval", F.timestamp_millis((F.col("tick") + 1) * width + t0).alias("tick_end"))
        .withWatermark("tick_end", f"{late_seconds + intervals[-1]} seconds")
    )
    per_topic = ends.groupBy("interval", "tick_end", "topic").agg(F.count(F.lit(1)).alias("n"))
    ticks = per_topic.groupBy("interval", "tick_end").agg(
        F.count(F.lit(1)).alias("unique_topics"), F.sum("n").alias("messages")
    )
    if fill:
        ticks = _filled(ticks, t0)
    past = F.call_function("div", F.unix_millis("tick_end") - t0, width)
    return ticks.select(
        "interval",
        (past - 1).alias("tick"),
        (past * F.col("interval")).cast("double").alias("time"),
        "unique_topics",
        "messages",
    )


def stream_topic_sketches(
    recs: DataFrame, slot_seconds: int = 1, late_seconds: int = 10, t0: int = 0, lg_k: int = LG_K
) -> DataFrame:
    """The slots of ``topic_sketches``, each once it is complete (append mode); for ``metrics_from_sketches``.

    State is one sketch per open slot instead of a row per topic. Messages without a time or before ``t0`` have no slot here.
    """
    width = slot_seconds * 1000
    slot = F.call_function("div", F.col("time") - t0, F.lit(width).cast("bigint"))
    slots = (
        recs.where((F.col("topic") != METRICS_TOPIC) & (F.col("time") >= t0))
        .select("topic", F.timestamp_millis((slot + 1) * width + t0).alias("slot_end"))
        .withWatermark("slot_end", f"{late_seconds + slot_seconds} seconds")
    )
    number = F.call_function("div", F.unix_millis("slot_end") - t0, F.lit(width).cast("bigint")) - 1
    return slots.groupBy("slot_end").agg(*slot_columns(lg_k)).select(number.alias("slot"), "topics", "messages")


@contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, which state with timers needs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _filled(ticks: DataFrame, t0: int) -> DataFrame:
    """Adds the empty ticks; ``ticks`` has one row per tick, so a key gets as many rows as the watermark passes ticks."""
    schema = "interval int, tick_end timestamp, unique_topics bigint, messages bigint"
    return ticks.select("interval", "tick_end", "unique_topics", "messages").groupBy("interval").transformWithStateInPandas(
        _EmptyTicks(t0), schema, "append", "eventTime"
    )


class _EmptyTicks(StatefulProcessor):
    """Keeps the first tick of an interval that is not reported yet, and a timer at its end."""

    def __init__(self, t0: int):
        self.t0 = t0

    def init(self, handle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "tick bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, closed = self._open(key, timerValues)
        filled = np.zeros(max(closed - first, 0), bool)
        for pdf in rows:
            ends = pdf["tick_end"].astype("datetime64[ms]").astype("int64").to_numpy()
            ticks = (ends - self.t0) // (key[0] * 1000) - 1
            within = ticks[(ticks >= first) & (ticks < closed)]
            filled[within - first] = True
            yield pdf
        yield from self._zeros(key, first, closed, filled)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, closed = self._open(key, timerValues)
        yield from self._zeros(key, first, closed, np.zeros(max(closed - first, 0), bool))

    def close(self) -> None:
        pass

    def _open(self, key, timerValues) -> tuple[int, int]:
        """The first tick that is not reported and the first that the watermark has not passed."""
        first = self.first.get()[0] if self.first.exists() else 0
        return first, max(first, (timerValues.getCurrentWatermarkInMs() - self.t0) // (key[0] * 1000))

    def _zeros(self, key, first: int, closed: int, filled: np.ndarray) -> Iterator[pd.DataFrame]:
        width = key[0] * 1000
        for at in range(0, len(filled), _ZERO_ROWS):
            empty = np.flatnonzero(~filled[at : at + _ZERO_ROWS]) + (first + at)
            ends = pd.to_datetime((empty + 1) * width + self.t0, unit="ms")
            zeros = np.zeros(len(empty), "int64")
            interval = np.full(len(empty), key[0], "int32")
            yield pd.DataFrame({"interval": interval, "tick_end": ends, "unique_topics": zeros, "messages": zeros})
        self.first.update((closed,))
        self.handle.registerTimer((closed + 1) * width + self.t0)


def on_tick(ticks: DataFrame, listener: Callable[[DataFrame], None]):
    """Stream writer that hands each batch of finished ticks to ``listener``."""
    return ticks.writeStream.outputMode("append").foreachBatch(lambda batch, _: listener(batch))

"""Approximate unique topics: one mergeable sketch per slot of time, stored once and rolled up to any interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailrace.functions.columns import METRICS_TOPIC, floor_div
from tailrace.operators.metrics import SERVER_INTERVALS

LG_K = 12


def sketch_error(lg_k: int = LG_K, deviations: float = 4) -> float:
    """Relative error of a sketch's count: its standard error, 1.04 / sqrt(2^lg_k), times ``deviations``."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def topic_sketches(msgs: DataFrame, slot_seconds: int = 1, t0: int = 0, lg_k: int = LG_K) -> DataFrame:
    """Messages and a HyperLogLog sketch of the topics per slot of ``slot_seconds``, counted from ``t0``.

    A map task sends one sketch of at most 2^lg_k bytes per slot, however many topics there are. Messages without a time
    are counted in a slot whose number is null, as in ``interval_metrics``.
    """
    slot = floor_div(F.col("time") - t0, slot_seconds * 1000).alias("slot")
    counted = msgs.where(F.col("topic") != METRICS_TOPIC).select("topic", slot)
    return counted.groupBy("slot").agg(*slot_columns(lg_k))


def slot_columns(lg_k: int) -> list:
    return [F.hll_sketch_agg("topic", F.lit(lg_k)).alias("topics"), F.count(F.lit(1)).alias("messages")]


def metrics_from_sketches(
    sketches: DataFrame, slot_seconds: int = 1, intervals: Sequence[int] = SERVER_INTERVALS
) -> DataFrame:
    """Ticks of several intervals from stored slots, which may hold several rows per slot (of several runs).

    Intervals must be multiples of ``slot_seconds``. ``unique_topics`` is approximate, see ``sketch_error``;
    ``messages`` is exact. The other columns are those of ``interval_metrics``.
    """
    intervals = sorted(set(intervals))
    odd = [i for i in intervals if i % slot_seconds]
    if odd:
        raise ValueError(f"intervals {odd} are no multiples of the slot of {slot_seconds} seconds")
    every = F.explode(F.array(*[F.lit(i) for i in intervals])).alias("interval")
    ticks = sketches.select("slot", "topics", "messages", every).withColumn(
        "tick", floor_div(F.col("slot"), F.call_function("div", F.col("interval"), F.lit(slot_seconds)))
    )
    return (
        ticks.groupBy("interval", "tick")
        .agg(F.hll_sketch_estimate(F.hll_union_agg("topics")).alias("unique_topics"), F.sum("messages").alias("messages"))
        .select(
            "interval",
            "tick",
            ((F.col("tick") + 1) * F.col("interval")).cast("double").alias("time"),
            "unique_topics",
            "messages",
        )
    )

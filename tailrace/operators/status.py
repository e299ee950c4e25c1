"""Counters of status logs: the last absolute value plus the increments after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BLOCK_BITS = 12


def counter_changes(log: DataFrame) -> DataFrame:
    """Progress notes ``(id, time, count[])`` as one row per entry, in note order."""
    entry = F.posexplode("count").alias("pos", "c")
    return log.select("id", "time", entry).select(
        "id",
        F.col("c.key").alias("key"),
        "time",
        "pos",
        F.col("c.integerIncrement").cast("bigint").alias("int_add"),
        F.col("c.doubleIncrement").alias("double_add"),
        F.col("c.ivalue").alias("int_set"),
        F.col("c.dvalue").alias("double_set"),
    )


def fold_status_counters(log: DataFrame) -> DataFrame:
    """Final value of each counter, as ``ivalue`` and ``dvalue``, per process and key.

    A value that is set replaces what came before it; an increment in the same entry is added to it. Of values set at
    one time and place in their notes the largest counts, and all increments from there on. The fold runs per short stretch of time first and then over the stretches, so a counter that gets most of
    the log is still split over many tasks.
    """
    changes = counter_changes(log).withColumn("ord", F.struct("time", "pos"))
    changes = changes.withColumn("block", F.shiftright("time", _BLOCK_BITS))
    # The last level has one row per key and block: a window over it grows with the time span only.
    blocks = _fold(changes, ["id", "key", "block"])
    blocks = blocks.withColumn("ord", F.struct(F.col("block").alias("time"), F.lit(0).alias("pos")))
    return _fold(blocks, ["id", "key"]).select(
        "id",
        "key",
        _final("int_set", "int_add").alias("ivalue"),
        _final("double_set", "double_add").alias("dvalue"),
    )


def _final(set_value: str, added: str):
    return F.when(F.col(set_value).isNull(), F.col(added)).otherwise(
        F.col(set_value) + F.coalesce(F.col(added), F.lit(0))
    )


def _fold(changes: DataFrame, group: list[str]) -> DataFrame:
    """One change per group that has the effect of all of its changes in order."""
    whole = Window.partitionBy(*group)
    marked = changes
    for kind in ("int", "double"):
        last = F.max(F.when(F.col(f"{kind}_set").isNotNull(), F.col("ord"))).over(whole)
        marked = marked.withColumn(f"_{kind}_from", last)
    parts = []
    for kind in ("int", "double"):
        start = F.col(f"_{kind}_from")
        counts = start.isNull() | (F.col("ord") >= start)
        is_last = F.col("ord") == start
        parts.append(F.max(F.when(is_last, F.col(f"{kind}_set"))).alias(f"{kind}_set"))
        parts.append(F.sum(F.when(counts, F.col(f"{kind}_add"))).alias(f"{kind}_add"))
    return marked.groupBy(*group).agg(*parts)

"""Unacknowledged messages, replay and restart offsets, and the bookkeeping of seen files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending_messages(emitted: DataFrame, acked: DataFrame) -> DataFrame:
    """Emitted messages without an acknowledgement."""
    return emitted.join(acked.select("msg_id"), "msg_id", "left_anti").select(*emitted.columns)


def resend_failed(pending: DataFrame, failed: DataFrame) -> DataFrame:
    """Pending messages reported as failed; ids and tuples are those of the first try."""
    return pending.join(failed.select("msg_id"), "msg_id", "left_semi").select(*pending.columns)


def checkpoint_offsets(pending: DataFrame, live: DataFrame) -> DataFrame:
    """Smallest pending offset per file; a live file with nothing pending keeps its position."""
    smallest = pending.groupBy("file").agg(F.min("record_offset").alias("record_offset"))
    idle = live.select("file", "record_offset").join(smallest.select("file"), "file", "left_anti")
    return smallest.unionByName(idle)


def replay_set(recs: DataFrame, offsets: DataFrame) -> DataFrame:
    """Records at or after the restart offset of their file."""
    from_offset = offsets.select("file", F.col("record_offset").alias("restart_offset"))
    return (
        recs.join(from_offset, "file")
        .where(F.col("record_offset") >= F.col("restart_offset"))
        .select(*recs.columns)
    )


def missing_files(offsets: DataFrame, files: DataFrame) -> DataFrame:
    """Restart entries whose file is gone."""
    return offsets.select("file").distinct().join(files.select("file"), "file", "left_anti")


def new_files(listed: DataFrame, seen: DataFrame) -> DataFrame:
    """Listed files that were not seen before."""
    keys = ["topic", "file"]
    return listed.select(*keys).subtract(seen.select(*keys))


def next_seen(listed: DataFrame, seen: DataFrame) -> DataFrame:
    """What to remember after a scan: vanished files are forgotten, new ones added, so just what is listed."""
    return listed.select("topic", "file").distinct()

"""Offsets, sizes and gaps of topic files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that results depend on.
TAKEOVER_PAD = 100_000
MAX_FILE_BYTES = 100_000_000
RECORDS_PER_TURN = 100


def topic_end_offset(files: DataFrame) -> DataFrame:
    """End of each topic: base plus length of its last file."""
    end = F.max_by(F.col("base_offset") + F.col("length"), "base_offset")
    return files.groupBy("topic").agg(end.alias("end_offset"))


def file_sizes(plan: DataFrame) -> DataFrame:
    """Records and bytes of every topic file of a rollover plan."""
    return plan.groupBy("topic", "base_offset").agg(
        F.count(F.lit(1)).alias("records"), F.sum("size").alias("bytes")
    )


def gap_audit(files: DataFrame, pad: int = TAKEOVER_PAD) -> DataFrame:
    """Distance from a file's end to the next base, and what it means."""
    following = F.lead("base_offset").over(Window.partitionBy("topic").orderBy("base_offset"))
    gap = F.col("next_base") - F.col("base_offset") - F.col("length")
    kind = (
        F.when(F.col("gap").isNull(), "last")
        .when(F.col("gap") < 0, "overlap")
        .when(F.col("gap") == 0, "own_roll")
        .when(F.col("gap") >= pad, "takeover")
        .otherwise("short_gap")
    )
    return (
        files.select("topic", "base_offset", "length")
        .withColumn("next_base", following)
        .withColumn("gap", gap)
        .withColumn("kind", kind)
        .select("topic", "base_offset", "next_base", "gap", "kind")
    )


def fair_batch(recs: DataFrame, n: int = RECORDS_PER_TURN) -> DataFrame:
    """The first ``n`` records of every topic; Spark cuts to ``n`` per topic before it shuffles."""
    turn = Window.partitionBy("topic").orderBy("stream_offset")
    return recs.withColumn("_turn", F.row_number().over(turn)).where(F.col("_turn") <= n).drop("_turn")


def topic_order(recs: DataFrame) -> DataFrame:
    """Records in the order of their topic; a range shuffle, so a hot topic spans many tasks."""
    return recs.orderBy("topic", "stream_offset")


def valid_envelopes(recs: DataFrame, t0: int, t1: int) -> DataFrame:
    """Records with a time in range and a payload."""
    return recs.where(F.col("time").between(t0, t1) & F.col("payload").isNotNull())

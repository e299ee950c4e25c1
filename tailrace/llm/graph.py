"""Connected components by alternating large and small stars."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailrace.llm.tables import Tables


def _stars(edges: DataFrame, tables: Tables, name: str, large: bool) -> DataFrame:
    """One step: around each node, its neighbours (the larger ones, or itself and the smaller) get the smallest."""
    if large:
        edges = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = edges.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    lowest = tables.keep(lowest, f"{name}-low")
    moved = edges.join(lowest, "a")
    moved = moved.where("b > a") if large else moved.where("b != low")
    out = moved.select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not large:
        out = out.union(lowest.select("a", F.col("low").alias("b")))
    out = out.where("a != b")
    return tables.keep(out if large else out.distinct(), name)


def _settled(stars: DataFrame) -> bool:
    """Whether each node has one edge up, or edges down only: then ``b`` is the smallest node of every component."""
    ends = stars.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(stars.select("b", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return (ends.agg(F.max(F.col("up") + F.col("down"))).first()[0] or 0) <= 1


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots; a root is the smallest node of its component.

    Minima are combined before the shuffle and rejoined as a table of one row per node, so a hub with a large
    share of all edges is a skewed join that Spark splits, not a group in one task.
    """
    run, step = uuid.uuid4().hex[:8], 0
    while True:
        names = [f"star-{run}-{step}-{x}" for x in "ls"]
        edges = _stars(_stars(edges, tables, names[0], True), tables, names[1], False)
        if step:
            tables.drop(f"star-{run}-{step - 1}-s")
        tables.drop(names[0], f"{names[0]}-low", f"{names[1]}-low")
        if _settled(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        step += 1

"""Shards by a k-d tree over document metadata, cut at weighted medians that all rows together determine.

A node that is to become several shards is cut along its widest dimension (its range as a part of the whole
table's range), so that the bytes on both sides are as the numbers of shards they become. The cut is found by
histograms: rows of the undecided range fall into bins, the bin in which the wanted share lies becomes the
next range. Rows alike in the dimension are ordered by a hash of their text, then by row, so equal texts stay
together unless a cut has to pass between them, and a cut exists that is exact up to one row. All nodes of a
level share each pass; what reaches the driver is bounded by the number of bins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tailrace.llm.tables import Tables

_BINS = 1 << 16  # in all nodes of a pass together
_KEYS = ("dim", "tie", "uid")
_MAX_SHARDS = 1 << 14  # node tables are broadcast


@dataclass
class _Cut:
    """Search for a node's cut: values fixed so far, the range of the next key, bytes before it and wanted."""

    wanted: int
    exact: int
    fixed: tuple[int, ...] = ()
    low: int = -(1 << 63)
    high: int = (1 << 63) - 1
    before: int = 0
    found: bool = False

    def narrow(self, bins: list[tuple[int, int, int]]) -> None:
        """``bins``: smallest and largest key and bytes, in order of keys."""
        for low, high, size in bins:
            if self.before + size > self.wanted or (low, high, size) == bins[-1]:
                self.low, self.high = low, high
                self.found = size <= self.exact or (low == high and len(self.fixed) == len(_KEYS) - 1)
                if self.found and self.wanted - self.before > size / 2:  # the cut is nearer to the range's end
                    self.low = high + 1
                elif low == high and not self.found:
                    self.fixed, self.low, self.high = (*self.fixed, low), -(1 << 63), (1 << 63) - 1
                return
            self.before += size

    def row(self) -> tuple:
        values = [*self.fixed, self.low, *[-(1 << 63)] * len(_KEYS)]
        return (len(self.fixed), min(self.low, (1 << 63) - 1), self.high, *values[: len(_KEYS)])


def kd_shards(docs: DataFrame, dimensions: list[F.Column], shards: int | None = None, target_bytes: int = 1 << 30, exact: float = 1e-4) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs``.

    The number of shards is given or the bytes over ``target_bytes``, rounded up. ``dimensions`` are bigint columns;
    null counts as 0. A range of less than ``exact`` of a shard's bytes is not cut further. size is the text's UTF-8
    bytes (null: none) plus 1. Slots count from 0 in each shard, in no particular order. Repeated rows get a slot
    each; null ids are kept; an empty table gives no rows.
    """
    spark = docs.sparkSession
    tables = Tables(spark, "kd")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = [F.coalesce(d.cast("bigint"), F.lit(0)).alias(f"d{i}") for i, d in enumerate(dimensions)]
    points = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("uid"), F.lit(0).alias("node"), *named,
    )
    points = tables.keep(points, "level0")
    ranges = [F.struct(F.min(f"d{i}"), F.max(f"d{i}")).alias(f"d{i}") for i in range(len(dimensions))]
    whole = points.agg(F.sum("size").alias("size"), F.count("*").alias("rows"), *ranges).first()
    total = whole["size"] or 0
    shards = shards or max(1, -(-total // target_bytes))
    if shards > _MAX_SHARDS:
        raise ValueError(f"{shards} shards; raise target_bytes for at most {_MAX_SHARDS}")
    nodes, level = {0: (0, shards)}, 0  # node -> its shards
    spread = [max(whole[f"d{i}"][1] - whole[f"d{i}"][0], 1) if whole["rows"] else 1 for i in range(len(dimensions))]
    while any(b - a > 1 for a, b in nodes.values()):
        stats = {r["node"]: r for r in points.groupBy("node").agg(F.sum("size").alias("size"), *ranges).collect()}
        axis, cuts = {}, {}
        for node, (a, b) in nodes.items():
            if b - a > 1 and node in stats:
                s = stats[node]
                axis[node] = max(range(len(dimensions)), key=lambda i: (s[f"d{i}"][1] - s[f"d{i}"][0]) / spread[i])
                cuts[node] = _Cut(s["size"] * ((b - a) // 2) // (b - a), max(1, int(exact * total / shards)))
        _find(points, axis, cuts)
        points = tables.keep(_applied(points, nodes, axis, cuts), f"level{level + 1}")
        tables.drop(f"level{level}")
        halves = {}
        for node, (a, b) in nodes.items():
            middle = a + (b - a) // 2 if b - a > 1 else b
            halves[2 * node] = (a, middle)
            if b - a > 1:
                halves[2 * node + 1] = (middle, b)
        nodes, level = halves, level + 1
    shard_of = spark.createDataFrame([(n, a) for n, (a, _) in nodes.items()], "node int, shard int")
    placed = points.select("doc_id", "size", "text_crc32", "uid", "node").join(F.broadcast(shard_of), "node").drop("node")
    return _slotted(placed, max(1, (whole["rows"] or 0) // shards // 50_000))


def _with_key(points: DataFrame, axis: dict[int, int]) -> DataFrame:
    """Adds the value of the dimension along which a row's node is cut."""
    spark = points.sparkSession
    table = F.broadcast(spark.createDataFrame(list(axis.items()), "node int, axis int"))
    dims = F.array(*[c for c in points.columns if c[0] == "d" and c[1:].isdigit()])
    return points.join(table, "node", "left").withColumn("dim", F.when(F.col("axis").isNotNull(), dims[F.col("axis")]))


_STATE = "node int, depth int, low bigint, high bigint, v0 bigint, v1 bigint, v2 bigint"


def _find(points: DataFrame, axis: dict[int, int], cuts: dict[int, _Cut]) -> None:
    while open_ := {n: c for n, c in cuts.items() if not c.found}:
        bins = max(16, _BINS // len(open_))
        state = points.sparkSession.createDataFrame([(n, *c.row()) for n, c in open_.items()], _STATE)
        rows = _with_key(points, axis).join(F.broadcast(state), "node")
        key = F.when(F.col("depth") == 0, F.col("dim")).when(F.col("depth") == 1, F.col("tie")).otherwise(F.col("uid"))
        same = ((F.col("depth") < 1) | (F.col("dim") == F.col("v0"))) & ((F.col("depth") < 2) | (F.col("tie") == F.col("v1")))
        rows = rows.withColumn("key", key).where(same & F.col("key").between(F.col("low"), F.col("high")))
        x, low, high = (F.col(c).cast("double") for c in ("key", "low", "high"))
        bin_ = F.floor((x - low) / (high - low + 1) * bins)  # never falls as the key grows
        found = rows.groupBy("node", bin_.alias("bin")).agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("size"))
        by_node: dict[int, list] = {}
        for r in sorted(found.collect(), key=lambda r: (r["node"], r["low"])):
            by_node.setdefault(r["node"], []).append((r["low"], r["high"], r["size"]))
        for n, c in open_.items():
            c.narrow(by_node[n])


def _applied(points: DataFrame, nodes: dict[int, tuple[int, int]], axis: dict[int, int], cuts: dict[int, _Cut]) -> DataFrame:
    """Children: rows before the cut go to the left one; a node that is a shard already has a left child only."""
    state = points.sparkSession.createDataFrame([(n, *c.row()) for n, c in cuts.items()], _STATE)
    columns = points.columns
    rows = _with_key(points, axis).join(F.broadcast(state), "node", "left")
    at0, at1 = F.col("dim") == F.col("v0"), F.col("tie") == F.col("v1")
    before = (F.col("dim") < F.col("v0")) | (at0 & (F.col("tie") < F.col("v1"))) | (at0 & at1 & (F.col("uid") < F.col("v2")))
    right = F.col("depth").isNotNull() & ~before
    return rows.withColumn("node", F.col("node") * 2 + right.cast("int")).select(columns)


def _slotted(placed: DataFrame, blocks: int) -> DataFrame:
    """Slots without gaps: blocks of a shard are counted, their starts summed up, and rows numbered in each block."""
    placed = placed.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    starts = placed.groupBy("shard", "block").count()
    order = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("shard", "block", F.coalesce(F.sum("count").over(order), F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "uid"))
    rows = placed.withColumn("number", number).join(starts, ["shard", "block"])
    return rows.select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("number") - 1).alias("slot"))

"""Which server owns a topic: assignment, redirects, balance and membership changes.

The ranked server list is one small array, read by every row as a scalar subquery. Deliveries therefore
find their server without a join or a shuffle, however unevenly the topics are filled. A list of more than
``MAX_SERVERS`` is ranked in buckets and joined by position instead; Spark broadcasts it or splits skewed positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailrace.functions.columns import java_string_hash, server_key

MAX_SERVERS = 10_000
_BUCKETS = 4096


def _ring_table(servers: DataFrame) -> DataFrame:
    """One row with the servers in unsigned id order."""
    entry = F.struct(server_key("server_id").alias("key"), F.col("server_id"))
    return servers.select("server_id").distinct().agg(F.sort_array(F.collect_list(entry)).alias("ring"))


def server_rank(servers: DataFrame) -> DataFrame:
    """Position of every server in the sorted membership list.

    Ids are dealt to buckets by their value, which keeps their order; a position is the number of servers in the
    buckets before and the place within the bucket, so no task sorts the whole list.
    """
    ids = servers.select("server_id").where("server_id is not null").distinct()
    id_ = F.col("server_id").cast("bigint")
    ids = ids.withColumn("value", F.when(id_ < 0, id_.cast("double") + float(1 << 64)).otherwise(id_.cast("double")))
    ends = ids.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high"))).scalar()
    share = (F.col("value") - ends["low"]) / (ends["high"] - ends["low"] + 1)
    ids = ids.withColumn("bucket", F.floor(share * _BUCKETS))
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sizes = ids.groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(server_key("server_id")))
    placed = ids.withColumn("place", place).join(F.broadcast(sizes), "bucket")  # at most a row per bucket
    return placed.select("server_id", (F.col("before") + F.col("place") - 1).cast("int").alias("pos"))


def _position(topic_hash: Column, size: Column) -> Column:
    return F.pmod(topic_hash, F.nullif(size, F.lit(0)))


def _owned(rows: DataFrame, servers: DataFrame, name: str = "server_id") -> DataFrame:
    """``rows`` with the server of their topic, position ``floorMod(hash, n)`` in the sorted list; null without servers."""
    topic_hash = java_string_hash("topic")
    ids = servers.select("server_id").where("server_id is not null").distinct()
    if ids.count() <= MAX_SERVERS:
        ring = _ring_table(ids).scalar()
        return rows.withColumn(name, F.get(ring, _position(topic_hash, F.size(ring)))["server_id"])
    size = ids.agg(F.count("*").cast("int")).scalar()
    ranked = server_rank(ids).select(F.col("pos").alias("_pos"), F.col("server_id").alias("_owner"))
    kept = rows.columns if name not in rows.columns else [c for c in rows.columns if c != name]
    joined = rows.withColumn("_pos", _position(topic_hash, size)).join(ranked, "_pos", "left")
    return joined.select(*kept, F.col("_owner").alias(name))


def assign_topics(topics: DataFrame, servers: DataFrame) -> DataFrame:
    """Server of each distinct topic: position ``floorMod(hash, n)`` in the sorted list."""
    size = servers.select(F.count_distinct("server_id").cast("int")).scalar()
    hashed = topics.select("topic").distinct().withColumn("hash", java_string_hash("topic"))
    return _owned(hashed.withColumn("pos", _position(F.col("hash"), size)), servers)


def redirect_audit(deliveries: DataFrame, servers: DataFrame) -> DataFrame:
    """Adds the owning ``server_id`` and whether the receiving server had to redirect."""
    return _owned(deliveries, servers).withColumn("redirect", ~F.col("received_by").eqNullSafe(F.col("server_id")))


def redirect_totals(audit: DataFrame) -> DataFrame:
    """Redirects per receiving server."""
    return audit.groupBy("received_by").agg(F.count_if("redirect").alias("redirects"))


def server_load(deliveries: DataFrame, servers: DataFrame) -> DataFrame:
    """Messages per owning server; messages are counted per topic before topics are hashed."""
    per_topic = deliveries.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return _owned(per_topic, servers).groupBy("server_id").agg(F.sum("n").alias("messages"))


def reassignment_diff(topics: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Topics that change server between two membership lists."""
    both = _owned(_owned(topics.select("topic").distinct(), before, "old_server"), after, "new_server")
    return both.where(~F.col("old_server").eqNullSafe(F.col("new_server")))


def latest_owner(responses: DataFrame) -> DataFrame:
    """Last successful response decides: the redirect's target, else the responder."""
    owner = F.coalesce("redirect_to", "server_id")
    return (
        responses.where("successful").groupBy("topic").agg(F.max_by(owner, "seq").alias("server_id"))
    )


def drop_dead_owners(owners: DataFrame, failed: DataFrame) -> DataFrame:
    """Forgets topics whose server failed."""
    return owners.join(failed.select("server_id"), "server_id", "left_anti").select(*owners.columns)


def flatten_hosts(servers: DataFrame) -> DataFrame:
    """One row per server address."""
    return (
        servers.select("server_id", F.explode("hosts").alias("h"))
        .select("server_id", F.col("h.host_name").alias("host_name"), F.col("h.port").alias("port"))
        .dropDuplicates()
    )


def membership_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Servers on one side only."""
    left, right = a.select("server_id"), b.select("server_id")
    only_a = left.subtract(right).withColumn("side", F.lit("a"))
    return only_a.unionByName(right.subtract(left).withColumn("side", F.lit("b")))

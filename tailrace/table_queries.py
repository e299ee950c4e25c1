"""The operators on the driver's tables, each with the SQL that must give the same rows.

Messages come from ``events``: the topic is the event type (few, large topics) or the user (many, small
ones), ``seq`` the event id, ``time`` the event time in milliseconds, the payload ``props``. The servers
are the 25 nations; those of region 0 are the ones that fail.
"""

from __future__ import annotations

from collections.abc import Callable
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailrace.functions.columns import frame_size, message_id, name_offset, offset_name, same_hosts, stream_offset
from tailrace.operators import audit, delivery, metrics, offsets, routing, sketches, status
from tailrace.plans.rollover import rollover_plan
from tailrace.session import fresh_dir
from tailrace.sinks.topic_log import valid_topics, write_count_blob, write_metrics, write_topic_log
from tailrace.sources import parsers
from tailrace.sources.batch import parse_payload, read_count_blob, read_metrics, read_topic_log, split_words
from tailrace.sources.progress import read_progress, write_progress
from tailrace.streaming import metrics as metric_stream
from tailrace.streaming import status as status_stream
from tailrace.streaming.sink import append_topic_log
from tailrace.streaming.tail import tail_topic_log

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BY_TYPE = "event_type"
BY_USER = "concat('topic-', user_id)"
SQL_BY_TYPE = "event_type"
SQL_BY_USER = "'topic-' || user_id"

INTERVALS = (60, 3600, 86400)
FILE_BYTES = 5000
DOCUMENT_FILE_BYTES = 50_000


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# --- inputs -------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str, topic=BY_USER, source: DataFrame | None = None) -> DataFrame:
    millis = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    return (source or table(spark, sf_dir, "events")).select(
        F.expr(topic).alias("topic"),
        F.col("event_id").alias("seq"),
        millis.alias("time"),
        F.encode("props", "UTF-8").alias("payload"),
        F.col("user_id").alias("client"),
    )


def message_sizes(spark: SparkSession, sf_dir: str, topic=BY_TYPE) -> DataFrame:
    msgs = messages(spark, sf_dir, topic)
    return msgs.select("topic", "seq", frame_size("time", "payload").alias("size"))


def servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return nations.select(F.col("n_nationkey").cast("bigint").alias("server_id"), (F.col("n_regionkey") == 0).alias("failed"))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select("topic", "seq", (F.col("seq") % 25).alias("received_by"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("seq")
    return messages(spark, sf_dir).select(
        "topic",
        "seq",
        (seq % 25).alias("server_id"),
        (seq % 7 != 0).alias("successful"),
        F.when(seq % 3 == 0, (seq + 4) % 25).alias("redirect_to"),
    )


def emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("msg_id"),
        F.expr(BY_USER).alias("file"),
        (F.col("event_id") * 16).alias("record_offset"),
        F.col("props").alias("tuple"),
    )


def acked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emitted(spark, sf_dir).where(F.col("msg_id") % 7 != 0).select("msg_id")


def server_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = F.struct(F.col("s_name").alias("host_name"), F.lit(9090).alias("port"))
    spare = F.struct(F.col("s_name").alias("host_name"), (F.col("s_nationkey") + 9080).cast("int").alias("port"))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("server_id"), F.array(main, spare).alias("hosts"), F.array(spare, main, main).alias("again"),
        F.array(spare).alias("spare"),
    )


# --- SQL fragments ------------------------------------------------------------------------------------


def _sql_varint(x: str) -> str:
    steps = " ".join(f"WHEN {x} < {1 << (7 * n)} THEN {n}" for n in range(1, 9))
    return f"(CASE WHEN {x} < 0 THEN 10 {steps} ELSE 9 END)"


_LENGTH = "octet_length(encode(props))"
_SIZE = f"(4 + 1 + {_sql_varint('(epoch_us(ts) // 1000)')} + 1 + {_sql_varint(_LENGTH)} + {_LENGTH})::BIGINT"


def _sql_messages(topic: str) -> str:
    return (
        f"msgs AS (SELECT {topic} AS topic, event_id AS seq, epoch_us(ts) // 1000 AS time, user_id AS client, "
        f"props AS payload, {_SIZE} AS size FROM events)"
    )


_HASH = (
    "list_reduce(list_prepend(0::BIGINT, list_transform(string_split(topic, ''), lambda c: ord(c)::BIGINT)), "
    "lambda a, x: (a * 31 + x) % 4294967296)"
)
_SIGNED = "CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END"


def _sql_ring(name: str, members: str = "true") -> str:
    """Assignments of all topics of ``msgs`` to the servers."""
    return f"""
ring_{name} AS (SELECT n_nationkey::BIGINT AS server_id, row_number() OVER (ORDER BY n_nationkey) - 1 AS pos,
                count(*) OVER () AS n FROM nation WHERE {members}),
{name} AS (
  SELECT topic, hash, pos, server_id FROM (
    SELECT topic, {_SIGNED} AS hash FROM (SELECT topic, {_HASH} AS h FROM (SELECT DISTINCT topic FROM msgs))
  ) JOIN ring_{name} ON pos = ((hash % n) + n) % n)"""


def _sql_rollover(limit: int, source: str = "msgs", begins: str | None = None) -> str:
    """Sequential fold, one record per step."""
    base = f"coalesce((SELECT b.begin FROM {begins} b WHERE b.topic = numbered.topic), 0)" if begins else "0"
    end = "f.record_offset + f.size"
    return f"""
numbered AS (SELECT topic, seq, size, row_number() OVER (PARTITION BY topic ORDER BY seq) AS n FROM {source}),
plan AS (
  SELECT topic, seq, n, size, ({base})::BIGINT AS base_offset, 0::BIGINT AS record_offset FROM numbered WHERE n = 1
  UNION ALL
  SELECT o.topic, o.seq, o.n, o.size,
         CASE WHEN {end} > {limit} THEN f.base_offset + {end} ELSE f.base_offset END,
         CASE WHEN {end} > {limit} THEN 0 ELSE {end} END
  FROM plan f JOIN numbered o ON o.topic = f.topic AND o.n = f.n + 1)"""


_PLAN_BY_TYPE = f"WITH RECURSIVE {_sql_messages(SQL_BY_TYPE)}, {_sql_rollover(FILE_BYTES)}"
_FILES = "files AS (SELECT topic, base_offset, sum(size)::BIGINT AS length FROM plan GROUP BY ALL)"


# --- metrics ------------------------------------------------------------------------------------------


def _sql_interval_metrics() -> str:
    parts = []
    for i in INTERVALS:
        parts.append(
            f"SELECT {i} AS interval, s.tick AS tick, ((s.tick + 1) * {i})::DOUBLE AS time, "
            "coalesce(c.u, 0)::BIGINT AS unique_topics, coalesce(c.n, 0)::BIGINT AS messages FROM "
            f"(SELECT unnest(generate_series(0::BIGINT, (SELECT (max(time) - min(time)) // {i * 1000} FROM msgs))) AS tick) s "
            f"LEFT JOIN (SELECT (time - (SELECT min(time) FROM msgs)) // {i * 1000} AS tick, count(*) AS n, "
            "count(DISTINCT topic) AS u FROM msgs GROUP BY 1) c ON c.tick = s.tick"
        )
    return f"WITH {_sql_messages(SQL_BY_USER)} " + " UNION ALL ".join(parts)


@query(_sql_interval_metrics())
def interval_metrics(spark, sf_dir):
    return metrics.interval_metrics(messages(spark, sf_dir), INTERVALS)


@query(
    f"""WITH {_sql_messages(SQL_BY_USER)}, ticks AS ({" UNION ALL ".join(
        f"SELECT {i} AS interval, time // {i * 1000} AS tick, topic FROM msgs" for i in INTERVALS)})
    SELECT interval, tick, count(*) AS messages, TRUE AS near FROM ticks GROUP BY interval, tick"""
)
def sketch_metrics(spark, sf_dir):
    """Interval metrics from stored sketches; ``near`` tells whether unique topics are within the stated error of the exact ones."""
    msgs, slot = messages(spark, sf_dir), gcd(*INTERVALS)
    path = fresh_dir(spark, "sketches")
    sketches.topic_sketches(msgs, slot).write.parquet(path)
    rolled = sketches.metrics_from_sketches(spark.read.parquet(path), slot, INTERVALS)
    exact = metrics.interval_metrics(msgs, INTERVALS, t0=0, fill=False).select("interval", "tick", F.col("unique_topics").alias("exact"))
    near = F.abs(F.col("unique_topics") - F.col("exact")) <= sketches.sketch_error() * F.col("exact")
    return rolled.join(exact, ["interval", "tick"]).select("interval", "tick", "messages", near.alias("near"))


@query(
    f"""WITH {_sql_messages(SQL_BY_TYPE)} SELECT topic, count(*) AS messages,
    sum(octet_length(encode(payload)))::BIGINT AS bytes, count(DISTINCT client) AS clients FROM msgs GROUP BY topic"""
)
def topic_stats(spark, sf_dir):
    return metrics.topic_stats(messages(spark, sf_dir, BY_TYPE))


# --- routing ------------------------------------------------------------------------------------------


@query(f"WITH {_sql_messages(SQL_BY_USER)}, {_sql_ring('assigned')} SELECT topic, hash::INT AS hash, pos::INT AS pos, server_id FROM assigned")
def assign_topics(spark, sf_dir):
    return routing.assign_topics(messages(spark, sf_dir), servers(spark, sf_dir))


@query("SELECT n_nationkey::BIGINT AS server_id, (row_number() OVER (ORDER BY n_nationkey) - 1)::INT AS pos FROM nation")
def server_rank(spark, sf_dir):
    return routing.server_rank(servers(spark, sf_dir))


@query(
    f"""WITH {_sql_messages(SQL_BY_USER)}, {_sql_ring('assigned')}
    SELECT server_id, count(*) AS messages FROM msgs JOIN assigned USING (topic) GROUP BY server_id"""
)
def server_load(spark, sf_dir):
    return routing.server_load(deliveries(spark, sf_dir), servers(spark, sf_dir))


_AUDIT = f"""WITH {_sql_messages(SQL_BY_USER)}, {_sql_ring('assigned')}, audited AS (
    SELECT topic, seq, seq % 25 AS received_by, server_id, seq % 25 <> server_id AS redirect
    FROM msgs JOIN assigned USING (topic))"""


@query(f"{_AUDIT} SELECT * FROM audited")
def redirect_audit(spark, sf_dir):
    return routing.redirect_audit(deliveries(spark, sf_dir), servers(spark, sf_dir))


@query(f"{_AUDIT} SELECT received_by, count(*) FILTER (WHERE redirect) AS redirects FROM audited GROUP BY received_by")
def redirect_totals(spark, sf_dir):
    return routing.redirect_totals(redirect_audit(spark, sf_dir))


@query(
    f"""WITH {_sql_messages(SQL_BY_USER)}, {_sql_ring('old')}, {_sql_ring('new', 'n_regionkey <> 0')}
    SELECT topic, old.server_id AS old_server, new.server_id AS new_server FROM old JOIN new USING (topic)
    WHERE old.server_id <> new.server_id"""
)
def reassignment_diff(spark, sf_dir):
    before = servers(spark, sf_dir)
    return routing.reassignment_diff(messages(spark, sf_dir), before, before.where("not failed"))


_OWNERS = f"""WITH {_sql_messages(SQL_BY_USER)}, owners AS (
    SELECT topic, arg_max(CASE WHEN seq % 3 = 0 THEN (seq + 4) % 25 ELSE seq % 25 END, seq) AS server_id
    FROM msgs WHERE seq % 7 <> 0 GROUP BY topic)"""


@query(f"{_OWNERS} SELECT * FROM owners")
def latest_owner(spark, sf_dir):
    return routing.latest_owner(responses(spark, sf_dir))


@query(f"{_OWNERS} SELECT * FROM owners WHERE server_id NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)")
def drop_dead_owners(spark, sf_dir):
    return routing.drop_dead_owners(latest_owner(spark, sf_dir), servers(spark, sf_dir).where("failed"))


@query(
    """SELECT s_suppkey AS server_id, s_name AS host_name, 9090 AS port FROM supplier
    UNION SELECT s_suppkey, s_name, s_nationkey + 9080 FROM supplier"""
)
def flatten_hosts(spark, sf_dir):
    return routing.flatten_hosts(server_hosts(spark, sf_dir))


@query("SELECT s_suppkey AS server_id, true AS reordered, s_nationkey = 10 AS spare_only FROM supplier")
def compare_hosts(spark, sf_dir):
    return server_hosts(spark, sf_dir).select(
        "server_id", same_hosts("hosts", "again").alias("reordered"), same_hosts("hosts", "spare").alias("spare_only")
    )


@query(
    """SELECT s_suppkey AS server_id, 'a' AS side FROM supplier WHERE s_nationkey < 8
    UNION ALL SELECT s_suppkey, 'b' FROM supplier WHERE s_nationkey >= 16"""
)
def membership_diff(spark, sf_dir):
    every = table(spark, sf_dir, "supplier").select("s_nationkey", F.col("s_suppkey").alias("server_id"))
    return routing.membership_diff(every.where("s_nationkey < 16"), every.where("s_nationkey >= 8"))


@query(
    """SELECT event_id AS seq, ((xor((user_id::HUGEINT + 18446744073709551616) % 18446744073709551616,
    (event_id::HUGEINT * 213887370601841) % 18446744073709551616)) // 2)::BIGINT AS msg_id FROM events"""
)
def message_ids(spark, sf_dir):
    msgs = messages(spark, sf_dir)
    return msgs.select("seq", message_id("client", "seq").alias("msg_id"))


# --- offsets and files --------------------------------------------------------------------------------


@query(
    f"""WITH {_sql_messages(SQL_BY_TYPE)} SELECT topic, seq, coalesce(sum(size) OVER (PARTITION BY topic ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS stream_offset FROM msgs"""
)
def running_offset(spark, sf_dir):
    return offsets.running_offset(message_sizes(spark, sf_dir))


@query(f"{_PLAN_BY_TYPE} SELECT topic, seq, size, base_offset, record_offset FROM plan")
def rollover(spark, sf_dir):
    return rollover_plan(message_sizes(spark, sf_dir), max_file_bytes=FILE_BYTES)


@query(ORACLES["rollover"])
def rollover_in_segments(spark, sf_dir):
    """As above with topics cut into segments, as happens to very large ones."""
    return rollover_plan(message_sizes(spark, sf_dir), max_file_bytes=FILE_BYTES, segment_rows=256)


@query(
    f"""WITH RECURSIVE {_sql_messages(SQL_BY_USER)},
    begins AS (SELECT 'topic-' || user_id AS topic, max(event_id) * 100 + 100000 AS begin FROM events
               WHERE user_id % 2 = 0 GROUP BY 1),
    {_sql_rollover(500, begins='begins')} SELECT topic, seq, size, base_offset, record_offset FROM plan"""
)
def rollover_takeover(spark, sf_dir):
    """Every second topic already holds data and goes on after the takeover gap."""
    known = table(spark, sf_dir, "events").where("user_id % 2 = 0").groupBy(F.expr(BY_USER).alias("topic"))
    ends = known.agg((F.max("event_id") * 100).alias("end_offset"))
    return rollover_plan(message_sizes(spark, sf_dir, BY_USER), ends, max_file_bytes=500)


@query(
    f"""WITH RECURSIVE docs AS (SELECT source AS topic, doc_id AS seq, (4 + octet_length(encode(text)))::BIGINT AS size
    FROM documents), {_sql_rollover(DOCUMENT_FILE_BYTES, 'docs')}
    SELECT topic, seq, size, base_offset, record_offset FROM plan"""
)
def rollover_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("source").alias("topic"),
        F.col("doc_id").alias("seq"),
        frame_size(None, F.encode("text", "UTF-8"), envelope=False).alias("size"),
    )
    return rollover_plan(docs, max_file_bytes=DOCUMENT_FILE_BYTES)


def _planned_files(spark, sf_dir):
    sizes = audit.file_sizes(rollover(spark, sf_dir))
    return sizes.withColumnRenamed("bytes", "length")


@query(f"{_PLAN_BY_TYPE} SELECT topic, base_offset, count(*) AS records, sum(size)::BIGINT AS bytes FROM plan GROUP BY ALL")
def file_sizes(spark, sf_dir):
    return audit.file_sizes(rollover(spark, sf_dir))


@query(f"{_PLAN_BY_TYPE}, {_FILES} SELECT topic, arg_max(base_offset + length, base_offset) AS end_offset FROM files GROUP BY topic")
def topic_end_offset(spark, sf_dir):
    return audit.topic_end_offset(_planned_files(spark, sf_dir))


@query(
    f"""{_PLAN_BY_TYPE}, {_FILES}, runs AS (
      SELECT topic, base_offset, length FROM files UNION ALL
      SELECT topic, max(base_offset + length) + 100000, 77 FROM files GROUP BY topic UNION ALL
      SELECT topic, max(base_offset + length) + 100077, 99 FROM files GROUP BY topic UNION ALL
      SELECT topic, max(base_offset + length) + 100099, 5 FROM files GROUP BY topic UNION ALL
      SELECT topic, max(base_offset + length) + 100500, 5 FROM files GROUP BY topic),
    gaps AS (SELECT topic, base_offset, lead(base_offset) OVER w AS next_base,
             lead(base_offset) OVER w - base_offset - length AS gap FROM runs
             WINDOW w AS (PARTITION BY topic ORDER BY base_offset))
    SELECT topic, base_offset, coalesce(next_base, -1) AS next_base, coalesce(gap, 0) AS gap, CASE WHEN gap IS NULL THEN 'last' WHEN gap < 0 THEN 'overlap'
    WHEN gap = 0 THEN 'own_roll' WHEN gap >= 100000 THEN 'takeover' ELSE 'short_gap' END AS kind FROM gaps"""
)
def gap_audit(spark, sf_dir):
    """A rolled run, then a takeover, an own roll, an overlap and a short gap."""
    files = _planned_files(spark, sf_dir).select("topic", "base_offset", "length")
    later = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(n).alias("n")) for o, n in ((100000, 77), (100077, 99), (100099, 5), (100500, 5))])
    more = (
        audit.topic_end_offset(files)
        .select("topic", "end_offset", F.explode(later).alias("x"))
        .select("topic", (F.col("end_offset") + F.col("x.o")).alias("base_offset"), F.col("x.n").cast("bigint").alias("length"))
    )
    return audit.gap_audit(files.unionByName(more)).fillna({"next_base": -1, "gap": 0})


_STREAM = f"""WITH {_sql_messages(SQL_BY_USER)}, recs AS (SELECT topic, seq, time, payload, coalesce(sum(size) OVER
    (PARTITION BY topic ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS stream_offset FROM msgs)"""


@query(
    f"""{_STREAM} SELECT topic, seq, stream_offset FROM recs
    QUALIFY row_number() OVER (PARTITION BY topic ORDER BY stream_offset) <= 20"""
)
def fair_batch(spark, sf_dir):
    return audit.fair_batch(offsets.running_offset(message_sizes(spark, sf_dir, BY_USER)), 20)


@query(f"{_STREAM} SELECT topic, seq, stream_offset FROM recs")
def topic_order(spark, sf_dir):
    return audit.topic_order(offsets.running_offset(message_sizes(spark, sf_dir, BY_USER)))


@query(
    f"""WITH {_sql_messages(SQL_BY_USER)} SELECT topic, seq, time FROM msgs
    WHERE time BETWEEN 1704500000000 AND 1706000000000 AND length(payload) > 8"""
)
def valid_envelopes(spark, sf_dir):
    msgs = messages(spark, sf_dir)
    msgs = msgs.withColumn("payload", F.when(F.octet_length("payload") > 8, F.col("payload")))
    return audit.valid_envelopes(msgs, 1704500000000, 1706000000000).select("topic", "seq", "time")


@query(
    """SELECT event_id, lower(lpad(hex(event_id * 16), 16, '0')) AS name, event_id * 16 AS named_offset,
    CASE WHEN regexp_full_match(event_type, '[0-9a-f]+') THEN 0 END AS type_offset FROM events"""
)
def file_names(spark, sf_dir):
    """Names of offsets, the offsets of these names, and no offset for names that are none."""
    named = table(spark, sf_dir, "events").select("event_id", offset_name(F.col("event_id") * 16).alias("name"), "event_type")
    return named.select("event_id", "name", name_offset("name").alias("named_offset"), name_offset("event_type").cast("int").alias("type_offset"))


@query(
    r"""SELECT o_orderpriority AS topic, o_orderkey AS seq, regexp_full_match(o_orderpriority, '[0-9a-zA-Z_\-]+') AS valid
    FROM orders"""
)
def topic_guard(spark, sf_dir):
    """Orders by priority, one of which holds a space and is no name for a topic."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("topic"), F.col("o_orderkey").alias("seq"))
    good, bad = valid_topics(orders)
    return good.withColumn("valid", F.lit(True)).union(bad.withColumn("valid", F.lit(False)))


@query(
    """SELECT conv_id, turn, string_split(coalesce(text, ''), ' ')[1] AS word, string_split(coalesce(text, ''), ' ')[2] AS n
    FROM conversations"""
)
def payload_words(spark, sf_dir):
    """The first two words of every turn, parsed from its bytes."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.encode("text", "UTF-8").alias("payload"))
    return parse_payload(turns, lambda p: split_words(p, ["word", "n"])).drop("payload")


@query(
    """SELECT conv_id, turn, string_split(coalesce(text, ''), ' ')[1] AS word,
    CASE WHEN regexp_full_match(string_split(coalesce(text, ''), ' ')[2], '[0-9]{1,18}')
    THEN string_split(coalesce(text, ''), ' ')[2] END::BIGINT AS n FROM conversations"""
)
def parser_function(spark, sf_dir):
    """Every turn through a table function in SQL, whose columns are named in the call."""
    parsers.register_parser(spark, "words_of", parsers.split_at_spaces)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.encode("text", "UTF-8").alias("payload"))
    return spark.sql("SELECT * FROM words_of(TABLE(SELECT * FROM {turns}), 'word string, n bigint')", turns=turns)


# --- delivery -----------------------------------------------------------------------------------------

_EMITTED = """emitted AS (SELECT event_id AS msg_id, 'topic-' || user_id AS file, event_id * 16 AS record_offset,
    props AS tuple FROM events), pending AS (SELECT * FROM emitted WHERE msg_id % 7 = 0)"""


@query(f"WITH {_EMITTED} SELECT * FROM pending")
def pending_messages(spark, sf_dir):
    return delivery.pending_messages(emitted(spark, sf_dir), acked(spark, sf_dir)).orderBy("msg_id")


@query(f"WITH {_EMITTED} SELECT * FROM pending WHERE msg_id % 5 = 0")
def resend_failed(spark, sf_dir):
    failed = emitted(spark, sf_dir).where("msg_id % 5 = 0").select("msg_id")
    return delivery.resend_failed(pending_messages(spark, sf_dir), failed)


_RESTART = f"""WITH {_EMITTED}, smallest AS (SELECT file, min(record_offset) AS record_offset FROM pending
    WHERE msg_id % 3 = 0 GROUP BY file), restart AS (SELECT * FROM smallest UNION ALL
    SELECT file, max(record_offset) FROM emitted WHERE file NOT IN (SELECT file FROM smallest) GROUP BY file)"""


@query(f"{_RESTART} SELECT * FROM restart")
def checkpoint_offsets(spark, sf_dir):
    live = emitted(spark, sf_dir).groupBy("file").agg(F.max("record_offset").alias("record_offset"))
    return delivery.checkpoint_offsets(pending_messages(spark, sf_dir).where("msg_id % 3 = 0"), live)


@query(f"{_RESTART} SELECT e.* FROM emitted e JOIN restart r ON e.file = r.file AND e.record_offset >= r.record_offset")
def replay_set(spark, sf_dir):
    return delivery.replay_set(emitted(spark, sf_dir), checkpoint_offsets(spark, sf_dir))


@query(
    f"""{_RESTART} SELECT DISTINCT file FROM restart
    WHERE file NOT IN (SELECT 'topic-' || user_id FROM events WHERE user_id % 4 <> 0)"""
)
def missing_files(spark, sf_dir):
    files = table(spark, sf_dir, "events").where("user_id % 4 != 0").select(F.expr(BY_USER).alias("file"))
    return delivery.missing_files(checkpoint_offsets(spark, sf_dir), files)


_LISTINGS = """WITH days AS (SELECT DISTINCT event_type AS topic, user_id::VARCHAR AS file, user_id FROM events),
    listed AS (SELECT topic, file FROM days WHERE user_id % 3 <> 0),
    seen AS (SELECT topic, file FROM days WHERE user_id % 4 <> 0)"""


def _listings(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(F.expr(BY_TYPE).alias("topic"), F.col("user_id").cast("string").alias("file"), "user_id").distinct()
    return days.where("user_id % 3 != 0"), days.where("user_id % 4 != 0")


@query(f"{_LISTINGS} SELECT * FROM listed EXCEPT SELECT * FROM seen")
def new_files(spark, sf_dir):
    return delivery.new_files(*_listings(spark, sf_dir))


@query(f"{_LISTINGS} SELECT * FROM listed")
def next_seen(spark, sf_dir):
    return delivery.next_seen(*_listings(spark, sf_dir))


# --- status logs --------------------------------------------------------------------------------------


def status_log(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    """Each event is a note with two entries: sign-ups set a counter of the user, others add to it, in cents and in quarters."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    quarters = F.floor(F.col("value") * 4).cast("double") / 4
    signup = F.col("event_type") == "signup"
    none_int, none_big, none_double = (F.lit(None).cast(t) for t in ("int", "bigint", "double"))

    def entry(key, add, set_, double_add, double_set):
        return F.struct(
            F.lit(key).alias("key"),
            add.cast("int").alias("integerIncrement"),
            double_add.alias("doubleIncrement"),
            set_.alias("ivalue"),
            double_set.alias("dvalue"),
        )

    notes = F.array(
        entry("cents", F.when(~signup, cents), F.when(signup, cents), F.when(~signup, quarters), F.when(signup, quarters)),
        entry("seen", F.lit(1), none_big, none_double, none_double),
    )
    return (source or table(spark, sf_dir, "events")).select(
        F.col("user_id").cast("int").alias("id"), F.col("event_id").alias("time"), notes.alias("count")
    )


@query(
    """WITH e AS (SELECT user_id::INT AS id, event_id, event_type, round(value * 100)::BIGINT AS cents, floor(value * 4) / 4 AS quarters FROM events),
    last_set AS (SELECT id, max(event_id) AS set_at, arg_max(cents, event_id) AS start, arg_max(quarters, event_id) AS q FROM e WHERE event_type = 'signup' GROUP BY id)
    SELECT id, 'cents' AS key, (coalesce(any_value(start), 0) + coalesce(sum(cents) FILTER
      (WHERE event_type <> 'signup' AND (set_at IS NULL OR event_id > set_at)), 0))::BIGINT AS ivalue,
      (coalesce(any_value(q), 0) + coalesce(sum(quarters) FILTER
      (WHERE event_type <> 'signup' AND (set_at IS NULL OR event_id > set_at)), 0))::DOUBLE AS dvalue
    FROM e LEFT JOIN last_set USING (id) GROUP BY id
    UNION ALL SELECT id, 'seen', count(*), NULL FROM e GROUP BY id"""
)
def fold_status_counters(spark, sf_dir):
    return status.fold_status_counters(status_log(spark, sf_dir))


# --- files and streams --------------------------------------------------------------------------------


def _text(column: str):
    return F.decode(column, "UTF-8").alias(column)


def _read_back(spark, base):
    return read_topic_log(spark, base).select("topic", "stream_offset", "time", _text("payload"))


_SQL_LOG = f"{_STREAM} SELECT topic, stream_offset, time, payload FROM recs"


@query(_SQL_LOG)
def topic_log_round_trip(spark, sf_dir):
    """Write every event as a message, with many files per topic, and read the log."""
    base = fresh_dir(spark, "log")
    write_topic_log(messages(spark, sf_dir), base, max_file_bytes=FILE_BYTES)
    return _read_back(spark, base)


@query(
    """SELECT source AS topic, coalesce(sum(4 + octet_length(encode(text))) OVER (PARTITION BY source ORDER BY doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS stream_offset, text AS content FROM documents"""
)
def count_blob_round_trip(spark, sf_dir):
    """Write whole documents as blobs and read them."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("source").alias("topic"), F.col("doc_id").alias("seq"), F.encode("text", "UTF-8").alias("payload")
    )
    base = fresh_dir(spark, "blobs")
    write_count_blob(docs, base, max_file_bytes=DOCUMENT_FILE_BYTES)
    blobs = read_count_blob(spark, base)
    return blobs.select("topic", stream_offset("base_offset", "record_offset").alias("stream_offset"), _text("content"))


_ORDER = "o_orderkey || '|' || o_custkey || '|' || o_orderpriority"
_ORDER_SIZE = f"(4 + 1 + {_sql_varint('epoch_us(o_orderdate) // 1000')} + 1 + {_sql_varint(f'length({_ORDER})')} + length({_ORDER}))"


@query(
    f"""SELECT o_orderstatus AS topic, epoch_us(o_orderdate) // 1000 AS time, {_ORDER} AS payload,
    coalesce(sum({_ORDER_SIZE}) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS stream_offset FROM orders"""
)
def order_log(spark, sf_dir):
    """Log every order by status, which makes a few large topics, and read the log."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("topic"),
        F.col("o_orderkey").alias("seq"),
        F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', o_orderdate)").alias("time"),
        F.encode(F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderpriority"), "UTF-8").alias("payload"),
    )
    base = fresh_dir(spark, "log")
    write_topic_log(orders, base, max_file_bytes=20 * FILE_BYTES)
    return _read_back(spark, base)


@query(
    f"""SELECT role AS topic, coalesce(sum(4 + 1 + {_sql_varint('octet_length(encode(text))')} + octet_length(encode(text)))
    OVER (PARTITION BY role ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS
    stream_offset, text AS payload FROM conversations"""
)
def conversation_log(spark, sf_dir):
    """Log every turn of every conversation by role, without times, and read the log."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("role").alias("topic"),
        (F.shiftleft("conv_id", 20) + F.col("turn")).alias("seq"),
        F.lit(None).cast("bigint").alias("time"),
        F.encode("text", "UTF-8").alias("payload"),
    )
    base = fresh_dir(spark, "log")
    write_topic_log(turns, base, max_file_bytes=DOCUMENT_FILE_BYTES)
    return _read_back(spark, base).drop("time")


@query(f"SELECT time, interval, unique_topics, messages FROM ({_sql_interval_metrics()})")
def metrics_round_trip(spark, sf_dir):
    """Log the data points of the interval metrics and read the metrics topic."""
    base = fresh_dir(spark, "metrics")
    write_metrics(interval_metrics(spark, sf_dir), base, t0=0)
    return read_metrics(spark, base)


@query(f"{_RESTART} SELECT file, record_offset, file IN (SELECT file FROM pending) AS seen FROM restart")
def progress_round_trip(spark, sf_dir):
    """Save restart offsets and seen files, and restore them."""
    path = fresh_dir(spark, "progress")
    offsets_ = checkpoint_offsets(spark, sf_dir)
    write_progress(offsets_, pending_messages(spark, sf_dir).select("file").distinct(), path, sf_dir, ".*")
    offsets_, seen = read_progress(spark, path)
    known = seen.withColumn("known", F.lit(True))
    return offsets_.join(known, "file", "left").select("file", "record_offset", F.coalesce("known", F.lit(False)).alias("seen"))


def _run(writer, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")


@query(f"WITH {_sql_messages(SQL_BY_TYPE)} SELECT topic, time, payload FROM msgs")
def tail_round_trip(spark, sf_dir):
    """Tail a log while it grows: half of the time span, a restart, then the rest."""
    base, work = fresh_dir(spark, "log"), fresh_dir(spark, "tail")
    msgs = messages(spark, sf_dir, BY_TYPE)
    middle = msgs.agg(F.floor((F.min("time") + F.max("time")) / 2)).scalar()
    for part in (msgs.where(F.col("time") < middle), msgs.where(F.col("time") >= middle)):
        write_topic_log(part, base, max_file_bytes=10 * FILE_BYTES)
        recs = tail_topic_log(spark, base).select("topic", "time", _text("payload"))
        _run(recs.writeStream.format("parquet").option("path", f"{work}/out"), f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out")


@query(_SQL_LOG)
def stream_sink(spark, sf_dir):
    """Append a stream of the events to a log."""
    base, work = fresh_dir(spark, "log"), fresh_dir(spark, "stream")
    events = messages(spark, sf_dir, source=_event_stream(spark, sf_dir))
    _run(append_topic_log(events, base, "events", max_file_bytes=FILE_BYTES), work)
    return _read_back(spark, base)


def _sql_stream_metrics() -> str:
    ticks = " UNION ALL ".join(
        f"SELECT {i} AS interval, time // {i * 1000} AS tick, topic FROM msgs" for i in (3600, 86400)
    )
    return f"""WITH {_sql_messages(SQL_BY_USER)}, ticks AS ({ticks})
    SELECT interval, tick, ((tick + 1) * interval)::DOUBLE AS time, count(DISTINCT topic) AS unique_topics,
    count(*) AS messages FROM ticks GROUP BY interval, tick
    HAVING (tick + 1) * interval <= (SELECT max((tick + 1) * interval) FROM ticks) - 86410"""


@query(_sql_stream_metrics())
def stream_interval_metrics(spark, sf_dir):
    """Ticks that the watermark has closed once all events have arrived."""
    work = fresh_dir(spark, "stream")
    events = messages(spark, sf_dir, source=_event_stream(spark, sf_dir))
    ticks = metric_stream.stream_interval_metrics(events, (3600, 86400))
    _run(metric_stream.on_tick(ticks, lambda df: df.write.mode("append").parquet(f"{work}/out")), f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out")


_FILLED_FROM = "(SELECT min(time) // 86400000 * 86400000 FROM msgs)"


def _sql_filled_metrics() -> str:
    ends = ", ".join(f"max((time - {_FILLED_FROM}) // {i * 1000} + 1) * {i}" for i in (3600, 86400))
    parts = [
        f"""SELECT {i} AS interval, s.tick AS tick, ((s.tick + 1) * {i})::DOUBLE AS time, coalesce(c.u, 0)::BIGINT AS unique_topics,
        coalesce(c.n, 0)::BIGINT AS messages FROM (SELECT unnest(generate_series(0::BIGINT, (SELECT closed // {i} FROM mark) - 1)) AS tick) s
        LEFT JOIN (SELECT (time - {_FILLED_FROM}) // {i * 1000} AS tick, count(*) AS n, count(DISTINCT topic) AS u FROM msgs GROUP BY 1) c
        ON c.tick = s.tick"""
        for i in (3600, 86400)
    ]
    return f"WITH {_sql_messages(SQL_BY_USER)}, mark AS (SELECT greatest({ends}) - 86410 AS closed FROM msgs) " + " UNION ALL ".join(parts)


@query(_sql_filled_metrics())
def stream_filled_metrics(spark, sf_dir):
    """Ticks up to the watermark, from the first day of the events, with those in which nothing arrived."""
    work = fresh_dir(spark, "stream")
    events = messages(spark, sf_dir, source=_event_stream(spark, sf_dir))
    t0 = messages(spark, sf_dir).agg(F.min("time")).first()[0] // 86_400_000 * 86_400_000
    ticks = metric_stream.stream_interval_metrics(events, (3600, 86400), t0=t0, fill=True)
    with metric_stream.timers(spark):
        _run(metric_stream.on_tick(ticks, lambda df: df.write.mode("append").parquet(f"{work}/out")), f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out")


_SLOT_ENDS = "(time // 3600000 + 1) * 3600"


@query(
    f"""WITH {_sql_messages(SQL_BY_USER)} SELECT time // 3600000 AS slot, count(*) AS messages, TRUE AS near FROM msgs GROUP BY 1
    HAVING max({_SLOT_ENDS}) <= (SELECT max({_SLOT_ENDS}) FROM msgs) - 3610"""
)
def stream_sketches(spark, sf_dir):
    """Slots of an hour that the watermark has closed, with topics counted by sketches."""
    work = fresh_dir(spark, "stream")
    slots = metric_stream.stream_topic_sketches(messages(spark, sf_dir, source=_event_stream(spark, sf_dir)), 3600)
    _run(metric_stream.on_tick(slots, lambda df: df.write.mode("append").parquet(f"{work}/out")), f"{work}/checkpoint")
    rolled = sketches.metrics_from_sketches(spark.read.parquet(f"{work}/out"), 3600, (3600,))
    exact = messages(spark, sf_dir).groupBy(F.call_function("div", F.col("time"), F.lit(3_600_000)).alias("tick"))
    near = F.abs(F.col("unique_topics") - F.col("exact")) <= sketches.sketch_error() * F.col("exact")
    joined = rolled.join(exact.agg(F.countDistinct("topic").alias("exact")), "tick")
    return joined.select(F.col("tick").alias("slot"), "messages", near.alias("near"))


@query(ORACLES["fold_status_counters"])
def stream_status_counters(spark, sf_dir):
    """Counters after all events have gone through streaming state."""
    work = fresh_dir(spark, "stream")
    log = status_log(spark, sf_dir, _event_stream(spark, sf_dir))
    changed = status_stream.stream_status_counters(log).writeStream.outputMode("update")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{work}/out/batch={batch_id}")

    _run(changed.foreachBatch(keep), f"{work}/checkpoint")
    newest = spark.read.parquet(f"{work}/out").groupBy("id", "key")
    return newest.agg(F.max_by("ivalue", "batch").alias("ivalue"), F.max_by("dvalue", "batch").alias("dvalue"))

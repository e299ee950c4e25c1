"""Queries over logs that are written, pruned, indexed, cut and listed, each with the SQL that must give the same rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from tailrace.functions.columns import stream_offset
from tailrace.operators import metrics, routing
from tailrace.session import fresh_dir
from tailrace.sinks.topic_log import write_topic_log
from tailrace.sources.batch import index_topic_log, list_files, read_framed, read_topic_log, torn_tails
from tailrace.sources.files import locate
from tailrace.streaming.sink import append_topic_log
from tailrace.table_queries import (
    _SQL_LOG, _STREAM, BY_TYPE, FILE_BYTES, ORACLES, SQL_BY_TYPE, SQL_BY_USER, _event_stream, _read_back, _run, _sql_messages, _text, messages, query, table,
)

_MIDDLE = 1_705_276_800_000  # 15 January 2024
_BY_TYPE = _STREAM.replace(SQL_BY_USER, SQL_BY_TYPE)
_LAST = f"{_BY_TYPE}, last AS (SELECT * FROM recs QUALIFY row_number() OVER (PARTITION BY topic ORDER BY seq DESC) = 1)"
_TORN = 3


def _log(spark, sf_dir, topic=BY_TYPE, **options) -> str:
    base = fresh_dir(spark, "log")
    write_topic_log(messages(spark, sf_dir, topic), base, **options)
    return base


@query(f"WITH {_sql_messages(SQL_BY_TYPE)} SELECT topic, time, payload FROM msgs WHERE topic LIKE 's%' AND time >= {_MIDDLE}")
def pruned_scan(spark, sf_dir):
    """Conditions on topic and time: other folders are not listed, and strides of other times not read."""
    base = _log(spark, sf_dir, stride_bytes=FILE_BYTES)
    recs = read_topic_log(spark, base, columns=["topic", "time", "payload"], where=[("topic", "startswith", "s"), ("time", ">=", _MIDDLE)])
    return recs.select("topic", "time", _text("payload"))


@query(f"{_BY_TYPE} SELECT topic, stream_offset, time, payload FROM recs WHERE stream_offset BETWEEN 20000 AND 90000")
def indexed_seek(spark, sf_dir):
    """Large files, read from one offset of their topic to another in parts that the index makes; it is built afterwards."""
    base = _log(spark, sf_dir, stride_bytes=1 << 40)
    index_topic_log(spark, base, stride_bytes=FILE_BYTES)
    recs = read_topic_log(spark, base, part_bytes=2 * FILE_BYTES, where=[("stream_offset", ">=", 20000), ("stream_offset", "<=", 90000)])
    return recs.select("topic", "stream_offset", "time", _text("payload"))


@query(_SQL_LOG)
def manifest_log(spark, sf_dir):
    """Two runs add their files by manifest, without renames, and the log is read."""
    base = fresh_dir(spark, "log")
    msgs = messages(spark, sf_dir)
    middle = msgs.agg(F.floor(F.avg("seq"))).scalar()
    for part in (msgs.where(F.col("seq") <= middle), msgs.where(F.col("seq") > middle)):
        write_topic_log(part, base, max_file_bytes=FILE_BYTES, pad=0, manifest=True)
    return _read_back(spark, base)


@query(_SQL_LOG)
def manifest_sink(spark, sf_dir):
    """Append a stream of the events to a log with a manifest."""
    base, work = fresh_dir(spark, "log"), fresh_dir(spark, "stream")
    events = messages(spark, sf_dir, source=_event_stream(spark, sf_dir))
    _run(append_topic_log(events, base, "events", max_file_bytes=FILE_BYTES, manifest=True), work)
    return _read_back(spark, base)


@query(
    f"""{_LAST} SELECT topic, (max(stream_offset))::BIGINT AS complete_bytes, (any_value(size) - {_TORN})::BIGINT AS torn_bytes
    FROM (SELECT last.*, 4 + 1 + {{time}} + 1 + {{length}} + octet_length(encode(payload)) AS size FROM last) GROUP BY topic""".format(
        time="(CASE WHEN time < 128 THEN 1 ELSE CAST(ceil(length(bin(time)) / 7.0) AS INTEGER) END)",
        length="CAST(ceil(greatest(length(bin(octet_length(encode(payload)))), 1) / 7.0) AS INTEGER)",
    )
)
def torn_records(spark, sf_dir):
    """Every file loses its last bytes; the record they belonged to is reported and not read."""
    base = _log(spark, sf_dir)

    def cut(batches):
        for batch in batches:
            for path, length in zip(batch.column("file").to_pylist(), batch.column("length").to_pylist()):
                system, name = locate(path)
                with system.open_input_stream(name) as source:
                    data = source.read(length - _TORN)
                with system.open_output_stream(name) as out:
                    out.write(data)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    list_files(spark, base).mapInArrow(cut, "n bigint").agg(F.sum("n")).first()
    return torn_tails(spark, base).select("topic", "complete_bytes", "torn_bytes")


@query(
    f"""SELECT topic, printf('%016x', base_offset) AS name, bytes AS length, row_number() OVER (PARTITION BY topic ORDER BY base_offset) AS place
    FROM ({ORACLES["file_sizes"]}) WHERE base_offset % 2 = 0"""
)
def name_filter(spark, sf_dir):
    """Files whose whole name matches a pattern, and their place in the order of names."""
    files = list_files(spark, _log(spark, sf_dir, max_file_bytes=FILE_BYTES), "[0-9a-f]*[02468ace]")
    return files.selectExpr("topic", "name", "length", "CAST(row_number() OVER (PARTITION BY topic ORDER BY name) AS BIGINT) AS place")


@query(f"{_LAST} SELECT topic, stream_offset, time, payload FROM last")
def positioned_read(spark, sf_dir):
    """Read each file again from the offset of its last record on."""
    base = _log(spark, sf_dir)
    recs = read_topic_log(spark, base, columns=["file", "record_offset"])
    offsets = recs.groupBy("file").agg(F.max("record_offset").alias("record_offset"))
    again = read_topic_log(spark, base, starting_offsets=offsets)
    return again.select("topic", stream_offset("base_offset", "record_offset").alias("stream_offset"), "time", _text("payload"))


def _lines(buf: bytes):
    rows, at = [], 0
    while (end := buf.find(b"\n", at)) >= 0:
        rows.append((at, buf[at:end].decode()))
        at = end + 1
    return rows, at


@query("SELECT props AS value FROM events")
def own_framing(spark, sf_dir):
    """Lines of text files, by a framing of the user's own."""
    base = fresh_dir(spark, "lines")
    table(spark, sf_dir, "events").select("props").write.text(base)
    return read_framed(spark, base, _lines, "value string", "part-.*", topic_dirs=False).select("value")


_MANY = 1_000_000


@query(
    f"""WITH keys AS (SELECT c_custkey AS server_id FROM customer UNION ALL SELECT c_custkey + {_MANY} FROM customer UNION ALL SELECT c_custkey + {2 * _MANY} FROM customer)
    SELECT server_id, (row_number() OVER (ORDER BY server_id) - 1)::INT AS pos FROM keys"""
)
def large_server_rank(spark, sf_dir):
    """Ranks of three servers for each customer."""
    keys = table(spark, sf_dir, "customer").select(F.explode(F.array(*[F.col("c_custkey").cast("bigint") + i * _MANY for i in range(3)])).alias("server_id"))
    return routing.server_rank(keys)


@query(
    f"""WITH {_sql_messages(SQL_BY_TYPE)}, timed AS (SELECT topic, CASE WHEN seq % 10 <> 0 THEN time END AS time FROM msgs),
    t AS (SELECT *, time - (SELECT min(time) FROM timed) AS rel FROM timed)
    SELECT 86400 AS interval, rel // 86400000 AS tick, (rel // 86400000 + 1) * 86400.0::DOUBLE AS time, count(DISTINCT topic) AS unique_topics, count(*) AS messages
    FROM t GROUP BY rel // 86400000"""
)
def untimed_metrics(spark, sf_dir):
    """Every tenth message has no time and is counted in a tick without number."""
    msgs = messages(spark, sf_dir, BY_TYPE).withColumn("time", F.when(F.col("seq") % 10 != 0, F.col("time")))
    return metrics.interval_metrics(msgs, (86400,), fill=False)

"""Streaming writers of topic logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tailrace.sinks.topic_log import write_count_blob, write_topic_log


def append_topic_log(msgs: DataFrame, base: str, sink: str, envelope: bool = True, **options) -> DataStreamWriter:
    """Writer that appends every batch of ``msgs`` (``topic, seq, payload``, optional ``time``) once.

    ``sink`` names this query in the log's journal, by which a batch that is run again is recognised.
    """
    write = write_topic_log if envelope else write_count_blob

    def append(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            write(kept, base, sink=sink, batch_id=batch_id, **options)
        finally:
            kept.unpersist()

    return msgs.writeStream.foreachBatch(append)

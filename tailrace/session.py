"""Session helpers: where a job may keep intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession

from tailrace.sources.files import locate

_local_root: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; it is removed when the process ends.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tailrace-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def written(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Cut lineage by writing ``df`` as a table in the shared folder; the table is removed on exit."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        system, name = locate(path)
        if system.get_file_info(name).type == FileType.Directory:
            system.delete_dir(name)

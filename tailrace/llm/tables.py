"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailrace.session import fresh_dir

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Tables:
    """Written tables of one run. A table cuts lineage and survives the loss of executors.

    Tables that a returned DataFrame reads must stay until its rows are used; ``drop`` removes the others.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = fresh_dir(spark, label)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, once: bool = False) -> DataFrame:
        """Writes ``df``. What it shuffled is removed at once if ``once`` says that nothing else will read it; else Spark removes
        it some time after the driver's next garbage collection."""
        before = self.spark.conf.get(_CLEAN_UP, "false")
        self.spark.conf.set(_CLEAN_UP, "true" if once else before)
        try:
            df.write.parquet(self.path(name))
        finally:
            self.spark.conf.set(_CLEAN_UP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str = "doc_id", parts: int = 5) -> F.Column:
    """The fold of a row: crc32 of its id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of batches whose ``column`` holds about ``most`` bytes at most; a longer row stands alone."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)

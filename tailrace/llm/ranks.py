"""Places of rows within their groups, with no group in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailrace.llm.tables import Tables


def changes(batch: pa.RecordBatch, names: list[str], last: pa.RecordBatch | None) -> np.ndarray:
    """True for each row whose ``names`` differ from those of the row before; ``last`` is the row before the batch."""
    out = np.zeros(batch.num_rows, bool)
    for name in names:
        column = batch.column(name)
        before = last.column(name) if last is not None else column.slice(0, 1)
        before = pa.concat_arrays([before, column.slice(0, batch.num_rows - 1)])
        differ = pc.fill_null(pc.not_equal(before, column), False)
        out |= np.asarray(pc.or_(differ, pc.xor(pc.is_null(before), pc.is_null(column))))
    return out


def numbered(df: DataFrame, group: list[str], order: list[str], tables: Tables, name: str) -> DataFrame:
    """``df`` with ``tree``, the number of a row's group, and ``pos``, its place in it by ``order``, both from 0.

    Groups are numbered as they sort, nulls first; rows that tie in ``order`` keep the order of the input. Rows are
    sorted by ranges of (group, order), so a group of any size is spread over tasks. Each task counts from its own first
    row; what lies before it is added from one summary row per task, which is all that goes to the driver.
    """
    keys = [*group, *order, "tie"]
    kept = df.columns
    rows = df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")

    def count(batches):
        part, run, idx, last = TaskContext.get().partitionId(), 0, -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = changes(batch, group, last)
            runs = run + np.cumsum(new)
            places = np.arange(batch.num_rows)
            start = np.maximum.accumulate(np.where(new, places, -1))
            local = np.where(start >= 0, places - start, places + idx + 1)
            run, idx, last = int(runs[-1]), int(local[-1]), batch.slice(batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.repeat(pa.scalar(part, pa.int32()), batch.num_rows), pa.array(runs, pa.int64()), pa.array(local, pa.int64())],
                [*batch.schema.names, "part", "run", "idx"],
            )

    schema = T.StructType([*df.schema.fields, *T._parse_datatype_string("part int, run bigint, idx bigint").fields])
    rows = tables.keep(rows.mapInArrow(count, schema), name)
    place, value = F.struct("run", "idx"), F.struct(*group) if group else F.lit(0)
    parts = rows.groupBy("part").agg(
        F.max("run").alias("runs"), F.min_by(value, place).alias("first"), F.max_by(value, place).alias("last"), F.max_by("idx", place).alias("idx")
    )
    starts, trees, before, size = [], 0, None, 0
    for p in sorted(parts.collect(), key=lambda p: p.part):
        goes_on = before is not None and before[0] == p.first
        trees -= goes_on
        starts.append((p.part, trees, size if goes_on else 0))
        size = p.idx + 1 + (size if goes_on and not p.runs else 0)
        trees, before = trees + p.runs + 1, (p.last,)
    starts = rows.sparkSession.createDataFrame(starts, "part int, trees bigint, before bigint")
    tree = F.col("trees") + F.col("run")
    pos = F.col("idx") + F.when(F.col("run") == 0, F.col("before")).otherwise(0)
    return rows.join(F.broadcast(starts), "part").select(*kept, tree.alias("tree"), pos.alias("pos"))

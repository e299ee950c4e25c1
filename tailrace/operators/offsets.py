"""Running offsets that no hot topic can pull into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_BITS = 17
_LEVELS = 3
TASK_ROWS = 1 << 18


def tasks_for(spark: SparkSession, rows: int = 0) -> int:
    """Tasks for a shuffle of about ``rows`` light rows.

    Given as a number, so that Spark does not merge the parts of a shuffle up to a size that columns of offsets,
    which compress well, only reach with millions of rows.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def required(df: DataFrame, *columns: str) -> DataFrame:
    """``df``, in which a null in one of the columns is an error, whatever its size and the way it is worked on."""
    missing = [F.raise_error(F.lit(f"{c} is null")).cast(df.schema[c].dataType) for c in columns]
    return df.withColumns({c: F.when(F.col(c).isNull(), e).otherwise(F.col(c)) for c, e in zip(columns, missing)})


def exclusive_prefix(
    df: DataFrame, key: str, order: str, sums: dict[str, Column], block_bits: int = BLOCK_BITS, records: int = 0
) -> DataFrame:
    """Adds, for each entry of ``sums``, the sum over all earlier rows of the same key.

    ``order`` is a BIGINT, unique within a key. Rows are grouped by its high bits, so a window covers at
    most ``2**block_bits`` rows. Block totals are summed the same way, level by level, and their prefixes joined back.
    The grouping depends on the data alone, so a lost task recomputes to the same blocks. A row without key or
    order has no place in it and raises an error. ``records`` is the number of rows, if known.
    """
    df = required(df, key, order)
    names = list(sums)
    rows = df.withColumns({"_b1": _block(order, block_bits)} | {f"_v_{n}": c.cast("bigint") for n, c in sums.items()})
    rows = rows.repartition(tasks_for(df.sparkSession, records), key, "_b1")
    totals = rows.groupBy(key, "_b1").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    blocks = _before_blocks(totals, key, 1, names, block_bits)

    in_block = Window.partitionBy(key, "_b1").orderBy(order)
    w0 = in_block.rowsBetween(Window.unboundedPreceding, -1)
    same_as_last = F.lag(order).over(in_block) == F.col(order)
    twice = F.raise_error(F.concat(F.lit(f"{order} is not unique in {key} "), F.col(key)))
    rows = rows.withColumns(
        {f"_o_{n}": F.when(same_as_last, twice).otherwise(_before(w0, f"_v_{n}")) for n in names}
    )
    joined = rows.join(blocks, [key, "_b1"])
    return joined.select(*df.columns, *[(F.col(f"_o_{n}") + F.col(f"_p_{n}")).alias(n) for n in names])


def _block(column: str, block_bits: int) -> Column:
    # Blocks are never null. Saying so keeps the joins from adding filters by which the branches would
    # differ, and lets the levels of totals share one exchange.
    return F.coalesce(F.shiftright(column, block_bits), F.lit(0).cast("bigint"))


def _before(window, source: str) -> Column:
    return F.coalesce(F.sum(source).over(window), F.lit(0).cast("bigint"))


def _before_blocks(totals: DataFrame, key: str, level: int, names: list[str], block_bits: int) -> DataFrame:
    """The sums ``_p_*`` over all earlier blocks of a key, from the totals ``_t_*`` of each block."""
    at, upper = f"_b{level}", f"_b{level + 1}"
    if level == _LEVELS:
        earlier = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(key, at, *[_before(earlier, f"_t_{n}").alias(f"_p_{n}") for n in names])
    totals = totals.withColumn(upper, _block(at, block_bits))
    above = totals.groupBy(key, upper).agg(*[F.sum(f"_t_{n}").alias(f"_t_{n}") for n in names])
    above = _before_blocks(above, key, level + 1, names, block_bits)
    above = above.withColumnsRenamed({f"_p_{n}": f"_u_{n}" for n in names})
    earlier = Window.partitionBy(key, upper).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    inside = totals.select(key, at, upper, *[_before(earlier, f"_t_{n}").alias(f"_i_{n}") for n in names])
    return inside.join(above, [key, upper]).select(key, at, *[(F.col(f"_i_{n}") + F.col(f"_u_{n}")).alias(f"_p_{n}") for n in names])


def running_offset(msgs_sizes: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Offset of each record in its topic: the sum of the earlier frame sizes."""
    light = msgs_sizes.select("topic", "seq", "size")
    out = exclusive_prefix(light, "topic", "seq", {"stream_offset": F.col("size")}, block_bits)
    return out.select("topic", "seq", "stream_offset")

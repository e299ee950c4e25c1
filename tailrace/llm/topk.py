"""Exact top-k search by tiles: products of query and shard matrices, a partial selection per tile, merged in a tree.

Queries are cut into blocks of a fixed number of rows, each sent to all tasks on its own; their number may
grow with the data, the size of what is sent does not. A task takes its candidates a tile at a time, keeps the
best ``k`` of each query so far, and hands on one packed list per block. Lists of neighbouring tasks are then
merged ``fan_in`` at a time until one is left, so no task ever holds more than ``fan_in`` lists of a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailrace.llm.tables import Tables

_LISTS = "part int, lane int, query array<bigint>, score array<bigint>, vec_id array<bigint>"
_LOW = -(1 << 62)  # below every score; its negative is a number too
_LANE_ROWS = 1024  # queries in one matrix product


def quantized(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and v, floor(scale * x) of each component as a double. Unusable vectors take no part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    good = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null")
    return rows.where(good & (F.size("x") > 0)).select("vec_id", F.transform("x", lambda e: F.floor(e * scale)).alias("v"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch, for each length of vector."""
    ids, column = batch.column("vec_id").to_numpy(zero_copy_only=False), batch.column("v")
    at = np.asarray(column.offsets)
    flat, sizes = column.values.to_numpy(zero_copy_only=False), np.diff(at)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield ids[rows], flat[at[rows][:, None] + np.arange(d)]


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point where every partial sum is a whole number it can hold."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    bound = float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1]
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
    return (q.astype(kind) @ c.astype(kind).T).astype(np.int64)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of each row, in order: largest score, then smallest id. ``ids`` has the shape of ``score``."""
    if score.shape[1] > 4 * k:  # partial selection first; ties with the k-th score stay in, then the order decides
        edge = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k]
        wide = (score >= edge).sum(axis=1).max()
        keep = np.argpartition(score < edge, wide - 1, axis=1)[:, :wide]
        score, ids = np.take_along_axis(score, keep, 1), np.take_along_axis(ids, keep, 1)
    order = np.lexsort((ids, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, block_rows: int = 16384, tile_rows: int = 4096, fan_in: int = 16
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's ``k`` best rows of ``vectors``, its own excepted.

    Both inputs have vec_id and v (array of long); vectors of different lengths are not compared. Fewer than
    ``k`` candidates give fewer rows, none give none. Equal vectors rank by vec_id. Rows that repeat a vec_id
    are candidates each for itself, but not of a query with that vec_id. Products are exact while they fit 64 bits.
    """
    spark = vectors.sparkSession
    tables = Tables(spark, "top-k")
    vectors = vectors.select("vec_id", "v")
    numbered = tables.keep(queries.select("vec_id", "v"), "queries")
    count, blocks, after = numbered.count(), [], None
    for start in range(0, max(count, 1), block_rows):  # by position in a written table
        part = numbered if count <= block_rows else numbered.orderBy("vec_id", "v").offset(start).limit(block_rows)
        part = part.toArrow()
        if not part.num_rows:
            continue
        lists = _partial(vectors, part.combine_chunks().to_batches()[0], k, tile_rows)
        blocks.append(_merged(tables.keep(lists, f"lists{start}"), tables, f"{start}", k, fan_in))
    out = None
    for b in blocks:
        out = b if out is None else out.union(b)
    if out is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return out


def _partial(vectors: DataFrame, block: pa.RecordBatch, k: int, tile_rows: int) -> DataFrame:
    sent = vectors.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        from pyspark import TaskContext

        lanes = [(ids[a : a + _LANE_ROWS], m[a : a + _LANE_ROWS]) for ids, m in _matrices(sent.value) for a in range(0, len(ids), _LANE_ROWS)]
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, tile_rows):
                for ids, c in _matrices(batch.slice(a, tile_rows)):
                    for lane, (query, q) in enumerate(lanes):
                        if q.shape[1] != c.shape[1]:
                            continue
                        score = _product(q, c)
                        score[query[:, None] == ids[None, :]] = _LOW
                        s, i = best(score, np.broadcast_to(ids, score.shape), k)
                        if lane in found:
                            s, i = best(np.hstack((found[lane][0], s)), np.hstack((found[lane][1], i)), k)
                        found[lane] = s, i
        for lane, (s, i) in found.items():
            yield _row(TaskContext.get().partitionId(), lane, lanes[lane][0], s, i)

    return vectors.mapInArrow(run, _LISTS)


def _row(part: int, lane: int, query: np.ndarray, s: np.ndarray, i: np.ndarray) -> pa.RecordBatch:
    """One packed row: all lists of a block's queries, padded with the lowest score."""
    lists = [pa.array([x.ravel()], pa.list_(pa.int64())) for x in (query, s, i)]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([lane], pa.int32()), *lists], ["part", "lane", "query", "score", "vec_id"])


def _merged(lists: DataFrame, tables: Tables, name: str, k: int, fan_in: int) -> DataFrame:
    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        query = np.array(rows[0]["query"])
        s = np.hstack([np.array(r["score"], np.int64).reshape(len(query), -1) for r in rows])
        i = np.hstack([np.array(r["vec_id"], np.int64).reshape(len(query), -1) for r in rows])
        return pa.Table.from_batches([_row(rows[0]["part"] // fan_in, rows[0]["lane"], query, *best(s, i, k))])

    level, highest = 0, lists.agg(F.max("part")).first()[0] or 0
    while True:
        level += 1
        lists = lists.groupBy((F.col("part") / fan_in).cast("int"), "lane").applyInArrow(merge, _LISTS)
        lists = tables.keep(lists, f"merged{name}-{level}")
        if highest < fan_in:
            break
        highest //= fan_in
    width = (F.size("score") / F.size("query")).cast("int")
    one = lists.select("query", width.alias("width"), F.posexplode(F.arrays_zip("score", "vec_id")).alias("at", "hit"))
    query = F.expr("query[cast(at / width as int)]")
    out = one.where(F.col("hit.score") > _LOW).select(
        query.alias("query_id"), (F.col("at") % F.col("width") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score"
    )
    return out

"""Merkle manifest of a table with SHA-256 midstates.

Leaves of a group stand in order; every three nodes in a row become their parent, whose digest is that of their digests as
hexadecimal text. Such a text fills one block of SHA-256, so the state before each child is eight words, and a parent
keeps these states next to its children. Putting another leaf into the tree then takes, on each level, the state before
the leaf's slot, one step for the new digest and one for each sibling to its right; nothing on the left is read again.

The forest grows in rounds. A block is up to 3^7 neighbours of a tree and is one row, with all levels inside it. The tops
of the blocks are the nodes of the next round, and the tops of all groups those of a last tree. The way back
hands each block what lies above it: the siblings for proofs and the states for folding.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailrace.llm.ranks import numbered
from tailrace.llm.tables import Tables

FAN = 3
_DEPTH = 7
BLOCK = FAN**_DEPTH
_ROWS = 1 << 13
# A parent: number of children, states before the second and third, digests of the children.
_PARENT = np.dtype([("k", "u1"), ("states", ">u4", (FAN - 1, 8)), ("children", "u1", (FAN, 32))])
# A step of folding: the state before the slot, how many siblings follow, how many children there are, the siblings.
_STEP = np.dtype([("state", ">u4", 8), ("right", "u1"), ("k", "u1"), ("siblings", "u1", (FAN - 1, 32))])
_BLOCKS = "tree bigint, block bigint, ids array<bigint>, digests binary, replaced binary, levels array<binary>, digest binary"
_PATHS = "tree bigint, block bigint, proof binary, fold binary, subroot binary, root binary"
_PROVED = "doc_id bigint, leaf binary, subroot binary, root binary, proof_sha256 binary, folded_root binary"


@lru_cache(maxsize=None)
def _constants() -> tuple[np.ndarray, np.ndarray]:
    """First 32 fractional bits of the square roots of 8 primes and the cube roots of 64."""
    primes = [n for n in range(2, 312) if all(n % d for d in range(2, math.isqrt(n) + 1))][:64]

    def cube_root(x: int) -> int:
        r = round(x ** (1 / 3))
        while r**3 > x:
            r -= (r**3 - x) // (3 * r * r) + 1
        while (r + 1) ** 3 <= x:
            r += 1
        return r

    start = [math.isqrt(p << 64) & 0xFFFFFFFF for p in primes[:8]]
    return np.array(start, np.uint32), np.array([cube_root(p << 96) & 0xFFFFFFFF for p in primes], np.uint32)


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compressed(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """SHA-256 states (n, 8) after one more block (n, 16) each."""
    w = [np.ascontiguousarray(blocks[:, i]) for i in range(16)]
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        s0 = _turned(x, 7) ^ _turned(x, 18) ^ (x >> np.uint32(3))
        s1 = _turned(y, 17) ^ _turned(y, 19) ^ (y >> np.uint32(10))
        w.append(w[i - 16] + s0 + w[i - 7] + s1)
    a, b, c, d, e, f, g, h = (np.ascontiguousarray(states[:, i]) for i in range(8))
    for i, key in enumerate(_constants()[1]):
        t = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + (g ^ (e & (f ^ g))) + key + w[i]
        u = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + ((a & b) | (c & (a | b)))
        h, g, f, e, d, c, b, a = g, f, e, d + t, c, b, a, t + u
    return states + np.stack([a, b, c, d, e, f, g, h], 1)


_HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)


def _text_blocks(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32) as hexadecimal text, which is one block each."""
    return _HEX[digests].reshape(-1, 64).view(">u4").astype(np.uint32)


def finished(states: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of messages of ``k`` blocks."""
    end = np.zeros((len(k), 16), np.uint32)
    end[:, 0], end[:, 15] = 0x80000000, k.astype(np.uint32) * 512
    return compressed(states, end).astype(">u4").view(np.uint8).reshape(-1, 32)


def parents_of(children: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parents (_PARENT) of ``children`` (n, 3, 32), of which ``k`` are there, and their digests."""
    out = np.zeros(len(k), _PARENT)
    out["k"], out["children"] = k, children
    states = np.tile(_constants()[0], (len(k), 1))
    for slot in range(FAN):
        there = np.flatnonzero(k > slot)
        states[there] = compressed(states[there], _text_blocks(children[there, slot]))
        if slot < FAN - 1:
            out["states"][:, slot] = states
    return out, finished(states, k)


def folded(digests: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Digests of the parents when ``digests`` (n, 32) stand in the slots of ``steps`` (_STEP)."""
    states = compressed(steps["state"].astype(np.uint32), _text_blocks(digests))
    for i in range(FAN - 1):
        there = np.flatnonzero(steps["right"] > i)
        if there.size:
            states[there] = compressed(states[there], _text_blocks(steps["siblings"][there, i]))
    return finished(states, steps["k"])


def steps_of(parents: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """The step of folding at ``slot`` of each parent."""
    out = np.zeros(len(slot), _STEP)
    every, after = np.arange(len(slot)), np.maximum(slot - 1, 0)
    out["state"] = np.where((slot == 0)[:, None], _constants()[0], parents["states"][every, after])
    out["k"], out["right"] = parents["k"], parents["k"] - 1 - slot
    for i in range(FAN - 1):
        out["siblings"][:, i] = parents["children"][every, np.minimum(slot + 1 + i, FAN - 1)]
    return out


# --- blocks -------------------------------------------------------------------------------------------


def _digests(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _grown(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Whole blocks, in order, one row each with all levels inside."""
    tree, block = (np.asarray(rows.column(c)) for c in ("tree", "block"))
    first = np.flatnonzero(np.concatenate(([True], (np.diff(tree) != 0) | (np.diff(block) != 0))))
    count = np.diff(np.append(first, len(tree)))
    whole = (block[first] > 0) | (count == BLOCK)
    depth = np.where(whole, _DEPTH, [0 if n == 1 else next(d for d in range(_DEPTH + 1) if FAN**d >= n) for n in count.tolist()])
    leaves = _digests(rows.column("digest"))
    replaced = _digests(rows.column("replaced"))
    levels: list[list[bytes]] = [[] for _ in first]
    nodes, size = leaves, count
    for level in range(_DEPTH):
        grows = depth > level
        if not grows.any():
            break
        of = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        above = np.where(grows, -(-size // FAN), 0)
        at = np.cumsum(above) - above
        live = grows[of]
        children = np.zeros((int(above.sum()), FAN, 32), np.uint8)
        parent = at[of[live]] + place[live] // FAN
        children[parent, place[live] % FAN] = nodes[live]
        made, digests = parents_of(children, np.bincount(parent, minlength=len(children)))
        for b in np.flatnonzero(grows):
            levels[b].append(made[at[b] : at[b] + above[b]].tobytes())
        size = np.where(grows, above, size)
        merged = np.empty((int(size.sum()), 32), np.uint8)
        kept = np.repeat(grows, size)
        merged[kept], merged[~kept] = digests, nodes[~live]
        nodes = merged
    ends = np.append(first, len(tree))
    part = lambda x: [x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
    ids = rows.column("doc_id")
    columns = [
        pa.array(tree[first], pa.int64()),
        pa.array(block[first], pa.int64()),
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids),
        pa.array(part(leaves), pa.binary()),
        pa.array(part(replaced), pa.binary()),
        pa.array(levels, pa.list_(pa.binary())),
        pa.array([n.tobytes() for n in nodes], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["tree", "block", "ids", "digests", "replaced", "levels", "digest"])


def _grow(batches):
    """Hands on whole blocks, some thousand rows at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) < _ROWS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        tree, block = (np.asarray(rows.column(c)) for c in ("tree", "block"))
        cut = np.flatnonzero((tree != tree[-1]) | (block != block[-1]))
        if cut.size:
            yield _grown(rows.slice(0, int(cut[-1]) + 1))
            rows = rows.slice(int(cut[-1]) + 1)
        held = [rows]
    if held:
        yield _grown(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _blocks(nodes: DataFrame, tables: Tables, name: str) -> DataFrame:
    """``nodes`` (tree, pos, doc_id, digest, replaced) as written blocks."""
    keys = ["tree", "block"]
    rows = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).repartition(*keys).sortWithinPartitions(*keys, "pos")
    return tables.keep(rows.select(*keys, "doc_id", "digest", "replaced").mapInArrow(_grow, _BLOCKS), name)


def _tops(blocks: DataFrame, tree: Column, pos: Column) -> DataFrame:
    none = F.lit(None).cast("bigint")
    return blocks.select(tree.alias("tree"), pos.alias("pos"), none.alias("doc_id"), "digest", F.col("digest").alias("replaced"))


def _rounds(nodes: DataFrame, tables: Tables, name: str) -> list[DataFrame]:
    """Rounds of blocks until each tree is one block."""
    rounds = [_blocks(nodes, tables, f"{name}0")]
    while (rounds[-1].agg(F.max("block")).first()[0] or 0) > 0:
        rounds.append(_blocks(_tops(rounds[-1], F.col("tree"), F.col("block")), tables, f"{name}{len(rounds)}"))
    return rounds


# --- the way back -------------------------------------------------------------------------------------


def _inside(row: dict) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """Of a block with what lies above it: each leaf's proof, its steps of folding level by level, and those above."""
    n = len(row["digests"]) // 32
    levels = [np.frombuffer(x, _PARENT) for x in row["levels"]]
    proofs = [row["proof"]]
    for parents in reversed(levels):
        texts = _HEX[parents["children"]].reshape(-1, FAN, 64)
        below = []
        for p, k, above in zip(texts, parents["k"].tolist(), proofs):
            sides = [x.tobytes() for x in p[:k]]
            below.extend(b"".join(sides[:j] + sides[j + 1 :]) + above for j in range(k))
        proofs = below
    place, steps = np.arange(n), []
    for parents in levels:
        steps.append(steps_of(parents[place // FAN], place % FAN))
        place = place // FAN
    return proofs, steps, np.frombuffer(row["fold"], _STEP)


def _paths_below(last_tree: bool):
    """Paths of the blocks below; in the tree of groups a node is a group's root and leads to its first block."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                proofs, steps, above = _inside(row)
                n = len(proofs)
                folds = [b"".join([*(s[i].tobytes() for s in steps), above.tobytes()]) for i in range(n)]
                places = np.arange(n) + row["block"] * BLOCK
                digests = [row["digests"][i * 32 : i * 32 + 32] for i in range(n)]
                columns = [places, np.zeros(n, np.int64)] if last_tree else [np.full(n, row["tree"]), places]
                columns = [pa.array(c, pa.int64()) for c in columns] + [pa.array(proofs, pa.binary()), pa.array(folds, pa.binary())]
                columns += [pa.array(digests if last_tree else [row["subroot"]] * n, pa.binary()), pa.array([row["root"]] * n, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "block", "proof", "fold", "subroot", "root"])

    return run


def _proved(batches):
    """Leaves with digests of their proofs and the roots that their replacements fold to, some thousand at a time."""
    held, size = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            held.append(row)
            size += len(row["digests"]) // 32
            if size >= _ROWS:
                yield _folded_rows(held)
                held, size = [], 0
    if held:
        yield _folded_rows(held)


def _folded_rows(rows: list[dict]) -> pa.RecordBatch:
    proofs, ways, above = [], [], []
    for row in rows:
        p, s, a = _inside(row)
        proofs += [hashlib.sha256(x).digest() for x in p]
        ways.append(s)
        above.append(a)
    counts = np.array([len(row["digests"]) // 32 for row in rows])
    ends = np.cumsum(counts)
    now = np.frombuffer(b"".join(row["replaced"] for row in rows), np.uint8).reshape(-1, 32).copy()
    of = np.repeat(np.arange(len(rows)), counts)
    for level in range(max(map(len, ways))):
        live = [b for b, s in enumerate(ways) if len(s) > level]
        at = np.concatenate([np.arange(ends[b] - counts[b], ends[b]) for b in live])
        now[at] = folded(now[at], np.concatenate([ways[b][level] for b in live]))
    for level in range(max(map(len, above))):
        steps = np.array([a[level] if len(a) > level else np.zeros((), _STEP) for a in above], _STEP)
        at = np.flatnonzero(np.array([len(a) > level for a in above])[of])
        now[at] = folded(now[at], steps[of[at]])
    same = lambda name: pa.array([row[name] for row in rows], pa.binary()).take(pa.array(of))
    leaves = b"".join(row["digests"] for row in rows)
    columns = [
        pa.array([i for row in rows for i in row["ids"]], pa.int64()),
        pa.array([leaves[i : i + 32] for i in range(0, len(leaves), 32)], pa.binary()),
        same("subroot"),
        same("root"),
        pa.array(proofs, pa.binary()),
        pa.array([x.tobytes() for x in now], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in _PROVED.split(", ")])


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of fields: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]).cast("binary"), 256)


def manifest(rows: DataFrame) -> DataFrame:
    """Proofs and folds for ``rows`` (group, doc_id, leaf, replaced): digests as hexadecimal text.

    Groups and leaves stand in ascending order, nulls first; rows that repeat a doc_id stand by their leaf digests. Returns
    doc_id, leaf, subroot (of the group), root, proof_sha256 (digest of the siblings from the leaf up, left to
    right), folded_root (the root with ``replaced`` in the leaf's place) and verified (it is the same root).
    Other columns of ``rows`` are not read; an empty table gives no rows.
    """
    tables = Tables(rows.sparkSession, "merkle")
    rows = rows.select(F.col("group").cast("string").alias("group"), F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex("leaf").alias("digest"), F.unhex("replaced").alias("replaced"))
    leaves = tables.keep(rows, "leaves")
    placed = numbered(leaves, ["group"], ["doc_id", "digest", "replaced"], tables, "placed").drop("group")
    inner = _rounds(placed, tables, "group")
    outer = _rounds(_tops(inner[-1], F.lit(0).cast("bigint"), F.col("tree")), tables, "root")
    nothing = F.lit(b"")
    paths = outer[-1].select("tree", "block", nothing.alias("proof"), nothing.alias("fold"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    every = inner + outer
    for i in range(len(every) - 1, 0, -1):
        above = every[i].select("tree", "block", "digests", "levels").join(paths, ["tree", "block"])
        paths = tables.keep(above.mapInArrow(_paths_below(i == len(inner)), _PATHS), f"paths{i}")
    last = inner[0].drop("digest").join(paths, ["tree", "block"]).mapInArrow(_proved, _PROVED)
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    return last.select("doc_id", *hexed, (F.col("folded_root") == F.col("root")).alias("verified"))


def documents_manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """``manifest`` of documents by source, where ``tampered`` rows come back without line feeds in their text.

    Null fields count as ``-``. Repeated rows are leaves of their own. Texts are read once and not shuffled.
    """
    names = ["doc_id", "source", "lang", "n_chars"]
    fields = [F.col(n) for n in names]
    changed = F.when(F.coalesce(tampered, F.lit(False)), F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    return manifest(docs.select(F.col("source").alias("group"), "doc_id", leaf_digest([*fields, F.col("text")]).alias("leaf"), leaf_digest([*fields, changed]).alias("replaced")))

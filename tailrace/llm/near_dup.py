"""Near duplicates by one-permutation MinHash: densified sketches, banded buckets, star-shaped candidates.

A document's set holds its distinct shingles of ``k`` words. Documents with the same set form a class, which
one row stands for. The sketch takes one permutation: the top bits of a shingle's hash name its bin, the
smallest hash of a bin is kept, and an empty bin copies a filled one that a fixed random probe order finds
(optimal densification), so two sketches agree in a bin with the probability of their similarity.

Buckets are bands of bins. In each, every class is compared with one hub only, so a bucket of n classes costs
n - 1 pairs. The links a star does not see can only join components that meet in a bucket. These are
taken up once more, exactly: each class lists its rarest shingles, as many as a similar set cannot all
lack, and only classes of different components that share one of these, early enough in both lists for the
rest to suffice, are compared on the full sets. Before that, parities tell most pairs apart: where two sets hold an even and an
odd number of shingles with the same 8 bits, they differ in one of them, so sets that do so in too many of the 256
places are no pair. Where the lists would meet too often for that, the buckets first get further stars, each around a member of
a component that is not the bucket's largest, while these find links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailrace.llm.graph import components
from tailrace.llm.tables import Tables, slices
from tailrace.llm.words import Words, scramble, shingle_hashes, utf8

_PROBES = 1024
_STARS = 3
_MEETINGS = 32
_COUNTER_BITS = 21
_ODD = [f"odd{i}" for i in range(4)]
_SKETCHES = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("cls", pa.binary()), ("shingles", pa.list_(pa.int64()))])


@lru_cache(maxsize=None)
def _probe(bins: int) -> np.ndarray:
    """For each bin, the order in which it looks for a filled one."""
    x = np.arange(bins * _PROBES, dtype=np.uint64).reshape(bins, _PROBES)
    return (scramble(x + np.uint64(0x5851F42D4C957F2D)) % np.uint64(bins)).astype(np.int64)


def sketch(shingles: np.ndarray, bins: int) -> np.ndarray:
    """Smallest hash of each bin; ``shingles`` are distinct and in order, ``bins`` is a power of two."""
    place = (shingles >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    out = np.zeros(bins, np.uint64)
    filled = np.zeros(bins, bool)
    out[place[first]] = shingles[first]
    filled[place[first]] = True
    empty, own = np.flatnonzero(~filled), out.copy()
    for probe in _probe(bins).T:
        if not empty.size:
            return out
        found = filled[probe[empty]]
        out[empty[found]] = own[probe[empty[found]]]
        empty = empty[~found]
    out[empty] = shingles[0]  # after so many misses, all but a few bins are empty: take the overall minimum
    return out


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    rows = values.reshape(bands, -1)
    key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for j in range(rows.shape[1]):
        key = scramble(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key.view(np.int64)


def _class_of(s: np.ndarray) -> bytes:
    """128 bits that depend on the set alone."""
    a = scramble(s + np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    b = scramble(s ^ np.uint64(0xE7037ED1A0B428DB)).sum(dtype=np.uint64)
    return np.array([a, b], ">u8").tobytes()


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[np.ndarray]:
    found = Words(*utf8(batch.column("text")))
    h, first = shingle_hashes(found.hashes, found.first, k)
    for a, b in zip(first[:-1], first[1:]):
        yield np.unique(h[a:b])


def sketches(docs: DataFrame, k: int, bins: int, bands: int) -> DataFrame:
    """doc_id, size of the set, class (null when the set is empty) and band keys."""

    def run(batches):
        for batch in slices(batches, "text"):
            n, cls, keys = [], [], []
            for s in _sets(batch, k):
                n.append(s.size)
                cls.append(_class_of(s) if s.size else None)
                keys.append(band_keys(sketch(s, bins), bands) if s.size else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], schema=_SKETCHES)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, n bigint, cls binary, bands array<bigint>")


def _slots(ids: pa.Array, cls: pa.Array, bits: int) -> np.ndarray:
    """Place of each (id, class) in a table of ``2 ** bits``."""
    first = np.frombuffer(b"".join(c.as_py() for c in cls), ">u8")[::2].astype(np.uint64)
    ids = np.asarray(ids.fill_null(-(1 << 63))).view(np.uint64)
    return scramble(first + scramble(ids)) >> np.uint64(64 - bits)


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """cls and shingles of the rows of ``docs`` whose doc_id and class ``wanted`` has (as id and cls).

    The wanted rows are marked in a table of bits, 16 for each up to 64 MB in all, so texts are not shuffled. A row that
    is marked by chance gives a set that nobody asks for.
    """
    bits = min(max(wanted.count().bit_length() + 4, 20), 29)

    def mark(batches):
        words = np.zeros(1 << (bits - 6), np.uint64)
        for batch in batches:
            at = _slots(batch.column("id"), batch.column("cls"), bits)
            np.bitwise_or.at(words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        at = np.flatnonzero(words)
        for a in range(0, at.size, 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(at[a : a + (1 << 16)]), pa.array(words[at[a : a + (1 << 16)]].view(np.int64))], ["at", "word"])

    marks = wanted.mapInArrow(mark, "at bigint, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[np.asarray(marks.column("at"))] = np.asarray(marks.column("word"))
    sent = docs.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def run(batches):
        for batch in slices(batches, "text"):
            rows = [(i, s) for i, s in enumerate(_sets(batch, k)) if s.size]
            if not rows:
                continue
            cls = pa.array([_class_of(s) for _, s in rows], pa.binary())
            slot = _slots(batch.column("doc_id").take(pa.array([i for i, _ in rows])), cls, bits)
            marked = np.flatnonzero(sent.value[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1))
            sets = [rows[i][1] for i in marked]
            at = np.concatenate(([0], np.cumsum([s.size for s in sets]))).astype(np.int32)
            values = pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([cls.take(pa.array(marked)), pa.ListArray.from_arrays(pa.array(at), values)], schema=_SETS)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "cls binary, shingles array<bigint>")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bins: int = 128, bands: int = 32) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Sets linked: 100 * common >= ``percent`` * union, confirmed on full sets of 64-bit shingle hashes. A link
    at 0.8 is missed by all 32 bands of 4 bins with a probability near 10^-7.

    Null and empty texts link with nothing and keep their own id. A row with a null doc_id links like any other
    but never names a component that has an id; it is kept only where no row of its component has one. Rows
    that repeat a doc_id are all kept or all not. Other columns are not read; an empty table gives no rows.
    """
    tables = Tables(docs.sparkSession, "near-dup")
    signed = tables.keep(sketches(docs, k, bins, bands), "signed")
    classes = tables.keep(
        signed.where("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "classes"
    )
    spread = classes.select("cls", "n", F.explode("bands").alias("band"))
    order = F.xxhash64("cls", F.col("band").bitwiseAND(7))  # several hubs for a group that fills several buckets
    spread = spread.withColumn("order", order)
    lowest = spread.groupBy("band").agg(F.min("order").alias("lowest"), F.count("*").alias("members")).where("members > 1")
    lowest = tables.keep(lowest.drop("members"), "lowest-order")
    crowd = tables.keep(spread.join(lowest.hint("merge"), "band"), "met")
    hubs = crowd.where(F.col("order") == F.col("lowest")).select("band", F.col("cls").alias("hub"), F.col("n").alias("m"))
    crowd = tables.keep(crowd.select("band", "cls", "n").join(hubs.hint("merge"), "band"), "crowd")
    near = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent  # the sizes alone allow the similarity
    pair = [F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")]
    pairs = tables.keep(crowd.where((F.col("cls") != F.col("hub")) & near).select(pair).distinct(), "pairs0")
    wanted = tables.keep(classes.select("cls", "id").join(crowd.select("cls").distinct(), "cls", "left_semi"), "wanted")
    sets = tables.keep(full_sets(docs, wanted, k), "sets")
    tables.drop("met", "lowest-order")
    known = tables.keep(_verified(pairs, sets, percent), "links0")
    for star in range(1, _STARS + 1):
        roots = components(known, tables)
        open_ = tables.keep(_open(crowd, roots), f"open{star}")
        early = _early(open_.select("cls", "root", "n").distinct().join(sets, "cls"), tables, percent, star)
        if star == _STARS or _few_meetings(early):
            break
        fresh = _star(open_, f"star{star}", near).join(pairs, ["a", "b"], "left_anti")
        fresh = tables.keep(fresh, f"pairs{star}")
        more = tables.keep(_verified(fresh, sets, percent), f"links{star}")
        pairs = pairs.union(fresh)
        if more.isEmpty():
            break
        known = roots.toDF("a", "b").union(more)
    fresh = _missed(early, percent).join(pairs, ["a", "b"], "left_anti")
    more = tables.keep(_verified(tables.keep(fresh, "pairs-left"), sets, percent), "links-left")
    if not more.isEmpty():
        roots = components(roots.toDF("a", "b").union(more), tables)
    named = classes.select("cls", "id").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = tables.keep(named, "named")
    lowest = tables.keep(named.groupBy("root").agg(F.min("id").alias("component_id")), "lowest")
    named = tables.keep(named.join(lowest, "root").select("cls", "component_id"), "result")
    out = signed.select("doc_id", "n", "cls").join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def _open(crowd: DataFrame, roots: DataFrame) -> DataFrame:
    """band, cls, n and root of the members of bands that hold several components."""
    inside = crowd.select("band", "cls", "n").join(roots.withColumnRenamed("node", "cls").hint("merge"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    mixed = inside.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("band")
    return inside.join(mixed.hint("merge"), "band", "left_semi")


def _star(open_: DataFrame, name: str, near: Column) -> DataFrame:
    """Pairs (a, b) of a new hub in each band, from a component that is not the band's largest, and the others' members."""
    order = F.xxhash64("cls", F.lit(name))
    sizes = open_.groupBy("band", "root").agg(F.count("*").alias("members"), F.min(F.struct(order.alias("order"), "cls", "n")).alias("first"))
    most = sizes.groupBy("band").agg(F.max(F.struct("members", "root")).alias("most"))
    hubs = sizes.join(most, "band").where(F.col("root") != F.col("most.root")).groupBy("band").agg(F.min(F.struct("first", "root")).alias("hub"))
    hubs = hubs.select("band", F.col("hub.first.cls").alias("hub"), F.col("hub.first.n").alias("m"), F.col("hub.root").alias("hub_root"))
    met = open_.join(hubs.hint("merge"), "band").where((F.col("root") != F.col("hub_root")) & near)
    return met.select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()


def parities(s: np.ndarray) -> np.ndarray:
    """Four words whose bit i tells whether an odd number of the hashes ``s`` has bits i in places 16 to 23."""
    at = (s >> np.uint64(16)) & np.uint64(255)
    return (np.bincount(at.astype(np.int64), minlength=256) & 1).astype(np.uint64).reshape(4, 64) @ (np.uint64(1) << np.arange(64, dtype=np.uint64))


def _early(open_: DataFrame, tables: Tables, percent: int, star: int) -> DataFrame:
    """Rows of class and rare shingle that may meet one of another component, by prefixes of the sets in order of rarity.

    ``open_`` has cls, root, n and shingles; ``most`` is the component with the most members in a shingle. Sets with
    ``need`` common shingles, none of them before places i and j, have need <= min(n - i, m - j) + 1; so a common
    shingle must come early in both. Rarity is a count in a table of fixed size: where it errs it makes more
    candidates, never fewer.
    """

    def count(batches):
        total = np.zeros(1 << _COUNTER_BITS, np.int64)
        for batch in batches:
            flat = np.asarray(batch.column("shingles").flatten()).view(np.uint64)
            np.add.at(total, flat >> np.uint64(64 - _COUNTER_BITS), 1)
        at = np.flatnonzero(total)
        for a in range(0, at.size, 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(at[a : a + (1 << 16)]), pa.array(total[at[a : a + (1 << 16)]])], ["slot", "n"])

    sets = tables.keep(open_, f"open-sets{star}")
    counts = sets.select("shingles").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(1 << _COUNTER_BITS, np.int64)
    table[np.asarray(counts.column("slot"))] = np.asarray(counts.column("n"))
    sent = sets.sparkSession.sparkContext.broadcast(np.minimum(table, 2**31 - 1).astype(np.int32))

    def prefixes(batches):
        for batch in batches:
            shingles, places, rows, odd = [], [], [], []
            at, flat = np.asarray(batch.column("shingles").offsets), np.asarray(batch.column("shingles").values).view(np.uint64)
            for r in range(batch.num_rows):
                s = flat[at[r] : at[r + 1]]
                seen = sent.value[s >> np.uint64(64 - _COUNTER_BITS)]
                first = np.lexsort((s, seen))[: s.size - -(-s.size * percent // 100) + 1]
                keep = np.flatnonzero(seen[first] > 1)
                shingles.append(s[first[keep]]), places.append(keep + 1), rows.append(np.full(keep.size, r))
                odd.append(np.tile(parities(s).view(np.int64), (keep.size, 1)))
            odd = np.concatenate([*odd, np.empty((0, 4), np.int64)])
            taken = batch.select(["cls", "root", "n"]).take(pa.array(np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(np.concatenate([*shingles, np.empty(0, np.uint64)]).view(np.int64)), pa.array(np.concatenate([*places, np.empty(0, np.int64)]).astype(np.int64)), *(pa.array(odd[:, i]) for i in range(4))],
                ["cls", "root", "n", "shingle", "place", *_ODD],
            )

    schema = "cls binary, root binary, n bigint, shingle bigint, place bigint, " + ", ".join(f"{c} bigint" for c in _ODD)
    rows = tables.keep(sets.select("cls", "root", "n", "shingles").mapInArrow(prefixes, schema), f"prefixes{star}")
    shared = rows.groupBy("shingle", "root").agg(F.count("*").alias("members"), F.min("n").alias("least"))
    shared = shared.groupBy("shingle").agg(F.count("*").alias("roots"), F.max_by("root", F.struct("members", "root")).alias("most"), F.min("least").alias("least"))
    shared = tables.keep(shared.where("roots > 1").drop("roots"), f"shared{star}")
    rows = rows.join(shared, "shingle")
    enough = (F.col("n") - F.col("place") + 1) * (100 + percent) >= percent * (F.col("n") + F.greatest("least", F.ceil(F.col("n") * percent / 100)))
    rows = tables.keep(rows.where(enough).drop("least"), f"early{star}")
    tables.drop(f"open-sets{star}", f"prefixes{star}", f"shared{star}")
    return rows


def _few_meetings(early: DataFrame) -> bool:
    """Whether ``_missed`` looks at no more than ``_MEETINGS`` pairs for each of its rows."""
    shingles = early.groupBy("shingle").agg(F.count("*").alias("n"), F.sum((F.col("root") != F.col("most")).cast("int")).alias("few"))
    rows, pairs = shingles.agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("few"))).first()
    return (pairs or 0) <= _MEETINGS * (rows or 0)


def _missed(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes in different components that may be similar, from rows of ``_early``."""
    few = rows.where("root != most").select("shingle", F.col("cls").alias("hub"), F.col("root").alias("hub_root"), F.col("n").alias("m"), F.col("place").alias("at"), *[F.col(c).alias(f"of_hub_{c}") for c in _ODD])
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"of_hub_{c}"))) for c in _ODD), F.lit(0))
    close = differ * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)
    left = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at")) + 1
    met = rows.join(few, "shingle").where((F.col("root") != F.col("hub_root")) & (left * (100 + percent) >= percent * (F.col("n") + F.col("m"))) & close)
    return met.select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes whose full sets are similar enough."""
    left = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("of_b"))
    right = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("of_a"))
    both = pairs.join(left.hint("merge"), "b").join(right.hint("merge"), "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    both = both.select("a", "b", common.alias("common"), (F.size("of_a") + F.size("of_b")).alias("sizes"))
    return both.where(F.col("common") * 100 >= (F.col("sizes") - F.col("common")) * percent).select("a", "b").distinct()

"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

A document is read in windows as long as each benchmark item, one word apart; one with fewer words than the item
is a single window. A window's fingerprint has 64
bits; bit j is the sign of the sum of its shingles' weights, each added or taken away as bit j of its hash says.
A weight is the number of times the shingle occurs. Fingerprints of items are indexed by ``radius + 1`` blocks
of bits: two that differ in at most ``radius`` bits agree in one block at least, so looking up each block finds
all of them. Whoever is within the radius is checked on the shingles themselves: the sum of the smaller over
the sum of the larger weights must reach ``percent``.

An item of fewer words than a shingle has is looked for as a shingle of its own length, word for word.

A window without any shingle of the items has similarity 0 with each, so only windows around shared shingles are
fingerprinted; that loses nothing. Items are sent to the tasks in blocks of bounded size, with a pass over the
documents for each block (a benchmark of up to 4 MB of text is one).
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailrace.llm.tables import Tables, slices
from tailrace.llm.words import Words, scramble, shingle_hashes, utf8

_HITS = "doc_id bigint, item_id bigint, first_word bigint, n_words bigint, distance int, similarity double"
_BITS = 64
_ITEMS_BYTES = 4 << 20  # of item text in one broadcast


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each hash, as an array of ``len(shingles)`` by 64."""
    bits = np.unpackbits(scramble(shingles).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view(np.uint64).ravel()


class Index:
    """Items by length in words: fingerprints, block tables and shingle weights."""

    def __init__(self, items: list[tuple[int, str]], k: int, radius: int):
        self.k, self.radius = k, radius
        edges = np.linspace(0, _BITS, radius + 2).astype(int)
        self.blocks = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(edges, edges[1:])]
        found = Words(*utf8(pa.array([t for _, t in items], pa.string())), letters_only=True)
        h, first = shingle_hashes(found.hashes, found.first, k)
        self.ids, self.weights, self.prints, sizes = [], [], [], []
        self.short: dict[int, dict[int, list[int]]] = {}  # items shorter than a shingle: ids by length and hash
        self.lookup: dict[int, list[dict[int, list[int]]]] = {}
        for n, (item, _) in enumerate(items):
            own = h[first[n] : first[n + 1]]
            if not own.size:
                continue  # an item without words is in no text
            size = int(found.first[n + 1] - found.first[n])
            if size < k:
                whole, _ = shingle_hashes(found.hashes[found.first[n] : found.first[n + 1]], np.array([0, size]), size)
                self.short.setdefault(size, defaultdict(list))[int(whole[0])].append(item)
                continue
            place = len(self.ids)
            sizes.append(size)
            self.ids.append(item)
            self.weights.append(Counter(own.tolist()))
            self.prints.append(fingerprints(signs(own).sum(axis=0)[None, :])[0])
            tables = self.lookup.setdefault(size, [defaultdict(list) for _ in self.blocks])
            for table, (shift, mask) in zip(tables, self.blocks):
                table[int(self.prints[-1] >> shift & mask)].append(place)
        self.prints = np.array(self.prints, np.uint64)
        pairs = sorted({(s, size) for size, weights in zip(sizes, self.weights) for s in weights})
        self.shared = np.array([s for s, _ in pairs], np.uint64)
        self.size_of = np.array([size for _, size in pairs], np.int64)
        self.anchors = np.unique(self.shared)

    def within(self, size: int, prints: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, item place, distance) of all items of ``size`` words within the radius of each fingerprint."""
        for row, f in enumerate(prints):
            close: set[int] = set()
            for table, (shift, mask) in zip(self.lookup[size], self.blocks):
                close.update(table.get(int(f >> shift & mask), ()))
            if close:
                places = np.fromiter(close, np.int64)
                distance = np.bitwise_count(self.prints[places] ^ f)
                for p, d in zip(places[distance <= self.radius], distance[distance <= self.radius]):
                    yield row, int(p), int(d)

    def search(self, words: np.ndarray, percent: int) -> Iterator[tuple[int, int, int, int, float]]:
        """(item, first word, words, distance, similarity) of the best window of each item in one text."""
        if words.size < self.k:
            return
        best: dict[int, tuple] = {}
        h, _ = shingle_hashes(words, np.array([0, words.size]), self.k)
        hits = np.flatnonzero(self.anchors[np.minimum(np.searchsorted(self.anchors, h), self.anchors.size - 1)] == h)
        wanted = defaultdict(list)
        low, high = np.searchsorted(self.shared, h[hits]), np.searchsorted(self.shared, h[hits], "right")
        for at, a, b in zip(hits.tolist(), low.tolist(), high.tolist()):
            for size in self.size_of[a:b].tolist():
                wanted[size].append(at)
        for size, at in wanted.items():
            span = min(size, words.size)
            reach = span - self.k
            starts = np.unique(np.concatenate([np.arange(max(0, x - reach), min(x, words.size - span) + 1) for x in at]))
            width = reach + 1
            for part in np.split(starts, range(4096, starts.size, 4096)):  # a part of the windows at a time
                base = part[0]
                sums = np.zeros((part[-1] + width - base + 1, _BITS), np.int32)
                np.cumsum(signs(h[base : part[-1] + width]), axis=0, out=sums[1:])
                prints = fingerprints(sums[part - base + width] - sums[part - base])
                for row, place, distance in self.within(size, prints):
                    s = int(part[row])
                    like = weighted_similarity(Counter(h[s : s + width].tolist()), self.weights[place])
                    if like * 100 >= percent and (place not in best or like > best[place][4]):
                        best[place] = (self.ids[place], s, span, distance, like)
        yield from best.values()

    def search_short(self, found: Words) -> Iterator[tuple[int, int, int, int, int, float]]:
        """(text, item, first word, words, 0, 1.0) of the first place of each item shorter than a shingle in each text."""
        for size, items in self.short.items():
            h, first = shingle_hashes(found.hashes, found.first, size)
            keys = np.array(sorted(items), np.uint64)
            which = np.minimum(np.searchsorted(keys, h), keys.size - 1)
            at = np.flatnonzero(keys[which] == h)
            text = np.searchsorted(first, at, "right") - 1
            _, once = np.unique(text * keys.size + which[at], return_index=True)
            for n, x in zip(text[once].tolist(), at[once].tolist()):
                for item in items[int(h[x])]:
                    yield n, item, x - int(first[n]), size, 0, 1.0


def weighted_similarity(a: Counter, b: Counter) -> float:
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common / (sum(a.values()) + sum(b.values()) - common)


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Distinct items in blocks of about ``_ITEMS_BYTES``, dealt by their hash and fetched one at a time."""
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // _ITEMS_BYTES))
    for block in range(n):
        held = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        yield sorted(map(tuple, held), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def _finder(spark: SparkSession, block: list[tuple], k: int, percent: int, radius: int):
    """A maker, for tasks, of a function from a column of texts to (row, item, first word, words, distance, similarity)."""
    sent = spark.sparkContext.broadcast(block)

    def make():
        index = Index(sent.value, k, radius)

        def find(column: pa.Array) -> list[tuple]:
            if not index.ids and not index.short:
                return []
            found = Words(*utf8(column), letters_only=True)
            rows = list(index.search_short(found))
            if not index.ids:
                return rows
            h, first = shingle_hashes(found.hashes, found.first, k)
            hit = index.anchors[np.minimum(np.searchsorted(index.anchors, h), index.anchors.size - 1)] == h
            for n in np.unique(np.searchsorted(first, np.flatnonzero(hit), "right") - 1).tolist():
                words = found.hashes[found.first[n] : found.first[n + 1]]
                rows += [(n, *x) for x in index.search(words, percent)]
            return rows

        return find

    return make


def contaminated(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80, radius: int = 19) -> DataFrame:
    """One row for each row of ``docs`` and item it holds: the best window (first of equals), its distance and similarity.

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case. Null or empty texts and
    items hold nothing. A text with fewer words than an item is compared whole. Items of fewer than ``k`` words are
    found wherever all their words stand in a row. Rows with a null doc_id or item_id are compared like others; repeated rows of ``docs``
    each give theirs, repeated items count once. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def hits(make) -> DataFrame:
        def run(batches):
            find = make()
            for batch in slices(batches, "text"):
                ids = batch.column("doc_id")
                rows = [(ids[n].as_py(), *x) for n, *x in find(batch.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, [pa.int64()] * 4 + [pa.int32(), pa.float64()])],
                    ["doc_id", "item_id", "first_word", "n_words", "distance", "similarity"],
                )

        return texts.mapInArrow(run, _HITS)

    return reduce(DataFrame.union, [hits(_finder(docs.sparkSession, block, k, percent, radius)) for block in _blocks(items)])


def clean(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80, radius: int = 19) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; see ``contaminated``.

    What one block of items leaves is written before the next is looked for, so a task holds one block.
    """
    tables = Tables(docs.sparkSession, "decontaminated")

    def kept(docs: DataFrame, make) -> DataFrame:
        def run(batches):
            find = make()
            for batch in slices(batches, "text"):
                keep = np.ones(batch.num_rows, bool)
                keep[[n for n, *_ in find(batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))

        return docs.mapInArrow(run, docs.schema)

    for n, block in enumerate(_blocks(items)):
        docs = kept(tables.keep(docs, f"before{n}") if n else docs, _finder(docs.sparkSession, block, k, percent, radius))
    return docs

"""Removal of byte strings that occur earlier in the corpus, by suffixes sorted in small blocks.

Every window of ``length`` bytes has an anchor: of the strings of half that length in it, the one with the smallest hash, the
leftmost of equals. Equal windows have equal anchors in the same place, so an anchor's text says where windows
may meet. Neighbouring windows with one anchor are one row; sorted by (anchor, content, place), all but
the first of equal rows are repeats at once, whatever their number. What is left are different surroundings of the same
anchor; only these are cut out of the texts, and only here suffixes are needed.

Such surroundings, whole anchors at a time, are joined to a text of bounded size, whose suffixes are sorted and whose
Burrows-Wheeler transform is walked breadth first: the interval of a string w, extended backward by each byte that
stands before it, gives the intervals of the strings cw. Intervals come by increasing length, and where one ends, the
common prefix of the two suffixes there is one shorter than its string if nothing shorter has ended there. Each place is
entered once, so intervals that tell nothing new are not extended. The walk stops at ``length``: places without an entry
part suffixes that share a whole window, and windows between two entries are equal.

An anchor with more surroundings than fit is split: windows with the anchor in their left half and those with it in their right
half are told apart by the longer text that all of them share, if need be down to single windows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailrace.llm.ranks import changes, numbered
from tailrace.llm.tables import Tables, slices
from tailrace.llm.words import scramble, utf8

_STEP = 1 << 19
_PLACE_BITS = 20
_BLOCK_BYTES = 1 << 18
_BASES = (0xD6E8FEB86659FD93, 0xA3B195354A39B70D)  # odd and arbitrary
_ANCHORS = "key bigint, ctx bigint, ord bigint, at bigint, lo bigint, hi bigint"
_PLACES = "key bigint, ctx bigint, ord bigint, at bigint, lo bigint, hi bigint, near int, far int, body binary"
_SPANS = "ord bigint, start bigint, end bigint"


@lru_cache(maxsize=None)
def _table(which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the bytes, powers of the base and of its inverse."""
    size = _STEP + (1 << 17)
    values = scramble((np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * which)) * np.uint64(0x9E3779B97F4A7C15))
    powers = []
    for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
        p = np.full(size, np.uint64(base))
        p[0] = 1
        powers.append(np.multiply.accumulate(p))
    return values, *powers


class _Sums:
    """Hashes of parts of a text of bounded size, from running sums."""

    def __init__(self, data: np.ndarray, which: int):
        values, power, self.inverse = _table(which)
        self.sums = np.zeros(data.size + 1, np.uint64)
        np.cumsum(values[data] * power[: data.size], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def anchored(data: np.ndarray, offsets: np.ndarray, length: int):
    """Rows of windows with one anchor: text, anchor hash, hash of the content, anchor, first and last window.

    ``data`` holds the texts at ``offsets``, at most ``_STEP`` bytes and a window; places count from its start.
    """
    k = length // 2
    width, n = length - k + 1, data.size - length + 1
    if n <= 0:
        return [np.empty(0, np.int64)] * 6
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = np.flatnonzero(offsets[1:][text[:n]] >= np.arange(n) + length)
    first = _Sums(data, 0)
    at = np.arange(data.size - k + 1)
    lowest = (first.hashes(at, at + k) >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | at.astype(np.uint64)
    have = 1
    while have < width:  # the smallest of ``have`` neighbours becomes that of more
        step = min(have, width - have)
        lowest = np.minimum(lowest[:-step], lowest[step:])
        have += step
    anchor = (lowest[inside] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate((np.ones(min(1, inside.size), bool), (np.diff(anchor) != 0) | (np.diff(inside) != 1))))
    lo, hi, anchor = inside[cut], inside[np.append(cut[1:], inside.size) - 1] if cut.size else inside, anchor[cut]
    return text[lo], first.hashes(anchor, anchor + k), _Sums(data, 1).hashes(lo, hi + length), anchor, lo, hi


def _anchors(length: int, step: int):
    def run(batches):
        for batch in slices(batches, "text", step // 2):
            data, offsets = utf8(batch.column("text"))
            ords = np.asarray(batch.column("ord"))
            for a in range(0, max(data.size, 1), step):  # only a long text of its own takes more than one step
                part = data[a : a + step + length - 1]
                ends = offsets if a == 0 and part.size == data.size else np.array([0, part.size])
                text, key, ctx, anchor, lo, hi = anchored(part, ends, length)
                begin = offsets[text] - (0 if a == 0 else offsets[0]) - a
                columns = [key.view(np.int64), ctx.view(np.int64), ords[text], anchor - begin, lo - begin, hi - begin]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "ctx", "ord", "at", "lo", "hi"])

    return run


def _marked(batches):
    """Rows in order of (key, ctx, ord, at) with ``head``, true for the first of equal (key, ctx).

    A head alone with its key is left out. What a task cannot know, because its neighbour's rows go on, it hands on as a head.
    """
    last = pending = None
    several = True  # of the key at hand: heads of it were handed on, or it may go on in the task before
    for batch in batches:
        if not batch.num_rows:
            continue
        new_key, head = changes(batch, ["key"], last), changes(batch, ["key", "ctx"], last)
        if last is None:
            head[0] = True
        run = np.cumsum(new_key)
        heads = np.bincount(run, head)
        kept = heads[run] >= 2
        if several:
            kept |= run == 0
        elif heads[0]:
            kept |= run == 0
            yield _with_head(pending, np.array([True]))
            several, pending = True, None
        if run[-1] > 0:
            several, pending = bool(heads[-1] >= 2), None
            if not several:
                pending = batch.slice(int(np.flatnonzero(head)[-1]), 1)
        out = np.flatnonzero(~head | kept)
        yield _with_head(batch.take(pa.array(out)), head[out])
        last = batch.slice(batch.num_rows - 1)
    if pending is not None:
        yield _with_head(pending, np.array([True]))


def _with_head(batch: pa.RecordBatch, head: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(head)], [*batch.schema.names, "head"])


def _reduced(rows: DataFrame, schema: str, tables: Tables, name: str) -> DataFrame:
    order = ["key", "ctx", "ord", "at", "lo"]
    return tables.keep(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_marked, f"{schema}, head boolean"), name)


# --- surroundings -------------------------------------------------------------------------------------


def _places(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 9
    kinds = [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split(" ")[0] for c in _PLACES.split(", ")])


def _cut_out(length: int):
    """The bytes around the anchors of a text."""

    def run(batches):
        for batch in slices(batches, "text", 1 << 16):
            rows = []
            for text, ord_, marks in zip(batch.column("text"), batch.column("ord").to_pylist(), batch.column("marks")):
                data = text.as_buffer()
                for m in marks.as_py():
                    body = data.slice(m["lo"], m["hi"] + length - m["lo"]).to_pybytes()
                    rows.append((m["key"], 0, ord_, m["at"], m["lo"], m["hi"], 0, length - length // 2, body))
                    if len(rows) == 4096:
                        yield _places(rows)
                        rows = []
            if rows:
                yield _places(rows)

    return run


def _hash(*parts) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "big", signed=True)


def _halves(length: int):
    """Each row as up to two: windows whose anchor begins ``near`` to ``far`` bytes after them, in two ranges."""

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                middle = (r["near"] + r["far"]) // 2
                for near, far in ((r["near"], middle), (middle + 1, r["far"])):
                    lo, hi = max(r["lo"], r["at"] - far), min(r["hi"], r["at"] - near)
                    if lo <= hi:
                        body = r["body"][lo - r["lo"] : hi + length - r["lo"]]
                        shared = body[r["at"] - near - lo : r["at"] - far + length - lo]
                        rows.append((_hash(near, far, shared), _hash(body), r["ord"], r["at"], lo, hi, near, far, body))
            yield _places(rows)

    return run


# --- suffixes -----------------------------------------------------------------------------------------


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` (values below 512) in order of the ``depth`` symbols there, at least."""
    n = text.size
    packed, have = np.zeros(n, np.uint64), 7
    for i in range(have):
        packed[: n - i] |= text[i:].astype(np.uint64) << np.uint64(9 * (have - 1 - i))
    while True:
        order = np.argsort(packed)
        if have >= depth:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate(([1], packed[order[1:]] != packed[order[:-1]])))
        packed = rank << np.uint64(32)
        if have < n:
            packed[:-have] |= rank[have:]
        have *= 2


def ends_of_classes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True at place i of ``order`` where suffix i starts other than i - 1 within ``length`` symbols, none of them 0.

    A breadth-first walk over intervals of the Burrows-Wheeler transform, for strings of 0, 1, 2, ... symbols.
    """
    n = text.size
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(order > 0, text[order - 1], 0).astype(np.int64)
    place_before = place[order - 1]
    entered = np.zeros(n + 1, bool)
    first, last = np.zeros(1, np.int64), np.full(1, n - 1)
    for _ in range(length):
        size = last - first + 1
        at = np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)
        symbol = before[at]
        there = np.flatnonzero(symbol)
        if not there.size:
            break
        string = np.repeat(np.arange(size.size), size)[there] * 512 + symbol[there]
        by = np.argsort(string, kind="stable")
        string, to = string[by], place_before[at[there[by]]]
        starts = np.flatnonzero(np.concatenate(([True], string[1:] != string[:-1])))
        first, last = np.minimum.reduceat(to, starts), np.maximum.reduceat(to, starts)
        fresh = ~entered[last + 1]
        entered[last + 1] = True
        first, last = first[fresh], last[fresh]
        if not first.size:
            break
    return entered[:n]


def equal_windows(bodies: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of each body: the body, the place in it and a number that equal windows share."""
    size = np.array([len(b) for b in bodies])
    text = np.frombuffer(b"\0".join([*bodies, b""]), np.uint8).astype(np.int64) + 1
    ends = np.cumsum(size + 1)
    text[ends - 1] = 0
    order = sorted_suffixes(text, length)
    numbers = np.empty(text.size, np.int64)
    numbers[order] = np.cumsum(ends_of_classes(text, order, length))
    count = np.maximum(size - length + 1, 0)
    body = np.repeat(np.arange(len(bodies)), count)
    place = np.arange(body.size) - np.repeat(np.cumsum(count) - count, count)
    return body, place, numbers[(ends - size - 1)[body] + place]


def _repeated(length: int):
    """Rows in order of key to the spans of windows that occur earlier under the same key."""

    def solved(rows: list[dict]) -> pa.RecordBatch:
        body, place, number = equal_windows([r["body"] for r in rows], length)
        ord_ = np.array([r["ord"] for r in rows])[body]
        start = np.array([r["lo"] for r in rows])[body] + place
        by = np.lexsort((start, ord_, number))
        again = by[1:][number[by[1:]] == number[by[:-1]]]
        again = again[np.lexsort((start[again], ord_[again]))]
        ord_, start = ord_[again], start[again]
        new = np.flatnonzero(np.concatenate((np.ones(min(1, start.size), bool), (np.diff(ord_) != 0) | (np.diff(start) > length))))
        ends = start[np.append(new[1:], start.size) - 1] + length if new.size else start
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ord_[new], start[new], ends)], ["ord", "start", "end"])

    def run(batches):
        held, own, size = [], [], 0  # whole keys with several rows, the key at hand, bytes held
        for batch in batches:
            for row in batch.to_pylist():
                if own and own[0]["key"] != row["key"]:
                    if len(own) > 1:
                        held += own
                        size += sum(len(r["body"]) for r in own)
                    own = []
                    if size >= _BLOCK_BYTES:
                        yield solved(held)
                        held, size = [], 0
                own.append(row)
        if len(own) > 1:
            held += own
        if held:
            yield solved(held)

    return run


# --- documents ----------------------------------------------------------------------------------------


def _ordered(docs: DataFrame, tables: Tables) -> DataFrame:
    """doc_id, text and ``ord``, a number that is one row's alone and grows with doc_id."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if docs.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        return docs.withColumn("ord", F.col("doc_id"))
    return numbered(docs, [], ["doc_id"], tables, "rows").select("doc_id", "text", F.col("pos").alias("ord"))


def repeated_spans(rows: DataFrame, length: int, tables: Tables, most_rows: int = 2048, step: int = _STEP) -> DataFrame:
    """Spans (ord, start, end) in bytes of ``rows`` (ord, text) that windows with an earlier equal cover; they may overlap."""
    anchors = rows.where(F.octet_length("text") >= length).select("ord", "text").mapInArrow(_anchors(length, step), _ANCHORS)
    marked = _reduced(anchors, _ANCHORS, tables, "anchors")
    whole = F.col("lo").alias("start"), (F.col("hi") + length).alias("end")
    spans = [marked.where("not head").select("ord", *whole)]
    marks = marked.where("head").groupBy("ord").agg(F.collect_list(F.struct("key", "at", "lo", "hi")).alias("marks"))
    texts = rows.select("ord", F.col("text").cast("binary").alias("text")).join(marks, "ord")
    places = tables.keep(texts.mapInArrow(_cut_out(length), _PLACES), "places")
    for i in range(length.bit_length()):
        crowded = tables.keep(places.groupBy("key").count().where(F.col("count") > most_rows).select("key"), f"crowded{i}")
        done = crowded.isEmpty()
        few = places if done else places.join(crowded, "key", "left_anti")
        few = few.select("key", "ord", "lo", "body").repartition("key").sortWithinPartitions("key")
        spans.append(tables.keep(few.mapInArrow(_repeated(length), _SPANS), f"spans{i}"))
        if done:
            break
        split = places.join(crowded, "key", "left_semi").mapInArrow(_halves(length), _PLACES)
        marked = _reduced(split, _PLACES, tables, f"halves{i}")
        spans.append(marked.where("not head").select("ord", *whole))
        places = marked.where("head and near < far").drop("head")
    return reduce(DataFrame.union, spans)


def _removed(batches):
    for batch in slices(batches, "text"):
        spans, kept = [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            merged, rest, at = [], [], 0
            for s in sorted(found or [], key=lambda s: (s["start"], s["end"])):
                if merged and s["start"] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                else:
                    merged.append(s)
            for s in merged:
                rest.append(text[at : s["start"]])
                at = s["end"]
            spans.append(merged)
            kept.append(b"".join([*rest, text[at:]]))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        size = [len(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def without_repeats(docs: DataFrame, length: int = 100, most_rows: int = 2048, step: int = _STEP) -> DataFrame:
    """doc_id, n_bytes, the ``spans`` removed and the bytes ``kept``, for every row of ``docs``.

    A byte goes if a string of ``length`` bytes covers it that also starts earlier: in a smaller doc_id, or further left
    in the same text. Texts are taken as UTF-8, a null one as empty; a shorter one keeps all. Null ids come first; rows
    that repeat an id count as texts of their own, in the order of the table. Spans are in bytes, apart from each
    other, and may cut a character. Other columns are not read; an empty table gives no rows. An anchor with more than
    ``most_rows`` surroundings is split; texts are read ``step`` bytes at a time. Neither changes the result.
    """
    if not 2 <= length <= 1 << 16:
        raise ValueError("length must be from 2 to 65,536")
    tables = Tables(docs.sparkSession, "repeats")
    rows = _ordered(docs, tables)
    spans = repeated_spans(rows, length, tables, most_rows, step).groupBy("ord").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.withColumn("text", F.col("text").cast("binary")).join(spans, "ord", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_removed, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")

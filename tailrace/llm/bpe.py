"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

Merging is undone only from the right: whether two pieces join at a place can depend on later bytes through a
chain of merges, each of which must come earlier in the merge list than the one it prevents. The longest such
chain is the sufficient lookahead of the list (``Merges.lookahead``, in bytes). A token boundary with that many
bytes behind it can never change, so the transducer emits all tokens up to the last such boundary and goes on
from there with a buffer of fixed size, however long a stretch without gaps may be.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import sys
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailrace.llm.tables import slices

# How byte-level vocabularies split text into stretches that merges never leave.
STRETCH = regex.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# The same for texts of characters below U+0100 alone, where a plain character class is quicker.
_LATIN_STRETCH = re.compile(
    "'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+| ?[0-9²³¹¼-¾]+"
    "| ?[^\t-\r \x85\xa0A-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼-¾]+|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+"
)
_BEYOND_LATIN = re.compile("[^\x00-\xff]")
# Before a single space between two other characters a stretch always ends.
_SURE = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
_CHUNK = 1 << 16
_ID = 24  # bits of a token id
_BLOCK = 1 << 12
_CACHED_BYTES = 64
_CACHED_WORDS = 1 << 20


def _byte_names() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Token ids, their bytes, and for each pair of ids the rank and the id of what it becomes."""

    def __init__(self, tokens: dict[bytes, int], pairs: list[tuple[bytes, bytes]]):
        self.bytes_of = {i: b for b, i in tokens.items()}
        self.of_byte = [tokens.get(bytes([b]), -1) for b in range(256)]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for a, b in pairs:
            self.rank.setdefault((tokens[a], tokens[b]), len(self.made))
            self.made.append(tokens[a + b])
        self.packed = {a << _ID | b: r << _ID | self.made[r] for (a, b), r in self.rank.items()}

    @classmethod
    def read(cls, spec: dict) -> Merges:
        names = _byte_names()
        raw = lambda s: bytes(names[c] for c in s)
        added = {t["content"] for t in spec["added_tokens"]}
        tokens = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        return cls(tokens, [(raw(a), raw(b)) for a, b in pairs])

    def lookahead(self) -> int:
        """Bytes after a token boundary that decide whether it stays, whatever follows them.

        A merge (x, y) is prevented from the right by an earlier merge (c, d) where c is y or the last part of
        y at some level, if (c, d) comes before the merge that uses c in y. That one may in turn be prevented.
        """
        size = {i: len(b) for i, b in self.bytes_of.items()}
        last: dict[int, tuple[int, int]] = {}  # id -> its right part and the rank of its making
        reach: dict[int, tuple[list[int], list[int]]] = {}  # left id -> ranks, and the largest reach up to each
        longest = 0
        for (x, y), r in sorted(self.rank.items(), key=lambda e: e[1]):
            beyond, part, before = 0, y, r
            while True:
                ranks, far = reach.get(part, ((), ()))
                if k := bisect_left(ranks, before):
                    beyond = max(beyond, far[k - 1])
                if part not in last:
                    break
                part, before = last[part]
            longest = max(longest, size[y] + beyond)
            ranks, far = reach.setdefault(x, ([], []))
            ranks.append(r)
            far.append(max(size[y] + beyond, far[-1] if far else 0))
            last.setdefault(self.made[r], (y, r))
        return longest

    def short(self, data: bytes) -> list[int]:
        """Ids of a short stretch."""
        of, get, none = self.of_byte, self.packed.get, 1 << 62
        ids = [of[b] for b in data]
        ranks = [get(a << _ID | b, none) for a, b in zip(ids, ids[1:])]  # rank and what the pair becomes, in one number
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i] = new = best & ((1 << _ID) - 1)
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << _ID | new, none)
            if i < len(ranks):
                ranks[i] = get(new << _ID | ids[i + 1], none)
        return ids

    def long(self, data: bytes) -> list[int]:
        """The same, with a queue of merges, for stretches of any length."""
        ids = [self.of_byte[b] for b in data]
        n, get = len(ids), self.rank.get
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            r, i, a, b = heapq.heappop(queue)
            j = right[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[r], -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for p, q in ((left[i], i), (i, right[i])):
                if p >= 0 and q < n and (s := get((ids[p], ids[q]))) is not None:
                    heapq.heappush(queue, (s, p, ids[p], ids[q]))
        return [t for t in ids if t >= 0]


class Transducer:
    """Ids of one stretch that arrives in parts: tokens leave once no later byte can change them."""

    def __init__(self, merges: Merges, lookahead: int):
        self.merges, self.lookahead, self.held = merges, lookahead, b""

    def feed(self, data: bytes) -> list[int]:
        self.held += data
        if len(self.held) < self.lookahead + _BLOCK:
            return []
        ids, at, stable = self.merges.long(self.held), 0, []
        for t in ids:
            end = at + len(self.merges.bytes_of[t])
            if end > len(self.held) - self.lookahead:
                break
            stable.append(t)
            at = end
        self.held = self.held[at:]
        return stable

    def close(self) -> list[int]:
        ids, self.held = self.merges.long(self.held), b""
        return ids


class Encoder:
    """Little-endian 32-bit ids of texts, in parts of limited size."""

    def __init__(self, spec: dict, lookahead: int):
        self.merges, self.lookahead = Merges.read(spec), lookahead
        self.added = {t["content"]: t["id"].to_bytes(4, "little") for t in spec["added_tokens"]}
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.known = _Known(self)

    def encode(self, text: str) -> Iterator[bytes]:
        at, self.stretch = 0, STRETCH if _BEYOND_LATIN.search(text) else _LATIN_STRETCH
        for m in self.split.finditer(text):
            yield from self._plain(text, at, m.start())
            yield self.added[m[0]]
            at = m.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, at: int, end: int) -> Iterator[bytes]:
        while at < end:
            cut = end
            if end - at > 2 * _CHUNK:
                sure = _SURE.search(text, at + _CHUNK, at + 2 * _CHUNK)
                cut = sure.start() if sure else 0
            if cut:
                yield b"".join(map(self.known.__getitem__, self.stretch.findall(text, at, cut)))
                at = cut
                continue
            for m in self.stretch.finditer(text, at, end):  # no sure gap for long: a stretch at a time
                if m.end() - m.start() <= _CHUNK:
                    yield self.known[m[0]]
                else:
                    yield from self._stream(text[a : min(a + _CHUNK, m.end())] for a in range(m.start(), m.end(), _CHUNK))
                at = m.end()
                if at >= end or _SURE.match(text, at):
                    break

    def _stream(self, parts: Iterable[str]) -> Iterator[bytes]:
        run = Transducer(self.merges, self.lookahead)
        for part in parts:
            yield pack(run.feed(part.encode()))
        yield pack(run.close())


class _Known(dict):
    """Packed ids of stretches seen lately; emptied when full, so memory has a bound."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, stretch: str) -> bytes:
        data = stretch.encode()
        if len(data) > _CACHED_BYTES:
            return b"".join(self.encoder._stream([stretch]))
        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[stretch] = out = pack(self.encoder.merges.short(data))
        return out


def pack(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


class Decoder:
    """Text of ids that arrive in parts: bytes wait until they complete a character; broken ones become U+FFFD."""

    def __init__(self, spec: dict, merges: Merges):
        names = _byte_names()
        self.table = [b""] * (max([*merges.bytes_of, *(t["id"] for t in spec["added_tokens"])]) + 1)
        for i, b in merges.bytes_of.items():
            self.table[i] = b
        for t in spec["added_tokens"]:
            s = t["content"]
            self.table[t["id"]] = bytes(names[c] for c in s) if all(c in names for c in s) else s.encode()
        self.start()

    def start(self) -> None:
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, packed: bytes) -> str:
        return self.state.decode(b"".join(map(self.table.__getitem__, np.frombuffer(packed, "<u4").tolist())))

    def close(self) -> str:
        return self.state.decode(b"", True)


def _tools(spark, path: str):
    """A maker of encoder and decoder for tasks. The vocabulary file is read by the driver and sent to them."""
    with open(path, "rb") as file:
        text = file.read()
    lookahead = Merges.read(json.loads(text)).lookahead()
    sent = spark.sparkContext.broadcast({"file": text})

    def make() -> tuple[Encoder, Decoder]:
        ready = sent.value  # one object in each Python worker: later tasks there find the tools and known stretches
        if "tools" not in ready:
            spec = json.loads(ready["file"])
            encoder = Encoder(spec, lookahead)
            ready["tools"] = encoder, Decoder(spec, encoder.merges)
        return ready["tools"]

    return make


def encode(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids of every row of ``docs``.

    ``decoded_sha256`` is of the text that the decoder makes of the ids. A null text is an empty one; repeated
    rows each give a row, a null doc_id stays null, other columns are not read, and no rows give no rows.
    Without ``ids`` a text of any length passes through in parts of fixed size.
    """
    make = _tools(docs.sparkSession, path)

    def run(batches):
        encoder, decoder = make()
        for batch in slices(batches, "text", 4 << 20):
            out = []
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                mark, back, n, all_ids = hashlib.sha256(), hashlib.sha256(), 0, []
                decoder.start()
                for part in encoder.encode(text.as_py() or ""):
                    mark.update(part)
                    back.update(decoder.feed(part).encode())
                    n += len(part) // 4
                    if ids:
                        all_ids.append(np.frombuffer(part, "<i4"))
                back.update(decoder.close().encode())
                row = (i, n, mark.hexdigest(), back.hexdigest())
                out.append((*row, np.concatenate([*all_ids, np.empty(0, "<i4")])) if ids else row)
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names[: len(out[0])])

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ``ids`` (array of int; null is empty)."""
    make = _tools(tokens.sparkSession, path)

    def run(batches):
        _, decoder = make()
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                decoder.start()
                packed = pack(ids.as_py() or [])
                texts.append("".join(decoder.feed(packed[a : a + 4 * _CHUNK]) for a in range(0, len(packed), 4 * _CHUNK)) + decoder.close())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, text string")

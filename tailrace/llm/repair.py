"""Repair of conversations at the least cost of edits.

A conversation is legal if its roles read: perhaps one system turn, then one or more pairs of user and assistant; or nothing.
Repairs walk a lattice whose node is (rows read, last role): a row is kept, given the right role or deleted, and
missing turns are inserted. A bidirectional Dijkstra search finds the cheapest walk. Both heaps are ordered by cost, then
by rows read, so of all walks of a node's cost the one with the least audit settles it. Every edge between a node settled
from the front and one settled from the back is a crossing; the search goes on until the heaps' tops together cost more
than the best crossing, so all crossings of that cost are seen, and the least joined audit wins. (At one node and cost, no
audit begins with another: both have read as many rows, and what one inserts more would cost more.)

Conversations are cut into blocks of rows, so one that holds a large share of the table is searched by many tasks: each
block is solved from every role it may be entered with to every role it may be left with, and the answers are put
together in order. Texts stay out of this; they are shuffled to be sorted, and to be hashed in order.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailrace.llm.ranks import numbered
from tailrace.llm.tables import Tables, slices

# Roles so far: none, system, user, assistant. A walk may end after none or after the assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
_BEFORE = {SYSTEM: (NONE,), USER: (NONE, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_LEGAL_PAIRS = ("su", "ua", "au")
RETYPE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
_SPACE = " \t\n\x0b\x0c\r"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

Row = tuple[str, bool, bool]  # initial of the role, whether it must go, whether it is cut off


def _next(state: int) -> int:
    """The role an inserted or retyped turn has to have."""
    return ASSISTANT if state == USER else USER


def _edits(rows: list[Row], i: int, state: int):
    """Edges out of a node: place, state, cost, letter."""
    if i < len(rows):
        initial, must_go, cut = rows[i]
        yield i + 1, state, DELETE, "D"
        if not must_go:
            cost, kept = CUT_OFF * cut, _INITIAL.get(initial)
            if kept is not None and state in _BEFORE[kept]:
                yield i + 1, kept, cost, "K"
            yield i + 1, _next(state), cost + RETYPE, "R"
    yield i, _next(state), INSERT, "I"


def _edits_into(rows: list[Row], i: int, state: int):
    """Edges into a node: place, state, cost, letter."""
    if i:
        initial, must_go, cut = rows[i - 1]
        yield i - 1, state, DELETE, "D"
        if not must_go and state != NONE:
            cost = CUT_OFF * cut
            for before in _BEFORE[state]:
                if _INITIAL.get(initial) == state:
                    yield i - 1, before, cost, "K"
                if state != SYSTEM:
                    yield i - 1, before, cost + RETYPE, "R"
    if state in (USER, ASSISTANT):
        for before in _BEFORE[state]:
            yield i, before, INSERT, "I"


def cheapest(rows: list[Row], start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and audit of the cheapest walk over ``rows`` from role ``start`` to one of ``ends``; the least audit of equals."""
    n = len(rows)
    front, back = [(0, 0, "", 0, start)], [(0, 0, "", n, end) for end in ends]
    ahead: dict[tuple[int, int], tuple[int, str]] = {}
    behind: dict[tuple[int, int], tuple[int, str]] = {}
    best = None
    while front and back and (best is None or front[0][0] + back[0][0] <= best[0]):
        forward = front[0][0] <= back[0][0]
        heap, settled, other = (front, ahead, behind) if forward else (back, behind, ahead)
        cost, _, audit, i, state = heappop(heap)
        if (i, state) in settled:
            continue
        settled[i, state] = cost, audit
        for j, to, more, letter in (_edits if forward else _edits_into)(rows, i, state):
            now = cost + more, audit + letter if forward else letter + audit
            if (j, to) not in settled:
                heappush(heap, (now[0], j if forward else n - j, now[1], j, to))
            met = other.get((j, to))
            if met is not None:
                crossing = now[0] + met[0], now[1] + met[1] if forward else met[1] + now[1]
                best = crossing if best is None else min(best, crossing)
        met = other.get((i, state))
        if met is not None:
            crossing = cost + met[0], audit + met[1] if forward else met[1] + audit
            best = crossing if best is None else min(best, crossing)
    return best


# --- blocks -------------------------------------------------------------------------------------------

_BLOCKS = (
    "tree bigint, block bigint, conv_id bigint, n int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, "
    "low bigint, high bigint, turns bigint, ways array<struct<start:int,end:int,cost:bigint,audit:string>>"
)
_PICKS = "tree bigint, block bigint, kind int, pos bigint, role string, text string, start int, audit string, conv_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
_OUT = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string"


def _names(schema: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in schema.replace("start:int,end:int,cost:bigint,audit:string", "").split(", ")]


_WAY = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _record(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [(name, pa.list_(_WAY) if name == "ways" else _KINDS[part.split(" ")[1]]) for name, part in zip(_names(schema), schema.split(", "))]
    return pa.RecordBatch.from_pylist([{name: row.get(name) for name, _ in fields} for row in rows], pa.schema(fields))


def _solved(tree: int, block: int, rows: list[dict], block_rows: int) -> dict:
    """Counts of one block and the cheapest walks through it."""
    conv_id, rows = rows[0]["conv_id"], [r for r in rows if not r["gone"]]
    walked = [(r["initial"], r["blank"] or r["again"], r["cut"]) for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    pairs = [a[0] + b[0] for a, b in zip(walked, walked[1:])]
    whole = block == 0 and len(rows) < block_rows
    starts = (NONE,) if block == 0 else range(4)
    ways = [(a, None, cheapest(walked, a, (NONE, ASSISTANT))) for a in starts] if whole else [(a, b, cheapest(walked, a, (b,))) for a in starts for b in range(4)]
    return {
        "tree": tree,
        "block": block,
        "conv_id": conv_id,
        "n": len(rows),
        "blank": sum(r["blank"] for r in rows),
        "duplicate": sum(r["again"] and not r["blank"] for r in rows),
        "truncated": sum(cut and not must_go for _, must_go, cut in walked),
        "illegal": sum(p not in _LEGAL_PAIRS for p in pairs),
        "first": walked[0][0] if walked else None,
        "last": walked[-1][0] if walked else None,
        "low": min(turns, default=None),
        "high": max(turns, default=None),
        "turns": len(set(turns)),
        "ways": [{"start": a, "end": b if b is not None else NONE, "cost": way[0], "audit": way[1]} for a, b, way in ways if way is not None],
    }


def _solve(block_rows: int):
    """Rows in order of (tree, block, pos) to one row per block."""

    def run(batches):
        at, held = None, []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if at != (row["tree"], row["block"]):
                    if held:
                        out.append(_solved(*at, held, block_rows))
                    at, held = (row["tree"], row["block"]), []
                held.append(row)
            if out:
                yield _record(out, _BLOCKS)
        if held:
            yield _record([_solved(*at, held, block_rows)], _BLOCKS)

    return run


def _picked(blocks: list[dict]) -> list[dict]:
    """One row for the conversation and one per block with the walk it takes in it."""
    best = {NONE: (0, "")}
    came: list[dict[int, dict]] = []
    for b in blocks:
        reached, through = {}, {}
        for way in b["ways"]:
            if way["start"] in best:
                cost, audit = best[way["start"]]
                new = cost + way["cost"], audit + way["audit"]
                if way["end"] not in reached or new < reached[way["end"]]:
                    reached[way["end"]], through[way["end"]] = new, way
        best, came = reached, [*came, through]
    end = min((e for e in (NONE, ASSISTANT) if e in best), key=lambda e: best[e])
    cost, audit = best[end]
    walk = []
    for through in reversed(came):
        walk.append(through[end])
        end = through[end]["start"]
    filled = [b for b in blocks if b["n"]]
    total = {c: sum(b[c] for b in blocks) for c in ("blank", "duplicate", "truncated", "illegal")}
    total["illegal"] += sum(a["last"] + b["first"] not in _LEGAL_PAIRS for a, b in zip(filled, filled[1:]))
    timed = [b for b in filled if b["low"] is not None]
    gaps = 0
    if timed:
        distinct = sum(b["turns"] for b in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
        gaps = timed[-1]["high"] - timed[0]["low"] + 1 - distinct
    head = {"tree": blocks[0]["tree"], "block": -1, "kind": 0, "conv_id": blocks[0]["conv_id"], "audit": audit, "cost": cost, "gaps": gaps, **total}
    return [head, *({"tree": b["tree"], "block": b["block"], "kind": 1, "start": w["start"], "audit": w["audit"]} for b, w in zip(blocks, reversed(walk)))]


def _pick(batches):
    held = []
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held and held[0]["tree"] != row["tree"]:
                out += _picked(held)
                held = []
            held.append(row)
        if out:
            yield _record(out, _PICKS)
    if held:
        yield _record(_picked(held), _PICKS)


class _Replay:
    """Applies a conversation's walk to its rows as they come and hashes what stays."""

    def __init__(self, head: dict):
        self.head, self.digest, self.empty, self.state, self.left = head, hashlib.sha256(), True, NONE, ""

    def block(self, start: int, audit: str) -> None:
        self._insert_all()
        self.state, self.left = start, audit

    def row(self, role: str, text: str) -> None:
        letter = self._insert_all()
        self.left = self.left[1:]
        if letter == "K":
            self._emit(_INITIAL[role[0]], role, text)
        elif letter == "R":
            self._emit_next(text)

    def done(self) -> dict:
        self._insert_all()
        return self.head | {"repaired_sha256": self.digest.hexdigest()}

    def _insert_all(self) -> str:
        while self.left[:1] == "I":
            self.left = self.left[1:]
            self._emit_next("")
        return self.left[:1]

    def _emit_next(self, text: str) -> None:
        state = _next(self.state)
        self._emit(state, "assistant" if state == ASSISTANT else "user", text)

    def _emit(self, state: int, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty, self.state = False, state


def _replay(batches):
    """Head, then for each block its walk and its rows, in order, to one row per conversation; one text at a time."""
    current = None
    for batch in slices(batches, "text"):
        out = []
        for row in batch.to_pylist():
            if row["kind"] == 0:
                if current:
                    out.append(current.done())
                current = _Replay({c: row[c] for c in ("conv_id", "audit", *_COUNTS)})
            elif row["kind"] == 1:
                current.block(row["start"], row["audit"])
            else:
                current.row(row["role"], row["text"])
        if out:
            yield _record(out, _OUT)
    if current:
        yield _record([current.done()], _OUT)


def repaired(turns: DataFrame, present: Column | None = None, block_rows: int = 512) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): its faults, the cheapest repair and its digest.

    Rows stand by turn, nulls first, then by role and digest of the text. A null role or text counts as one space. Faults: a
    blank text; a role and text seen earlier (duplicate); a text that does not end in ``.!?`` (truncated); the first of
    these counts. ``illegal`` counts neighbours whose roles do not follow each other, ``gaps`` missing turn numbers.
    Keeping costs 0, another role 3, deleting 4 (a must for blank and duplicate rows), an inserted empty turn 3, a truncated
    row that stays 3 more. ``audit`` has the first letters of the edits. ``repaired_sha256`` is of the lines ``role:text``.

    Rows for which ``present`` is not true make their conversation known but are no part of it; one without any other
    row has zeros and an empty audit. A null conv_id is a conversation, other columns are not read, and an empty table
    gives no rows. One conversation's texts pass through one task in order, as its digest needs, but one at a time.
    """
    tables = Tables(turns.sparkSession, "repair")
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    known = lambda c: F.when(there, F.coalesce(F.col(c).cast("string"), F.lit(" "))).alias(c)
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.when(there, F.col("turn").cast("bigint")).alias("turn"), known("role"), known("text"), (~there).alias("gone"))
    rows = rows.withColumn("seal", F.unhex(F.sha2(F.concat_ws(":", "role", "text").cast("binary"), 256)))
    placed = numbered(rows, ["conv_id"], ["gone", "turn", "role", "seal"], tables, "placed")
    body = F.rtrim("text", F.lit(_SPACE))
    light = placed.select(
        F.col("tree").alias("conv"),
        F.col("pos").alias("place"),
        "conv_id",
        "turn",
        "gone",
        F.coalesce(F.substring("role", 1, 1), F.lit("")).alias("initial"),
        F.coalesce(body == "", F.lit(False)).alias("blank"),
        F.coalesce(~F.right(body, F.lit(1)).isin(".", "!", "?"), F.lit(False)).alias("cut"),
        F.concat("role", F.lit(":"), F.hex("seal")).alias("seal"),
    )
    light = numbered(light, ["conv", "gone", "seal"], ["place"], tables, "seen")
    light = light.select(F.col("conv").alias("tree"), "place", "conv_id", "turn", "gone", "initial", "blank", "cut", (F.col("pos") > 0).alias("again"))
    block = lambda c: F.floor(F.col(c) / block_rows).alias("block")
    blocks = light.withColumn("block", block("place")).repartition("tree", "block").sortWithinPartitions("tree", "block", "place").drop("place")
    blocks = tables.keep(blocks.mapInArrow(_solve(block_rows), _BLOCKS), "blocks")
    picks = tables.keep(blocks.repartition("tree").sortWithinPartitions("tree", "block").mapInArrow(_pick, _PICKS), "picks")
    texts = placed.where("not gone").select("tree", block("pos"), F.lit(2).alias("kind"), "pos", "role", "text")
    every = picks.unionByName(texts, allowMissingColumns=True).repartition("tree").sortWithinPartitions("tree", "block", "kind", "pos")
    return every.mapInArrow(_replay, _OUT)


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """``turns`` with faults by crc32 of ``conv_id:turn`` modulo 20, and which of the rows are still there.

    0 drops a row, 1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes it the user's; a null is one space.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "fault", copies), F.col("fault") != 0

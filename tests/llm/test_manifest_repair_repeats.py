"""Merkle manifest, conversation repair and repeated byte strings against plain versions and on odd input."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tailrace.llm import merkle, ranks, repair, repeats
from tailrace.llm.tables import Tables

sha = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


# --- places in groups ---------------------------------------------------------------------------------


def test_numbered_groups_span_tasks(spark):
    rows = [(g, i) for g, n in ((None, 3), ("a", 500), ("b", 1), ("c", 40)) for i in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int").repartition(5)
    got = sorted((r.tree, r.pos, r.g, r.i) for r in ranks.numbered(df, ["g"], ["i"], Tables(spark, "t"), "n").collect())
    assert got == [(t, i, g, i) for t, (g, n) in enumerate(((None, 3), ("a", 500), ("b", 1), ("c", 40))) for i in range(n)]


# --- Merkle manifest ----------------------------------------------------------------------------------


def test_sha256_from_states():
    rng = np.random.default_rng(1)
    children = rng.integers(0, 256, (60, 3, 32), np.uint8)
    k = rng.integers(1, 4, 60)
    parents, digests = merkle.parents_of(children, k)
    for i in range(60):
        assert digests[i].tobytes() == hashlib.sha256("".join(c.tobytes().hex() for c in children[i, : k[i]]).encode()).digest()
    slot = np.minimum(rng.integers(0, 3, 60), k - 1)
    new = rng.integers(0, 256, (60, 32), np.uint8)
    changed = children.copy()
    changed[np.arange(60), slot] = new
    assert (merkle.folded(new, merkle.steps_of(parents, slot)) == merkle.parents_of(changed, k)[1]).all()


def plain_manifest(rows):
    by = collections.defaultdict(list)
    for group, doc_id, leaf, replaced in rows:
        by[group].append((doc_id is not None, doc_id or 0, leaf, replaced))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    groups = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(by[g])]) for g in groups}
    top, out = levels([trees[g][-1][0] for g in groups]), []
    for at, g in enumerate(groups):
        for i, (there, doc_id, leaf, now) in enumerate(sorted(by[g])):
            proof = ""
            for tree, place in ((trees[g], i), (top, at)):
                for level in tree[:-1]:
                    run, j = level[place // 3 * 3 : place // 3 * 3 + 3], place % 3
                    proof, now = proof + "".join(run[:j] + run[j + 1 :]), sha(*run[:j], now, *run[j + 1 :])
                    place //= 3
            out.append((doc_id if there else None, leaf, trees[g][-1][0], top[-1][0], sha(proof), now, now == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [{"a": 1}, {None: 1, "a": 2, "ä": 3, "b": 4}, {f"s{i}": 1 + i % 5 for i in range(40)}, {"a": 2187, "b": 2188, "c": 1}])
def test_manifest_equals_plain(spark, sizes):
    rows = [(g, None if i == 0 and n > 2 else i // 2, sha(str(g), str(i // 2)), sha("new", str(i)) if i % 3 else sha(str(g), str(i // 2))) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "group string, doc_id bigint, leaf string, replaced string")
    got = [tuple(r) for r in merkle.manifest(df.withColumn("root", F.lit("x"))).collect()]
    assert sorted(got, key=repr) == plain_manifest(rows)


def test_manifest_of_documents(spark):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf int"
    rows = [(1, None, "de", 3, "ä\nb", 1), (1, None, "de", 3, "ä\nb", 1), (None, "x", None, None, None, 2), (7, "x", "", 0, "", 3), (8, "x", "en", 9, "a\n" * 60000, 4)]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = merkle.documents_manifest(spark.createDataFrame(rows, schema), even).collect()
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    want = []
    for r in rows:
        text = r[4].replace("\n", "") if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[4]
        want.append((r[1], r[0], sha(*map(part, r[:5])), sha(*map(part, (*r[:4], text)))))
    assert sorted(map(tuple, got), key=repr) == plain_manifest(want)
    assert merkle.documents_manifest(spark.createDataFrame([], schema), even).count() == 0


# --- conversation repair ------------------------------------------------------------------------------


def plain_cheapest(rows, start, ends):
    """All least walks, row by row."""

    def closed(walks):
        for state in (repair.NONE, repair.SYSTEM, repair.ASSISTANT, repair.USER):
            if state in walks:
                to, new = (3 if state == 2 else 2), (walks[state][0] + 3, walks[state][1] + "I")
                walks[to] = min(walks.get(to, new), new)
        return walks

    walks = closed({start: (0, "")})
    for initial, must_go, cut in rows:
        after = {}
        for state, (cost, audit) in walks.items():
            options = [(state, 4, "D")]
            if not must_go:
                user = state != repair.USER
                options.append((2 if user else 3, 3 + 3 * cut, "R"))
                if initial == ("u" if user else "a") or (initial == "s" and state == repair.NONE):
                    options.append(({"s": 1, "u": 2, "a": 3}[initial], 3 * cut, "K"))
            for to, more, letter in options:
                new = cost + more, audit + letter
                after[to] = min(after.get(to, new), new)
        walks = closed(after)
    return min((walks[e] for e in ends if e in walks), default=None)


def test_search_finds_the_least_audit():
    rng = random.Random(2)
    for _ in range(3000):
        rows = [(rng.choice("suauax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 9))]
        start, ends = rng.choice([(0, (0, 3)), (0, (2,)), (2, (3,)), (3, (0,)), (1, (1,))])
        assert repair.cheapest(rows, start, ends) == plain_cheapest(rows, start, ends), (rows, start, ends)


def plain_repair(turns):
    """turns: (turn, role, text) in order."""
    blank_of = lambda t: not t.strip(" \t\n\x0b\x0c\r")
    seen, rows, counts = set(), [], collections.Counter()
    for turn, role, text in turns:
        body = text.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[kind] += 1
        rows.append((role[:1], kind in ("blank", "duplicate"), bool(body) and body[-1] not in ".!?"))
    cost, audit = plain_cheapest(rows, 0, (0, 3))
    lines, left, state = [], iter(turns), 0
    for letter in audit:
        _, role, text = next(left) if letter != "I" else (None, None, "")
        if letter in "RI":
            role = "assistant" if state == 2 else "user"
        if letter != "D":
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(f"{role}:{text}")
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(lines))


@pytest.mark.parametrize("block", [512, 3])
def test_repair_equals_plain(spark, block):
    """Also with conversations of many blocks."""
    rng, convs = random.Random(3), {}
    for conv in [None, *range(60)]:
        rows = []
        for turn in range(rng.choice([1, 2, 5, 6, 40])):
            if rng.random() < 0.9:
                rows.append((turn * 2 if rng.random() < 0.1 else turn, rng.choice(["user", "assistant"] * 4 + ["system", "tool", ""]), rng.choice(["Yes.", "no", "What?", " \n", "", "Ends here. \n", f"n{turn}!"])))
        convs[conv] = sorted(rows, key=lambda r: (r[0], r[1], hashlib.sha256(f"{r[1]}:{r[2]}".encode()).digest()))
    data = [(c, *r, "x") for c, rows in convs.items() for r in rows]
    rng.shuffle(data)
    got = repair.repaired(spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string, audit string").repartition(3), block_rows=block).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: plain_repair(rows) for c, rows in convs.items() if rows} and len(got) == sum(map(bool, convs.values()))


def test_repair_of_odd_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    rows = [(1, None, None, None), (1, None, "user", "Hi."), (1, None, "assistant", "x" * 300000 + "."), (2, 5, "user", "gone")]
    got = {r.conv_id: r for r in repair.repaired(spark.createDataFrame(rows, schema), F.col("conv_id") == 1).collect()}
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert (got[1].blank, got[1].gaps, got[1].repaired_sha256) == (1, 0, plain_repair([(None, " ", " "), (None, "assistant", rows[2][3]), (None, "user", "Hi.")])[-1])
    assert repair.repaired(spark.createDataFrame([], schema)).count() == 0


# --- repeated byte strings ----------------------------------------------------------------------------


def plain_removal(texts, length):
    """texts in order; spans that an earlier equal window covers."""
    seen, out = set(), []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            if w in seen:
                gone[i : i + length] = True
            seen.add(w)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
        out.append((list(zip(edges[::2].tolist(), edges[1::2].tolist())), bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def assert_removed(spark, rows, length, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept string").repartition(3)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in repeats.without_repeats(df, length, **options).collect())
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [(t or "").encode() for _, t, _ in rows]
    assert got == sorted((i is not None, i or 0, len(t), spans, kept) for (i, _, _), t, (spans, kept) in zip(rows, texts, plain_removal(texts, length)))


def test_equal_windows_have_equal_numbers():
    rng = random.Random(4)
    for length in (2, 5, 12):
        bodies = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 40))) for _ in range(30)]
        body, place, number = repeats.equal_windows(bodies, length)
        windows = [bodies[b][p : p + length] for b, p in zip(body, place)]
        assert all(len(w) == length for w in windows) and len(windows) == sum(max(0, len(b) - length + 1) for b in bodies)
        assert len(set(zip(windows, number.tolist()))) == len(set(windows)) == len(set(number.tolist()))


@pytest.mark.parametrize("most", [2048, 2])
def test_removal_equals_plain(spark, most):
    """Near copies with one line in common; with room for two surroundings of an anchor, all others are split."""
    rng = random.Random(5)
    line = "".join(rng.choice("abcdé ") for _ in range(25))
    rows = []
    for i in range(80):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))
        text += line[: rng.randint(15, 25)] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 12)))
        rows.append((i, text if i % 7 else rows[-1][1] if rows else text, "x"))
    rows += [(200, "a" * 900, None), (201, None, None), (202, "", None), (203, "ab" * 100, None)]
    assert_removed(spark, rows, 20, most_rows=most)


def test_removal_in_long_texts(spark):
    """A text of several steps that repeats itself, and one that repeats a part of it."""
    rng = random.Random(6)
    part = ["".join(rng.choice("abcdefgh \n") for _ in range(n)) for n in (9000, 300, 5000)]
    assert_removed(spark, [(1, part[0] + part[1] + part[2] + part[1] + part[0][100:7000], ""), (2, part[2][400:4800], ""), (0, "z" + part[1][:150], "")], 100, step=1 << 12)


def test_removal_with_null_and_repeated_ids(spark):
    rows = [(None, "abcdefghij" * 3, ""), (1, "abcdefghijk", ""), (1, "abcdefghijk", ""), (0, "xbcdefghijkl", ""), (2, None, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string").coalesce(1)
    got = sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.kept)) for r in repeats.without_repeats(df, 10).collect())
    # Of the two rows of id 1, the first keeps what only its last window adds; the second is a copy.
    assert got == [(False, 0, b"abcdefghij"), (True, 0, b"xbcdefghijkl"), (True, 1, b""), (True, 1, b""), (True, 2, b"")]
    assert repeats.without_repeats(df.limit(0), 10).count() == 0

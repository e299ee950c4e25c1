"""Nulls, empty and odd texts, repeated rows, empty tables, and columns with names that clash."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tailrace.llm import bpe, decontaminate, kd_shards, lm, near_dup, preference, quality, surrogates, topk, warc
from tailrace.llm.queries import vocabulary
from tailrace.llm.tables import fold

LONG = "one two three four five six seven eight nine ten " * 400
ROWS = [
    (1, "a b c d e f g h i j k", "x", 1), (2, "a b c d e f g h i j k", "x", 1), (2, "a b c d e f g h i j k", "x", 1), (3, None, None, None),
    (4, "", "x", 2), (None, "a b c d e f g h i j k", "y", 3), (5, LONG, "z", 4), (6, "word", "z", 5), (7, " \n\t ", "z", 6),
    (8, "write to jo.x@mail.example.com or +1 (017) 555-7713, Mrs. Anna Smith", "z", 7),
]
SCHEMA = "doc_id bigint, text string, score string, n_entities int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicates(odd, none):
    rows = near_dup.near_duplicates(odd).collect()
    assert near_dup.near_duplicates(none).count() == 0 and len(rows) == len(ROWS)
    found = {r.doc_id: (r.component_id, r.kept) for r in rows}
    assert found[1] == (1, True) and found[2] == (1, False) and found[None] == (1, False)
    assert found[3] == (3, True) and found[4] == (4, True) and found[7] == (7, True)


def test_texts_pass_through(odd, none):
    model, prior = quality.train(odd, odd.select("doc_id"), odd.select("doc_id"))
    scored = quality.scored(odd, model)
    assert scored.columns == ["doc_id", "text", "n_entities", "score", "predicted"] and scored.count() == len(ROWS)
    assert quality.scored(none, quality.train(none, none, none)[0]).count() == 0 and 0 < prior < 1
    items = odd.sparkSession.createDataFrame([(1, "a b c d e f g"), (None, None), (2, ""), (3, "word")], "item_id bigint, text string")
    hits = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, items).collect()}
    assert hits == {(1, 1), (2, 1), (None, 1), (6, 3)}
    assert decontaminate.clean(odd, items).count() == len(ROWS) - 5 and decontaminate.clean(odd, items.limit(0)).count() == len(ROWS)


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "_ITEMS_BYTES", 40)
    texts = [" ".join(f"w{i}x{j}" for j in range(8)) for i in range(9)]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:6])] * 2, "item_id bigint, text string")
    docs = spark.createDataFrame([(i, f"before {t} after") for i, t in enumerate(texts)], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()) == [(i, i) for i in range(6)]
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [6, 7, 8]


def test_items_cut_by_a_text_and_items_shorter_than_a_shingle(spark):
    item = [f"w{j}" for j in range(50)]
    texts = [item[:49], item[1:], item[1:49], item[:48], item[:41], item[:40], "a tiny item".split(), "it has a Tiny, item here a tiny item".split(), "a tiny".split()]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "a tiny item"), (3, "here")], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = {(r.doc_id, r.item_id): (r.first_word, r.n_words, round(r.similarity, 3)) for r in decontaminate.contaminated(docs, items).collect()}
    cut = {(0, 1): (0, 49, 0.978), (1, 1): (0, 49, 0.978), (2, 1): (0, 48, 0.957), (3, 1): (0, 48, 0.957), (4, 1): (0, 41, 0.804)}
    assert rows == cut | {(6, 2): (0, 3, 1.0), (7, 2): (2, 3, 1.0), (7, 3): (5, 1, 1.0)}
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [5, 8]


def test_quality_sample_is_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, None)], "doc_id bigint, text string")
    assert quality._sampled(docs, docs.select("doc_id").distinct()).shape == (2, quality.SIZE)


def test_surrogates_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame([(i, f"mail to person{i}@site{i % 3}.org" if i % 2 else "nothing") for i in range(60)], "doc_id bigint, text string")
    first, second = ({r.doc_id: r.text for r in surrogates.surrogated(docs.repartition(n), "k").collect()} for n in (1, 7))
    assert first == second and len(set(first.values())) == 31


def test_bpe_round_trip(odd, none):
    coded = bpe.encode(odd, vocabulary())
    back = [(r.doc_id, r.text) for r in bpe.decode(coded, vocabulary()).collect()]
    assert sorted(back, key=repr) == sorted(((i, t or "") for i, t, *_ in ROWS), key=repr) and bpe.encode(none, vocabulary()).count() == 0


def test_transducer_equals_whole_merge():
    for seed in range(60):
        rng = random.Random(seed)
        tokens, pairs, pool = {bytes([b]): b for b in range(256)}, [], [b"a", b"b", b"c"]
        for _ in range(rng.randrange(1, 14)):
            a, b = rng.choice(pool), rng.choice(pool)
            if a + b not in tokens and len(a + b) < 8:
                tokens[a + b] = len(tokens)
                pairs.append((a, b))
                pool.append(a + b)
        merges = bpe.Merges(tokens, pairs)
        text = bytes(rng.choice(b"abc") for _ in range(3 * bpe._BLOCK))
        run, out = bpe.Transducer(merges, merges.lookahead()), []
        for a in range(0, len(text), 997):
            out += run.feed(text[a : a + 997])
        assert out + run.close() == merges.long(text)
        assert merges.long(text[:50]) == merges.short(text[:50])


def test_language_model(odd, none):
    assert lm.scores(none, fold(parts=10) == 0).count() == 0
    rows = {r.doc_id: r for r in lm.scores(odd, fold(parts=10) == 0).collect()}
    assert rows[3].n_tokens == rows[4].n_tokens == rows[7].n_tokens == 1 and rows[3].score == pytest.approx(rows[4].score)


def test_language_model_of_words_within_classes(spark):
    pairs = [(f"a{i}", f"b{(7 * i) % 60}") for i in range(60)]
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, " ".join(w for _ in range(20) for w in rng.choice(pairs))) for i in range(1200)], "doc_id bigint, text string")
    rows = lm.scores(docs, F.col("doc_id") % 10 == 0, classes=12).where("held_out").collect()
    gain = (sum(r.score for r in rows) - sum(r.base_score for r in rows)) / sum(r.n_tokens for r in rows)
    assert gain > 0.5  # which word comes second is certain; knowing no more than classes gives little


def test_language_model_is_normalised():
    n = np.sort(np.random.default_rng(1).integers(1, 50, 23))[::-1]
    words = lm.Vocabulary(np.arange(23, dtype=np.uint64), np.arange(23) + 1, n, 4, np.full(7, 1 / 7), int(n.sum()) + 5, 25, 5, 2)
    model = lm.Model(words)
    model.train(np.arange(25 * 24 * 3), np.arange(25 * 24 * 3) % 9 + 1, np.random.default_rng(2))
    every = np.arange(24)
    for c1, c2 in ((24, 24), (3, 0), (0, 22)):
        assert (10 ** model.log_probs(np.full(24, c1), np.full(24, c2), every)).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_does_not_depend_on_files(spark, monkeypatch):
    monkeypatch.setattr(lm, "_GROUP_TOKENS", 2000)
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(40))) for i in range(600)], "doc_id bigint, text string")
    few, many = ({r.doc_id: r.score for r in lm.scores(docs.repartition(n), F.col("doc_id") % 10 == 0, classes=8).collect()} for n in (2, 13))
    assert few == pytest.approx(many, rel=1e-4)


def test_language_model_equals_a_plain_softmax():
    """Probabilities from a loop over words in double precision, also where logits are beyond what single precision can sum."""
    n = np.sort(np.random.default_rng(4).integers(2, 50, 21))[::-1]
    words = lm.Vocabulary(np.arange(21, dtype=np.uint64), np.arange(21) + 1, n, 4, np.full(7, 1 / 7), int(n.sum()) + 5, 23, 5, 2)
    model, every = lm.Model(words), np.arange(22)
    model.train(np.arange(23 * 22 * 4), np.arange(23 * 22 * 4) % 7 + 1, np.random.default_rng(5))
    for scale in (1, 400):
        model.parts[3], model.parts[4] = model.parts[3] * np.float32(scale), model.parts[4] * np.float32(scale)
        e, m1, m2, qc, qw = (p.astype(float) for p in model.parts)
        for c1, c2 in ((22, 22), (4, 0), (0, 17)):
            r = np.append(e[c1] * m1[:, 0] + e[c2] * m2[:, 0], 1)
            got = model.log_probs(np.full(22, c1), np.full(22, c2), every)
            for w in every:
                own = (w + 3) // 4
                logit = [r @ q for q in qc]
                want = logit[own] - np.logaddexp.reduce(logit)
                if w:
                    inside = [r @ q for q in qw[(own - 1) * 4 : own * 4]]
                    want += inside[(w - 1) % 4] - np.logaddexp.reduce(inside)
                assert got[w] == pytest.approx(want / np.log(10), abs=2e-3, rel=1e-4)


def test_top_k(spark):
    v = [(20, [1.0, 0.5]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [1.0]), (None, [1.0, 1.0])]
    vectors = topk.quantized(spark.createDataFrame(v, "vec_id bigint, embedding array<float>"))
    rows = topk.top_k(vectors, vectors.where("vec_id % 20 = 0")).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in rows] == [(20, 1, 1, 64 * 64 + 32 * 32), (20, 2, 1, 64 * 64 + 32 * 32)]
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_warc(spark):
    pages = [(2, None, b"same"), (1, "u", b"same"), (1, "u", b"same"), (None, "u", b"same"), (3, "u", None), (4, "u", bytes(range(256)) * 9000)]
    pages = spark.createDataFrame([(p, u, bytearray(b) if b is not None else None) for p, u, b in pages], "page_id bigint, url string, payload binary")
    manifest, chunks = warc.archived(pages)
    last = chunks.where("last").collect()
    assert len(last) == 6 and all(r.digest == r.declared_digest for r in last)
    assert sum(r.record_type == "response" for r in last) == 3 and {r.refers_to for r in last} == {None, 1}
    big = warc.read_chunks(manifest, 1 << 16).where("page_id = 4").orderBy("chunk").collect()
    assert b"".join(r.content for r in big) == bytes(range(256)) * 9000 and max(len(r.content) for r in big) <= 1 << 16
    assert warc.archived(pages.limit(0))[1].count() == 0


def test_shards(odd, none):
    rows = kd_shards.kd_shards(odd, [F.octet_length("text")], shards=2).collect()
    assert len(rows) == len(ROWS) and {r.shard for r in rows} <= {0, 1}
    assert kd_shards.kd_shards(none, [F.octet_length("text")], shards=4).count() == 0


def test_surrogates(odd, none):
    rows = {r.doc_id: r for r in surrogates.surrogated(odd, "k").collect()}
    assert surrogates.surrogated(none, "k").count() == 0 and len(rows) == 9
    new = rows[8].text
    assert rows[8].n_entities == 3 and "jo.x" not in new and "Anna" not in new and "+1 (" in new and "Mrs. " in new
    assert rows[3].text is None and rows[5].text == LONG


def test_preferences(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "good"), (1, 1, "assistant", "good"), (0, 0, "user", None), (None, 0, "user", "x"), (4, None, None, "<|user|>")]
    pairs = preference.mismatched(preference.conversations_of(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")))
    rows = {r.conv_id: r for r in preference.preference_pairs(pairs).collect()}
    assert set(rows) == {0, 1, 4} and rows[1].n_common == 1 and rows[1].prompt == "<|user|>\nq<|end|>\n"
    s = rows[1].chosen_mask[0]
    assert rows[1].chosen_text[s.start : s.end] == "good<|end|>" and rows[4].chosen_text == "<||>\n< |user|><|end|>\n"


def test_components(spark):
    from tailrace.llm.graph import components
    from tailrace.llm.tables import Tables

    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    rows = components(spark.createDataFrame(chain, "a bigint, b bigint"), Tables(spark, uuid.uuid4().hex)).collect()
    assert all(r.root == (0 if r.node <= 40 else 100) for r in rows) and len(rows) == 41 + 60 - 2


def test_sums_and_lookups_of_the_language_model(monkeypatch):
    rng = np.random.default_rng(5)
    n = np.sort(rng.integers(2, 90, 5000))[::-1]
    hashes = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2) >> np.uint64(3))  # eight times as dense
    numbers = rng.permutation(hashes.size) + 1
    n = n[: hashes.size]
    words = lm.Vocabulary(hashes, numbers, n, 300, np.full(18, 1 / 18), int(n.sum()) + 5, hashes.size + 3, 5, 3)
    tokens = np.concatenate((rng.choice(hashes, 3000), hashes + np.uint64(1), np.array([0, (1 << 64) - 1], np.uint64)))
    at = {int(h): int(i) for h, i in zip(hashes, numbers)}
    assert words.number(tokens).tolist() == [at.get(int(t), 0) for t in tokens]

    model = lm.Model(words)
    u = np.concatenate((model.until[:-1], model.until[1:] - 1, rng.integers(0, model.until[-1], 999)))
    want = np.searchsorted(model.until, u, "right") - 1
    assert (model._word_at(u, want // 300 * 300) == want).all()

    rows = np.sort(np.minimum(rng.geometric(0.02, 4000), 97))
    order, g = rng.permutation(rows.size), rng.normal(size=(rows.size, 3))
    start = np.flatnonzero(np.diff(rows, prepend=-1))
    times = np.diff(np.append(start, rows.size))
    assert np.allclose(lm._run_sums(g, order, start, times), np.add.reduceat(g[order], start))

    # A context that many words of a class follow is summed over the class once.
    summed, log_sums = [], lm._log_sums
    monkeypatch.setattr(lm, "_log_sums", lambda r, q, room: summed.append(len(r)) or log_sums(r, q, room))
    c1 = rng.integers(1, 4, 2000)
    word = rng.integers(1, 301, 2000)
    each = model.log_probs(c1, c1, word)
    assert sum(summed) == 6
    assert np.allclose(each[:50], [model.log_probs(c1[i : i + 1], c1[i : i + 1], word[i : i + 1])[0] for i in range(50)], atol=1e-5)


def test_shuffles_of_tables_read_once_are_removed(spark):
    import glob
    import time

    from tailrace.llm.tables import Tables

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    held = lambda: {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    tables, rows = Tables(spark, "once"), spark.range(5000)
    before = held()
    tables.keep(rows.repartition(3, "id"), "kept")
    kept = held() - before
    assert kept
    once = tables.keep(rows.repartition(5, "id"), "once", once=True)
    end = time.time() + 20
    while held() - before - kept and time.time() < end:
        time.sleep(0.1)
    assert not held() - before - kept
    assert once.count() == 5000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"

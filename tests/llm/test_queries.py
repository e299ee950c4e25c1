"""The registered queries against SQL, and where SQL cannot express them, against plain versions."""

import collections
import hashlib
import json
import math
import re
import zlib

import numpy as np
import oracle
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tailrace.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, name):
    oracle.assert_same(QUERIES[name](spark, sf), oracle.connect(sf), ORACLES[name])


def test_quality_on_held_out_labels(spark, sf):
    found = {r.doc_id: r for r in QUERIES["op1_quality_pu"](spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if found[r.doc_id].held_out]
    assert all(f.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, f in found.items())
    good = [found[r.doc_id].score for r in labels if r.quality == 1]
    bad = [found[r.doc_id].score for r in labels if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.8


def test_shards_are_even_and_slots_gapless(spark, sf, docs):
    rows = QUERIES["op4_kd_shards"](spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r.size == len(docs[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    sizes = [sum(r.size for r in by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)
    assert all(sorted(r.slot for r in g) == list(range(len(g))) for g in by.values())


def test_bpe_equals_library(spark, sf, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in QUERIES["op6_bpe"](spark, sf).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_language_model_scores(spark, sf, docs):
    rows = QUERIES["op7_log_bilinear"](spark, sf).collect()
    tokens = {i: [*words(t), None] for i, t in docs.items()}
    c = collections.Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    floor = math.log10(c.total() + 0.1 * (len(c) + 1))
    for r in rows:
        ws = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), c.total())
        assert r.base_score == pytest.approx(sum(math.log10(c[w] + 0.1) - floor for w in ws))
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_contaminated_documents(spark, sf, docs):
    """Every item that stands in a text word by word is found; what is found is similar on plain counting."""
    plain = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower() if t.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), t))
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    texts = {i: plain(t) for i, t in docs.items()}
    rows = QUERIES["op10_decontamination"](spark, sf).collect()
    exact = {(d, i) for d, t in texts.items() for i, w in items.items() if f" {' '.join(w)} " in f" {' '.join(t)} "}
    assert exact <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        window, item = texts[r.doc_id][r.first_word : r.first_word + r.n_words], items[r.item_id]
        a, b = (collections.Counter(tuple(x[j : j + 5]) for j in range(len(x) - 4)) for x in (window, item))
        assert r.similarity == pytest.approx((a & b).total() / (a | b).total()) and r.similarity >= 0.8


def test_personal_data(spark, sf, docs):
    rows = QUERIES["op5_pii_surrogates"](spark, sf).collect()
    assert len(rows) == len(docs)
    seen = {}
    for r in rows:
        before, after = docs[r.doc_id], r.text or ""
        if not r.n_entities:
            assert before == after
            continue
        for m in re.findall(r"\b\d{16}\b|\b\d+\.\d+\.\d+\.\d+\b|[\w.]+@[\w.]+\w", before):
            assert m not in after
        pairs = zip(re.findall(r"\b\d{16}\b", before), re.findall(r"\b\d{16}\b", after))
        for a, b in pairs:
            assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen)


def test_pipeline(spark, sf, docs):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, sf).collect()
    assert 0 < len(rows) < len(docs) and {r.doc_id for r in rows} <= set(docs)
    assert len({r.doc_id for r in rows}) == len(rows) and all(r.n_tokens == len(r.ids) for r in rows)
    assert json.dumps([n for n, _ in corpus_pipeline.STAGES])

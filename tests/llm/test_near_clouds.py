"""Large groups of texts that differ from each other by about as much as a link allows."""

import random

import numpy as np

from tailrace.llm import near_dup
from tailrace.llm.words import Words, shingle_hashes, utf8


def cloud(n, words=120, changed=2, seed=1):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    texts = []
    for _ in range(n):
        text = list(base)
        for at in rng.sample(range(words), changed):
            text[at] = f"x{rng.randrange(8)}"
        texts.append(" ".join(text))
    return texts


def plain_components(texts, k):
    sets = [frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for w in (t.split() for t in texts)]
    names = {s: i for i, s in enumerate({s for ss in sets for s in ss})}
    table = np.zeros((len(sets), len(names)), np.float32)
    for i, s in enumerate(sets):
        table[i, [names[x] for x in s]] = 1
    common, size = table @ table.T, table.sum(1)
    linked = 100 * common >= 80 * (size[:, None] + size[None] - common)
    root = np.arange(len(sets))
    while True:
        low = np.where(linked, root[None], len(sets)).min(1)
        if (low == root).all():
            return root.tolist()
        root = low


def test_clouds_equal_plain_components(spark, monkeypatch):
    counts = []
    missed = near_dup._missed

    def counted(*args):
        found = missed(*args)
        counts.append(found.count())
        return found

    monkeypatch.setattr(near_dup, "_missed", counted)
    texts = cloud(2000, changed=3)
    rows = near_dup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), k=4).collect()
    assert [r.component_id for r in sorted(rows)] == plain_components(texts, 4)
    assert sum(counts) < 5 * len(texts), counts


def test_parities_bound_the_difference():
    import pyarrow as pa

    found = Words(*utf8(pa.array(cloud(40, changed=3))))
    h, first = shingle_hashes(found.hashes, found.first, 4)
    sets = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:])]
    for a, b in zip(sets, sets[1:]):
        differ = sum(int(x).bit_count() for x in near_dup.parities(a) ^ near_dup.parities(b))
        assert differ <= np.setxor1d(a, b).size


def test_few_meetings_need_no_further_stars(spark, monkeypatch):
    """Groups of similar texts that share a bucket with others: the exact step alone finds what the first hubs missed."""
    stars = []
    star = near_dup._star
    monkeypatch.setattr(near_dup, "_star", lambda *args: stars.append(args) or star(*args))
    texts = [t.replace("w", f"g{g}w") if g else t for g in range(4) for t in cloud(12, changed=4, seed=g)]
    rows = near_dup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), k=4).collect()
    assert [r.component_id for r in sorted(rows)] == plain_components(texts, 4)
    assert not stars


def test_components_stop_at_stars(spark, monkeypatch):
    """Edges that are stars already take one step, not a second one to see that nothing changed."""
    from tailrace.llm import graph
    from tailrace.llm.tables import Tables

    steps = []
    step = graph._stars
    monkeypatch.setattr(graph, "_stars", lambda *args: steps.append(args) or step(*args))
    edges = spark.createDataFrame([(i, i % 5) for i in range(5, 60)], "a bigint, b bigint")
    rows = graph.components(edges, Tables(spark, "stop-at-stars")).collect()
    assert sorted(map(tuple, rows)) == [(i, i % 5) for i in range(5, 60)]
    assert len(steps) == 2
    chain = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 21), (22, 21)], "a bigint, b bigint")
    rows = graph.components(chain, Tables(spark, "stop-at-stars")).collect()
    assert sorted(map(tuple, rows)) == [(i, 0) for i in range(1, 10)] + [(21, 20), (22, 20)]

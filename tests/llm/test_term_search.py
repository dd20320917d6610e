"""Ranked search against scoring every document, pruning, blocks and edges."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from courtside.llm import term_search
from courtside.llm.term_search import Shard, search, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    own = [(i, Counter(brute_terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, n_words = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    queries = {}
    for i, t in items:
        queries.setdefault(i, Counter()).update(brute_terms(t))
    out = []
    for item, q in queries.items():
        scores = []
        for i, c in own:
            m = 25 + 75 * sum(c.values()) * n_docs // n_words
            s = sum(x * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, x in q.items() if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def words(rng, n):
    return " ".join(f"w{min(int(rng.paretovariate(0.6)), 400)}" for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    docs = [(i, words(rng, rng.choice((3, 30, 200)))) for i in range(250)]
    docs += [(250 + i, docs[7][1]) for i in range(15)] + [(300, None), (301, ""), (302, "...!"), (None, "W3 W5"), (5, "w1 w9"),
             (303, "Ünï w3_w5/w9 日本 W7"), (304, words(rng, 20_000))]
    items = [(i, words(rng, 25)) for i in range(12)] + [(50, None), (51, "absent words"), (52, "w1"), (53, "日本 Ünï w9 w9"), (52, "w3")]
    return docs, items


def run(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id bigint, text string, score double").repartition(4)
    q = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in search(d, q, k).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_equals_scoring_everything(spark, tables):
    assert run(spark, *tables) == brute(*tables, 10)
    assert run(spark, *tables, k=1) == brute(*tables, 1)


def test_small_shards_blocks_and_slices(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(term_search, "BLOCK_TERMS", 60)  # several blocks of queries; the driver cuts them
    assert run(spark, docs, items) == brute(docs, items, 10)
    text = "Abc dé,f 12 " * 9
    whole = [t for part in terms(text.encode()) for t in part]
    monkeypatch.setattr(term_search, "SLICE", 5)
    assert [t for part in terms(text.encode()) for t in part] == whole == [t.encode() for t in brute_terms(text)]


def test_pruning_keeps_the_best_exactly():
    rng = np.random.default_rng(5)
    closed = 0
    for _ in range(60):
        n, t = 300, 12
        held = rng.random((n, t)) < np.linspace(0.01, 0.9, t)
        times = rng.integers(1, 4, (n, t)) * held
        doc, term = np.nonzero(held)
        shard = Shard(doc, term, times[doc, term], np.full(n, 100), t)
        query = [(i, int(w)) for i, w in enumerate(np.linspace(9000, 10, t))]
        full = sum(w * np.where(held[:, i], 10**9 * times[:, i] // (1000 * times[:, i] + 800), 0) for i, w in query)
        want = sorted((-s, i) for i, s in enumerate(full.tolist()) if s)[:5]
        got = shard.best(query, 5, 0)
        assert list(zip((-got[0]).tolist(), got[1].tolist())) == want
        closed += int((shard.acc > 0).sum() < (full > 0).sum())
        floor = -want[2][0]
        got = shard.best(query, 5, floor)
        assert list(zip((-got[0]).tolist(), got[1].tolist()))[:3] == want[:3]
    assert closed > 30  # accumulators were really saved


def test_empty(spark, tables):
    assert run(spark, [], tables[1]) == [] and run(spark, tables[0], []) == []

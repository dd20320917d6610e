"""PPM scores against a trie of plain dictionaries, base scores against counting."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import ppm
from courtside.llm.common import crc_mod
from courtside.llm.ppm import ContextTrie, FixedTrie, adaptive_score, gram_counts, score


def texts(rng, n):
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6))) for _ in range(30)]
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) + rng.choice(["", ".", "\n"]) for _ in range(n)]
    return [*out, None, "", " ", "ZZ new Ünknown 日本", "a" * 3000]


def brute(rows, order):
    fold = lambda i: zlib.crc32((str(i) if i is not None else "").encode()) % 7 == 2
    trie, words, n_train = ContextTrie(order), Counter(), 0
    for i, t in rows:
        if not fold(i):
            raw = (t or "").encode().lower()
            words.update(raw.split())
            n_train += 1
            context = (ppm.START,) * order
            for s in (*raw, ppm.END):
                trie.update(context, s)
                context = (*context, s)[1:] if order else ()
    total, kinds = sum(words.values()) + n_train, len(words) + (n_train > 0)
    out = []
    for i, t in rows:
        raw = (t or "").encode().lower()
        counts = [words[w] for w in raw.split()] + [n_train]
        out.append((i, fold(i), len(counts), sum(c > 0 for c in counts), total,
                    sum(math.log10((c + 1) / (total + kinds + 1)) for c in counts), trie.read(raw, learn=False)))
    return out


@pytest.mark.parametrize("order,max_words", [(4, 1 << 17), (2, 5), (0, 0)])
def test_scores(spark, order, max_words):
    rng = random.Random(order)
    rows = [(i, t) for i, t in enumerate(texts(rng, 60))] + [(None, "aé b"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, score string")
    got = score(docs, crc_mod(F.col("doc_id"), 7) != 2, order, max_words=max_words).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    want = sorted(brute(rows, order), key=key)
    got = sorted((tuple(r) for r in got), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


@pytest.mark.parametrize("max_grams", [0, 150])
def test_order_stays_with_few_broadcast_grams(spark, max_grams):
    """Grams beyond the broadcast bound are settled by joins: the same scores of order 4."""
    rows = list(enumerate(texts(random.Random(8), 60)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(map(tuple, score(docs, crc_mod(F.col("doc_id"), 7) != 2, max_grams=max_grams).collect()))
    want = sorted(brute(rows, 4))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_probabilities_sum_to_one():
    rng = random.Random(0)
    trie = ContextTrie(3)
    for t in texts(rng, 20):
        trie.read((t or "").encode())
    for context in [(97, 98, 99), (32, 97, 98), (1, 2, 3), (ppm.START,) * 3]:
        assert math.isclose(sum(10 ** trie.cost(context, s) for s in range(ppm.SYMBOLS)), 1, rel_tol=1e-9)


def test_blocks_and_trained_grams(spark, monkeypatch):
    rng = random.Random(6)
    rows = [((t or "").encode(),) for t in texts(rng, 40)]
    frame = spark.createDataFrame([(r[0].decode(),) for r in rows], "text string")
    for order in (0, 2, 4):
        held = gram_counts(frame, order).toArrow()
        keys, counts = held.column("g").to_numpy(), held.column("n").to_numpy()
        assert len(set(keys.tolist())) == len(keys)
        assert counts.sum() == sum(len(r[0]) + 1 for r in rows)  # each symbol and end once
    trie = FixedTrie(order, keys, counts)
    raws = [r[0].lower() for r in rows]
    whole = trie.scores(raws)
    monkeypatch.setattr(ppm, "BLOCK", 37)
    assert np.allclose(trie.scores(raws), whole, rtol=1e-12)


def test_adaptive_and_empty(spark):
    docs = spark.createDataFrame([(1, "abababababab"), (2, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in adaptive_score(docs).collect()}
    assert got[2] == pytest.approx(-math.log10(257))
    assert got[1] > 13 * -math.log10(257)
    assert score(docs.limit(0), F.lit(True)).count() == 0
    none = score(docs, F.lit(False)).collect()
    assert [r["score"] for r in none if r["doc_id"] == 2] == [pytest.approx(-math.log10(257))]
    assert all(r["held_out"] and r["n_known"] == 0 and r["base_score"] == 0 for r in none)

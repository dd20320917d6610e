"""Collocations against counting every phrase, shards, hashes and edges."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import collocations as C
from courtside.llm.collocations import BidirectionalIndex, collocations


def brute_pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split("[\x20\x09]+", p) if w] for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def brute(rows, least, top, cover=50):
    f = defaultdict(Counter)
    for lang, text in rows:
        for w in brute_pieces(text):
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(x for g, x in c.items() if len(g) == 1)
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        best = []
        for g, a in cand.items():
            if any(len(h) > len(g) and 100 * x >= cover * a and g in (h[:2], h[1:]) for h, x in cand.items()):
                continue
            score, k = min((10**6 * a * a // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
            best.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    names = [f"w{i}" for i in range(25)] + ["Ünder", "日本"]
    out = []
    for i in range(220):
        text = "".join(rng.choice(names) + rng.choice((" ", " ", " ", "\t ", ", ", ".\n", "  "))
                       for _ in range(rng.choice((1, 12, 60))))
        text += rng.choice(("", " New York city!", " new york;", " of the day. of the"))
        out.append((["en", "de", None, "und"][i % 4], text))
    return out + [("en", None), ("en", ""), (None, " .,! "), ("fr", "x y z " * 30)] + out[:20]


def run(spark, rows, **settings):
    d = spark.createDataFrame([(a, t, 3) for a, t in rows], "lang string, text string, rank int").repartition(3)
    got = collocations(d, **settings)
    return sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_equals_counting_everything(spark, rows):
    assert run(spark, rows) == brute(rows, 10, 2000)
    assert run(spark, rows, min_count=2, top=7, cover=80) == brute(rows, 2, 7, 80)


def test_index_intervals():
    rng = np.random.default_rng(1)
    s = rng.integers(0, 5, 400).astype(np.int32)
    index = BidirectionalIndex(s, 5)
    cyc = [tuple(np.roll(s, -i)[:3].tolist()) for i in range(len(s))]
    left, right, begin, count = index.pairs()
    assert Counter(t[:2] for t in cyc) == dict(zip(zip(left.tolist(), right.tolist()), count.tolist()))
    which, first, n = index.triples(begin, count)
    assert Counter(cyc) == {(a, int(left[i]), int(right[i])): x for i, a, x in zip(which.tolist(), first.tolist(), n.tolist())}


@pytest.mark.parametrize("overlap", [0, 1, 2])
def test_each_phrase_lies_in_one_shard(monkeypatch, overlap):
    import pyarrow as pa

    text = "a b c d. e f a b c a b. c a b c d e f " * 5
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array([text, text])], names=["lang", "text"])
    monkeypatch.setattr(C, "SHARD_WORDS", 7)
    monkeypatch.setattr(C, "SLICE", 9)
    found = Counter()
    for numbers, names in C._shards(iter([batch]), overlap):
        word = [b"."if i < 0 else names[i][1] for i in numbers.tolist()]
        found.update(tuple(word[i:i + overlap + 1]) for i in range(len(word) - overlap))
    pieces = [p for p in brute_pieces(text) if p] * 2
    want = Counter(tuple(x.encode() for x in p[i:i + overlap + 1]) for p in pieces for i in range(len(p) - overlap))
    assert {g: x for g, x in found.items() if b"." not in g} == want


def test_exact_products():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    a, left, right = 3_000_000_019, 3_000_000_021, 9_000_000_000
    got = spark.range(1).select(C._score(F.lit(a), F.lit(left), F.lit(right))).first()[0]
    assert got == 10**6 * a * a // (left * right)


def test_meeting_hashes_take_the_next_seed(spark, rows, monkeypatch):
    real, seeds = C._count_words, []

    def count(frame, seed):
        seeds.append(seed)
        return real(frame, seed).withColumn("h", F.lit(1).cast("long")) if seed == 0 else real(frame, seed)

    monkeypatch.setattr(C, "_count_words", count)
    assert run(spark, rows) == brute(rows, 10, 2000) and seeds == [0, 1]


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(None, None), ("en", "one word")]) == []

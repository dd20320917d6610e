"""Repeated words and bytes against brute force over all windows."""

import random
from collections import defaultdict

import pytest

from courtside.llm.automaton_dedup import SuffixAutomaton, remove_repeated_words
from courtside.llm.automaton_dedup import judge as automaton_judge
from courtside.llm.suffix_dedup import remove_repeated_bytes, repeated_starts, suffix_array


def test_suffix_array_is_sorted_order():
    rng = random.Random(1)
    for n in [0, 1, 2, 3, 5, 8, 20, 60, 200]:
        for k in (1, 2, 3, 10):
            for _ in range(30):
                t = [rng.randrange(1, k + 1) for _ in range(n)]
                assert suffix_array(t) == sorted(range(n), key=lambda i: t[i:]), t
    t = [1, 2] * 300 + [3] * 200
    assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def test_matching_statistics():
    rng = random.Random(2)
    for _ in range(200):
        parts = [[rng.choice("ab") for _ in range(rng.randrange(0, 12))] for _ in range(3)]
        shard = SuffixAutomaton()
        for p in parts:
            shard.add(p)
        held = {"".join(p[i:j]) for p in parts for i in range(len(p)) for j in range(i + 1, len(p) + 1)}
        t = "".join(rng.choice("abc") for _ in range(15))
        want = [max([n for n in range(i + 2) if n == 0 or t[i + 1 - n:i + 1] in held]) for i in range(len(t))]
        assert list(shard.statistics(t)) == want


def test_repeated_starts_with_and_without_spaces():
    rng = random.Random(3)
    for alphabet in ("ab ", "abcdefgh", " ", "a", "ab\n c"):
        for _ in range(40):
            pool = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(3)]
            texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 5))).encode() for _ in range(5)]
            texts = [t for t in texts if len(t) >= 8] or [b"12345678"]
            seen = defaultdict(int)
            for t in texts:
                for i in range(len(t) - 7):
                    seen[t[i:i + 8]] += 1
            got = repeated_starts(texts, [len(t) - 7 for t in texts], 8)
            assert [g.tolist() for g in got] == [[seen[t[i:i + 8]] > 1 for i in range(len(t) - 7)] for t in texts]


@pytest.mark.parametrize("shard_words", [1, 30, 10**6])
def test_shards_in_any_cut(shard_words):
    rng = random.Random(shard_words)
    for _ in range(60):
        rows = sorted((rng.randrange(4), " ".join(rng.choice("ab") for _ in range(rng.randrange(5, 12)))) for _ in range(7))
        group = [(1, k, doc, True, 0, piece.encode()) for k, (doc, piece) in enumerate(rows)]
        got = sorted((s, b + i) for _, s, b, n in automaton_judge(5, shard_words)(group) for i in range(n))
        want = sorted((k, i) for k, (d, t) in enumerate(rows) for i in range(len(t.split()) - 4)
                      if any(" ".join(t.split()[i:i + 5]) in u for e, u in rows if e < d))
        assert got == want


def corpus(rng, words, n_docs, vocabulary=4000):
    """Texts with copies, near copies, shared passages, periodic and long texts, NULL and empty ones."""
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(words + rng.randrange(0, 2 * words))] for _ in range(4)]
    texts = []
    for _ in range(n_docs):
        parts = [word() for _ in range(rng.randrange(0, 3 * words))]
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = rng.choice(passages)
        if texts and rng.random() < 0.4:  # a near copy
            parts = (rng.choice(texts) or "").split()
            for _ in range(rng.randrange(0, 4)):
                if parts:
                    parts[rng.randrange(len(parts))] = word()
        texts.append(rng.choice([" ", " ", "\n", "\t "]).join(parts))
    return [*texts, None, "", " ", "x " * 300, "x " * 280 + "y", "ab" * 700, "é" * 500, "ab" * 650]


def brute_words(rows, length):
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - length + 1):
            k = tuple(w[i:i + length])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < d:
                gone |= set(range(i, i + length))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out)


def brute_bytes(rows, length):
    seen = defaultdict(int)
    for _, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] += 1
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("max_units", [1_000_000, 300])
def test_words_against_brute_force(spark, max_units):
    rng = random.Random(7)
    rows = [(i, t) for i, t in enumerate(corpus(rng, 50, 60))]
    rng.shuffle(rows)
    rows += [rows[3], (rows[5][0], rows[6][1])]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, n bigint")
    got = remove_repeated_words(docs, 50, max_units=max_units)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept").collect()) == brute_words(rows, 50)
    for r in got.collect():
        assert sum(s["end"] - s["begin"] for s in r["spans"]) == r["n_removed"]


@pytest.mark.parametrize("max_units", [1_000_000, 300])
def test_bytes_against_brute_force(spark, max_units):
    rng = random.Random(8)
    rows = [(i, t) for i, t in enumerate(corpus(rng, 60, 40))]
    rng.shuffle(rows)
    rows += [rows[3], (rows[5][0], rows[6][1])]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, rk bigint")
    got = remove_repeated_bytes(docs, 400, max_units=max_units)
    assert sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()) == brute_bytes(rows, 400)


def test_null_ids_and_empty_tables(spark):
    text = " ".join(f"v{i}" for i in range(160))
    docs = spark.createDataFrame([(None, text), (4, text), (None, text)], "doc_id bigint, text string")
    assert sorted(r["n_removed"] for r in remove_repeated_words(docs).collect()) == [0, 160, 160]
    assert sorted(r["n_removed"] for r in remove_repeated_bytes(docs).collect()) == [len(text)] * 3
    assert remove_repeated_words(docs.limit(0)).count() == remove_repeated_bytes(docs.limit(0)).count() == 0


def test_a_large_anchor_table_is_tested_by_bits_before_the_shuffle(spark, monkeypatch):
    """pipeline: suffix_dedup shuffled every segment once the table of shared anchors passed BROADCAST_BYTES."""
    from courtside.llm import repeats

    segs = spark.range(-500, 500).selectExpr("id doc", "id * 70460292543863 a", "xxhash64(id) s").union(
        spark.range(-500, 500).selectExpr("id doc", "xxhash64(id) a", "id s"))
    shared = segs.where("doc % 10 = 0").select("a").distinct()
    want = sorted(map(tuple, segs.join(shared, ["a"]).select(segs.columns).collect()))
    for limit, words in ((1 << 20, 1 << 19), (0, 1 << 19), (0, 4)):  # broadcast; bits; bits that are nearly all set
        monkeypatch.setattr(repeats, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(repeats, "FILTER_WORDS", words)
        out = repeats.sharing(segs, shared)
        assert sorted(map(tuple, out.select(segs.columns).collect())) == want
        assert ("bit_or" in out._jdf.queryExecution().optimizedPlan().toString()) == (limit == 0)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_rows_without_a_partner_are_told_before_the_shuffle(spark, monkeypatch, how):
    """pipeline: suffix_dedup shuffled every text for the joins with the pieces asked of them and with their ranges."""
    from pyspark.sql import functions as F

    from courtside.llm import repeats

    docs = spark.range(-300, 300).selectExpr("id % 200 doc", "xxhash64(id) rk", "cast(id as string) text")
    docs = docs.union(docs.where("doc = 7")).union(spark.sql("SELECT NULL, 5L, 'none'"))
    small = docs.where("doc % 10 = 0 OR doc IS NULL").select("doc", "rk", F.array("rk").alias("q")).distinct()
    want = sorted(map(repr, map(tuple, docs.join(small, ["doc", "rk"], how).collect())))
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", 0)
    for words in (1 << 19, 4):  # few false hits; bits that are nearly all set
        monkeypatch.setattr(repeats, "FILTER_WORDS", words)
        out = repeats.join_small(docs, small, ["doc", "rk"], how, F.lit(100), repeats._text_hash())
        assert out.columns == ["doc", "rk", "text", "q"] and sorted(map(repr, map(tuple, out.collect()))) == want
    monkeypatch.setattr(repeats, "FILTER_WORDS", 1 << 19)
    sent = repeats.likely(docs, small, repeats._text_hash()).where("__likely")
    assert sent.count() == docs.where("doc % 10 = 0 OR doc IS NULL").count()

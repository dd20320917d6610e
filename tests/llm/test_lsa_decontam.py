"""Benchmark decontamination: planted copies and paraphrases, LCS and products against brute force."""

import random

import numpy as np

from courtside.llm import lsa_decontam
from courtside.llm.common import table
from courtside.llm.lsa_decontam import (candidates, contaminated, document_frequency, gram_product, holds_answer, latent_space,
                                        lcs_length, masks_of, term_places, without_leaks, words_of)

SF = "/root/testdata/sf0.01"


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_lcs_and_answers():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 90))]
        b = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randrange(0, 90))]
        assert lcs_length(masks_of(a), b) == brute_lcs(a, b)
    assert holds_answer(b"x y z t".split(), b"q x y r z t".split())
    assert not holds_answer(b"x y z t".split(), b"x q q q y z t".split())
    assert words_of("The É-tude, 3.14\n") == ["the".encode(), "é".encode(), b"tude", b"3", b"14"]


def test_products_and_space(spark):
    rng = random.Random(2)
    vocabulary = [f"t{i}" for i in range(30)]
    rows = [(i, i, " ".join(rng.choice([*vocabulary, "other", "more"]) for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc bigint, rk bigint, text string").repartition(3)
    terms = {t.encode(): k for k, t in enumerate(vocabulary)}
    stride, matrix = 8, []
    df = np.zeros(30)
    for _, _, text in rows:
        words = text.split()
        df[[k for k, t in enumerate(vocabulary) if t in words]] += 1
        for lo in range(-stride, len(words), stride):
            matrix.append([words[max(lo, 0):lo + 2 * stride].count(t) for t in vocabulary] if lo >= 0 else [0] * 30)
    assert (document_frequency(docs, terms) == df).all()
    weight = df.astype(np.float32) ** -0.5
    a = np.array(matrix) * weight
    places = term_places(docs, terms)
    basis = np.random.default_rng(0).standard_normal((30, 5)).astype(np.float32)
    assert np.allclose(gram_product(places, weight, basis, stride), a.T @ a @ basis, rtol=1e-3, atol=1e-4)
    space = latent_space(places, weight, 30, stride)
    values = np.linalg.svd(a, compute_uv=False)
    assert np.allclose(np.sort(((a @ space) ** 2).sum(axis=0))[::-1], values ** 2, rtol=1e-3)
    got = candidates(places, weight, space, space[:1].copy(), stride, 0.0, 0.0).count()
    assert got > 0


def planted():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ter", "ing", "sa"]) for _ in range(rng.randrange(2, 5)))
    common = ["the", "of", "and", "to", "in"]
    sentence = lambda n: [rng.choice(common) if rng.random() < 0.4 else word() for _ in range(n)]
    items = [sentence(rng.randrange(15, 60)) for _ in range(30)]
    docs, truth = [], set()
    for i in range(300):
        words = sentence(rng.randrange(0, 400))
        if i % 5 == 0:
            j = rng.randrange(len(items))
            leak = list(items[j])
            if i % 10 == 0:  # a paraphrase: every eighth word replaced, the answer kept
                leak = [word() if k % 8 == 3 and k < len(leak) - 15 else w for k, w in enumerate(leak)]
            at = rng.randrange(len(words) + 1)
            words[at:at] = leak
            truth.add((i, j))
        docs.append((i, (" ".join(words)).upper() if i % 3 == 0 else "\n".join(words), "x"))
    return items, docs, truth


def test_planted_leaks(spark):
    items, rows, truth = planted()
    docs = spark.createDataFrame([*rows, (None, None, "x"), (1000, "", "x")], "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame([*((j, " ".join(w)) for j, w in enumerate(items)), (30, None), (31, ""), (32, "the of")],
                                  "item_id bigint, text string")
    got = contaminated(docs, bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == truth
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench, block=7).collect()} == truth
    kept = without_leaks(docs, bench)
    assert kept.columns == docs.columns
    leaked = {d for d, _ in truth}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [*(i for i in range(300) if i not in leaked), 1000]
    assert kept.where("doc_id IS NULL").count() == 1


def test_corpus_copies_are_found(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    texts = {r["doc_id"]: " ".join(w.decode() for w in words_of(r["text"])) for r in docs.collect()}
    items = {r["item_id"]: " ".join(w.decode() for w in words_of(r["text"])) for r in bench.collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if f" {x} " in f" {t} "}
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()}
    assert exact and exact <= got
    assert len(got - exact) <= 0.1 * len(exact)


def test_one_reading_serves_all_blocks(spark, monkeypatch):
    """Texts are read once for all blocks, with the rows of one reading a block."""
    items, rows, truth = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id bigint, text string")
    readings = []
    count = lsa_decontam.document_frequency
    monkeypatch.setattr(lsa_decontam, "document_frequency", lambda d, t: readings.append(len(t)) or count(d, t))
    together = sorted(map(tuple, contaminated(docs, bench, block=11).collect()))
    assert len(readings) == 1
    monkeypatch.setattr(lsa_decontam, "READING", 11)
    apart = sorted(map(tuple, contaminated(docs, bench, block=11).collect()))
    assert len(readings) == 1 + 3
    assert [r[:3] for r in together] == [r[:3] for r in apart] and {(r[0], r[2]) for r in together} == truth
    assert np.allclose([r[3] for r in together], [r[3] for r in apart], rtol=1e-3)


def test_paraphrases_are_found(spark):
    """Recall of rewordings: every ``every``-th word replaced or two words swapped, the answer kept."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    common = ["the", "of", "and", "to", "in", "is"]
    sentence = lambda n: [rng.choice(common) if rng.random() < 0.4 else word() for _ in range(n)]
    items = [sentence(rng.randrange(20, 60)) for _ in range(80)]
    docs, truth = [], set()
    for i in range(400):
        j, leak = i % 80, list(items[i % 80])
        body = len(leak) - max(5, len(leak) // 4)
        for k in range(rng.randrange(4), body, 4 + i % 4):
            if i % 2:
                leak[k] = word()
            elif k + 1 < body:
                leak[k], leak[k + 1] = leak[k + 1], leak[k]
        docs.append((i, " ".join(sentence(rng.randrange(0, 200)) + leak + sentence(rng.randrange(0, 200)))))
        truth.add((i, j))
    docs += [(1000 + i, " ".join(sentence(150))) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(frame, bench).collect()}
    assert got <= truth
    assert len(got) >= 0.9 * len(truth), len(got) / len(truth)


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (1, "a b c d e f g h i j k l"), (1, "zz")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(5, "a b c d e f g h i j"), (5, "a b c d e f g h i j")], "item_id bigint, text string")
    assert [(r["doc_id"], r["item_id"], r["lcs"]) for r in contaminated(docs, bench).collect()] == [(1, 5, 1.0)]
    assert [r["text"] for r in without_leaks(docs, bench).collect()] == ["zz"]
    assert contaminated(docs.limit(0), bench).count() == contaminated(docs, bench.limit(0)).count() == 0


def test_long_item_beside_short_ones(spark):
    """A leaked list of short items, and a short copy in a long document, with one very long item in the block."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    sentence = lambda n: [word() for _ in range(n)]
    items = [sentence(15) for _ in range(60)] + [sentence(3000)]
    docs = [[w for j in range(60) for w in items[j]], sentence(2000) + items[7] + sentence(2000),
            sentence(333) + items[60] + sentence(100), sentence(40) + items[60][:1000], *(sentence(50) for _ in range(60))]
    truth = {(0, j) for j in range(60)} | {(1, 7), (2, 60)}
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id bigint, text string")
    got = contaminated(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == truth
    assert all(r["lcs"] == 1 for r in got)
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(frame, bench, block=9).collect()} == truth


def test_hot_item_among_rare_ones(spark):
    """An item copied in a third of the documents is found between two rare ones, too."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    sentence = lambda n: [word() for _ in range(n)]
    hot, before, after = sentence(40), sentence(40), sentence(40)
    docs = [sentence(20) + (hot if i % 3 == 0 else []) + sentence(20) for i in range(900)]
    docs += [sentence(at) + before + hot + after + sentence(9) for at in range(0, 64, 7)]
    truth = {(i, 0) for i in range(0, 900, 3)} | {(i, j) for i in range(900, len(docs)) for j in range(3)}
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate([hot, before, after])], "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(frame, bench).collect()} == truth


def test_short_and_unspaced_items(spark):
    items = ["Who wrote the Iliad?", "法国的首都是哪座城市?它的人口是多少?", "日本で一番高い山は?", "ประเทศไทยมีกี่จังหวัด", "unheard", "is a",
             "who, wrote the iliad", "三国"]
    texts = ["So: who wrote\nthe ILIAD, then?", "who wrote or read the iliad", "问题:法国的首都是哪座城市?它的人口是多少?答案", "富士山。日本で一番高い山は富士山です",
             "ถาม ประเทศไทยมีกี่จังหวัด ตอบ", "this is a word", "that is a word unheard of", "法国的山", *["this is a text"] * 200]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["lcs"] for r in contaminated(frame, bench).collect()}
    assert got == dict.fromkeys([(0, 0), (0, 6), (2, 1), (3, 2), (4, 3), (6, 4)], 1.0)
    assert words_of("東京 Tokyo、é") == ["東".encode(), "京".encode(), b"tokyo", "é".encode()]

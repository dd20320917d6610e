"""The pipeline against a brute-force version of every stage on a small corpus."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from courtside.llm import langid
from courtside.llm.common import crc_mod
from courtside.llm.lsa_decontam import words_of
from courtside.llm.simhash_dedup import keep_one
from tests.llm.test_lsa_decontam import brute_lcs
from tests.llm.test_repeats import brute_bytes
from tests.llm.test_simhash_dedup import brute_fingerprint, brute_roots
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    rng = random.Random(12)
    syllables = {"en": "th er on tion ing ea nd st".split(), "de": "sch ung ich der ß ei ber".split()}
    common = {"en": "the of and to in".split(), "de": "der die und zu im".split()}

    def words(lang, n):
        return [rng.choice(common[lang]) if rng.random() < .4 else "".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(2, 5)))
                for _ in range(n)]

    items = [words("en", 30) for _ in range(6)]
    passage, rows = " ".join(words("de", 90)), []
    for i in range(90):
        lang = rng.choice(["en", "de"])
        w = words(lang, rng.randrange(60, 200))
        text = " ".join(w)
        if i % 9 == 1:
            text = text[:200] + passage + text[200:]
        if i % 9 == 2:
            text += " " + " ".join(items[i % 6]) + "."
        if i % 9 == 3 and rows:
            text, lang = rng.choice(rows)[1:3]
            text = (text or "x") + " Changed end"
        rows.append((i, text, lang))
    rows += [(90, None, "en"), (91, "", "de"), (92, "123 456 !!", "en"), (93, rows[0][1], None), (93, rows[0][1], None),
             (None, rows[5][1], "en")]
    return [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], items


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, items = corpus()
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id bigint, text string") \
        .write.parquet(f"{d}/benchmark.parquet")
    return d, rows, items


def brute_keep_one(rows):
    fps = [brute_fingerprint(r[1]) for r in rows]
    roots = brute_roots(sorted(set(fps)), 4)
    best = {}
    for r, f in zip(rows, fps):
        k = roots[f]
        if k not in best or (r[0] is None, r[0] or 0) < (best[k][0] is None, best[k][0] or 0):
            best[k] = r
    return list(best.values())


def test_run(spark, tables):
    d, rows, items = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    model = langid.train(docs, crc_mod(F.col("doc_id"), 4) != 2)
    kept = [r for r in rows if model.judge(r[1] or "")[2]]
    assert {r[0] for r in rows} - {r[0] for r in kept} >= {90, 91, 92}
    kept = brute_keep_one(kept)
    rest = {i: b.decode("utf-8", "ignore") for i, _, _, _, b in brute_bytes([(r[0], r[1]) for r in kept], corpus_pipeline.REPEAT_BYTES)}
    left = {}
    for i, text in rest.items():
        w = words_of(text)
        if not any(brute_lcs([x.encode() for x in item], w[lo:lo + 64]) >= .8 * len(item)
                   for item in items for lo in range(0, max(1, len(w) - 30), 5)):
            left[i] = text
    assert 0 < len(left) < len(kept) < len(rows)
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((i, len(e := lib.encode(t)), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(),
                   hashlib.sha256(lib.decode(e).encode()).hexdigest()) for i, t in left.items())
    got = corpus_pipeline.run(spark, d)
    assert sorted(tuple(r)[:4] for r in got.collect()) == want


def test_stages_keep_the_columns(spark, tables):
    d, _, _ = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, d).dtypes == docs.dtypes
        wide = docs.selectExpr("*", "1 AS id", "'x' AS row", "2L AS rk", "3L AS doc", "4L AS fp", "'y' AS kept")
        got = stage(spark, wide, d)
        assert got.dtypes == wide.dtypes
        assert {(r["id"], r["row"], r["rk"], r["doc"], r["fp"], r["kept"]) for r in got.collect()} == {(1, "x", 2, 3, 4, "y")}
        assert stage(spark, docs.limit(0), d).count() == 0


def test_keep_one_with_repeated_rows(spark):
    rows = [(None, "a b c d e", 1), (None, "a b c d e", 1), (None, "q r s t u v", 1), (5, "same", 1), (5, "same", 1),
            (4, "other words here now", 2), (6, "same", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source int")
    got = sorted((tuple(r) for r in keep_one(docs).collect()), key=str)
    assert got == sorted([rows[0], rows[2], rows[3], rows[5]], key=str)

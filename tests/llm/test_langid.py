"""Language identification: held-out accuracy, calibration, edges, block-wise n-grams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import langid
from courtside.llm.common import crc_mod, table
from courtside.llm.langid import fit, predict, subwords, train

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = table(spark, SF, "documents")
    return train(docs, crc_mod(F.col("doc_id"), 4) != 2)


def test_held_out_accuracy_and_calibration(spark, model):
    docs = table(spark, SF, "documents").where(crc_mod(F.col("doc_id"), 4) == 2)
    got = predict(docs, model, carry=("lang",)).toPandas()
    letters = got[got.lang_pred != "und"]
    assert (letters.lang == letters.lang_pred).mean() > 0.97
    assert letters.accepted.mean() > 0.97
    assert abs(letters.score.mean() - (letters.lang == letters.lang_pred).mean()) < 0.05


def test_edges(spark, model):
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "the and of"), (4, "the and of"), (None, "le des que"),
            (5, "x" * 50_000), (6, "日本語")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, score string")
    got = predict(docs, model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert [(by[i]["lang_pred"], by[i]["score"], by[i]["accepted"]) for i in (1, 2, 3)] == [("und", 0.0, False)] * 3
    assert by[4]["lang_pred"] == "en" and by[None]["lang_pred"] == "fr"
    assert all(0 <= r["score"] <= 1 for r in got) and by[5]["lang_pred"] in model.langs
    assert predict(docs.limit(0), model).count() == 0


def test_without_labelled_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    got = predict(docs, train(docs, F.lit(True))).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2


def test_blocks_give_the_same_ngrams(monkeypatch):
    text = "Der schnelle Fuchs, où il va; the end. " * 7
    whole = np.sort(np.concatenate(list(subwords(text))))
    monkeypatch.setattr(langid, "BLOCK", 11)
    assert (np.sort(np.concatenate(list(subwords(text)))) == whole).all()
    assert not [p for p in subwords(" 12 ") if len(p)]


def test_fit_is_deterministic():
    rows = [("the of and to in " * 5, "en"), ("le la de et un " * 5, "fr")] * 20
    a, b = fit(rows), fit(rows)
    assert (a.table == b.table).all() and a.predict("the and")[0] == "en" and a.predict("la de")[0] == "fr"


def test_unseen_languages_and_noise_are_rejected(spark):
    import random

    docs = table(spark, "/root/testdata/sf0.1", "documents").where("lang IS NOT NULL")
    training = crc_mod(F.col("doc_id"), 4) != 2
    for unseen in ("es", "fr"):
        model = train(docs.where(F.col("lang") != unseen), training)
        assert unseen not in model.langs and model.reject_below > 1 / 3
        got = predict(docs.where(~training), model, carry=("lang",)).toPandas()
        got = got[got.lang_pred != "und"]
        assert 1 - got[got.lang == unseen].accepted.mean() > 0.9
        assert got[got.lang != unseen].accepted.mean() > 0.97
        rng = random.Random(1)
        word = lambda: "".join(rng.choice("asdfghjklqwertyuiopzxcvbnm") for _ in range(rng.randint(2, 9)))
        noise = [" ".join(word() for _ in range(rng.randint(4, 40))) for _ in range(100)]
        assert sum(model.judge(t)[2] for t in noise) <= 10
        assert not any(model.judge(t)[2] for t in ("Привет, как дела, это русский текст", "日本語のテキストです。今日は天気がいい"))


def test_every_language_is_learnt_and_the_layout_does_not_matter(spark):
    rows = [(i, " ".join(f"q{i % 250}w{j}x" for j in range(30)) + chr(0x4E00 + i % 250) * 9, f"l{i % 250}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    a, b = (train(docs.repartition(n), F.lit(True), max_rows=500, epochs=2, folds=2) for n in (1, 7))
    assert len(a.langs) == 250 and a.weights is not None and a.table.shape == (langid.BUCKETS, 16)
    assert (a.table == b.table).all() and (a.temperature, a.reject_below, a.reject_unmet) == (b.temperature, b.reject_below, b.reject_unmet)


def test_prediction_equals_a_plain_forward_pass():
    import math
    import re

    model = fit([("the of and to in " * 5, "en"), ("le la de et un " * 5, "fr"), ("der die und das " * 5, "de")] * 20)

    def plain(text):
        code = [ord(c) if c.isalpha() else 0 for c in re.sub(r"[^\w]|[\d_]", " ", f" {text} ".lower())]
        code = [c for i, c in enumerate(code) if c or not i or code[i - 1]]
        found = []
        for n in (2, 3, 4):
            for i in range(len(code) - n + 1):
                g = code[i:i + n]
                if 0 in g[1:-1] or g == [0, 0]:
                    continue
                h = n
                for c in g:
                    h = (h ^ c) * 0x01000193 & 0xFFFFFFFF
                    h ^= h >> 15
                found.append((h * 0x9E3779B1 & 0xFFFFFFFF) >> 16)
        z = [(sum(float(model.table[b][k]) for b in found) / len(found) + float(model.bias[k])) / model.temperature for k in range(3)]
        e = [math.exp(x - max(z)) for x in z]
        return model.langs[z.index(max(z))], max(e) / sum(e)

    for text in ("the and of, le", "und der Hund", "la de 12 un et", "xyz"):
        got, want = model.predict(text), plain(text)
        assert got[0] == want[0] and math.isclose(got[1], want[1], rel_tol=1e-5)

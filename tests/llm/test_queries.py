"""The registered queries over small tables against brute force, and over empty and odd ones."""

import hashlib
import math
import random
import zlib

import public_tokenizers
import pytest
import sentencepiece

from courtside.llm.queries import ORACLE, REGISTRY
from tests.llm.test_collocations import brute as brute_phrases
from tests.llm.test_ctph import brute_likeness, brute_string
from tests.llm.test_ppm import brute as brute_scores
from tests.llm.test_repeats import brute_bytes, brute_words, corpus
from tests.llm.test_simhash_dedup import brute_fingerprint, brute_roots
from tests.llm.test_term_search import brute as brute_search
from tests.llm.test_warc_derivatives import brute_text

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def write(spark, d, docs, pages, labels, items):
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{d}/pages.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.fixture(scope="module")
def rows():
    texts = corpus(random.Random(21), 60, 40)
    item = " ".join(f"bench{i}" for i in range(20))
    texts += [f"{texts[0]} {item} tail", texts[1], "The QUICK brown fox, the lazy dog"]
    docs = [(i, t, ["en", "de", None][i % 3], "s", 1) for i, t in enumerate(texts)]
    pages = [(i, f"http://www.h{i % 4}.example.{'net' if i % 2 else 'com'}/en/{i}", f"<title>t {i}</title><p>a &amp; b<p>c {i}")
             for i in range(30)]
    labels = [(i, int(i % 4 > 0), 0) for i in range(0, 30, 2)]
    return docs, pages, labels, [(5, item), (6, "nowhere " * 12)]


@pytest.fixture(scope="module")
def sf(spark, rows, tmp_path_factory):
    return write(spark, str(tmp_path_factory.mktemp("sf")), *rows)


def got(spark, sf, name, *cols):
    return sorted(tuple(r) for r in REGISTRY[name](spark, sf).select(*cols).collect())


def test_names():
    assert [n.split("_")[0] for n in REGISTRY] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE) <= set(REGISTRY)


def test_fingerprints(spark, sf, rows):
    texts = sorted(((i, t or "") for i, t, *_ in rows[0]), reverse=True)
    want = []
    for (i, t), (_, nxt) in zip(texts, [*texts[1:], texts[0]]):
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        a, e, b = brute_string(t), brute_string(edited), brute_string(nxt)
        want.append((i, len(t), sha(edited), a, e, brute_likeness(a, e), brute_likeness(a, b)))
    found = got(spark, sf, "op2_ctph_fingerprints", "doc_id", "n_chars", "edited_sha256", "fingerprint",
                "edited_fingerprint", "near_edited", "near_next")
    assert [r[:5] for r in found] == [r[:5] for r in sorted(want)]
    assert all(math.isclose(x, y) for r, w in zip(found, sorted(want)) for x, y in zip(r[5:], w[5:]))


def test_leaks(spark, sf, rows):
    holder = next(i for i, t, *_ in rows[0] if t and "bench0 bench1" in t)
    assert got(spark, sf, "op3_lsa_decontamination", "doc_id", "item_id", "kind") == [(holder, 5, "copy")]


def test_codec(spark, sf, rows):
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((i, len(e := lib.encode(t or "")), sha(",".join(map(str, e))), sha(lib.decode(e))) for i, t, *_ in rows[0])
    assert got(spark, sf, "op4_sentencepiece_codec", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_languages(spark, sf, rows):
    fold = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    found = got(spark, sf, "op5_language_id", "doc_id", "held_out", "lang_pred", "score")
    assert [(r[0], r[1]) for r in found] == sorted((i, fold(i)) for i, *_ in rows[0])
    for r, (_, t, *_) in zip(found, sorted(rows[0])):
        assert (r[2] == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= r[3] <= 1
        assert r[2] in ("en", "de", "und")


def test_derivatives(spark, sf, rows):
    found = got(spark, sf, "op6_warc_derivatives", "page_id", "record_type", "block")
    assert [(p, b) for p, kind, b in found if kind == "conversion"] == [(i, "\n".join(brute_text(h))) for i, _, h in rows[1]]


def test_substrings(spark, sf, rows):
    pairs = [(i, t) for i, t, *_ in rows[0]]
    assert got(spark, sf, "op7_automaton_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == \
        [(*r[:3], sha(r[3])) for r in brute_words(pairs, 50)]
    assert got(spark, sf, "op9_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == \
        [(*r[:4], sha(r[4])) for r in brute_bytes(pairs, 400)]


def test_components(spark, sf, rows):
    fps = {i: brute_fingerprint(t) for i, t, *_ in rows[0]}
    roots = brute_roots(sorted(set(fps.values())), 4)
    least = {}
    for i, f in sorted(fps.items(), reverse=True):
        least[roots[f]] = i
    assert got(spark, sf, "op8_simhash_dedup", "doc_id", "fingerprint", "component_id") == \
        sorted((i, f"{f:016x}", least[roots[f]]) for i, f in fps.items())


def test_scores(spark, sf, rows):
    found = got(spark, sf, "op10_ppm_scoring", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    for r, w in zip(found, sorted(brute_scores([(i, t) for i, t, *_ in rows[0]], 4))):
        assert r[:5] == w[:5] and math.isclose(r[5], w[5], rel_tol=1e-9) and math.isclose(r[6], w[6], rel_tol=1e-9)


def test_search(spark, sf, rows):
    found = got(spark, sf, "op11_term_search", "item_id", "rank", "doc_id", "score")
    assert found == brute_search([(i, t) for i, t, *_ in rows[0]], rows[3], 10) and {r[0] for r in found} == {5}


def test_phrases(spark, sf, rows):
    found = got(spark, sf, "op12_collocations", "lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert found == brute_phrases([(lang, t) for _, t, lang, *_ in rows[0]], 10, 2000) and found


def test_toxicity(spark, sf, rows):
    fold = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    found = got(spark, sf, "op13_toxicity", "doc_id", "held_out", "score", "predicted")
    assert [(r[0], r[1]) for r in found] == sorted((i, fold(i)) for i, *_ in rows[0])
    assert {(r[2], r[3]) for r in found} == {(0.0, 0)}  # no toxic row: nothing is learnt


def test_empty_tables(spark, tmp_path):
    d = write(spark, str(tmp_path / "sf"), [], [], [], [])
    for name, query in REGISTRY.items():
        assert query(spark, d).count() == 0, name


def test_nulls_in_every_column(spark, tmp_path):
    docs = [(None,) * 5, (None,) * 5, (1, None, None, None, None), (2, "some words here", None, None, None)]
    d = write(spark, str(tmp_path / "sf"), docs, [(None,) * 3, (1, None, None)], [(None,) * 3, (1, None, None)], [(None,) * 2, (1, None)])
    for name, query in REGISTRY.items():
        rows_ = {"op1": 2, "op6": 4, "op3": 0, "op11": 0, "op12": 0}.get(name.split("_")[0], 4)
        assert len(query(spark, d).collect()) == rows_, name

"""The codec against the sentencepiece library, and its spans against the text."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from courtside.llm.sentencepiece_codec import Codec, codec_digests, decode, encode

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = open(PATH, "rb").read()
TEXTS = ["", " ", "  ", "a", "Hello world", "  two  spaces ", "tab\tand\nnew line\r\n", "▁mark ▁▁ x",
         "naïve café – déjà vu", "日本語のテキスト", "emoji 😀😀 mix", "<s></s><unk> <0x0A>", "a" * 300, "x1y22 3.14,5",
         "\x00\x01", "ﬁ ﬂ ½ ² ².", " " * 40, "ελληνικά кириллица", "é", "�", "a  b   c    d"]


def library(model=MODEL):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def random_texts(n=300):
    rng = random.Random(5)
    alphabet = "abcdeth  rson \n.,é▁ß日😀\t0123'-\"(){}=<>"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 120))) for _ in range(n)]


def check(model, texts):
    lib, own = library(model), Codec(model)
    for t in texts:
        joined, ids, spans = own.encode(t)
        want = lib.encode(t)
        assert ids.tolist() == want, repr(t)
        assert joined == ",".join(map(str, want))
        assert own.decode(want) == lib.decode(want), repr(t)
        assert own.decode_fast(ids) == lib.decode(want), repr(t)
        proto = lib.encode(t, return_type="proto")
        assert [(p.begin, p.end) for p in proto.pieces] == [tuple(s) for s in spans.tolist()], repr(t)


def test_as_the_library():
    check(MODEL, TEXTS + random_texts())


def test_with_a_compiled_character_map():
    proto = pb.ModelProto()
    proto.ParseFromString(MODEL)
    for rule in ("nmt_nfkc", "nmt_nfkc_cf"):
        norm = pb.ModelProto()
        norm.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        assert norm.normalizer_spec.precompiled_charsmap
        for squeeze in (True, False):
            proto.normalizer_spec.precompiled_charsmap = norm.normalizer_spec.precompiled_charsmap
            proto.normalizer_spec.remove_extra_whitespaces = squeeze
            check(proto.SerializeToString(), TEXTS + random_texts(150))


def test_decode_of_any_ids():
    lib, own, rng = library(), Codec(MODEL), random.Random(3)
    for _ in range(300):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(12)]
        assert own.decode(ids) == lib.decode(ids), ids


def test_wrong_model_is_refused():
    proto = pb.ModelProto()
    proto.ParseFromString(MODEL)
    proto.trainer_spec.byte_fallback = False
    with pytest.raises(ValueError):
        Codec(proto.SerializeToString())


def test_frames(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, None), (0, "", "x"), (0, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    lib = library()
    got = codec_digests(docs, MODEL).collect()
    assert len(got) == len(rows)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted((i is None, i or 0, len(e := lib.encode(t or "")), sha(",".join(map(str, e))), sha(lib.decode(e)))
                  for i, t, _ in rows)
    assert sorted((r[0] is None, r[0] or 0, r[1], r[2], r[3]) for r in got) == want
    assert codec_digests(docs.limit(0), MODEL).count() == 0
    e = encode(docs, MODEL).select("doc_id", "text", "encoded.*")
    for r in decode(e, MODEL).collect():
        assert r["ids"] == lib.encode(r["text"] or "") and r["decoded"] == lib.decode(r["ids"])
        if r["ids"]:
            assert r["begins"][0] == 0 and r["ends"][-1] == len(r["text"].encode())


def test_identity_path_is_the_normaliser():
    """This model's character map is empty: replacing spaces gives what the normaliser gives."""
    direct, own = Codec(MODEL), Codec(MODEL)
    assert direct.plain
    own.plain = False
    for t in TEXTS + random_texts():
        (a, i, s), (b, j, u) = direct.encode(t), own.encode(t)
        assert a == b and i.tolist() == j.tolist() and s.tolist() == u.tolist(), repr(t)

"""Context-triggered piecewise hashing against a byte-by-byte version."""

import hashlib
import random
import zlib

import pytest

from courtside.llm import ctph
from courtside.llm.ctph import fingerprint, fingerprint_neighbours, with_fingerprint


def brute_fingerprint(text):
    raw, size = text.encode(), 3
    while size * 64 < len(raw):
        size *= 2
    out = []
    for bs, most in ((size, 64), (2 * size, 32)):
        window, h3, sig, chunk = [0] * 7, 0, [], b""
        for b in raw:
            window = [*window[1:], b]
            h3 = (h3 << 5 ^ b) & 0xFFFFFFFF
            chunk += bytes([b])
            h = (sum(window) + sum((k + 1) * w for k, w in enumerate(window)) + h3) & 0xFFFFFFFF
            if h % bs == bs - 1 and len(sig) < most - 1:
                sig.append(chunk)
                chunk = b""
        if chunk:
            sig.append(chunk)
        out.append(sig)
    return size, out


def text_of(rng, n):
    return "".join(rng.choice("abcdefgh éü\n") for _ in range(n))


def brute_string(text):
    size, sigs = brute_fingerprint(text)
    sigs = ["".join(ctph.ALPHABET[zlib.crc32(c) & 63] for c in s) for s in sigs]
    return f"{size}:{sigs[0]}:{sigs[1]}"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(out[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
    return out


def brute_likeness(a, b):
    if a == b:
        return 1.0
    (sa, a1, a2), (sb, b1, b2) = a.split(":"), b.split(":")
    near = lambda x, y: 1 - levenshtein(x, y) / max(len(x), len(y)) if x or y else 1.0
    sa, sb = int(sa), int(sb)
    return max(near(a1, b1), near(a2, b2)) if sa == sb else near(a1, b2) if sa == 2 * sb else \
        near(a2, b1) if sb == 2 * sa else 0.0


def test_fingerprint(monkeypatch):
    rng = random.Random(1)
    some = [text_of(rng, n) for n in (0, 1, 5, 6, 7, 50, 192, 193, 500, 3000)] + ["a" * 1000, "é" * 300]
    for t in some:
        assert fingerprint(t) == brute_string(t), len(t)
    monkeypatch.setattr(ctph, "BLOCK", 13)
    for t in some:
        assert fingerprint(t) == brute_string(t), len(t)


@pytest.mark.parametrize("n", [0, 1, 2, 40])
def test_neighbours(spark, n):
    rng = random.Random(n)
    rows = [(i * 3, rng.choice([text_of(rng, rng.randrange(0, 1500)), "", None, "same"])) for i in range(n)]
    if n > 2:
        rows += [(None, "no id"), (6, rows[2][1]), (9, "tie")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, h int").repartition(5)
    got = fingerprint_neighbours(docs).collect()
    keyed = docs.selectExpr("doc_id", "coalesce(text, '') t", "xxhash64(coalesce(text, '')) h").collect()
    ordered = sorted(keyed, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    want = []
    for r, nxt in zip(ordered, [*ordered[1:], *ordered[:1]]):
        half = len(r[1]) // 2
        edited = r[1][:len(r[1]) - half] + nxt[1][:half]
        a, e, b = (brute_string(x) for x in (r[1], edited, nxt[1]))
        want.append((r[0], len(r[1]), hashlib.sha256(edited.encode()).hexdigest(), a, e,
                     round(brute_likeness(a, e), 9), round(brute_likeness(a, b), 9)))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=key) == sorted(want, key=key)


def test_near_copies_are_near(spark):
    rng = random.Random(5)
    base = text_of(rng, 4000)
    docs = spark.createDataFrame([(1, base), (2, base[:2000] + "xyz" + base[2000:]), (3, text_of(rng, 4000))],
                                 "doc_id bigint, text string")
    fp = {r["doc_id"]: r["fingerprint"] for r in with_fingerprint(docs).collect()}
    assert brute_likeness(fp[1], fp[2]) > 0.9 > 0.4 > brute_likeness(fp[1], fp[3])

"""SimHash components against all pairs, and links at every distance."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from courtside.llm.components import connected_components
from courtside.llm.simhash_dedup import (
    AGREE, agreeing_masks, fingerprint, fingerprint_links, keyed, simhash_components, variant_masks)


def brute_fingerprint(text, shingle=4):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        t = t.replace(c, " ")
    words = [w for w in t.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_roots(fps, bits):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    fps = list(root)
    for i, f in enumerate(fps):
        for g in fps[:i]:
            if (f ^ g).bit_count() <= bits:
                a, b = sorted((find(f), find(g)))
                root[b] = a
    return {f: find(f) for f in fps}


def test_fingerprint():
    rng = random.Random(4)
    for n in [0, 1, 2, 3, 4, 5, 50, 300]:
        t = " ".join(rng.choice(["The", "ÉTÉ", "x", "foo,", "a b"]) + rng.choice(["", "\t", "\n"]) for _ in range(n))
        assert fingerprint(t.encode()) == brute_fingerprint(t)
    assert fingerprint(b"") == fingerprint(b" \n\t") == 0


@pytest.mark.parametrize("bits,max_bucket", [(4, 4000), (4, 3), (4, 1), (3, 4000), (1, 4000), (0, 5)])
def test_links_connect_exactly(spark, bits, max_bucket):
    rng = random.Random(bits)
    fps = set()
    for _ in range(40):  # chains and clouds around random centres
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            fps.add(f)
            for _ in range(rng.randrange(0, 7)):
                f ^= 1 << rng.randrange(64)
    fps |= {0, (1 << 64) - 1, 1 << 63}
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(f,) for f in signed], "fp bigint").repartition(3)
    links = [tuple(x & (1 << 64) - 1 for x in r) for r in fingerprint_links(frame, bits, max_bucket).collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in links)
    want = brute_roots(sorted(fps), bits)
    got = {f: f for f in fps}
    for _ in fps:
        for a, b in links:
            got[a] = got[b] = min(got[a], got[b])
    assert got == want


def test_keys_are_one_expression_however_many_masks(spark):
    fps = spark.createDataFrame([(-1, 5), (0, 5), (1, None)], "fp bigint, a bigint")
    for masks, bucket, n in ((variant_masks(4), (), 64), (agreeing_masks(4, 1), ("a",), 5), (agreeing_masks(4, AGREE), (), 495)):
        assert len(set(masks)) == n
        keys = keyed(fps, masks, bucket)
        assert keys.count() == 3 * n and keys._jdf.queryExecution().optimizedPlan().toString().count("xxhash64(") == 1
        same = keys.groupBy("key").count().where("count > 1").count()  # 0 and 1 agree where the lowest bit is masked
        assert same == (0 if bucket else sum(not m & 1 for m in masks))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(70)] + [(200, i) for i in range(201, 260)] + [(300, 300), (401, 400), (400, 401)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(71)} | {i: 200 for i in range(200, 260)} | {400: 400, 401: 400}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_documents_against_all_pairs(spark):
    rng = random.Random(9)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(300)) for _ in range(8)]
    texts = [None, "", " \n", "one", "ONE", "one two three", "\U0001F600 " * 30]
    for b in base:
        for _ in range(6):
            w = b.split()
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = "changed"
            texts += [" ".join(w).upper(), " ".join(w)]
    rows = [(i * 7 % 1009, t, "fp") for i, t in enumerate(texts)] + [(None, base[0], "x"), (3, base[1], "y"), (3, base[1], "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = simhash_components(docs).collect()
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    roots = brute_roots(sorted(set(fps)), 4)
    least = {}
    for (i, _, _), f in zip(rows, fps):
        if i is not None:
            least[roots[f]] = min(least.get(roots[f], i), i)
    want = Counter((i, f"{f:016x}", least[roots[f]]) for (i, _, _), f in zip(rows, fps))
    assert Counter(tuple(r) for r in got) == want
    assert simhash_components(docs.limit(0)).count() == 0

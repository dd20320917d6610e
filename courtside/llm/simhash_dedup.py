"""SimHash near-duplicates through deletion-variant signatures.

Fingerprints that differ in at most d bits differ in at most one bit in one of
floor(d / 2) + 1 segments. Every segment is indexed once per bit position with
that bit left out; two fingerprints meet in an equal key exactly if one segment
differs in at most one bit, and are then verified. Each different fingerprint
is indexed once, however many documents have it. A key shared by more than
``max_bucket`` fingerprints is split exactly: linked fingerprints agree in one
of d + 1 blocks of all bits, which becomes part of the key. What then still shares
a key with too many is indexed once more by all choices of 8 of d + 8 blocks, of
which linked fingerprints agree in 8: for d = 4 that fixes 40 bits or more, so at
most 2**24 different fingerprints can meet in one task.

Defined results: NULL, empty and wordless texts have fingerprint zero, linked
like any other; rows with equal ids are kept apart; a NULL id is never a
component id unless the whole component has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import row_key, stored, tidied, utf8
from courtside.llm.components import connected_components
from courtside.llm.repeats import BROADCAST_BYTES

BITS = 64

#: Equal blocks asked for where a bucket is still too large after one: the buckets of that split are held whole.
AGREE = 8


def fingerprint(raw: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the lower-cased words' shingles, each hashed by XXH64."""
    words = raw.lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    hash_ = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), len(words) - k + 1
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        h = np.array([hash_(data[b:e], seed) for b, e in zip(begins[lo:hi].tolist(), ends[lo + k - 1:hi + k - 1].tolist())],
                     "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, fp) per row, fp as a signed 64-bit number, and the ``carry`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(raw, shingle) for raw in utf8(batch, 1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), *batch.columns[2:]],
                                             names=["id", "fp", *carry])

    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *carry)
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    return frame.mapInArrow(tidied(run), ", ".join([f"id {kinds['id']}", "fp bigint", *(f"{c} {kinds[c]}" for c in carry)]))


def _bits(lo: int, hi: int) -> int:
    """Mask of bits lo to hi - 1."""
    return (1 << hi) - (1 << lo)


def _cuts(parts: int) -> list[tuple[int, int]]:
    edges = [BITS * i // parts for i in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def variant_masks(max_bits: int) -> list[int]:
    """64 masks: one segment without one of its bits."""
    return [_bits(lo, hi) & ~(1 << bit) for lo, hi in _cuts(max_bits // 2 + 1) for bit in range(lo, hi)]


def agreeing_masks(max_bits: int, agree: int) -> list[int]:
    """Masks that split a bucket exactly: of ``max_bits`` + ``agree`` blocks linked fingerprints agree in ``agree``."""
    return [sum(_bits(lo, hi) for lo, hi in chosen) for chosen in combinations(_cuts(max_bits + agree), agree)]


def keyed(fps: DataFrame, masks: list[int], bucket: tuple[str, ...] = ()) -> DataFrame:
    """(key, fp) of every row and mask: equal keys if ``bucket``, the mask and the bits under it are equal.

    The masks are one constant array and the key is one expression. An expression for each mask makes generated code
    that grows with their number (495 for AGREE), and compiling it takes an executor's memory beside the heap.
    """
    signed = [F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint") for m in masks]
    each = fps.select("fp", *bucket, F.explode(F.array(*signed)).alias("mask"))
    return each.select(F.xxhash64(*bucket, F.col("fp").bitwiseAND(F.col("mask")), "mask").alias("key"), "fp")


def _links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links inside groups of equal (sorted) keys: enough to connect what is connected."""
    n = len(key)
    begins = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    sizes = np.diff(begins, append=n)
    left, right = [], []
    pairs = begins[sizes == 2]
    near = np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= max_bits
    left.append(fp[pairs[near]])
    right.append(fp[pairs[near] + 1])
    for b, size in zip(begins[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        rest = fp[b:b + size]
        while len(rest):  # one connected set at a time, a link per newly reached fingerprint
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                at = front.pop()
                near = np.bitwise_count(rest ^ at) <= max_bits
                if near.any():
                    new, rest = rest[near], rest[~near]
                    left.append(np.full(len(new), at))
                    right.append(new)
                    front.extend(new)
    return np.concatenate(left), np.concatenate(right)


def _scan(max_bits: int, max_bucket: int | None):
    """Stream rows sorted by key; give links (a, b, false), and members of larger buckets as (key, fp, true)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "open"]

        def give(a: np.ndarray, b: np.ndarray, open_: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                                               pa.array(np.full(len(a), open_))], names=names)

        key, fp, hot = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if hot is not None:  # the bucket at hand is already too large
                n = int(np.searchsorted(k, hot, side="right"))
                if n:
                    yield give(k[:n], f[:n], True)
                k, f = k[n:], f[n:]
                if not len(k):
                    continue
                hot = None
            key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
            tail = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if tail >= 1 << 17:
                yield from _whole(key[:tail], fp[:tail], max_bits, max_bucket, give)
                key, fp = key[tail:], fp[tail:]
                tail = 0
            if max_bucket and len(key) - tail > max_bucket:
                if tail:
                    yield from _whole(key[:tail], fp[:tail], max_bits, max_bucket, give)
                yield give(key[tail:], fp[tail:], True)
                hot, key, fp = key[-1], key[:0], fp[:0]
        if len(key):
            yield from _whole(key, fp, max_bits, max_bucket, give)

    return run


def _whole(key: np.ndarray, fp: np.ndarray, max_bits: int, max_bucket: int | None, give) -> Iterator[pa.RecordBatch]:
    if max_bucket:
        begins = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        large = np.repeat(np.diff(begins, append=len(key)) > max_bucket, np.diff(begins, append=len(key)))
        if large.any():
            yield give(key[large], fp[large], True)
            key, fp = key[~large], fp[~large]
    if len(key):
        yield give(*_links(key, fp, max_bits), False)


def fingerprint_links(fps: DataFrame, max_bits: int, max_bucket: int = 4000) -> DataFrame:
    """Different fingerprints (fp) -> links (a, b) that connect all within ``max_bits`` of each other."""
    schema = "a bigint, b bigint, open boolean"
    keys = keyed(fps, variant_masks(max_bits))
    found = keys.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(tidied(_scan(max_bits, max_bucket)), schema)
    found = stored(found, "fingerprint-links")
    links = found.where("NOT open").select("a", "b")
    # A link inside an open bucket has both its ends among the open rows, so each split covers all that is left.
    for agree, bound in ((1, max_bucket), (AGREE, None)):
        left = found.where("open")
        if left.isEmpty():
            break
        bucket = ("a",) if agree == 1 else ()
        split = keyed(left.select(*bucket, F.col("b").alias("fp")).distinct(), agreeing_masks(max_bits, agree), bucket)
        found = split.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(tidied(_scan(max_bits, bound)), schema)
        found = stored(found, "fingerprint-links")
        links = links.unionByName(found.where("NOT open").select("a", "b"))
    return links.distinct()


def _rooted(rows: DataFrame, max_bits: int, max_bucket: int) -> DataFrame:
    """(fp, least, root): the least id of each fingerprint and the root of its component."""
    least = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "least")
    roots = connected_components(fingerprint_links(least.select("fp"), max_bits, max_bucket))
    return least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                       text_col: str = "text", max_bucket: int = 4000) -> DataFrame:
    """Per row: id_col, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    rooted = _rooted(rows, max_bits, max_bucket)
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(component, "root").select(F.col("fp").alias("named_fp"), "component_id"), "named")
    return rows.join(named, rows["fp"] == named["named_fp"]).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text",
             max_bucket: int = 4000) -> DataFrame:
    """One row of each component, the one with the smallest id (NULL last, equal ids by a hash of the text).

    Which rows stay is settled on (id, hash) pairs; the texts are joined to the pairs once.
    """
    pair = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"),
                       row_key(docs, id_col, text_col).alias("rk"))
    rows = stored(fingerprints(pair, "doc", "text", shingle, ("rk",)), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rk")).alias("w")
    rooted = stored(_rooted(rows, max_bits, max_bucket).select(F.col("fp").alias("named_fp"), "root"), "rooted")
    winners = rows.join(rooted, rows["fp"] == rooted["named_fp"]).groupBy("root").agg(first)
    winners = stored(winners.select(F.col("w.id").alias("win_id"), F.col("w.rk").alias("win_rk")), "winners")
    again = rows.groupBy("id", "rk").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    again = stored(again.select(F.col("id").alias("win_id"), F.col("rk").alias("win_rk")), "repeated-rows")
    key = row_key(docs, id_col, text_col)

    def joined(small: DataFrame, how: str) -> DataFrame:
        on = docs[id_col].eqNullSafe(small["win_id"]) & (key == small["win_rk"])
        return docs.join(F.broadcast(small) if small.count() * 32 <= BROADCAST_BYTES else small, on, how)

    once = stored(winners.exceptAll(winners.intersect(again)), "single-winners")
    twice = stored(winners.intersect(again), "repeated-winners")
    # Rows that agree in id and text: one of them stays.
    return joined(once, "left_semi").unionByName(
        joined(twice, "left_semi").dropDuplicates([id_col, text_col]))

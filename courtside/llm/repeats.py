"""Repeated windows of a corpus, found without comparing documents with each other.

A window is ``length`` consecutive units (bytes or words) of one text. Every
window is owned by its minimiser, the smallest of the hashed k-grams inside it
(leftmost of equals), so equal windows have equal minimisers at equal offsets.
The windows that one minimiser occurrence owns form a *segment*.

1. Each text is cut into segments: (64-bit anchor hash, 64-bit hash of the segment).
2. Segments whose bytes occur again are settled by a grouped count.
3. Anchors that occur in different segments (a match that ends inside one) go,
   one copy of each different segment, to an exact judge, grouped by anchor.
4. An anchor whose different segments are too large together (a passage in very
   many documents) is not gathered: its segments are cut into single windows,
   which a grouped count settles exactly.

Only hashes and the segments of step 3 are shuffled. All results are ranges
(start, n): n windows from window ``start`` of a text.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import mix64, rebatched, stored, tidied, utf8

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
BROADCAST_BYTES = 24 << 20
FILTER_WORDS = 1 << 19  # of 64 bits each; as a broadcast table under BROADCAST_BYTES


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown as needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            steps = np.ones((2, size), np.uint64)
            steps[0, 1:], steps[1, 1:] = _BASE, _INVERSE
            cls.up, cls.down = np.cumprod(steps, axis=1, dtype=np.uint64)
        return cls.up[:n], cls.down[:n]


#: A random 64-bit value for each byte.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[begin:end] for each pair; equal bytes give equal hashes."""
    up, down = _Powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[:-1], out=sums[1:])
    return mix64((sums[ends] - sums[begins]) * down[begins])


def owners(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first window, owner position) of each run of windows with one owner; a window is ``width`` grams."""
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step * 2 <= width:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    if step < width:
        key = np.minimum(key[:len(key) - (width - step)], key[width - step:])
    at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    return first, at[first]


class ByteText:
    """A text as UTF-8 bytes; units are bytes."""

    gram = 32

    def __init__(self, raw: bytes):
        self.data, self.units = raw, len(raw)

    def span(self, start: int, n: int) -> bytes:
        return self.data[start:start + n]

    def gram_hashes(self, start: int, n: int) -> np.ndarray:
        part = np.frombuffer(self.data, np.uint8, n, start)
        begins = np.arange(n - self.gram + 1)
        return span_hashes(part, begins, begins + self.gram)


class WordText:
    """A text as words between ASCII white space; units are words, joined by one space."""

    gram = 8

    def __init__(self, raw: bytes):
        words = raw.split()
        self.data, self.units = b" ".join(words), len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(sizes + 1) - 1
        self.begins = self.ends - sizes

    def span(self, start: int, n: int) -> bytes:
        return self.data[self.begins[start]:self.ends[start + n - 1]]

    def gram_hashes(self, start: int, n: int) -> np.ndarray:
        lo = int(self.begins[start])
        part = np.frombuffer(self.data, np.uint8, int(self.ends[start + n - 1]) - lo, lo)
        words = span_hashes(part, self.begins[start:start + n] - lo, self.ends[start:start + n] - lo)
        total, factor = np.zeros(n - self.gram + 1, np.uint64), 1
        for j in range(self.gram):
            total += words[j:n - self.gram + 1 + j] * np.uint64(factor)
            factor = factor * _BASE % (1 << 64)
        return mix64(total)


def segments(text, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first windows, counts, anchor hashes) of a text, a block of windows at a time."""
    windows, width = text.units - length + 1, length - text.gram + 1
    for lo in range(0, max(windows, 0), BLOCK):
        n = min(BLOCK, windows - lo)
        grams = text.gram_hashes(lo, n + length - 1)
        first, owner = owners(grams, width)
        yield first + lo, np.diff(first, append=n), grams[owner]


def _digest(pieces: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, pieces), np.uint64).view(np.int64)


def all_segments(docs: DataFrame, kind: type, length: int) -> DataFrame:
    """Segments of (doc, rk, text) rows: doc, rk, start, n, a (anchor hash), s (segment hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size = [], 0
            for doc, rk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch, 2)):
                text = kind(raw)
                for first, n, anchors in segments(text, length):
                    s = _digest(text.span(at, c + length - 1) for at, c in zip(first.tolist(), n.tolist()))
                    parts.append((np.full(len(n), doc), np.full(len(n), rk), first, n, anchors.view(np.int64), s))
                    size += len(n)
                if size >= 50_000:
                    yield _columns(parts, ["doc", "rk", "start", "n", "a", "s"])
                    parts, size = [], 0
            if parts:
                yield _columns(parts, ["doc", "rk", "start", "n", "a", "s"])

    return docs.select("doc", "rk", "text").mapInArrow(
        tidied(run), "doc bigint, rk bigint, start bigint, n bigint, a bigint, s bigint")


def _columns(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)


def likely(big: DataFrame, small: DataFrame, key: Column) -> DataFrame:
    """``big`` with ``__likely``: true where its ``key``, a hash made from columns of both, is in ``small``, else mostly false.

    A bit for each key of ``small`` is broadcast, so that rows which can't have a partner are told where they lie.
    """
    place = F.pmod(key, F.lit(FILTER_WORDS * 64))
    frame = small.select(place.alias("__place"))
    word, bit = F.col("__place") % FILTER_WORDS, F.expr(f"shiftleft(1L, cast(__place div {FILTER_WORDS} as int))")
    words = frame.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    tried = big.withColumn("__place", place).withColumn("__word", word).join(F.broadcast(words), "__word", "left")
    hit = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))
    return tried.select(*[F.col(c) for c in big.columns], hit.alias("__likely"))


def join_small(big: DataFrame, small: DataFrame, keys: list[str], how: str, row_bytes, key: Column | None = None) -> DataFrame:
    """Equi-join (inner or left) with a stored frame, broadcast only if its counted bytes stay under BROADCAST_BYTES.

    Beyond that, with ``key`` (a hash of ``keys``) only the rows of ``big`` that are likely to have a partner are shuffled.
    """
    held = small.agg(F.sum(row_bytes)).first()[0] or 0
    if held <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), keys, how)
    if key is None:
        return big.join(small, keys, how)
    tried = likely(big, small, key)
    met = tried.where("__likely").drop("__likely").join(small, keys, how)
    return met if how == "inner" else met.unionByName(tried.where("NOT __likely").drop("__likely"), allowMissingColumns=True)


def sharing(segs: DataFrame, shared: DataFrame) -> DataFrame:
    """The segments whose anchor is in the stored table of shared anchors; most with an anchor of their own aren't shuffled."""
    return join_small(segs, shared, ["a"], "inner", F.lit(40), F.col("a")).select(*segs.columns)


def _text_hash() -> Column:
    """A hash of the two columns that tell a text."""
    return F.xxhash64("doc", "rk")


def repeated_windows(docs: DataFrame, kind: type, length: int, judge: Callable, earlier: bool,
                     max_units: int) -> DataFrame:
    """Ranges (doc, rk, start, n) of the windows of (doc, rk, text) rows that repeat.

    ``earlier``: a window counts if its content also starts in a text with a smaller
    ``doc``; else if it also starts anywhere else. ``judge`` takes an iterator of
    (a, s, doc, open, windows, bytes), sorted by (a, doc), and yields
    (a, s, first window, n) for the windows of open segments that repeat. Anchors
    whose different segments hold more than ``max_units`` units are counted by window.
    """
    segs = stored(all_segments(docs, kind, length), "segments")
    shared = stored(segs.groupBy("a").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("a"), "shared-anchors")
    segs = stored(sharing(segs, shared), "shared-segments")
    key = ["a", "s"]
    least = F.min(F.struct("doc", "rk", "start", "n"))
    kinds = stored(segs.groupBy(*key).agg(F.count(F.lit(1)).alias("c"), least.alias("at")), "segment-kinds")
    groups = kinds.groupBy("a").agg(
        F.count(F.lit(1)).alias("k"), F.min("c").alias("least_c"), F.min("at.doc").alias("lo"),
        F.max("at.doc").alias("hi"), F.sum(F.col("at.n") + length - 1).alias("units"))
    groups = stored(groups.where("k > 1 AND " + ("lo < hi" if earlier else "least_c = 1"))
                    .select("a", (F.col("units") > max_units).alias("hot")), "anchor-groups")
    unsettled = join_small(kinds, groups, ["a"], "inner", F.lit(48))
    # The text of one copy of each unsettled segment, cut out where its document lies.
    ask = F.struct(F.col("at.start").cast("int").alias("start"), F.col("at.n").cast("int").alias("n"), "a",
                   F.least("c", F.lit(2)).cast("int").alias("c"), "hot")
    asked = unsettled.groupBy(F.col("at.doc").alias("doc"), F.col("at.rk").alias("rk")).agg(F.collect_list(ask).alias("q"))
    asked = stored(asked.select("doc", "rk", *[F.col(f"q.{c}").alias(c) for c in ("start", "n", "a", "c", "hot")]), "asked")
    cut = join_small(docs.select("doc", "rk", "text"), asked, ["doc", "rk"], "inner", F.size("a") * 24 + 96, _text_hash())
    pieces = stored(cut.mapInArrow(tidied(_cutter(kind, length)), _PIECE), "pieces")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((a, s, d, earlier or c == 1, w, p) for b in batches
                for a, s, d, c, w, p in zip(*(x.to_pylist() for x in b.columns)))
        yield from rebatched(judge(rows), pa.schema([(x, pa.int64()) for x in ("a", "s", "off", "m")]))

    ordered = (pieces.where("NOT hot").select(*key, "doc", "c", "w", "piece").repartition("a")
               .sortWithinPartitions("a", "doc", "s"))
    found = ordered.mapInArrow(tidied(judged), "a bigint, s bigint, off bigint, m bigint")
    # Hot anchors: a row per window; pre-aggregated counts, no group is gathered.
    single = pieces.where("hot").select(*key, "doc", "c", "off", "w1", "w2")
    again = single.groupBy("w1", "w2").agg(F.sum("c").alias("wc"), F.min("doc").alias("wd"))
    hit = single.join(again.where("wc > 1") if not earlier else again, ["w1", "w2"])
    hit = hit.where("wd < doc") if earlier else hit
    found = found.unionByName(hit.select(*key, "off", F.lit(1).cast("bigint").alias("m")))
    # Both joins take the segments straight from their table, so adaptive execution can split a hot segment.
    first = kinds.select(*key, F.col("at.doc").alias("first_doc"), "c")
    whole = segs.join(first, key).where("doc > first_doc" if earlier else "c > 1").select("doc", "rk", "start", "n")
    found = stored(found.join(first, key).where("true" if earlier else "c = 1").drop("c"), "found-windows")
    part = segs.drop("n").join(found, key).where("doc = first_doc").select(
        "doc", "rk", (F.col("start") + F.col("off")).alias("start"), F.col("m").alias("n"))
    return whole.unionByName(part)


_PIECE = ("a bigint, s bigint, doc bigint, c bigint, hot boolean, w bigint, off bigint, w1 bigint, w2 bigint, "
          "piece binary")


def _cutter(kind: type, length: int) -> Callable:
    i = pa.int64()
    schema = pa.schema([("a", i), ("s", i), ("doc", i), ("c", i), ("hot", pa.bool_()), ("w", i), ("off", i),
                        ("w1", i), ("w2", i), ("piece", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            asks = [batch.column(x) for x in ("start", "n", "a", "c", "hot")]
            for at, (doc, raw) in enumerate(zip(batch.column("doc").to_pylist(), utf8(batch, 2))):
                text = kind(raw)
                for start, n, a, c, hot in zip(*(x[at].as_py() for x in asks)):
                    span = text.span(start, n + length - 1)
                    head = (a, struct.unpack(">q", xxhash.xxh3_64_digest(span))[0], doc, c, hot, n)
                    if hot:
                        for o in range(n):
                            w1, w2 = struct.unpack("<qq", xxhash.xxh3_128_digest(text.span(start + o, length)))
                            yield (*head, o, w1, w2, None)
                    else:
                        yield (*head, 0, 0, 0, span)

    return lambda batches: rebatched(rows(batches), schema)


def ranges_by_text(ranges: DataFrame) -> DataFrame:
    """One row per text: doc, rk, starts, ends of its maximal runs of windows, merged."""
    lists = ranges.groupBy("doc", "rk").agg(F.collect_list(F.struct("start", "n")).alias("r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [], []
            for r in batch.column(2):
                r = r.values
                start, n = r.field("start").to_numpy(), r.field("n").to_numpy()
                by = np.argsort(start, kind="stable")
                start, end = start[by], np.maximum.accumulate((start + n)[by])
                new = np.concatenate([[True], start[1:] > end[:-1]])
                out[0].append(start[new])
                out[1].append(end[np.concatenate([new[1:], [True]])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.list_(pa.int64())) for x in out)],
                names=["doc", "rk", "starts", "ends"])

    return lists.mapInArrow(tidied(run), "doc bigint, rk bigint, starts array<bigint>, ends array<bigint>")


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of (doc, rk, ...) with the starts and ends of their text, or NULL."""
    return join_small(docs, stored(ranges_by_text(ranges), "ranges"), ["doc", "rk"], "left", F.size("starts") * 16 + 96,
                      _text_hash())


def covered(starts: pa.Scalar, ends: pa.Scalar, length: int) -> list[tuple[int, int]]:
    """Maximal [begin, end) runs of units that the window runs cover."""
    if not starts.is_valid:
        return []
    out: list[tuple[int, int]] = []
    for b, e in zip(starts.as_py(), ends.as_py()):
        e += length - 1
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], e)
        else:
            out.append((b, e))
    return out


def runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """Maximal [begin, end) runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


"""Exact substring dedup over suffix arrays built by linear grouping.

A byte is removed if a 400-byte string that covers it also starts anywhere else.
Anchors (see ``repeats``) bring together the stretches of text that can share
such a string. A shard of them is read as white-space delimited pieces, whose
suffixes are sorted in linear time: suffixes are grouped by their longest Lyndon
prefix, groups are taken in descending order, each group splits those before it
along previous-smaller pointers, and one ascending pass then emits the order of
every group, without renaming or recursion. Byte suffixes inside a piece follow
from the rank of the next piece. Neighbours in that order that agree in the
window length, byte for byte, are the repeats.

Defined results: NULL or empty text has no bytes and the digest of nothing;
repeated rows are repeats of each other; matches never cross documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import row_key, tidied, utf8
from courtside.llm.repeats import ByteText, covered, repeated_windows, runs, span_hashes, with_ranges

LAST = (1 << 63) - 1
SHARD_BYTES = 1 << 18


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of the suffixes of ``text`` (symbols above 0) in ascending order."""
    text = [*text, 0]  # an end symbol below all others
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)  # positions by group, groups ascending
    place = [0] * n
    group = [0] * n  # first place of the group of a position
    size = [0] * n  # by first place
    for k, i in enumerate(order):
        place[i] = k
        first = k if k == 0 or text[order[k - 1]] != text[i] else group[order[k - 1]]
        group[i] = first
        size[first] += 1
    prev = [-1] * n
    top = n
    while top:  # groups in descending order; all above ``top`` are final
        first = group[order[top - 1]]
        members = sorted(order[first:top])
        top = first
        times: dict[int, int] = defaultdict(int)
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= first:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                times[j] += 1
        by_times: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for j, c in times.items():
            by_times[c][group[j]].append(j)
        for c in sorted(by_times, reverse=True):
            for g, moved in by_times[c].items():
                end = g + size[g] - 1
                if len(moved) == size[g]:
                    continue  # the whole group moves: it stays
                for j in moved:
                    k, other = place[j], order[end]
                    order[k], order[end] = other, j
                    place[other], place[j] = k, end
                    end -= 1
                new = end + 1
                size[g] -= len(moved)
                size[new] = len(moved)
                for j in moved:
                    group[j] = new
    free = list(range(n))  # next free place by group
    out = [-1] * n
    done = bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = 1
            j = prev[j]
    return out[1:]


def _pieces(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Begins of the pieces of ``data``; a piece ends after its one white-space byte or at the end."""
    raw = np.frombuffer(data, np.uint8)
    cut = np.flatnonzero((raw == 32) | ((raw >= 9) & (raw <= 13))) + 1
    begins = np.concatenate([[0], cut[cut < len(raw)]])
    ends = np.append(begins[1:], len(raw))
    return begins, [data[b:e] for b, e in zip(begins.tolist(), ends.tolist())]


def repeated_starts(stretches: list[bytes], windows: list[int], length: int) -> list[np.ndarray]:
    """For each stretch, which of its first ``windows`` window starts hold a string seen at another start."""
    begins, pieces, base, tails = [], [], [], []
    at = 0
    for data in stretches:
        b, p = _pieces(data)
        begins.append(b + at)
        pieces.append(p)
        base.append(at)
        at += len(data)
        tails.append(at)
    rank = {p: r for r, p in enumerate(sorted({p for ps in pieces for p in ps}), len(stretches) + 1)}
    symbols: list[int] = []
    for k, ps in enumerate(pieces):  # each stretch ends with a symbol of its own
        symbols.extend([rank[p] for p in ps])
        symbols.append(k + 1)
    order = np.empty(len(symbols) + 1, np.int64)
    order[suffix_array(symbols)] = np.arange(len(symbols))
    # Piece that each byte lies in, counted with the end symbols.
    piece_begin = np.concatenate([np.append(b, t) for b, t in zip(begins, tails)])
    piece_next = np.concatenate([np.append(b[1:], [t, t]) for b, t in zip(begins, tails)])
    is_end = np.concatenate([np.append(np.zeros(len(b), bool), True) for b in begins])
    starts = np.concatenate([np.arange(b, b + w) for b, w in zip(base, windows)])
    of = np.flatnonzero(~is_end)
    of = of[np.searchsorted(piece_begin[of], starts, side="right") - 1]
    piece_end = piece_next[of]
    data = np.frombuffer(b"".join(stretches), np.uint8)
    long_ = piece_end >= starts + length
    rest = span_hashes(data, starts, np.where(long_, starts + length, piece_end))
    following = np.where(long_, 0, order[of + 1])
    by = np.lexsort((following, rest))
    a, b = starts[by[:-1]], starts[by[1:]]
    same = span_hashes(data, a, a + length) == span_hashes(data, b, b + length)
    at_ = np.flatnonzero(same)
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    for lo in range(0, len(at_), 8192):  # byte for byte
        part = at_[lo:lo + 8192]
        same[part] = (view[a[part]] == view[b[part]]).all(axis=1)
    hit = np.zeros(len(starts), bool)
    hit[by[:-1]] |= same
    hit[by[1:]] |= same
    return np.split(hit, np.cumsum(windows)[:-1])


def judge(length: int):
    """Repeated windows of the open segments, a shard of whole anchor groups at a time."""

    def settle(shard: list[tuple]) -> Iterator[tuple]:
        for row, hit in zip(shard, repeated_starts([r[5] for r in shard], [r[4] for r in shard], length)):
            if row[3]:
                for b, e in runs(hit):
                    yield row[0], row[1], b, e - b

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        shard, size = [], 0
        for row in rows:
            if size >= SHARD_BYTES and row[0] != shard[-1][0]:
                yield from settle(shard)
                shard, size = [], 0
            shard.append(row)
            size += len(row[5])
        if shard:
            yield from settle(shard)

    return run


def remove_repeated_bytes(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text",
                          max_units: int = 3_000_000) -> DataFrame:
    """Per row: id_col, n_bytes, n_removed, n_spans (maximal removed runs), kept (bytes)."""
    out = _marked(docs, length, id_col, text_col, (id_col,), max_units)
    return out.select(F.col("row")[id_col].alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")


def without_repeated_bytes(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text",
                           size_col: str | None = "n_chars", max_units: int = 3_000_000) -> DataFrame:
    """The rows with the rest of each text, columns unchanged but for the text and its size in characters.

    A character that the removal cuts through goes whole; a NULL text becomes empty.
    """
    carry = tuple(c for c in docs.columns if c not in (text_col, size_col))
    out = _marked(docs, length, id_col, text_col, carry, max_units, as_text=True)
    new = {text_col: F.col("kept"), size_col: F.length("kept").cast("bigint")}
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def _marked(docs: DataFrame, length: int, id_col: str, text_col: str, carry: tuple[str, ...], max_units: int,
            as_text: bool = False) -> DataFrame:
    keyed = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("doc"),
                        row_key(docs, id_col, text_col).alias("rk"), F.col(text_col).alias("text"),
                        F.struct(*carry).alias("row"))
    found = repeated_windows(keyed, ByteText, length, judge(length), False, max_units)
    marked = with_ranges(keyed, found).select("row", "text", "starts", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [], [], [], []
            for raw, starts, ends in zip(utf8(batch, 1), *batch.columns[2:]):
                gone = covered(starts, ends, length)
                kept = raw
                if gone:
                    edges = [0, *(x for r in gone for x in r), len(raw)]
                    kept = b"".join(raw[b:e] for b, e in zip(edges[::2], edges[1::2]))
                for column, value in zip(out, (len(raw), len(raw) - len(kept), len(gone), kept)):
                    column.append(value)
            kept = pa.array([k.decode("utf-8", "ignore") for k in out[3]], pa.string()) if as_text \
                else pa.array(out[3], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=pa.int64()) for c in out[:3]), kept],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept"])

    row = keyed.schema["row"].dataType.simpleString()
    return marked.mapInArrow(tidied(run), f"row {row}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                             f"kept {'string' if as_text else 'binary'}")

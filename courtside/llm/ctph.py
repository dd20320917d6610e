"""Context-triggered piecewise hashing of documents.

A rolling hash over the last seven bytes cuts a text wherever its value meets
the block size; each chunk becomes one character of the signature. The block
size is set by the length alone, and every fingerprint holds a second signature
at twice that size, so texts whose lengths differ by a factor of about two still
share a block size. Likeness is one minus the edit distance of the signatures
at a shared block size over the longer one's length (the best of them), else 0.

Defined results: NULL is the empty text, with fingerprint ``3::``; two empty
signatures at a shared block size are alike by 1. Neighbours go by descending
id, NULL ids last, equal ids by a hash of the text; the last's next is the first.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import rebatched, stored, texts, tidied

SMALLEST = 3
LENGTH = 64
ROLL = 7
BLOCK = 1 << 20
#: The 64 signature characters.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _cuts(raw: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks at block size ``size`` and at twice that."""
    once, twice = [], []
    data = np.frombuffer(raw, np.uint8)
    for lo in range(0, len(data), BLOCK):
        part = np.zeros(min(BLOCK, len(data) - lo) + ROLL - 1, np.uint32)
        begin = max(0, lo - ROLL + 1)
        part[ROLL - 1 - (lo - begin):] = data[begin:lo + BLOCK]
        n = len(part) - ROLL + 1
        plain, weighted, shifted = (np.zeros(n, np.uint32) for _ in range(3))
        for j in range(ROLL):  # j bytes back
            b = part[ROLL - 1 - j:ROLL - 1 - j + n]
            plain += b
            weighted += b * np.uint32(ROLL - j)
            shifted ^= b << np.uint32(5 * j)
        roll = plain + weighted + shifted
        at = np.flatnonzero(roll % np.uint32(size) == size - 1)
        once.append(at + lo + 1)
        at = at[roll[at] % np.uint32(2 * size) == 2 * size - 1]
        twice.append(at + lo + 1)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *once]), np.concatenate([none, *twice])


def _signature(raw: bytes, ends: np.ndarray, length: int) -> str:
    """One character per chunk; the last character takes all that is left."""
    ends = ends[:length - 1].tolist()
    if not ends or ends[-1] < len(raw):
        ends.append(len(raw))
    elif len(ends) == length - 1:
        ends[-1] = len(raw)
    begins = [0, *ends[:-1]]
    return "".join([ALPHABET[zlib.crc32(raw[b:e]) & 63] for b, e in zip(begins, ends) if e > b])


def fingerprint(text: str) -> str:
    """``size:signature:signature at twice the size``."""
    raw = text.encode()
    size = SMALLEST
    while size * LENGTH < len(raw):
        size *= 2
    once, twice = _cuts(raw, size)
    return f"{size}:{_signature(raw, once, LENGTH)}:{_signature(raw, twice, LENGTH // 2)}"


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: edit-distance likeness of two fingerprint columns."""

    def parts(fp: Column) -> tuple[Column, Column, Column]:
        p = F.split(fp, ":")
        return p[0].cast("bigint"), p[1], p[2]

    def near(x: Column, y: Column) -> Column:
        longest = F.greatest(F.length(x), F.length(y))
        return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(x, y) / longest)

    (size_a, a1, a2), (size_b, b1, b2) = parts(a), parts(b)
    return (F.when(a == b, F.lit(1.0)).when(size_a == size_b, F.greatest(near(a1, b1), near(a2, b2)))
            .when(size_a == 2 * size_b, near(a1, b2)).when(size_b == 2 * size_a, near(a2, b1)).otherwise(F.lit(0.0)))


def with_fingerprint(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each text."""

    @F.pandas_udf("string")
    def run(col):
        return col.map(lambda t: fingerprint(t or ""))

    return df.withColumn(out_col, run(F.coalesce(F.col(text_col), F.lit(""))))


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text, of its edited text, and how near these and the next text are.

    The edited text has its last floor(n / 2) characters replaced by the first as many of
    the next document's. Columns: id_col, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    Texts move once, into ranges of the id order; inside a range neighbours follow each
    other. Only the first and last text of each range are kept for the step across.
    """
    kind = docs.schema[id_col].dataType
    order = [F.desc_nulls_last("id"), F.asc("h")]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        first = next(batches, None)
        if first is None:
            return

        def out() -> Iterator[tuple]:
            """(place, first text, own text, id, n, sha, fp, edited fp, next fp): the last row lacks what follows."""
            held = None
            for batch in chain((first,), batches):
                for key, text in zip(batch.column(0).to_pylist(), texts(batch, 1)):
                    fp = fingerprint(text)
                    if held is None:
                        yield (place, text, None, key, len(text), None, fp, None, None)
                    else:
                        yield (place, None, None, *_finished(held, text, fp))
                    held = key, text, fp
            if held is not None:
                yield (place, None, held[1], held[0], len(held[1]), None, held[2], None, None)

        schema = pa.schema([("place", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
                            ("id", first.column(0).type), ("n", pa.int64()), ("sha", pa.string()), ("fp", pa.string()),
                            ("edited", pa.string()), ("next", pa.string())])
        yield from rebatched(out(), schema)

    fields = (f"place bigint, head string, tail string, id {kind.simpleString()}, n bigint, sha string, fp string, "
              "edited string, next string")
    done = stored(rows.select("id", "text").mapInArrow(tidied(run), fields), "neighbours")
    result = ["id", "n", "sha", "fp", "edited", "next"]
    inner = done.where("head IS NULL AND tail IS NULL").select(*result)
    # One row per range from here on: the last text of each meets the first of the next non-empty one.
    places = done.where("head IS NOT NULL").select("place")
    lead = F.lead("place").over(Window.orderBy("place"))
    steps = places.select("place", lead.alias("next_place"))
    steps = steps.select("place", F.coalesce("next_place", F.min("place").over(Window.orderBy(F.lit(1)))).alias("next_place"))
    heads = done.where("head IS NOT NULL").select(F.col("place").alias("next_place"), "head", F.col("fp").alias("head_fp"))
    ends = done.where("tail IS NOT NULL").select("place", "id", "tail", "fp").join(steps, "place").join(heads, "next_place")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("id", batch.column(0).type), ("n", pa.int64()), *((c, pa.string()) for c in result[2:])])
            cols = zip(*(c.to_pylist() for c in batch.columns))
            yield from rebatched((_finished((key, tail, fp), head, head_fp) for key, tail, fp, head, head_fp in cols), schema)

    last = ends.select("id", "tail", "fp", "head", "head_fp").mapInArrow(
        tidied(finish), f"id {kind.simpleString()}, n bigint, sha string, fp string, edited string, next string")
    both = inner.unionByName(last)
    return both.select(F.col("id").alias(id_col), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"),
                       F.col("fp").alias("fingerprint"), F.col("edited").alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next")).alias("near_next"))


def _finished(held: tuple[object, str, str], following: str, following_fp: str) -> tuple:
    key, text, fp = held
    edited = _edited(text, following)
    return (key, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp, fingerprint(edited), following_fp)

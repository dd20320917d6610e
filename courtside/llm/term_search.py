"""Ranked lexical search, term at a time with limited accumulators.

The documents are cut into shards, each with an inverted index over the words of
the queries. In a shard a query is worked off one term at a time, rarest first,
adding to one accumulator per document. Each term has an upper bound (its weight
times its largest impact in the shard). As soon as the bounds of all remaining
terms together stay below the k-th best partial score, or below the k-th best
score of the shards that the task has finished, a document without accumulator
can no longer be among the best: no accumulators are made from there on, and the
remaining terms only complete those that exist, exactly. The best k of each
shard then meet in one ranking per query, cut to k before it is shuffled.

Scores are integers: sum over the query's terms, repeats included, of
w * ((10**9 * tf) div (1000 * tf + 8 * m)) with w = floor(1000 ln((2N+2)/(2df+1)))
and m = 25 + (75 n N) div L.

Defined results: terms are runs of ASCII letters and digits and of any non-ASCII
characters, A-Z lower-cased; a NULL or empty text has none and is not counted in N.
Query rows with one id are one query (their terms together), NULL being an id too.
Rows that share a document id are documents of their own. Equal scores rank by
ascending document id (NULL last); documents with score 0 are not returned.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtside.llm.common import stored, text_batches, tidied, utf8

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
SLICE = 1 << 22
SHARD_DOCS, SHARD_POSTINGS = 1 << 16, 1 << 21
#: Distinct terms and words of the queries searched in one reading of the documents.
BLOCK_TERMS, BLOCK_WORDS = 1 << 17, 1 << 20


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a slice of it at a time."""
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):  # up to the next byte that is no part of a term
            while end < len(text) and _TABLE[text[end]] != 32:
                end += 1
        yield text[at:end].translate(_TABLE).split()
        at = end


def _blocks(queries: DataFrame, query_id: str, query_text: str) -> Iterator[list[tuple[object, Counter]]]:
    """Blocks of (query id, term counts), each within BLOCK_TERMS and BLOCK_WORDS unless it is one query."""
    rows = queries.select(F.col(query_id).alias("i"), F.col(query_text).cast("binary").alias("t"))
    block: dict[object, Counter] = {}
    words, vocabulary = 0, set()
    last = object()
    for row in rows.orderBy("i").toLocalIterator():
        own = Counter(t for part in terms(bytes(row["t"] or b"")) for t in part)
        size = sum(own.values())
        if row["i"] != last and block and (words + size > BLOCK_WORDS or len(vocabulary | own.keys()) > BLOCK_TERMS):
            yield list(block.items())
            block, words, vocabulary = {}, 0, set()
        last = row["i"]
        block.setdefault(last, Counter()).update(own)
        words += size
        vocabulary |= own.keys()
    if block:
        yield list(block.items())


def _postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Per document: id, n (all its terms) and the query terms it holds with their occurrences, by term number."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            n, held, times = [], [], []
            for text in utf8(batch, 1):
                size, found = 0, []
                for part in terms(text):
                    size += len(part)
                    ids = np.fromiter(map(number, part, repeat(-1)), np.int32, len(part))
                    found.append(ids[ids >= 0])
                u, c = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int32),) * 2
                n.append(size)
                held.append(u)
                times.append(c)
            ends = pa.array(np.concatenate([[0], np.cumsum([len(u) for u in held])]).astype(np.int32), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(kind)))
                     for x, kind in ((held, np.int32), (times, np.int64))] if n else [pa.array([], pa.list_(pa.int32())),
                                                                                    pa.array([], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists],
                                             names=["id", "n", "terms", "times"])

    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = frame.schema["id"].dataType.simpleString()
    return frame.mapInArrow(tidied(run), f"id {kind}, n long, terms array<int>, times array<long>")


class Shard:
    """Inverted index of some documents: per term its documents (by number, ascending) and impacts without weight."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, times: np.ndarray, norm: np.ndarray, n_terms: int):
        order = np.argsort(term, kind="stable")
        self.docs = doc[order]
        self.impact = (times * 10**9 // (times * 1000 + 8 * norm[doc]))[order]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=n_terms))])
        self.top = np.zeros(n_terms, np.int64)
        held = np.flatnonzero(np.diff(self.ends))
        if len(held):
            self.top[held] = np.maximum.reduceat(self.impact, self.ends[held])
        self.acc = np.zeros(len(norm), np.int64)

    def best(self, query: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, documents) of the best k for (term, weight) pairs, rarest first, best first; ``floor``: the k-th
        best score known from elsewhere. Documents that score below ``floor`` may be missing."""
        acc = self.acc
        acc[:] = 0
        bound = np.array([w * self.top[t] for t, w in query], np.int64)
        rest = np.cumsum(bound[::-1])[::-1]
        survivors = None
        for j, (t, w) in enumerate(query):
            docs, impact = (x[self.ends[t]:self.ends[t + 1]] for x in (self.docs, self.impact))
            if not len(docs) or not w:
                continue
            if survivors is None and self._closed(int(rest[j]), int(rest[0] - rest[j]), k, floor):
                survivors = np.flatnonzero(acc)
            if survivors is None:
                acc[docs] += w * impact
            elif len(docs) > 4 * len(survivors):
                at = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
                hit = docs[at] == survivors
                acc[survivors[hit]] += w * impact[at[hit]]
            else:
                known = acc[docs] > 0
                acc[docs[known]] += w * impact[known]
        found = np.flatnonzero(acc) if survivors is None else survivors
        if len(found) > k:
            least = np.partition(acc[found], len(found) - k)[len(found) - k]
            found = found[acc[found] >= least]
        found = found[np.argsort(-acc[found], kind="stable")][:k]
        return acc[found], found

    def _closed(self, rest: int, so_far: int, k: int, floor: int) -> bool:
        """Can no document without accumulator reach the best k any more?"""
        if rest < floor:
            return True
        if rest >= so_far:  # no partial score is above the bounds so far
            return False
        made = self.acc[self.acc > rest]
        return len(made) >= k


def _shards(batches: Iterator[pa.RecordBatch], n_docs: int, n_words: int, n_terms: int) -> Iterator[tuple[Shard, pa.Array]]:
    """Shards of bounded size with the ids of their documents, numbered in id order."""
    held: list[pa.RecordBatch] = []

    def build() -> tuple[Shard, pa.Array]:
        t = pa.Table.from_batches(held)
        t = t.take(pa.compute.sort_indices(t, sort_keys=[("id", "ascending")], null_placement="at_end"))
        lists = t.column("terms").combine_chunks()
        doc = np.repeat(np.arange(len(t)), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        norm = 25 + 75 * t.column("n").to_numpy() * n_docs // max(1, n_words)
        times = t.column("times").combine_chunks().flatten().to_numpy()
        return Shard(doc, lists.flatten().to_numpy(), times, norm, n_terms), t.column("id").combine_chunks()

    docs = postings = 0
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            held.append(part)
            docs += len(part)
            postings += len(part.column(2).flatten())
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield build()
                held, docs, postings = [], 0, 0
    if held:
        yield build()


def _ranked(postings: DataFrame, plans: list[list[tuple[int, int]]], n_terms: int, n_docs: int, n_words: int,
            k: int) -> DataFrame:
    """(query, id, score): the best k of each task's documents for each query of the block."""
    shared = postings.sparkSession.sparkContext.broadcast(plans)
    id_type = postings.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best: list[list[tuple]] = [[] for _ in own]  # per query (-score, id is NULL, id), best first
        kind = None
        for shard, ids in _shards(batches, n_docs, n_words, n_terms):
            kind = ids.type
            for q, plan in enumerate(own):
                floor = -best[q][-1][0] if len(best[q]) >= k else 0
                scores, docs = shard.best(plan, k, floor)
                new = [(-int(s), i is None, i) for s, i in zip(scores, ids.take(pa.array(docs)).to_pylist()) if s >= floor]
                if new:
                    best[q] = sorted(best[q] + new, key=lambda x: x[:2] if x[1] else x)[:k]
        if kind is not None:
            rows = [(q, i, -s) for q, some in enumerate(best) for s, _, i in some]
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], kind),
                                              pa.array(cols[2], pa.int64())], names=["query", "id", "score"])

    return postings.mapInArrow(tidied(run), f"query int, id {id_type}, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """The best ``k`` documents of each query: query_id, rank (from 1), id_col, score.

    The queries are a stated set, taken in blocks whose vocabulary is broadcast
    (BLOCK_TERMS terms, BLOCK_WORDS words at most, but for a single longer query);
    documents are read once per block, and only the words of its queries are kept.
    """
    spark: SparkSession = docs.sparkSession
    text_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    query_type = queries.schema[query_id].dataType
    out = None
    counts = None
    for block in _blocks(queries, query_id, query_text):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in block for t in c}))}
        postings = stored(_postings(docs, vocabulary, id_col, text_col), "search-postings")
        if counts is None:
            counts = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
        n_docs, n_words = counts["docs"], counts["n"]
        df = dict(postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
        plans = [[(t, weight[t] * times) for _, t, times in sorted(
            (df[vocabulary[w]], vocabulary[w], times) for w, times in c.items() if vocabulary[w] in df)] for _, c in block]
        found = _ranked(postings, plans, len(vocabulary), n_docs, n_words, k)
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)],
                                      f"query int, `{query_id}` {query_type.simpleString()}")
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(names, "query")
        top = top.select(query_id, "rank", F.col("id").alias(id_col), "score")
        out = top if out is None else out.unionByName(top)
    if out is None:
        return spark.createDataFrame([], f"`{query_id}` {query_type.simpleString()}, rank int, `{id_col}` {id_type}, score long")
    return out

"""Substring dedup with suffix automata of reference shards.

A window of 50 words is removed if its word sequence also starts in a document
with a smaller id. Anchors (see ``repeats``) route text to the reference shard
of each shared anchor; there documents stream in ascending id order through the
shard's suffix automaton, which holds the text of all smaller ids: the matching
statistics give, for every word, the longest match ending there, and every
maximal span of at least the window length is removed. Sending every shard to
every document instead would be quadratic in the corpus.

Defined results: NULL or empty text has no words and an empty rest; rows with
one id do not remove each other's words; a NULL id counts as larger than all others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import rebatched, row_key, tidied, utf8
from courtside.llm.repeats import WordText, covered, repeated_windows, runs, with_ranges

LAST = (1 << 63) - 1


class SuffixAutomaton:
    """All substrings of the token sequences added so far."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size = [-1], [0]

    def add(self, tokens: Iterable) -> None:
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for t in tokens:
            q = nxt[last].get(t)
            if q is not None and size[q] == size[last] + 1:
                last = q
                continue
            if q is not None:
                last = self._split(last, q, t)
                continue
            new = len(nxt)
            nxt.append({})
            link.append(0)
            size.append(size[last] + 1)
            p = last
            while p >= 0 and t not in nxt[p]:
                nxt[p][t] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][t]
                link[new] = q if size[q] == size[p] + 1 else self._split(p, q, t)
            last = new

    def _split(self, p: int, q: int, t) -> int:
        nxt, link, size = self.next, self.link, self.size
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        size.append(size[p] + 1)
        link[q] = new
        while p >= 0 and nxt[p].get(t) == q:
            nxt[p][t] = new
            p = link[p]
        return new

    def statistics(self, tokens: Iterable) -> Iterator[int]:
        """Length of the longest suffix of each prefix that the automaton holds."""
        nxt, link, size = self.next, self.link, self.size
        state, n = 0, 0
        for t in tokens:
            while state and t not in nxt[state]:
                state = link[state]
                n = size[state]
            q = nxt[state].get(t)
            if q is not None:
                state, n = q, n + 1
            else:
                state, n = 0, 0
            yield n


def judge(length: int, shard_words: int = 40_000):
    """Windows of each segment that an automaton of segments with smaller ids holds.

    The segments of an anchor come in ascending id order. Each shard of them is
    built and read in turn, then all later segments are streamed against it.
    """

    def settle(group: list[tuple]) -> Iterator[tuple]:
        texts = [(doc, piece.split(b" ")) for _, _, doc, _, _, piece in group]
        best = [np.zeros(len(words), bool) for _, words in texts]  # where a matching window ends

        def read(k: int, shard: SuffixAutomaton) -> None:
            words = texts[k][1]
            best[k] |= np.fromiter(shard.statistics(words), np.int64, len(words)) >= length

        at = 0
        while at < len(texts):
            end, held = at, 0  # a shard ends where an id ends
            while end < len(texts) and (held < shard_words or texts[end][0] == texts[end - 1][0]):
                held += len(texts[end][1])
                end += 1
            shard, added = SuffixAutomaton(), at
            for k in range(at, end):
                while texts[added][0] < texts[k][0]:
                    shard.add(texts[added][1])
                    added += 1
                if added > at:
                    read(k, shard)
            if end < len(texts):
                for k in range(added, end):
                    shard.add(texts[k][1])
            for k in range(end, len(texts)):
                read(k, shard)
            at = end
        for row, ends in zip(group, best):
            for b, e in runs(ends):
                yield row[0], row[1], b - length + 1, e - b

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for _, group in groupby(rows, key=itemgetter(0)):
            yield from settle(list(group))

    return run


def remove_repeated_words(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
                          max_units: int = 1_000_000) -> DataFrame:
    """Per row: id_col, n_words, n_removed, spans (removed runs as [begin, end) of words), kept (text)."""
    keyed = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("doc"),
                        row_key(docs, id_col, text_col).alias("rk"), F.col(text_col).alias("text"))
    found = repeated_windows(keyed, WordText, length, judge(length), True, max_units)
    marked = with_ranges(keyed, found).select("id", "text", "starts", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("id", batch.column(0).type), ("n", pa.int64()), ("m", pa.int64()),
                                ("s", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                                ("k", pa.string())])

            def rows(batch=batch):
                for key, raw, starts, ends in zip(batch.column(0).to_pylist(), utf8(batch, 1), *batch.columns[2:]):
                    words = raw.split()
                    gone, kept, at = covered(starts, ends, length), [], 0
                    for b, e in gone:
                        kept += words[at:b]
                        at = e
                    kept += words[at:]
                    yield (key, len(words), len(words) - len(kept), [{"begin": b, "end": e} for b, e in gone],
                           b" ".join(kept).decode())

            yield from rebatched(rows(), schema)

    kind = docs.schema[id_col].dataType.simpleString()
    return marked.mapInArrow(tidied(run), f"id {kind}, n bigint, m bigint, s array<struct<begin:bigint,end:bigint>>, k string") \
        .toDF(id_col, "n_words", "n_removed", "spans", "kept")

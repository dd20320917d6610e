"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models over words, one of toxic and one of ordinary texts, with
absolute discounting: pairs of words, below them words by their continuation
counts (in how many different contexts a word occurs), below these the
continuation counts of both classes together. A text counts a pair once, so
that a line it repeats teaches nothing. Rare expressions (pairs in
less than ``min_pairs`` texts, words of less than ``min_contexts`` contexts) are not told
apart by class: both models give them the shared backoff, and they cancel out.

A toxic text is ordinary in most of its words. Its likelihood is therefore that of
the mixture (1 - mix) * ordinary + mix * toxic, word by word; the statistic of a text is
log-likelihood of the mixture minus that of the ordinary model, divided by the
number of words. One logistic curve, fitted on a held-back fifth, turns it into the
score.

The models are fitted on at most ``rows`` labelled texts of each class, the first by a hash
of the id, each text whole. That is the only bound; the counts are made by Spark, and what
comes to the driver are those of the frequent expressions of the sample. Scoring reads
every text as a whole and knows nothing but the text.

Defined results: NULL and empty texts, and all texts if one of the classes has no
row, get the share of toxic rows among the labelled ones (0 if there are none).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import rebatched, stored, text_batches, tidied, utf8
from courtside.llm.term_search import terms

DISCOUNT = 0.75
_PAIRS = pa.schema([("prev", pa.binary()), ("word", pa.binary()), ("c0", pa.int64()), ("c1", pa.int64())])
PAIRS_HELD = 1 << 16  # pairs that a task counts before it hands them on, about 300 bytes each


@dataclass
class Model:
    """Gains of words and pairs (log mixture likelihood over ordinary likelihood), and the curve of the score."""

    number: dict[bytes, int]
    gain: np.ndarray
    pairs: np.ndarray  # prev * len(gain) + word, ascending
    pair_gain: np.ndarray
    slope: float
    offset: float
    prior: float

    def statistic(self, text: bytes) -> float | None:
        """Mean gain of the words; None if there are none."""
        total, n, before = 0.0, 0, self.number.get(b"", -1)
        get, size = self.number.get, len(self.gain) - 1  # the last gain is that of every other word: 0
        for part in terms(text):
            if not part:
                continue
            ids = np.fromiter(map(get, part, repeat(size)), np.int64, len(part))
            prev = np.concatenate([[before], ids[:-1]])
            before = int(ids[-1])
            gains = self.gain[ids]
            if len(self.pairs):
                both = np.flatnonzero((ids < size) & (prev < size) & (prev >= 0))
                key = prev[both] * size + ids[both]
                at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
                hit = self.pairs[at] == key
                gains[both[hit]] = self.pair_gain[at[hit]]
            total += float(gains.sum())
            n += len(part)
        return total / n if n else None

    def score(self, text: bytes) -> float:
        x = self.statistic(text) if len(self.gain) > 1 else None
        return self.prior if x is None else float(1 / (1 + np.exp(-np.clip(self.slope * x + self.offset, -30, 30))))


def _count_pairs(rows: DataFrame) -> DataFrame:
    """(prev, word, c0, c1) of rows (toxic, text): the ordinary and the toxic texts that hold the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> Iterator[pa.RecordBatch]:
            yield from rebatched(((a, b, held[0][a, b], held[1][a, b]) for a, b in held[0].keys() | held[1].keys()), _PAIRS)
            held[0].clear()
            held[1].clear()

        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), utf8(batch, 1)):
                before, own = b"", set()
                for part in terms(text):
                    if part:
                        own.update(zip([before] + part[:-1], part))
                        before = part[-1]
                held[toxic].update(own)
                if len(held[0]) + len(held[1]) > PAIRS_HELD:
                    yield from flush()
        yield from flush()

    pairs = rows.select("toxic", "text").mapInArrow(tidied(run), "prev binary, word binary, c0 long, c1 long")
    return pairs.groupBy("prev", "word").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def _gains(pairs: DataFrame, mix: float, min_contexts: int, min_pairs: int) -> Model:
    """The model of counted pairs, without its curve."""
    seen = lambda c: F.count_if(F.col(c) > 0)
    words = stored(pairs.groupBy("word").agg(seen("c0").alias("t0"), seen("c1").alias("t1")), "toxicity-words")
    t = words.agg(F.sum("t0").alias("s0"), F.sum("t1").alias("s1"), seen("t0").alias("v0"), seen("t1").alias("v1"),
                  F.count("*").alias("v")).first()
    if not t["s0"] or not t["s1"]:
        return Model({}, np.zeros(1), np.zeros(0, np.int64), np.zeros(0), 0.0, 0.0, 0.0)
    frequent = words.where(F.col("t0") + F.col("t1") >= min_contexts)
    got = frequent.orderBy("word").toArrow()
    spell = got.column("word").to_pylist()
    number = {w: i for i, w in enumerate(spell)}
    d = DISCOUNT
    t0, t1 = (got.column(c).to_numpy().astype(float) for c in ("t0", "t1"))
    share = (np.maximum(t0 + t1 - d, 0) + d * t["v"] / (t["v"] + 1)) / (t["s0"] + t["s1"])
    p0 = (np.maximum(t0 - d, 0) + d * t["v0"] * share) / t["s0"]
    p1 = (np.maximum(t1 - d, 0) + d * t["v1"] * share) / t["s1"]
    context = pairs.groupBy("prev").agg(*[f(c).alias(n) for c, n, f in (("c0", "n0", F.sum), ("c1", "n1", F.sum),
                                                                        ("c0", "k0", seen), ("c1", "k1", seen))])
    known = pairs.where(F.col("c0") + F.col("c1") >= min_pairs).join(frequent.select("word"), "word", "left_semi") \
        .join(context.where("n0 > 0 AND n1 > 0"), "prev")
    got = known.toArrow()
    number.setdefault(b"", len(number))  # the context of a text's first word, no word itself
    p0, p1 = (np.append(p, 1.0) if len(number) > len(p) else p for p in (p0, p1))
    word = np.array([number[w] for w in got.column("word").to_pylist()], np.int64)
    prev = np.array([number.get(w, -1) for w in got.column("prev").to_pylist()], np.int64)
    c0, c1, n0, n1, k0, k1 = (got.column(c).to_numpy().astype(float) for c in ("c0", "c1", "n0", "n1", "k0", "k1"))
    q0 = (np.maximum(c0 - d, 0) + d * k0 * p0[word]) / n0
    q1 = (np.maximum(c1 - d, 0) + d * k1 * p1[word]) / n1
    key = prev * len(number) + word
    order = np.argsort(key)
    order = order[prev[order] >= 0]
    gain = lambda toxic, ordinary: np.log((1 - mix) + mix * toxic / ordinary)
    return Model(number, np.append(gain(p1, p0), 0.0), key[order], gain(q1, q0)[order], 0.0, 0.0, 0.0)


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope (not below 0) and offset of the weighted logistic regression of y on x, by Newton's method."""
    level = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    if len(set(y.tolist())) < 2 or not np.ptp(x):
        return 0.0, level
    mean, spread = np.average(x, weights=weight), np.sqrt(np.cov(x, aweights=weight)) or 1.0
    z = np.stack([(x - mean) / spread, np.ones(len(x))])
    beta = np.array([0.0, level])
    ridge = np.diag([1.0, 1e-6])  # separable classes would run away
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta @ z, -30, 30)))
        step = np.linalg.solve((z * (weight * np.maximum(p * (1 - p), 1e-6))) @ z.T + ridge,
                               z @ (weight * (p - y)) + ridge @ [beta[0], 0.0])
        beta = beta - np.clip(step, -2, 2)
    slope = max(0.0, beta[0] / spread)
    return float(slope), float(beta[1] - slope * mean) if slope else level


def fit(docs: DataFrame, labels: DataFrame, training: Column, rows: int = 5000, mix: float = 0.01, min_contexts: int = 3,
        min_pairs: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on the labelled texts where ``training`` (of the id) holds; ``rows`` bounds the texts of each class."""
    text_batches(docs.sparkSession)
    own = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("toxic"), training.alias("__in"))
    own = own.where("__in AND toxic IN (0, 1) AND __id IS NOT NULL").groupBy("__id").agg(F.max("toxic").alias("toxic"))
    own = stored(own.withColumn("h", F.xxhash64(F.lit("toxicity"), "__id")), "toxicity-labels")
    counts = {r["toxic"]: r["count"] for r in own.groupBy("toxic").count().collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    taken = {c: min(rows, n) for c, n in counts.items()}
    sample = [own.where(F.col("toxic") == c).orderBy("h", "__id").limit(rows) for c in (0, 1)]
    sample = stored(sample[0].unionByName(sample[1]), "toxicity-sample")  # 2 * rows ids at most
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "__id")
    fold = F.pmod("h", F.lit(5))
    pairs = stored(_count_pairs(texts.where(fold != 0)), "toxicity-pairs")
    model = _gains(pairs, mix, min_contexts, min_pairs)
    model.prior = prior
    if len(model.gain) > 1:
        held = _apply(texts.where(fold == 0).select("toxic", "text"), model, Model.statistic).where("value IS NOT NULL")
        got = held.select("row.toxic", "value").toPandas().sort_values(["toxic", "value"])  # in one order always
        weight = got["toxic"].map({c: counts[c] / taken[c] for c in counts}).to_numpy(float)
        model.slope, model.offset = _curve(got["value"].to_numpy(float), got["toxic"].to_numpy(float), weight, prior)
    return model


def _apply(frame: DataFrame, model: Model, what) -> DataFrame:
    """(row, value): ``what`` of the model for the text, the last column; ``row`` holds the others."""
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            values = pa.array([what(own, t) for t in utf8(batch, 1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["row", "value"])

    *others, text = frame.columns
    frame = frame.select(F.struct(*others).alias("row"), text)
    return frame.mapInArrow(tidied(run), f"row {frame.schema['row'].dataType.simpleString()}, value double")


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
          carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id_col, ``carry``, score (0 to 1) and predicted (1 if the score reaches ``threshold``)."""
    text_batches(docs.sparkSession)
    out = _apply(docs.select(id_col, *carry, F.col(text_col).alias("__text")), model, Model.score)
    return out.select(*[F.col("row")[c].alias(c) for c in (id_col, *carry)], F.col("value").alias("score"),
                      (F.col("value") >= threshold).cast("int").alias("predicted"))

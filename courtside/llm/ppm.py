"""Language-model scores by prediction by partial matching over bytes.

A trie of byte contexts up to ``order`` symbols predicts each next byte (and the
end of the text). The longest known context is asked first; a symbol that it has
not seen costs an escape (method C: as many as it has different symbols), and
the next shorter context is asked without the symbols already excluded, down to
a uniform choice. A trained trie scores documents with fixed counts; without
training the trie of each document adapts as it reads.

Training counts are gathered by distributed sums over all training documents:
(order + 1)-grams for the trie, from which all shorter contexts follow, and
words for the unigram base. The order is the same at every size. A trie of up to
``max_grams`` grams is broadcast whole, after its grams have been counted. Of a
larger one (2**21 grams hold 0.25 GB of a worker, 0.4 while they are arranged) the
grams of the highest counts are broadcast with their costs, whole
count classes only; each text's other grams are counted, and their costs come
from stored tables of grams and contexts by joins, one level of escapes at a
time. Words with high counts are looked up in a broadcast table of bounded size,
all others by a join.

Defined results: NULL text is the empty text, which still has its end to
predict; a NULL id counts as the empty text when the fold is taken; repeated
rows are scored each; with no training rows every symbol is uniform.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import stored, tidied, utf8

END, START, BASE = 256, 257, 258
SYMBOLS = 257  # bytes and the end
BLOCK = 1 << 20


class ContextTrie:
    """Adaptive model: counts by context, updated as symbols come."""

    def __init__(self, order: int):
        self.order = order
        self.counts: dict[tuple, Counter] = defaultdict(Counter)

    def cost(self, context: tuple, symbol: int) -> float:
        """log10 probability of the symbol after the context."""
        total, excluded = 0.0, set()
        for n in range(self.order, -1, -1):
            seen = self.counts.get(context[len(context) - n:])
            if not seen:
                continue
            if excluded:
                seen = {s: c for s, c in seen.items() if s not in excluded}
            if not seen:
                continue
            mass = sum(seen.values()) + len(seen)
            if symbol in seen:
                return total + math.log10(seen[symbol] / mass)
            total += math.log10(len(seen) / mass)
            excluded |= seen.keys()
        return total - math.log10(SYMBOLS - len(excluded))

    def update(self, context: tuple, symbol: int) -> None:
        for n in range(self.order + 1):
            self.counts[context[len(context) - n:]][symbol] += 1

    def read(self, raw: bytes, learn: bool = True) -> float:
        """log10 probability of a text and its end; learns each symbol after predicting it."""
        context, total = (START,) * self.order, 0.0
        for s in (*raw, END):
            total += self.cost(context, s)
            if learn:
                self.update(context, s)
            context = (*context, s)[1:] if self.order else ()
        return total


def _sequence(raws: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as symbols, ``order`` start marks before and an end after each; the begin of each text."""
    pad = bytes(order)
    seq = np.frombuffer(b"".join([x for r in raws for x in (pad, r, b"\0")]), np.uint8).astype(np.uint16)
    ends = np.cumsum(np.array([len(r) + order + 1 for r in raws], np.int64))
    begins = np.concatenate([[0], ends[:-1]])
    for k in range(order):
        seq[begins + k] = START
    seq[ends - 1] = END
    return seq, begins


def _gram_blocks(seq: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the last symbol, gram key) of every predicted symbol, a block at a time."""
    for lo in range(order, len(seq), BLOCK):
        hi = min(len(seq), lo + BLOCK)
        key = np.zeros(hi - lo, np.uint64)
        for j in range(order, -1, -1):
            key *= np.uint64(BASE)
            key += seq[lo - j:hi - j]
        last = seq[lo:hi] != START
        yield np.flatnonzero(last) + lo, key[last]


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    first = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _batches(batch: pa.RecordBatch, column: int) -> Iterator[list[bytes]]:
    """Lower-cased texts of a batch in lists of about BLOCK bytes (or one longer text)."""
    out, size = [], 0
    for raw in utf8(batch, column):
        out.append(raw.lower())
        size += len(raw)
        if size >= BLOCK:
            yield out
            out, size = [], 0
    if out:
        yield out


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """(g, n): how often each (order + 1)-gram occurs in the one text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def give(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["g", "n"])

        for batch in batches:
            for raws in _batches(batch, 0):
                for _, key in _gram_blocks(_sequence(raws, order)[0], order):
                    keys, n = np.unique(key, return_counts=True)
                    parts.append((keys, n.astype(np.int64)))
                    held += len(keys)
                if held > 2_000_000:
                    merged = _merge(*(np.concatenate(c) for c in zip(*parts)))
                    if len(merged[0]) > 1_000_000:
                        yield give(*merged)
                        merged = (merged[0][:0], merged[1][:0])
                    parts, held = [merged], len(merged[0])
        if parts:
            yield give(*_merge(*(np.concatenate(c) for c in zip(*parts))))

    return texts.mapInArrow(tidied(run), "g bigint, n bigint").groupBy("g").agg(F.sum("n").alias("n"))


class CostTable:
    """Costs of gram keys by open addressing; NaN for a key that it does not hold."""

    def __init__(self, keys: np.ndarray, costs: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_key = np.full(1 << bits, np.uint64(2 ** 64 - 1))
        self.slot_cost = np.zeros(1 << bits)
        left = np.arange(len(keys))
        at = self._slot(keys)
        while len(left):
            free = self.slot_key[at] == np.uint64(2 ** 64 - 1)
            self.slot_key[at[free]] = keys[left[free]]
            placed = self.slot_key[at] == keys[left]
            self.slot_cost[at[placed]] = costs[left[placed]]
            left, at = left[~placed], (at[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        held = self.slot_key[at]
        out = self.slot_cost[at]
        miss = np.flatnonzero(held != keys)
        while len(miss):  # step on while another key holds the slot
            more = self.slot_key[at[miss]] != np.uint64(2 ** 64 - 1)
            out[miss[~more]] = np.nan
            miss = miss[more]
            at[miss] = (at[miss] + 1) & self.mask
            hit = self.slot_key[at[miss]] == keys[miss]
            out[miss[hit]] = self.slot_cost[at[miss[hit]]]
            miss = miss[~hit]
        return out


def text_costs(raws: list[bytes], order: int, look) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sum of the known costs of each text, and (text, gram, count) of the grams for which ``look`` gives NaN, by text."""
    seq, begins = _sequence(raws, order)
    out = np.zeros(len(raws))
    of, grams, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for place, key in _gram_blocks(seq, order):
        doc = np.searchsorted(begins, place, side="right") - 1
        first = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1])
        cost = look(key)
        left = np.flatnonzero(np.isnan(cost))
        if len(left):
            cost[left] = 0
            d, g = doc[left], key[left]
            by = np.lexsort((g, d))
            d, g = d[by], g[by]
            new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (g[1:] != g[:-1])]))
            of.append(d[new])
            grams.append(g[new])
            counts.append(np.diff(new, append=len(d)))
        out[doc[first]] += np.add.reduceat(cost, first)
    return out, np.concatenate(of), np.concatenate(grams), np.concatenate(counts)


class FixedTrie:
    """A trained trie as sorted tables, scoring many symbols at once."""

    def __init__(self, order: int, keys: np.ndarray, counts: np.ndarray):
        self.order = order
        self.levels = []
        keys, counts = _merge(keys.astype(np.uint64), counts.astype(np.float64))
        for o in range(order, -1, -1):
            keys, counts = _merge(keys % np.uint64(BASE ** (o + 1)), counts)
            context = keys // np.uint64(BASE)
            first = np.concatenate([[0], np.flatnonzero(context[1:] != context[:-1]) + 1]) if len(keys) \
                else np.zeros(0, np.int64)
            level = {"gram": keys, "n": counts, "context": context[first], "first": first,
                     "total": np.add.reduceat(counts, first) if len(first) else counts,
                     "kinds": np.diff(first, append=len(keys)).astype(np.float64)}
            if self.levels:  # what the symbols of each longer context weigh in this level
                above = self.levels[-1]
                weight = counts[np.searchsorted(keys, above["gram"] % np.uint64(BASE ** (o + 1)))] if len(keys) \
                    else counts
                above["below"] = np.add.reduceat(weight, above["first"]) if len(weight) else weight
            self.levels.append(level)
        self.levels[-1]["below"] = np.zeros(len(self.levels[-1]["context"]))
        top = self.levels[0]  # the longest grams, which nearly every symbol hits
        per = np.repeat(top["total"] + top["kinds"], top["kinds"].astype(np.int64))
        self.table = CostTable(top["gram"], np.log10(top["n"] / per) if len(per) else np.zeros(0))

    def costs(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each gram given the others."""
        out = self.table.look(keys)
        unseen = np.flatnonzero(np.isnan(out))
        if len(unseen):
            out[unseen] = self._escaped(keys[unseen])
        return out

    def _escaped(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        weight, kinds = np.zeros(len(keys)), np.zeros(len(keys))  # excluded at the level at hand
        for o, level in zip(range(self.order, -1, -1), self.levels):
            if not len(level["gram"]) or not len(left):
                continue
            gram = keys[left] % np.uint64(BASE ** (o + 1))
            at = np.minimum(np.searchsorted(level["context"], gram // np.uint64(BASE)), len(level["context"]) - 1)
            known = level["context"][at] == gram // np.uint64(BASE)
            total, own = level["total"][at] - weight[left], level["kinds"][at] - kinds[left]
            g = np.minimum(np.searchsorted(level["gram"], gram), len(level["gram"]) - 1)
            hit = known & (level["gram"][g] == gram)
            mass = np.maximum(total + own, 1)
            out[left[hit]] += np.log10(level["n"][g[hit]] / mass[hit])
            escape = known & ~hit & (own > 0)
            out[left[escape]] += np.log10(own[escape] / mass[escape])
            step = known & ~hit
            weight[left[step]], kinds[left[step]] = level["below"][at[step]], level["kinds"][at[step]]
            left = left[~hit]
        out[left] -= np.log10(SYMBOLS - kinds[left])
        return out

    def scores(self, raws: list[bytes]) -> np.ndarray:
        """log10 probability of each text and its end."""
        return text_costs(raws, self.order, self.costs)[0]


class TrieTables:
    """A trained trie of any size as stored tables, one of grams and one of contexts for each order."""

    def __init__(self, grams: DataFrame, order: int):
        self.order = order
        self.grams, self.contexts = [grams], []
        for o in range(order, -1, -1):
            above = self.grams[-1]
            rows = above.select("g", "n", (F.col("g") % F.lit(BASE ** o)).alias("lower"))
            if o:  # what the symbols of each context weigh one level below
                lower = above.groupBy((F.col("g") % F.lit(BASE ** o)).alias("g")).agg(F.sum("n").alias("n"))
                self.grams.append(stored(lower, "grams"))
                rows = rows.join(self.grams[-1].select(F.col("g").alias("lower"), F.col("n").alias("w")), "lower")
            else:
                rows = rows.withColumn("w", F.lit(0).cast("bigint"))
            self.contexts.append(stored(rows.groupBy(F.expr(f"g div {BASE}").alias("c")).agg(
                F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum("w").alias("below")), "contexts"))

    def frequent(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(grams, costs) of the grams of the highest counts, whole count classes only, at most ``most`` grams."""
        least = least_count(self.grams[0], most)
        if least is None:
            return np.zeros(0, np.uint64), np.zeros(0)
        top = self.grams[0].where(F.col("n") >= least).withColumn("c", F.expr(f"g div {BASE}"))
        held = top.join(self.contexts[0], "c").select(
            "g", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("cost")).toArrow()
        return held.column("g").to_numpy().astype(np.uint64), held.column("cost").to_numpy()

    def costs(self, asked: DataFrame) -> DataFrame:
        """(g, cost) of the different grams ``g`` in ``asked``: seen ones at once, the others level by level."""
        zero = F.lit(0).cast("bigint")
        rows = asked.select("g", F.lit(0.0).alias("cost"), zero.alias("weight"), zero.alias("out"), F.lit(False).alias("done"))
        rows = stored(self._level(rows, 0), "gram-costs")
        settled, rows = rows.where("done").select("g", "cost"), rows.where("NOT done")
        for k in range(1, self.order + 1):
            rows = self._level(rows, k)
        uniform = F.when(F.col("done"), F.lit(0.0)).otherwise(F.log10(F.lit(SYMBOLS) - F.col("out")))
        return settled.unionByName(rows.select("g", F.coalesce(F.col("cost") - uniform, "cost").alias("cost")))

    def _level(self, rows: DataFrame, k: int) -> DataFrame:
        """One level of escapes: ``weight`` and ``out`` are the count and number of symbols excluded at it."""
        o = self.order - k
        grams = self.grams[k].select(F.col("g").alias("short"), "n")
        rows = rows.withColumn("short", F.col("g") % F.lit(BASE ** (o + 1))).withColumn("c", F.expr(f"short div {BASE}"))
        rows = rows.join(grams, "short", "left").join(self.contexts[k], "c", "left")
        own = F.col("kinds") - F.col("out")
        mass = F.greatest(F.col("total") - F.col("weight") + own, F.lit(1))
        hit, known = ~F.col("done") & F.col("n").isNotNull(), ~F.col("done") & F.col("n").isNull() & F.col("kinds").isNotNull()
        step = F.when(hit, F.log10(F.col("n") / mass)).when(known & (own > 0), F.log10(own / mass)).otherwise(F.lit(0.0))
        return rows.select("g", (F.col("cost") + step).alias("cost"),
                           F.when(known, F.col("below")).otherwise(F.col("weight")).alias("weight"),
                           F.when(known, F.col("kinds")).otherwise(F.col("out")).alias("out"),
                           (F.col("done") | F.col("n").isNotNull()).alias("done"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the one text column, summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def give() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()),
                                              pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for raw in utf8(batch, 0):
                counts.update(raw.lower().split())
                if len(counts) > 250_000:
                    yield give()
        if counts:
            yield give()

    return texts.mapInArrow(tidied(run), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def least_count(counts: DataFrame, most: int) -> int | None:
    """Lowest count whose class and all higher ones hold at most ``most`` rows together; None if no class fits."""
    classes = counts.groupBy(F.least("n", F.lit(1 << 20)).alias("n")).agg(F.count(F.lit(1)).alias("k"))
    least, held = None, 0
    for r in classes.orderBy(F.desc("n")).collect():  # one row per different count, 2**20 at most
        held += r["k"]
        if held > most:
            break
        least = r["n"]
    return least


def frequent_words(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The words of the highest counts, whole count classes only, at most ``most`` words."""
    least = least_count(counts, most)
    if least is None:
        return {}
    return {bytes(r["word"]): r["n"] for r in counts.where(F.col("n") >= least).collect()}


#: The model that this worker process made last: (key, costs, logs, ends).
_MADE: dict[str, tuple] = {}


def _model(key: str, shared, order: int, whole: bool) -> tuple:
    """(look-up of gram costs, logs of the frequent words, ends), made once per worker process and model."""
    if _MADE.get("model", ("",))[0] != key:
        _MADE.clear()  # the model before goes first: two do not fit beside each other
        trie, frequent, ends = shared.value
        costs = FixedTrie(order, *trie).costs if whole else CostTable(*trie).look
        _MADE["model"] = key, costs, {w: math.log10(n + 1) for w, n in frequent.items()}, ends
    return _MADE["model"][1:]


def score(docs: DataFrame, training: Column, order: int = 4, id_col: str = "doc_id", text_col: str = "text",
          max_words: int = 1 << 17, max_grams: int = 1 << 21) -> DataFrame:
    """Scores of all rows by the model of the rows where ``training`` holds.

    Columns: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score. Tokens are the
    words of the lower-cased text and one end; base_score is their add-one unigram log10 probability.
    ``max_words`` and ``max_grams`` bound what is broadcast, not the result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (~training).alias("held_out"))
    learnt = rows.where("NOT held_out").select("text")
    grams, tables = stored(gram_counts(learnt, order), "grams"), None
    if whole := grams.count() <= max_grams:
        held = grams.toArrow()
        trie = held.column("g").to_numpy(), held.column("n").to_numpy()
    else:
        tables = TrieTables(grams, order)
        trie = tables.frequent(max_grams)
    words = stored(word_counts(learnt), "words")
    n_train = learnt.count()
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    total, kinds = total + n_train, kinds + (n_train > 0)
    model = spark.sparkContext.broadcast((trie, frequent_words(words, max_words), n_train))
    model_key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, logs, ends = _model(model_key, model, order, whole)
        look = logs.get
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = 0
            for raws in _batches(batch, 1):
                n_tokens, known, base, rare, rare_n, sizes = [], [], [], [], [], []
                for raw in raws:
                    tokens = raw.split()
                    logs = list(map(look, tokens))
                    tail = Counter([t for t, x in zip(tokens, logs) if x is None])
                    n_tokens.append(len(tokens) + 1)
                    known.append(len(tokens) - tail.total() + (ends > 0))
                    base.append(sum(filter(None, logs)) + math.log10(ends + 1))
                    rare.extend(tail)
                    rare_n.extend(tail.values())
                    sizes.append(len(tail))
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                scores, of, left, left_n = text_costs(raws, order, costs)
                by = np.argsort(of, kind="stable")  # a text can go over several blocks
                cuts = pa.array(np.searchsorted(of[by], np.arange(len(raws) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(rid, rid + len(raws))), batch.column(0).slice(at, len(raws)),
                     batch.column(2).slice(at, len(raws)), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(scores),
                     pa.ListArray.from_arrays(offsets, pa.array(rare, pa.binary())),
                     pa.ListArray.from_arrays(offsets, pa.array(rare_n, pa.int64())),
                     pa.ListArray.from_arrays(cuts, pa.array(left[by].view(np.int64))),
                     pa.ListArray.from_arrays(cuts, pa.array(left_n[by]))],
                    names=["rid", "id", "held_out", "n_tokens", "known", "base", "score", "rare", "rare_n", "left",
                           "left_n"])
                at += len(raws)
                rid += len(raws)

    kind = rows.schema["id"].dataType.simpleString()
    scored = stored(rows.mapInArrow(tidied(run), f"rid bigint, id {kind}, held_out boolean, n_tokens bigint, known bigint, "
                                    "base double, score double, rare array<binary>, rare_n array<bigint>, left array<bigint>, "
                                    "left_n array<bigint>"), "scored")
    tail = scored.select("rid", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")) \
        .select("rid", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("k"))
    tail = tail.join(words, "word").groupBy("rid").agg(F.sum("k").alias("more"),
                                                       F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more_base"))
    zero, joined, own = F.lit(0), scored.join(tail, "rid", "left"), F.col("score")
    if tables is not None:
        left = stored(scored.select("rid", F.explode(F.arrays_zip("left", "left_n")).alias("x"))
                      .select("rid", F.col("x.left").alias("g"), F.col("x.left_n").alias("k")), "left-grams")
        priced = left.join(tables.costs(left.select("g").distinct()), "g")
        joined = joined.join(priced.groupBy("rid").agg(F.sum(F.col("k") * F.col("cost")).alias("more_score")), "rid", "left")
        own = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return joined.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("more", zero)).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))
         - F.col("n_tokens") * math.log10(total + kinds + 1)).alias("base_score"), own.alias("score"))


def adaptive_score(docs: DataFrame, order: int = 4, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """Add the log10 probability of each text under a trie that starts empty and adapts as it reads."""

    @F.pandas_udf("double")
    def run(col):
        import pandas as pd

        return pd.Series([ContextTrie(order).read((t or "").encode()) for t in col], dtype="float64")

    return docs.withColumn(out_col, run(F.col(text_col)))

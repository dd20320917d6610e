"""Benchmark decontamination by latent semantic retrieval.

Documents are read as overlapping passages of words. Passages are TF-IDF
vectors over the benchmark's terms (idf = 1 / sqrt(document frequency), counted
over all documents; terms of more than ``max_df`` of the documents are left out
unless they are among an item's rarest). A randomised SVD of the passage matrix
(random range finder, one power step, Rayleigh-Ritz), whose products are summed
over all passages by Spark, gives the latent space. A passage is a candidate for
an item if their latent cosine reaches ``min_cosine`` and it holds at least
``min_energy`` of the item's latent energy, or, whatever else it holds, if the
item's own kept terms that occur in it have at least ``min_held`` of their summed
idf. With one half an exact copy is always a candidate: it lies in two passages
that follow each other, so one of them holds half of it. Candidates are verified on the words
themselves: the longest common subsequence must cover ``min_lcs`` of the item,
or, for paraphrases, ``min_paraphrase`` of it with its answer (the closing words)
in place and twice the energy.

The benchmark is the query set. Items of more than ``PART`` words are searched in
parts of at most that many and verified whole, so passages have one length
whatever items there are. It is read in blocks of ``block`` parts, each with a
latent space of its own, so terms, products and query vectors are bounded by the
block; only the verification holds an item's whole words. The texts are read three
times (document frequencies, places of terms, verification) for every ``READING``
parts, whose terms, at most 64 times as many, are broadcast; the blocks among them
read the stored places.

Each character of a script written without spaces is a word. Items of fewer than
``min_words`` words are found where their words follow each other, by looking up
the word n-grams of their lengths; they have no cosine.

Defined results: NULL or empty texts match nothing, nor do items of one or two
words that each occur in more than ``max_df`` of the documents; an item given twice is reported once; documents with equal ids
are judged apart by their text; an empty benchmark or corpus gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import rebatched, row_key, stored, texts, tidied
from courtside.llm.repeats import join_small

#: Words of the longest part of an item, and of a passage; passages begin at every half of it.
PART = 64
STRIDE = PART // 2

#: ASCII letters and digits in lower case and all bytes above ASCII stay, the rest parts words.
_TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Scripts written without spaces (Thai, Lao, Myanmar, Khmer, kana, Han), their punctuation, and all UTF-8 lead bytes but theirs.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
                       "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
_STOPS = re.compile("[\u3000-\u3004\u3008-\u303f\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
_OTHER = bytes(set(range(256)) - {0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0})

#: Short items looked up in one pass over the texts.
SHORT_BLOCK = 1 << 16
#: Parts of items for which the texts are read together; their blocks read the stored term places.
READING = 1 << 12


def words_of(text: str | None) -> list[bytes]:
    raw = (text or "").lower().encode()
    if not raw.isascii() and raw.translate(None, _OTHER):
        raw = _UNSPACED.sub(r" \g<0> ", _STOPS.sub(" ", raw.decode())).encode()
    return raw.translate(_TABLE).split()


def lcs_length(masks: dict[bytes, int], words: list[bytes]) -> int:
    """Longest common subsequence with the sequence whose places each word's bits in ``masks`` give."""
    state = 0
    for w in words:
        m = masks.get(w)
        if m:  # each run of open places moves its lowest bit to the first place of the word
            x = state | m
            state = x & ~(x - (state << 1 | 1))
    return state.bit_count()


def masks_of(words: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _term_ids(words: list[bytes], terms: dict[bytes, int]) -> np.ndarray:
    return np.fromiter(map(terms.get, words, repeat(-1)), np.int32, len(words))


def document_frequency(docs: DataFrame, terms: dict[bytes, int]) -> np.ndarray:
    """In how many texts each term occurs; one partial vector per task, summed by term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for text in texts(batch, 0):
                ids = _term_ids(words_of(text), shared.value)
                df[np.unique(ids[ids >= 0])] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["t", "n"])

    sums = docs.select("text").mapInArrow(tidied(run), "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(terms), np.int64)
    out[sums.column("t").to_numpy()] = sums.column("n").to_numpy()
    return out


def term_places(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """Rows (doc, rk, at, t) of the texts that hold terms: their word places and numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, t, keep = [], [], []
            for k, text in enumerate(texts(batch, 2)):
                ids = _term_ids(words_of(text), shared.value)
                place = np.flatnonzero(ids >= 0)
                if len(place):
                    keep.append(k)
                    at.append(place.astype(np.int32))
                    t.append(ids[place])
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())),
                                              batch.column(1).take(pa.array(keep, pa.int64())),
                                              pa.array(at, lists), pa.array(t, lists)], names=["doc", "rk", "at", "t"])

    return docs.select("doc", "rk", "text").mapInArrow(tidied(run), "doc bigint, rk bigint, at array<int>, t array<int>")


def _blocks(at: np.ndarray, t: np.ndarray, row: np.ndarray, stride: int, weight: np.ndarray, basis: np.ndarray):
    """(row, number and vector of each half passage with terms, half passage of each term place)."""
    key = row.astype(np.int64) << 32 | at // stride
    first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    vectors = np.add.reduceat(basis[t] * weight[t, None], first, axis=0)
    return key[first], vectors, np.repeat(np.arange(len(first)), np.diff(first, append=len(key)))


def _chunks(batch: pa.RecordBatch, most: int = 12_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, terms, row of the batch) in chunks of whole rows, about ``most`` places each."""
    lists = batch.column(batch.schema.get_field_index("at"))
    edges = lists.offsets.to_numpy()
    at, t = lists.values.to_numpy(), batch.column(batch.schema.get_field_index("t")).values.to_numpy()
    row = np.repeat(np.arange(len(lists)), np.diff(edges))
    base, lo = edges[0], 0
    while lo < len(lists):
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + most, side="right")) - 1)
        b, e = edges[lo], edges[hi]
        if e > b:
            yield at[b:e], t[b:e], row[b - base:e - base]
        lo = hi


def gram_product(places: DataFrame, weight: np.ndarray, basis: np.ndarray, stride: int) -> np.ndarray:
    """A^T A basis for the passage matrix A; a partial product per task, summed over blocks of terms."""
    shared = places.sparkSession.sparkContext.broadcast((weight, basis))
    rows, width, step = *basis.shape, 128

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, v = shared.value
        out = np.zeros((rows, width), np.float32)
        for batch in batches:
            for at, t, row in _chunks(batch):
                key, half, of = _blocks(at, t, row, stride, w, v)
                follows = np.concatenate([key[1:] == key[:-1] + 1, [False]])
                passage = half.copy()  # half passages b and b + 1
                passage[follows] += half[np.flatnonzero(follows) + 1]
                near = passage.copy()  # every half lies in the passages that begin at it and at the one before it
                near[1:][follows[:-1]] += passage[:-1][follows[:-1]]
                alone = np.concatenate([[True], ~follows[:-1]]) & ((key & 0xFFFFFFFF) > 0)
                near[alone] += half[alone]  # the passage before it has terms in this half only
                by = np.argsort(t, kind="stable")
                first = np.concatenate([[0], np.flatnonzero(np.diff(t[by])) + 1])
                out[t[by][first]] += np.add.reduceat(near[of[by]] * w[t[by], None], first, axis=0)
        for lo in range(0, rows, step):
            part = out[lo:lo + step]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([part.tobytes()], pa.binary())], names=["lo", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for lo, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(v, np.float32).astype(np.float64)
                sums[lo] = sums[lo] + part if lo in sums else part
        for lo, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([part.tobytes()], pa.binary())], names=["lo", "v"])

    summed = places.select("at", "t").mapInArrow(tidied(multiply), "lo bigint, v binary").repartition("lo") \
        .mapInArrow(tidied(add), "lo bigint, v binary").collect()
    out = np.zeros((rows, width))
    for r in summed:
        part = np.frombuffer(r["v"]).reshape(-1, width)
        out[r["lo"]:r["lo"] + len(part)] = part
    return out


def latent_space(places: DataFrame, weight: np.ndarray, rank: int, stride: int, extra: int = 32, seed: int = 11) -> np.ndarray:
    """(terms x rank) right singular vectors of the passage matrix, by randomised SVD with one power step."""
    width = min(len(weight), rank + extra)
    start = np.random.default_rng(seed).standard_normal((len(weight), width)).astype(np.float32)
    basis = np.linalg.qr(gram_product(places, weight, start, stride))[0].astype(np.float32)
    product = gram_product(places, weight, basis, stride)
    values, vectors = np.linalg.eigh(basis.T @ product)
    best = np.argsort(-values)[:min(rank, width)]
    return (basis @ vectors[:, best]).astype(np.float32)


def _held(of: np.ndarray, t: np.ndarray, halves: int, terms: int, items: int, start: np.ndarray, item: np.ndarray,
          share: np.ndarray) -> np.ndarray:
    """(halves x items) what part of each item the different terms of each half passage make up."""
    both = np.unique(of.astype(np.int64) * terms + t)
    half, t = both // terms, both % terms
    n = start[t + 1] - start[t]
    entry = np.arange(n.sum()) + np.repeat(start[t] - np.cumsum(n) + n, n)
    return np.bincount(np.repeat(half, n) * items + item[entry], share[entry], halves * items).reshape(halves, items)


def _own_terms(asked: list[set], idf: dict[int, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items and shares by term number, for ``candidates``."""
    entries = []
    for j, w in enumerate(asked):
        total = sum(idf[k] for k in w)
        entries += [(k, j, idf[k] / total) for k in w]
    entries.sort()
    term, item, share = zip(*entries) if entries else ((), (), ())
    return (np.searchsorted(np.array(term, np.int64), np.arange(len(idf) + 1)), np.array(item, np.int64),
            np.array(share, np.float64))


def candidates(places: DataFrame, weight: np.ndarray, space: np.ndarray, queries: np.ndarray, stride: int,
               min_cosine: float, min_energy: float, own: tuple | None = None, min_held: float = 0.5) -> DataFrame:
    """Rows (doc, rk, passage, item, cosine, energy): passages near an item in the latent space, or that hold its terms.

    ``own``: (first entry of each term and the end, items, shares of the item that the term makes up).
    """
    shared = places.sparkSession.sparkContext.broadcast((weight, space, queries, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, v, q, shares = shared.value
        power = np.maximum((q * q).sum(axis=1), 1e-30)
        for batch in batches:
            for at, t, row in _chunks(batch):
                key, half, of = _blocks(at, t, row, stride, w, v)
                follows = np.concatenate([key[1:] == key[:-1] + 1, [False]])
                passage = half.copy()
                passage[follows] += half[np.flatnonzero(follows) + 1]
                norm = np.sqrt((passage * passage).sum(axis=1)) + 1e-30
                dot = passage @ q.T
                hit = (dot >= min_energy * power) & (dot >= min_cosine * norm[:, None] * np.sqrt(power))
                if shares is not None:
                    held = _held(of, t, len(key), len(w), len(q), *shares)
                    held[:-1][follows[:-1]] += held[1:][follows[:-1]]  # a term in both halves counts twice
                    hit |= held >= min_held - 1e-6
                p, j = np.nonzero(hit)
                own = pa.array(key[p] >> 32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), batch.column(1).take(own), pa.array(key[p] & 0xFFFFFFFF), pa.array(j),
                     pa.array((dot[p, j] / norm[p] / np.sqrt(power[j])).astype(np.float64)),
                     pa.array((dot[p, j] / power[j]).astype(np.float64))],
                    names=["doc", "rk", "passage", "item", "cosine", "energy"])

    return places.mapInArrow(tidied(run), "doc bigint, rk bigint, passage bigint, item bigint, cosine double, energy double")


def _narrowed(places: DataFrame, terms: dict[bytes, int], kept: dict[bytes, int]) -> DataFrame:
    """``places`` over ``terms`` -> places over ``kept``, some of these terms with numbers of their own."""
    number = np.full(len(terms), -1, np.int32)
    for t, k in kept.items():
        number[terms[t]] = k
    shared = places.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            edges = lists.offsets.to_numpy()
            lo, hi = edges[0], edges[-1]
            t = shared.value[batch.column(3).values.to_numpy()[lo:hi]]
            stays = t >= 0
            ends = np.concatenate([[0], np.cumsum(stays)])[edges - lo]
            rows = pa.array(np.flatnonzero(np.diff(ends)))
            ends = pa.array(np.unique(ends), pa.int32())  # rows without a term have no place of their own
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.ListArray.from_arrays(ends, pa.array(lists.values.to_numpy()[lo:hi][stays])),
                 pa.ListArray.from_arrays(ends, pa.array(t[stays]))], names=["doc", "rk", "at", "t"])

    return places.select("doc", "rk", "at", "t").mapInArrow(tidied(run), "doc bigint, rk bigint, at array<int>, t array<int>")


def _block_candidates(places: DataFrame, asked: list[list[bytes]], own: list[set], kept: dict[bytes, int],
                      weight: np.ndarray, min_cosine: float, min_energy: float, min_held: float) -> DataFrame:
    """Candidates of one block of parts, in a latent space of its own."""
    space = latent_space(places, weight, len(asked) + 16, STRIDE)
    vectors = np.zeros((len(asked), len(kept)), np.float32)
    for j, w in enumerate(asked):
        for t in w:
            if t in kept:
                vectors[j, kept[t]] += weight[kept[t]]
    held = _own_terms([{kept[t] for t in w if t in kept} for w in own], dict(enumerate(weight.tolist())))
    return candidates(places, weight, space, vectors @ space, STRIDE, min_cosine, min_energy, held, min_held)


def _parts(rows: Iterator, min_words: int) -> Iterator[tuple]:
    """(name, words, begin of the part, its words) of each part of the items, parts of an item about equally long."""
    for name, text in rows:
        words = words_of(text)
        if len(words) >= max(1, min_words):
            size = -(-len(words) // -(-len(words) // PART))
            for lo in range(0, len(words), size):
                yield name, words, lo, words[lo:lo + size]


def _regions(near: list[tuple], n: int) -> Iterator[tuple]:
    """(begin, end, cosine, energy) of the stretches to verify for an item of ``n`` words.

    ``near`` has (where the item would begin, cosine, energy) of each passage found; passages
    that put a long item at about the same place are verified once.
    """
    spans: list[list] = []
    for begin, cosine, energy in sorted(near):
        if spans and n > PART and begin - spans[-1][0] <= n // 2:
            spans[-1][1:] = begin, max(spans[-1][2], cosine), max(spans[-1][3], energy)
        else:
            spans.append([begin, begin, cosine, energy])
    for lo, hi, cosine, energy in spans:
        yield max(0, lo - n // 2), max(0, hi + PART + n // 2 + (n if n > PART else 0)), cosine, energy


def _verify(found: DataFrame, docs: DataFrame, items: list[list[bytes]], parts: list[tuple[int, int]], min_lcs: float,
            min_paraphrase: float, min_energy: float) -> DataFrame:
    """Rows (doc, rk, item, cosine, lcs, kind) of the candidates whose words hold the item."""
    asked = found.groupBy("doc", "rk").agg(F.collect_list(F.struct("passage", "item", "cosine", "energy")).alias("q"))
    asked = stored(asked, "lsa-asked")
    cut = join_small(docs.select("doc", "rk", "text"), asked, ["doc", "rk"], "inner", F.size("q") * 48 + 96)
    shared = docs.sparkSession.sparkContext.broadcast((items, parts))
    names = [("doc", pa.int64()), ("rk", pa.int64()), ("item", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()),
             ("kind", pa.string())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        items, parts = shared.value
        masks = [masks_of(w) for w in items]
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch, 2), batch.column(3))
            for doc, rk, text, asks in keys:
                words, best, near = words_of(text), {}, {}
                for a in asks.as_py():
                    j, at = parts[a["item"]]
                    near.setdefault(j, []).append((a["passage"] * STRIDE - at, a["cosine"], a["energy"]))
                for j, places in near.items():
                    item = items[j]
                    n = len(item)
                    for lo, hi, cosine, energy in _regions(places, n):
                        region = words[lo:hi]
                        share = lcs_length(masks[j], region) / n
                        kind = "copy" if share >= min_lcs else None
                        if not kind and share >= min_paraphrase and energy >= 2 * min_energy:
                            answer = item[-max(5, n // 4):]
                            if holds_answer(answer, region):
                                kind = "paraphrase"
                        if kind and share > best.get(j, (0.0,))[0]:
                            best[j] = (share, cosine, kind)
                for j, (share, cosine, kind) in best.items():
                    yield doc, rk, j, cosine, share, kind

    return cut.mapInArrow(tidied(lambda b: rebatched(rows(b), pa.schema(names))),
                          "doc bigint, rk bigint, item bigint, cosine double, lcs double, kind string")


def short_copies(docs: DataFrame, items: list[list[bytes]]) -> DataFrame:
    """Rows (doc, rk, item, cosine, lcs, kind) of the texts in which an item's words follow each other."""
    held: dict[tuple, list[int]] = {}
    lengths: dict[bytes, set[int]] = {}
    for j, w in enumerate(items):
        held.setdefault(tuple(w), []).append(j)
        lengths.setdefault(w[0], set()).add(len(w))
    shared = docs.sparkSession.sparkContext.broadcast((held, lengths))
    names = [("doc", pa.int64()), ("rk", pa.int64()), ("item", pa.int64())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, lengths = shared.value
        for batch in batches:
            for doc, rk, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch, 2)):
                words, found = words_of(text), set()
                for i, sizes in enumerate(map(lengths.get, words)):
                    for n in sizes or ():
                        found.update(held.get(tuple(words[i:i + n]), ()))
                for j in found:
                    yield doc, rk, j

    out = docs.select("doc", "rk", "text").mapInArrow(tidied(lambda b: rebatched(rows(b), pa.schema(names))),
                                                      "doc bigint, rk bigint, item bigint")
    return out.select("*", F.lit(None).cast("double").alias("cosine"), F.lit(1.0).alias("lcs"), F.lit("copy").alias("kind"))


def _telling(docs: DataFrame, part: list[tuple], max_df: float) -> list[tuple]:
    """The (name, words) of three words or more, or with a word that few documents hold."""
    terms = {t: k for k, t in enumerate(sorted({t for _, w in part if len(w) < 3 for t in w}))}
    if not terms:
        return part
    df, most = document_frequency(docs, terms), max(1, max_df * docs.count())
    return [(i, w) for i, w in part if len(w) > 2 or any(df[terms[t]] <= most for t in w)]


def holds_answer(answer: list[bytes], words: list[bytes]) -> bool:
    """Whether the answer's words occur in order within a stretch of one and a half times its length."""
    masks, n = masks_of(answer), len(answer)
    return any(lcs_length(masks, words[i:i + n + n // 2]) == n for i, w in enumerate(words) if w == answer[0])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", block: int = 256, max_df: float = 0.01,
                 rarest: int = 8, min_cosine: float = 0.3, min_energy: float = 0.25, min_lcs: float = 0.8,
                 min_paraphrase: float = 0.6, min_words: int = 8, min_held: float = 0.5) -> DataFrame:
    """Rows (id_col, rk, item_col, cosine, lcs, kind): documents that hold a benchmark item. ``rk`` tells equal ids apart."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).cast("bigint").alias("doc"), row_key(docs, id_col, text_col).alias("rk"),
                        F.col(text_col).alias("text")).where("text IS NOT NULL")
    item_type = benchmark.schema[item_col].dataType.simpleString()
    out = None
    rows = _parts(benchmark.select(item_col, item_text_col).toLocalIterator(), min_words)
    n_docs = max(1, keyed.count())
    while parts_read := list(islice(rows, max(block, READING))):
        items, titles, parts = [], [], []
        for name, words, lo, _ in parts_read:
            if not items or items[-1] is not words:
                items.append(words)
                titles.append(name)
            parts.append((len(items) - 1, lo))
        asked = [w for *_, w in parts_read]
        terms = {t: k for k, t in enumerate(sorted({t for w in asked for t in w}))}
        df = document_frequency(keyed, terms)
        own = [{t for t in w if df[terms[t]] <= max_df * n_docs}
               | set(sorted(set(w), key=lambda t: (df[terms[t]], t))[:rarest]) for w in asked]
        kept = {t: k for k, t in enumerate(sorted(t for t in set().union(*own) if df[terms[t]]))}
        if not kept:
            continue
        every = stored(term_places(keyed, kept), "term-places")
        found = None
        for at in range(0, len(asked), block):
            mine = {t: k for k, t in enumerate(sorted(t for t in set().union(*own[at:at + block]) if t in kept))}
            if not mine:
                continue
            places = every if len(mine) == len(kept) else stored(_narrowed(every, kept, mine), "block-places")
            near = _block_candidates(places, asked[at:at + block], own[at:at + block], mine,
                                     np.array([df[terms[t]] for t in mine], np.float32) ** np.float32(-0.5),
                                     min_cosine, min_energy, min_held)
            near = near.withColumn("item", F.col("item") + at)
            found = near if found is None else found.unionByName(near)
        hits = _verify(found, keyed, items, parts, min_lcs, min_paraphrase, min_energy)
        names = spark.createDataFrame(list(enumerate(titles)), f"item bigint, name {item_type}")
        hits = hits.join(F.broadcast(names), "item").select("doc", "rk", "name", "cosine", "lcs", "kind")
        out = hits if out is None else out.unionByName(hits)
    short = ((r[0], words_of(r[1])) for r in benchmark.select(item_col, item_text_col).toLocalIterator())
    short = (r for r in short if 0 < len(r[1]) < min_words)
    while part := list(islice(short, SHORT_BLOCK)):
        part = _telling(keyed, part, max_df)
        if not part:
            continue
        names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(part)], f"item bigint, name {item_type}")
        hits = short_copies(keyed, [w for _, w in part]).join(F.broadcast(names), "item")
        hits = hits.select("doc", "rk", "name", "cosine", "lcs", "kind")
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        out = spark.createDataFrame([], f"doc bigint, rk bigint, name {item_type}, cosine double, lcs double, kind string")
    best = F.max(F.struct("lcs", "cosine", "kind")).alias("b")
    return out.groupBy("doc", "rk", "name").agg(best).select(
        F.col("doc").cast(docs.schema[id_col].dataType).alias(id_col), "rk", F.col("name").alias(item_col),
        "b.cosine", "b.lcs", "b.kind")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **settings) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns unchanged."""
    leaks = contaminated(docs, benchmark, id_col, text_col, **settings)
    leaks = stored(leaks.select(F.col(id_col).cast("bigint").alias("leak_doc"), F.col("rk").alias("leak_rk")).distinct(), "leaks")
    key = row_key(docs, id_col, text_col)
    same = docs[id_col].cast("bigint").eqNullSafe(leaks["leak_doc"]) & (key == leaks["leak_rk"])
    return docs.join(leaks, same, "left_anti")

"""Phrase collocations from an FM-index per shard over word numbers.

A shard holds the words of up to SHARD_WORDS words of text as numbers, pieces
separated by a symbol of their own. It is sorted forwards and backwards by the
first DEPTH - 1 symbols, which is all that the intervals to be extended need,
and gives two Burrows-Wheeler transforms. All intervals of one depth are
extended together: the transform of the reversed text holds the word after each
occurrence, so the interval of each word splits into those of its two-word
phrases; the transform of the text holds the word before, so these split into
those of the three-word phrases. An interval's length is the phrase's count.
Counts are summed across shards by grouping.

Three readings of the texts, each leaving out what can't reach ``min_count``:
words; two-word phrases of frequent words; three-word phrases whose two-word
parts are both frequent. What is frequent is told to the tasks by a bit table of
a fixed size over hashes. Phrases that it lets through in error are dropped after the
sum, so counts and results are exact at every size.

Words are told apart by a 64-bit hash of language and word. It is verified to be
one to one over all words; should two ever meet, the next seed is taken.

Defined results: NULL or empty text has no words, NULL language is ``und``,
repeated rows count as often as they stand there. A phrase lies within one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import stored, text_batches, tidied, utf8

DEPTH = 3
SHARD_WORDS = 1 << 20
SLICE = 1 << 20
BITS = 1 << 27
_CUTS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 46 if c in _CUTS else 32 if c == 9 else c for c in range(256))
BREAK, FIRST = 0, 1  # symbols: a border of pieces or a word that is not frequent; the first word


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, ``.`` between pieces, a slice of it at a time."""
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and _TABLE[text[end]] not in (32, 46):
            end += 1
        yield text[at:end].translate(_TABLE).replace(b".", b" . ").split()
        at = end


class _Numbers(dict):
    """Numbers of a language's words, given in order of appearance; all languages of a shard share the counter."""

    def __init__(self, names: list[tuple[str, bytes]], lang: str):
        self.names, self.lang = names, lang
        super().__init__({b".": -1})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.names)
        self.names.append((self.lang, word))
        return n


def _shards(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[tuple[np.ndarray, list[tuple[str, bytes]]]]:
    """(word numbers with -1 between pieces and texts, (language, word) of each number), SHARD_WORDS words or so each.

    A text that goes on in the next shard repeats its last ``overlap`` words there: one less than the phrases to be
    counted have, so that each phrase lies in exactly one shard.
    """
    names: list[tuple[str, bytes]] = []
    langs: dict[str, _Numbers] = {}
    parts: list[np.ndarray] = []
    size = 0
    gap = np.array([-1], np.int32)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), utf8(batch, 1)):
            tail: list[bytes] = []
            for part in words(text):
                if size + len(part) > SHARD_WORDS and size:
                    yield np.concatenate(parts), names
                    names, langs, parts, size = [], {}, [], 0
                    part = tail + part
                number = langs.get(lang)
                if number is None:
                    number = langs[lang] = _Numbers(names, lang)
                parts.append(np.fromiter(map(number.__getitem__, part), np.int32, len(part)))
                size += len(part)
                tail = (tail + part)[-overlap:] if overlap else []
            parts.append(gap)
    if size:
        yield np.concatenate(parts), names


def _hashes(names: list[tuple[str, bytes]], seed: int) -> np.ndarray:
    own = {lang: xxhash.xxh3_64_intdigest(lang, seed=seed) for lang in {lang for lang, _ in names}}
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed=own[lang]) for lang, w in names), np.uint64, len(names)).view(np.int64)


def _suffix_order(s: np.ndarray, symbols: int) -> np.ndarray:
    """Positions of the cyclic text in the order of the DEPTH - 1 = 2 symbols from each."""
    return np.argsort(s.astype(np.int64) * symbols + np.roll(s, -1))


class BidirectionalIndex:
    """Both transforms of a text of symbols in 0..symbols-1, with the intervals of its two- and three-word phrases."""

    def __init__(self, s: np.ndarray, symbols: int):
        self.s, self.symbols = s, symbols
        self.first = np.repeat(np.arange(symbols), np.bincount(s, minlength=symbols))  # of either: sorted symbols

    @cached_property
    def before(self) -> np.ndarray:
        """Transform of the text: the symbol before each suffix."""
        return self.s[_suffix_order(self.s, self.symbols) - 1]

    @cached_property
    def after(self) -> np.ndarray:
        """Transform of the reversed text: the symbol after each prefix."""
        back = self.s[::-1]
        return back[_suffix_order(back, self.symbols) - 1]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(left, right, begin, count): every word's interval extended to the right; ``begin`` is that of the pair's
        interval among the suffixes, which lie in the order of the pairs."""
        key, count = np.unique(self.first * self.symbols + self.after, return_counts=True)
        return key // self.symbols, key % self.symbols, np.cumsum(count) - count, count

    def triples(self, begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which, left, count): each of the given pair intervals extended to the left."""
        which = np.repeat(np.arange(len(begin)), count)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
        key, n = np.unique(which * self.symbols + self.before[rows], return_counts=True)
        return key // self.symbols, key % self.symbols, n


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(37)).astype(np.int64)  # 64 - log2(BITS)


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.view(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _has(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _bit(hashes)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _bit_table(frequent: DataFrame, keys: list[str]) -> np.ndarray:
    """The bits of the keys' hashes, gathered as at most BITS / 32 words however many keys there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(BITS // 8, np.uint8)
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            at = _bit(cols[0] if len(cols) == 1 else _pair_hash(*cols))
            np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
        word = own.view(np.uint32)
        set_ = np.flatnonzero(word)
        for lo in range(0, len(set_), 1 << 16):
            part = set_[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(word[part].astype(np.int64))],
                                             names=["place", "bits"])

    rows = frequent.select(*keys).mapInArrow(tidied(run), "place int, bits long")
    got = rows.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITS // 32, np.uint32)
    out[got.column("place").to_numpy()] = got.column("bits").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def _symbols(numbers: np.ndarray, hashes: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shard as symbols, runs of breaks as one, and the word hash of each symbol."""
    kept = _has(frequent, hashes)
    symbol = np.full(len(hashes) + 1, BREAK, np.int32)  # the last entry is for number -1
    symbol[:-1][kept] = np.arange(FIRST, FIRST + int(kept.sum()))
    s = np.concatenate([[BREAK], symbol[numbers], [BREAK]]).astype(np.int32)
    again = (s[1:] == BREAK) & (s[:-1] == BREAK)
    return s[np.concatenate([[True], ~again])], np.concatenate([np.zeros(FIRST, np.int64), hashes[kept]])


def _count_words(frame: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, f): all words with their hash and count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, names in _shards(batches, 0):
            count = np.bincount(numbers[numbers >= 0], minlength=len(names))
            langs, word = zip(*names) if names else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(word, pa.binary()).cast(pa.string()),
                                              pa.array(_hashes(names, seed)), pa.array(count.astype(np.int64))],
                                             names=["lang", "word", "h", "f"])

    rows = frame.mapInArrow(tidied(run), "lang string, word string, h long, f long")
    return rows.groupBy("lang", "word", "h").agg(F.sum("f").alias("f"))


def _count_pairs(frame: DataFrame, frequent: np.ndarray, seed: int) -> DataFrame:
    shared = frame.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, names in _shards(batches, 1):
            s, word = _symbols(numbers, _hashes(names, seed), shared.value)
            left, right, _, count = BidirectionalIndex(s, len(word)).pairs()
            ok = (left >= FIRST) & (right >= FIRST)
            yield from _columns(["h1", "h2", "f"], word[left[ok]], word[right[ok]], count[ok])

    rows = frame.mapInArrow(tidied(run), "h1 long, h2 long, f long")
    return rows.groupBy("h1", "h2").agg(F.sum("f").alias("f"))


def _count_triples(frame: DataFrame, frequent: np.ndarray, pairs: np.ndarray, seed: int) -> DataFrame:
    shared = frame.sparkSession.sparkContext.broadcast((frequent, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, pairs_ = shared.value
        for numbers, names in _shards(batches, DEPTH - 1):
            s, word = _symbols(numbers, _hashes(names, seed), words_)
            index = BidirectionalIndex(s, len(word))
            left, right, begin, count = index.pairs()
            ok = (left >= FIRST) & (right >= FIRST)
            ok[ok] = _has(pairs_, _pair_hash(word[left[ok]], word[right[ok]]))
            left, right, begin, count = left[ok], right[ok], begin[ok], count[ok]
            which, first, n = index.triples(begin, count)
            ok = first >= FIRST
            ok[ok] = _has(pairs_, _pair_hash(word[first[ok]], word[left[which[ok]]]))
            which, first, n = which[ok], first[ok], n[ok]
            yield from _columns(["h1", "h2", "h3", "f"], word[first], word[left[which]], word[right[which]], n)

    rows = frame.mapInArrow(tidied(run), "h1 long, h2 long, h3 long, f long")
    return rows.groupBy("h1", "h2", "h3").agg(F.sum("f").alias("f"))


def _columns(names: list[str], *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(columns[0]), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo:lo + (1 << 16)].astype(np.int64)) for c in columns], names=names)


def phrase_counts(docs: DataFrame, min_count: int = 10, text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables of all words (lang, word, h, f), and of the phrases of two (h1, h2, f) and of three words
    (h1, h2, h3, f) that occur ``min_count`` times or more in their language."""
    text_batches(docs.sparkSession)
    frame = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    seed = 0
    while True:
        single = stored(_count_words(frame, seed), "phrases-words")
        if not single.groupBy("h").count().where("count > 1").head(1):
            break
        seed += 1
    frequent = _bit_table(single.where(F.col("f") >= min_count), ["h"])
    two = stored(_count_pairs(frame, frequent, seed).where(F.col("f") >= min_count), "phrases-two")
    three = _count_triples(frame, frequent, _bit_table(two, ["h1", "h2"]), seed)
    return single, two, stored(three.where(F.col("f") >= min_count), "phrases-three")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact: the products have up to 38 digits."""
    a, left, right, million = (c.cast("decimal(38,0)") for c in (a, left, right, F.lit(1_000_000)))
    return F.call_function("div", million * a * a, left * right)


def collocations(docs: DataFrame, min_count: int = 10, top: int = 2000, cover: int = 50, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of two or three words of each language.

    A phrase that occurs a >= ``min_count`` times is cut where a*a/(l*r) is least, l and r being the counts of both
    parts; it is dropped if it lies in a longer one that has ``cover`` per cent of its occurrences or more.
    Columns: lang, rank, phrase, a, l, r, n (all words of the language), score, and left_words and right_words, the
    number of different words that extend it to a frequent longer phrase.
    """
    single, two, three = phrase_counts(docs, min_count, text_col, lang_col)
    word = single.where(F.col("f") >= min_count)
    w = lambda i: word.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"),
                              *([F.col("lang")] if i == 1 else []))
    begins = three.groupBy("h1", "h2").agg(F.max("f").alias("m1"), F.count("*").alias("right_words"))
    ends = three.groupBy(F.col("h2").alias("h1"), F.col("h3").alias("h2")).agg(F.max("f").alias("m2"),
                                                                               F.count("*").alias("left_words"))
    longer = F.greatest(F.coalesce("m1", F.lit(0)), F.coalesce("m2", F.lit(0)))
    pairs = two.join(begins, ["h1", "h2"], "left").join(ends, ["h1", "h2"], "left") \
        .where((longer == 0) | (100 * longer < cover * F.col("f")))
    pairs = pairs.join(w(1), "h1").join(w(2), "h2").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"),
        F.col("f2").alias("r"), F.coalesce("left_words", F.lit(0)).alias("left_words"),
        F.coalesce("right_words", F.lit(0)).alias("right_words"))\
        .withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    t = three.join(two.select("h1", "h2", F.col("f").alias("f12")), ["h1", "h2"]) \
        .join(two.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("f").alias("f23")), ["h2", "h3"]) \
        .join(w(1), "h1").join(w(2).drop("f2"), "h2").join(w(3), "h3")
    cuts = [F.struct(_score(F.col("f"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
            for k, left, right in ((1, F.col("f1"), F.col("f23")), (2, F.col("f12"), F.col("f3")))]
    zero = F.lit(0).cast("long")
    triples = t.withColumn("cut", F.least(*cuts)).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r",
        zero.alias("left_words"), zero.alias("right_words"), "cut.score")
    totals = single.groupBy("lang").agg(F.sum("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = pairs.unionByName(triples).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "left_words", "right_words")

"""Language identification by averaged hashed subword embeddings.

A text is the mean of the embeddings of its letter n-grams (2 to 4 letters, word
borders included), hashed into a fixed number of buckets; a linear softmax over
the mean gives the language. Both layers are trained by stochastic gradient
descent in numpy on a bounded sample of labelled rows, part of which is held
back to calibrate the probabilities (one temperature) and the rejection bound.

Rejection is calibrated on texts of no learnt language: models trained without some of
the languages judge the texts of these, and keyboard noise. A text is accepted if the share of
its n-grams that training has met, and the winner's probability, both reach bounds
that are set between the texts kept and the texts to be rejected.

Defined results: NULL text, or one without a letter, is ``und`` with score 0;
so is every text if there is no labelled row. Each row is judged by its text alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import text_batches, texts, tidied

BUCKETS = 1 << 16
SIZES = (2, 3, 4)
BLOCK = 1 << 20
LIMIT = np.float32(8)  # of any weight
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def _codes(text: str) -> np.ndarray:
    """Lower-cased letters as code points, every run of anything else as one 0, 0 at both ends."""
    raw = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(_letters()[raw], raw, 0).astype(np.uint32)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    return code[keep]


def subwords(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, a block of letters at a time; nothing if it has no letter."""
    code = _codes(text)
    for lo in range(0, len(code) - 1, BLOCK):
        part = code[lo:lo + BLOCK + max(SIZES) - 1]
        for n in SIZES:
            own = min(BLOCK, len(code) - lo - n + 1)  # n-grams that begin in this block
            if own <= 0:
                continue
            h = np.full(own, n, np.uint32)
            whole = np.ones(own, bool)
            for j in range(n):
                c = part[j:j + own]
                h = (h ^ c) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
                if 0 < j < n - 1:
                    whole &= c != 0
            if n == 2:
                whole = (part[:own] != 0) | (part[1:own + 1] != 0)
            yield ((h * np.uint32(0x9E3779B1)) >> np.uint32(16))[whole]


@dataclass
class Model:
    """Languages, embeddings, output weights and bias, buckets met in training, temperature and rejection bounds.

    With no more languages than dimensions the embeddings are kept as their logits (``weights`` None), so the
    model's size does not depend on the number of languages but for the output layer.
    """

    langs: list[str]
    table: np.ndarray
    weights: np.ndarray | None
    bias: np.ndarray
    met: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    reject_unmet: float = 0.0

    def judge(self, text: str) -> tuple[str, float, bool]:
        """(language, probability, accepted)."""
        total, n, met = np.zeros(self.table.shape[1]), 0, 0
        for part in subwords(text):
            total += self.table[part].sum(axis=0, dtype=np.float64)
            n += len(part)
            met += int(self.met[part].sum())
        if not n or not self.langs:
            return "und", 0.0, False
        mean = total / n
        p = _softmax(((mean if self.weights is None else mean @ self.weights) + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] >= self.reject_below and met / n >= self.reject_unmet)

    def predict(self, text: str) -> tuple[str, float]:
        return self.judge(text)[:2]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _examples(text: str, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(buckets, counts, n) of the text and of two short spans of its words."""
    words = text.split()
    spans = [text]
    for _ in range(2 if len(words) > 3 else 0):
        n = int(rng.integers(1, min(30, len(words)) + 1))
        at = int(rng.integers(0, len(words) - n + 1))
        spans.append(" ".join(words[at:at + n]))
    out = []
    for s in spans:
        parts = list(subwords(s))
        if parts:
            buckets, counts = np.unique(np.concatenate(parts), return_counts=True)
            if len(buckets):
                out.append((buckets, counts.astype(np.float32), int(counts.sum())))
    return out


Example = tuple[np.ndarray, np.ndarray, int]


def _descend(seen: list[tuple[Example, int]], n_langs: int, dim: int, epochs: int, rate: float,
             seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, output weights and bias by stochastic gradient descent, deterministic in the order of ``seen``."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    weights, bias = np.zeros((dim, n_langs), np.float32), np.zeros(n_langs, np.float32)
    steps, done = max(1, epochs * len(seen)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(seen)):
            (buckets, counts, n), y = seen[i]
            step = rate * (1 - done / steps)
            done += 1
            share = counts / n
            x = share @ table[buckets]
            g = _softmax(x @ weights + bias)
            g[y] -= 1
            back = weights @ g
            # Clipped, so that texts of a few n-grams or contradicting labels cannot run away.
            weights = np.clip(weights - step * np.outer(x, g), -LIMIT, LIMIT)
            bias -= step * g
            table[buckets] = np.clip(table[buckets] - np.outer(share * (step * 10), back), -LIMIT, LIMIT)
    return table, weights, bias


def _model(langs: list[str], seen: list[tuple[Example, int]], dim: int, epochs: int, rate: float, seed: int) -> Model:
    table, weights, bias = _descend(seen, len(langs), dim, epochs, rate, seed)
    met = np.zeros(BUCKETS, bool)
    for (buckets, _, _), _ in seen:
        met[buckets] = True
    if len(langs) <= dim:
        return Model(langs, (table @ weights).astype(np.float32), None, bias.astype(np.float64), met)
    return Model(langs, table, weights.astype(np.float64), bias.astype(np.float64), met)


def _outputs(model: Model, examples: list[Example]) -> tuple[np.ndarray, np.ndarray]:
    """Raw outputs and the share of n-grams met in training, per example."""
    mean = np.stack([(c @ model.table[b]) / n for b, c, n in examples]).astype(np.float64)
    raw = (mean if model.weights is None else mean @ model.weights) + model.bias
    return raw, np.array([c[model.met[b]].sum() / n for b, c, n in examples])


def _noise(rng: np.random.Generator, letters: str, n: int) -> list[Example]:
    """Words of random letters out of those of the training texts."""
    out = []
    for _ in range(n):
        words = ["".join(rng.choice(list(letters), int(rng.integers(2, 11)))) for _ in range(int(rng.integers(3, 40)))]
        out += _examples(" ".join(words), rng)[:1]
    return out


def _cut(kept: np.ndarray, away: np.ndarray, false_rejects: float) -> float:
    """The bound that rejects ``false_rejects`` of ``kept``, eased by a quarter of the gap to the highest of ``away``."""
    top = float(np.quantile(kept, false_rejects))
    high = float(np.quantile(away, 0.99)) if len(away) else top
    return top - max(0.0, top - high) / 4


def fit(rows: list[tuple[str, str]], dim: int = 16, epochs: int = 4, rate: float = 2.0, held_back: float = 0.2,
        false_rejects: float = 0.005, folds: int = 4, seed: int = 7) -> Model:
    """Train on (text, language) rows; deterministic in their order."""
    langs = sorted({lang for _, lang in rows})
    rng = np.random.default_rng(seed)
    number = {lang: i for i, lang in enumerate(langs)}
    data = [(e, number[lang]) for text, lang in rows for e in [_examples(text, rng)] if e]
    if not data:
        return Model([], np.zeros((BUCKETS, 0), np.float32), None, np.zeros(0), np.zeros(BUCKETS, bool), 1.0, 0.5, 0.5)
    order = rng.permutation(len(data))
    cut = int(len(data) * held_back)
    held, seen = [data[i] for i in order[:cut]], [(e, data[i][1]) for i in order[cut:] for e in data[i][0]]
    model = _model(langs, seen, dim, epochs, rate, seed)
    check = [(e, y) for es, y in held for e in es]
    if not check:
        return model
    raw, met = _outputs(model, [e for e, _ in check])
    y = np.array([y for _, y in check])
    loss = lambda t: -np.log(np.maximum(_softmax(raw / t)[np.arange(len(y)), y], 1e-12)).mean()
    model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    whole = np.array([i == 0 for es, _ in held for i in range(len(es))])  # short spans calibrate the temperature only
    won = _softmax(raw / model.temperature).max(axis=1)
    # Texts of no learnt language: noise, and those of languages left out of a model of the same make.
    letters = "".join(sorted({c for text, _ in rows for c in text.lower() if c.isalpha()}))
    foreign = [_outputs(model, _noise(rng, letters, 200))]
    ways = min(folds, len(langs)) if len(langs) > 2 else 0
    for f in range(ways):
        own = [i for i in range(len(langs)) if i % ways != f]
        less = _model([langs[i] for i in own], [(e, own.index(j)) for e, j in seen if j in own], dim, epochs, rate, seed)
        away = [es[0] for es, j in held if j not in own]
        if away:
            foreign.append(_outputs(less, away))
    strange = np.concatenate([_softmax(r / model.temperature).max(axis=1) for r, _ in foreign])
    unmet = np.concatenate([m for _, m in foreign])
    model.reject_unmet = _cut(met[whole], unmet, false_rejects)
    model.reject_below = max(1 / len(langs), min(_cut(won[whole], strange[unmet >= model.reject_unmet], false_rejects), 0.999))
    return model


def train(docs: DataFrame, training: Column, max_rows: int = 3000, max_chars: int = 2000, least_rows: int = 10,
          text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", **settings) -> Model:
    """Fit on a bounded sample of the labelled rows where ``training`` holds. Every language is learnt.

    Of each of the L languages about max(max_rows / L, least_rows) rows, never more, first by a hash of text and id (all,
    if there are fewer), each a stretch of at most ``max_chars`` characters at a hashed place of its
    text. That is the whole bound; it grows with the number of languages and does not depend on how the
    rows are dealt to files and tasks. Prediction reads whole texts.
    """
    rows = docs.where(training).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                                       F.xxhash64(F.col(text_col), F.col(id_col)).alias("h")) \
        .where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("lang").count().collect()  # one row per language, as the model holds
    if not counts:
        return fit([])
    each = max(-(-max_rows // len(counts)), least_rows)
    # First by a hash bound that lets a little more than ``each`` rows of a language through, so that few are ranked.
    share = [(r["lang"], min(1.0, (each + 8 * each ** 0.5) / r["count"])) for r in counts]
    bound = F.broadcast(docs.sparkSession.createDataFrame(share, "lang string, share double"))
    low = (F.col("h") / 2.0**64 + 0.5) <= F.col("share")
    at = F.pmod(F.col("h"), F.greatest(F.lit(1), F.length("text") - max_chars + 1)).cast("int") + 1
    sample = rows.join(bound, "lang").where(low).select("h", F.substr("text", at, F.lit(max_chars)).alias("text"), "lang")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    picked = sample.withColumn("rn", first).where(F.col("rn") <= each).drop("rn").collect()
    return fit([(r["text"], r["lang"]) for r in sorted(picked, key=lambda r: (r["h"], r["lang"], r["text"]))], **settings)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id_col, ``carry``, lang_pred, score, accepted (as a text in one of the learnt languages)."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            got = [own.judge(t) for t in texts(batch, 1)]
            lang, p, ok = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(p, pa.float64()),
                                              pa.array(ok, pa.bool_())], names=["row", "lang_pred", "score", "accepted"])

    frame = docs.select(F.struct(id_col, *carry).alias("row"), F.col(text_col).alias("text"))
    row = frame.schema["row"].dataType.simpleString()
    out = frame.mapInArrow(tidied(run), f"row {row}, lang_pred string, score double, accepted boolean")
    return out.select(*[F.col("row")[c].alias(c) for c in (id_col, *carry)], "lang_pred", "score", "accepted")


def accepted_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose text is accepted as one of the model's languages, columns unchanged.

    A model without languages has learnt nothing and rejects nothing.
    """
    if not model.langs:
        return docs
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            yield batch.filter(pa.array([own.judge(t)[2] for t in texts(batch, at)], pa.bool_()))

    return docs.mapInArrow(tidied(run), docs.schema)

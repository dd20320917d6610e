"""Offset-preserving SentencePiece encoding and decoding (byte-fallback BPE models).

Normalisation reads the model's compiled character map (a double-array trie) by
longest prefix and records, for every normalised byte, the source byte it came
from. Pieces are merged by score and projected through that record to byte
spans of the original text. Words that cannot share a piece are merged apart,
so a bounded cache of merged words serves most of a corpus.

Defined results: a NULL text is the empty text, which has no ids and decodes to
the empty text. Rows are independent: repeated rows give repeated results.
Only BPE models with byte fallback and without user-defined symbols are taken;
another model raises ValueError.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import rebatched, text_batches, texts, tidied

SPACE = "▁"
SPACE_BYTES = SPACE.encode()
LATIN = "A-Za-zÀ-ɏ"


class CharMap:
    """Longest-prefix rewriting by a compiled character map (may be empty)."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.targets = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int]:
        """(replacement, source bytes used) at ``at``; one character itself if nothing matches."""
        found, used = -1, 0
        if self.units:
            unit = self.units[0]
            node = (unit >> 10) << ((unit & 512) >> 6)
            for i in range(at, len(data)):
                node ^= data[i]
                if node >= len(self.units):
                    break
                unit = self.units[node]
                if unit & 0x800000FF != data[i]:
                    break
                node ^= (unit >> 10) << ((unit & 512) >> 6)
                if unit >> 8 & 1:
                    found, used = self.units[node] & 0x7FFFFFFF, i + 1 - at
        if used:
            return self.targets[found:self.targets.index(0, found)], used
        lead = data[at]
        used = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[at:at + used], used


class Codec:
    """Encoder and decoder of one model, given as the bytes of its file."""

    def __init__(self, model: bytes, cache_size: int = 110_000):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        kinds = pb.ModelProto.SentencePiece
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback \
                or proto.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces \
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("only BPE models with byte fallback and plain pieces are supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == kinds.NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.names = {p: str(i) for p, i in self.ids.items()}
        self.byte_names = {b: str(i) for b, i in self.byte_ids.items()}
        # Bytes of each piece: with space marks, and in a text with plain spaces.
        self.sizes = np.ones((2, len(self.pieces)), np.int64)
        for p, i in self.ids.items():
            self.sizes[:, i] = len(p.encode()), len(p.encode()) - 2 * p.count(SPACE)
        self.id_bytes = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i, p in enumerate(proto.pieces) if p.type == kinds.CONTROL}
        self.unk = next((i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN), -1)
        self.unk_surface = proto.trainer_spec.unk_surface
        self.dummy_prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.charmap = CharMap(spec.precompiled_charsmap)
        self.plain = not spec.precompiled_charsmap and not self.squeeze
        self.words = re.compile(self._word_pattern())
        self.cache: dict[str, str] = {}
        self.older: dict[str, str] = {}  # the generation before: what is asked for again moves over
        self.cache_size = cache_size

    def _word_pattern(self) -> str:
        """Cut where no piece can reach across: before a space mark, and between Latin letters and the rest."""
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            return r"(?s).+"
        mixed = re.compile(f"[{LATIN}][^{LATIN}{SPACE}]|[^{LATIN}{SPACE}][{LATIN}]")
        if any(mixed.search(p) for p in self.score):
            return f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        return f"{SPACE}*[{LATIN}]+|{SPACE}*[^{LATIN}{SPACE}]+|{SPACE}+"

    # -- normalisation -------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """(normalised text, source byte offset of each normalised byte and of the end)."""
        data, out, origin = text.encode(), bytearray(), []
        at, n, before_space = 0, len(data), self.squeeze

        def put(piece: bytes, source: int) -> None:
            for b in piece:
                part = SPACE_BYTES if b == 32 else bytes((b,))
                out.extend(part)
                origin.extend([source] * len(part))

        if self.squeeze:
            while at < n:
                piece, used = self.charmap.longest(data, at)
                if piece != b" ":
                    break
                at += used
        if at < n and self.dummy_prefix:
            put(b" ", at)
        while at < n:
            piece, used = self.charmap.longest(data, at)
            if before_space:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece, at)
                before_space = piece.endswith(b" ")
            at += used
            before_space = before_space and self.squeeze
        if self.squeeze:
            while out.endswith(SPACE_BYTES):
                del out[-3:]
                at = origin[-3]
                del origin[-3:]
        return out.decode(), np.array([*origin, at], dtype=np.int64)

    # -- merging ---------------------------------------------------------------

    def merge(self, word: str) -> list[str]:
        """Pieces of a word: the best-scored neighbouring pair joins first, the leftmost of equals."""
        if len(word) > 48:
            return self._merge_long(word)
        get, none = self.score.get, -float("inf")
        parts = list(word)
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) != none:
            i = scores.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], none)
        return parts

    def _merge_long(self, word: str) -> list[str]:
        score, parts = self.score, list(word)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] < len(parts):
                s = score.get(pair := parts[i] + parts[right[i]])
                if s is not None:
                    heapq.heappush(heap, (-s, i, pair))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i] if parts[i] else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != pair:
                continue  # one of the two has changed meanwhile
            parts[i], parts[j] = pair, ""
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i])
            offer(i)
        return [p for p in parts if p]

    def _entry(self, word: str) -> str:
        """The ids of a word's pieces, joined by commas."""
        entry = self.cache.get(word) or self.older.get(word)
        if entry is None:
            names, out = self.names, []
            for p in self.merge(word):
                if (name := names.get(p)) is not None:
                    out.append(name)
                else:
                    out.extend([self.byte_names[b] for b in p.encode()])
            entry = ",".join(out)
        if len(word) <= 48:
            if len(self.cache) >= self.cache_size:
                self.older, self.cache = self.cache, {}
            self.cache[word] = entry
        return entry

    def rest(self) -> None:
        """Keep one generation of words: the worker process serves other tasks next."""
        if len(self.cache) > len(self.older) // 2:
            self.older = self.cache
        self.cache = {}

    def joined(self, norm: str) -> str:
        """The ids of a normalised text, joined by commas."""
        get, make = self.cache.get, self._entry
        return ",".join([get(w) or make(w) for w in self.words.findall(norm)])

    def encode(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """(ids joined by commas, ids, spans): row i of spans is the [begin, end) of piece i in source bytes."""
        if not text:
            return "", np.zeros(0, np.uint32), np.zeros((0, 2), np.int64)
        direct = self.plain and SPACE not in text
        if direct:  # each source character is one normalised character, a space one mark
            norm, origin = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE), None
        else:
            norm, origin = self.normalise(text)
        joined = self.joined(norm)
        ids = np.fromstring(joined, np.uint32, sep=",")
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.sizes[int(direct)][ids], out=ends[1:])
        if direct:
            ends[1:] -= self.dummy_prefix
            if len(ids):
                chars = text.encode() if not text.isascii() else b""
                if chars:  # a byte inside a character starts where the character starts
                    ends = _char_starts(chars, ends)
        else:
            ends = origin[ends]
        return joined, ids, np.stack([ends[:-1], ends[1:]], axis=1)

    # -- decoding --------------------------------------------------------------

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``; runs of byte pieces are read as UTF-8, bad bytes as U+FFFD."""
        out: list[str] = []
        run = bytearray()
        at_start = self.dummy_prefix or self.squeeze
        for i in ids:
            if (b := self.id_bytes.get(i)) is not None:
                run.append(b)
                at_start = False
                continue
            if run:
                out.append(_utf8_or_marks(run))
                run = bytearray()
            if i in self.silent:
                continue
            piece = self.unk_surface if i == self.unk else self.pieces[i]
            if at_start and i != self.unk:
                piece = piece.lstrip(SPACE) if self.squeeze else piece.removeprefix(SPACE)
            at_start = at_start and self.squeeze and not piece
            out.append(piece.replace(SPACE, " ") if i != self.unk else piece)
        if run:
            out.append(_utf8_or_marks(run))
        return "".join(out)

    def decode_fast(self, ids: np.ndarray) -> str:
        """:meth:`decode` through a table of piece bytes; for ids that :meth:`encode` gave."""
        if not hasattr(self, "surface"):
            self.surface = [p.replace(SPACE, " ").encode() for p in self.pieces]
            for i, b in self.id_bytes.items():
                self.surface[i] = bytes((b,))
        if not len(ids):
            return ""
        if self.squeeze:
            return self.decode(ids.tolist())
        surface = self.surface
        data = b"".join([surface[i] for i in ids.tolist()])
        if self.dummy_prefix and int(ids[0]) not in self.id_bytes:
            data = data.removeprefix(b" ")
        return data.decode()


def _char_starts(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Move offsets inside a character back to its start (the end stays)."""
    inner = np.frombuffer(data, np.uint8) & 0xC0 == 0x80
    start = np.where(inner, -1, np.arange(len(data)))
    start = np.append(np.maximum.accumulate(start), len(data))
    return start[ends]


def _utf8_or_marks(run: bytes) -> str:
    """UTF-8 text; every byte that is no part of a valid character becomes U+FFFD."""
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(bytes(run[at:at + n]).decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            n = 1
            out.append("�")
        at += n
    return "".join(out)


def _codec(shared) -> Codec:
    """One codec per worker process and model: the cache lives across batches."""
    value = shared.value
    key = hashlib.sha256(value).digest()
    if _MADE.get("key") != key:
        _MADE.update(key=key, codec=Codec(value))
    return _MADE["codec"]


_MADE: dict = {}


def encode(df: DataFrame, model: bytes, text_col: str = "text", out_col: str = "encoded") -> DataFrame:
    """Add ``out_col``: struct(ids array, begins array, ends array) with byte offsets into the text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<ids:array<int>,begins:array<bigint>,ends:array<bigint>>")
    def run(col):
        import pandas as pd

        codec = _codec(shared)
        got = [codec.encode(t or "") for t in col]
        return pd.DataFrame({"ids": [g[1].astype(np.int32) for g in got], "begins": [g[2][:, 0] for g in got],
                             "ends": [g[2][:, 1] for g in got]})

    return df.withColumn(out_col, run(F.col(text_col)))


def decode(df: DataFrame, model: bytes, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add ``out_col``, the text of an array of ids (NULL: the empty text)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(col):
        import pandas as pd

        codec = _codec(shared)
        return pd.Series([codec.decode([int(i) for i in ids] if ids is not None else []) for ids in col], dtype=object)

    return df.withColumn(out_col, run(F.col(ids_col)))


def codec_digests(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text; digests of both and of the spans, one row per row of ``docs``.

    Columns: id_col, n_tokens, ids_sha256, decoded_sha256, spans_sha256 (little-endian
    64-bit begin and end of each piece), span_bytes (source bytes inside a piece).
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            schema = pa.schema([("id", batch.column(0).type), ("n", pa.int64()), ("i", pa.string()), ("d", pa.string()),
                                ("s", pa.string()), ("b", pa.int64())])

            def rows(batch=batch):
                for key, text in zip(batch.column(0).to_pylist(), texts(batch, 1)):
                    joined, ids, spans = codec.encode(text)
                    yield (key, len(ids), _sha(joined.encode()), _sha(codec.decode_fast(ids).encode()),
                           _sha(spans.astype("<i8").tobytes()), int((spans[:, 1] - spans[:, 0]).sum()))

            yield from rebatched(rows(), schema)
        codec.rest()

    out = f"id {id_type}, n bigint, i string, d string, s string, b bigint"
    return docs.select(id_col, text_col).mapInArrow(tidied(run), out).toDF(
        id_col, "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256", "span_bytes")


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()

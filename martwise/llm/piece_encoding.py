"""SentencePiece encoding that keeps source offsets, and decoding.

A text is normalised by the model's own rules: at each place the longest
prefix found in the compiled character map is replaced (without one, the
character stands for itself), white space is marked, and every normalised
byte remembers the source byte it came from.  The library segments the text;
the pieces tile the normalised bytes, so each piece is projected to a span of
source bytes through that alignment.  Pieces that do not tile the normalised
text raise an error.

Defined cases: a null text is empty, and an empty text has no pieces and
decodes to the empty text.  Spans are byte offsets in the text's UTF-8; a
mark that the normaliser put in front has an empty span.  Models with
user-defined pieces are refused.  An empty table gives an empty result.
Columns named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁".encode()
USER_DEFINED, BYTE = 4, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = out = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out
    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            size = varint()
            yield key >> 3, data[at:at + size]
            at += size
        else:
            size = 8 if key & 7 == 1 else 4
            yield key >> 3, data[at:at + size]
            at += size


class CharMap:
    """Longest-prefix replacement through a compiled map: a double-array trie
    over source bytes whose values point at replacement strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size:] if blob else b""

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, source bytes taken) of the longest entry at ``at``."""
        units = self.units
        if not units:
            return None
        node, found = _child(units[0]), None
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[k]:  # the label sits in the low byte; leaves have the top bit
                break
            node ^= _child(unit)
            if unit >> 8 & 1:
                found = (units[node] & 0x7FFFFFFF, k + 1 - at)
        if found is None:
            return None
        start, taken = found
        return self.texts[start:self.texts.index(b"\0", start)], taken


def _child(unit: int) -> int:
    """Offset of a trie unit's children."""
    return (unit >> 10) << ((unit & 0x200) >> 6)


class Normaliser:
    """The normalisation of a model, with a source offset per normalised byte."""

    def __init__(self, model: bytes):
        spec = trainer = b""
        self.types: list[int] = []
        self.pieces: list[str] = []
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.types.append(piece.get(3, 1))
            elif number == 2:
                trainer = value
            elif number == 3:
                spec = value
        fields, train = dict(_fields(spec)), dict(_fields(trainer))
        self.map = CharMap(fields.get(2, b""))
        self.prefix = bool(fields.get(3, 1))
        self.squeeze = bool(fields.get(4, 1))
        self.escape = bool(fields.get(5, 1))
        self.suffix = bool(train.get(24, 0))

    def _replaced(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Bytes after the character map, and the source offset of each."""
        if not self.map.units:  # a map without entries: every character stands for itself
            return data, np.arange(len(data))
        out, source, at = [], [], 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit is None:
                first = data[at]
                n = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                hit = data[at:at + n], n
            out.append(hit[0])
            source += [at] * len(hit[0])
            at += hit[1]
        return b"".join(out), np.array(source, np.int64)

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source offset of each, and one more at the end)."""
        text, source = self._replaced(data)
        raw = np.frombuffer(text, np.uint8)
        end = len(data)
        if self.squeeze and len(raw):
            blank = raw == 32
            keep = ~blank
            keep[1:] |= blank[1:] & ~blank[:-1]  # the first of a run of spaces
            kept = np.flatnonzero(~blank)
            if len(kept):
                last = kept[-1]
                end = int(source[last + 1]) if last + 1 < len(raw) else end
                keep[:kept[0]] = False
                keep[last + 1:] = False
            else:
                keep[:] = False
            raw, source = raw[keep], source[keep]
        if not len(raw):
            return b"", np.array([end])
        blank = raw == 32
        mark = MARK if self.escape else b" "
        sizes = np.where(blank, len(mark), 1)
        out = raw.tobytes().replace(b" ", mark)
        source = np.repeat(source, sizes)
        if self.prefix and self.suffix:
            out, source = out + mark, np.concatenate((source, np.full(len(mark), end)))
        elif self.prefix:
            out, source = mark + out, np.concatenate((np.full(len(mark), source[0]), source))
        return out, np.append(source, end)


class Encoding(NamedTuple):
    ids: list[int]
    begin: np.ndarray
    end: np.ndarray


class PieceCodec:
    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.normalise = Normaliser(self.library.serialized_model_proto())
        types = self.normalise.types
        if USER_DEFINED in types:
            raise ValueError("models with user-defined pieces are not supported")
        self.sizes = np.array([1 if t == BYTE else len(p.encode()) for p, t in zip(self.normalise.pieces, types)])
        self.unknown = self.library.unk_id()

    def encode(self, text: str | None) -> Encoding:
        text = text or ""
        ids = self.library.encode(text)
        normal, source = self.normalise(text.encode())
        sizes = self.sizes[ids] if ids else np.empty(0, np.int64)
        if self.unknown in ids:  # an unknown piece is as long as its surface
            surface = self.library.encode(text, out_type=str)
            sizes = np.array([len(p.encode()) if k == self.unknown else n for k, p, n in zip(ids, surface, sizes)])
        ends = np.cumsum(sizes)
        if (ends[-1] if len(ends) else 0) != len(normal):
            raise ValueError("pieces do not tile the normalised text")
        return Encoding(ids, source[ends - sizes] if ids else ends, source[ends] if ids else ends)

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_CODECS: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    if model_file not in _CODECS:
        _CODECS[model_file] = PieceCodec(model_file)
    return _CODECS[model_file]


def spans_digest(e: Encoding) -> str:
    """sha256 of every piece's source span: begin and end as little-endian 64-bit integers, piece after piece."""
    return hashlib.sha256(np.stack((e.begin, e.end), axis=1).astype("<i8").tobytes()).hexdigest()


OUTPUTS = {
    "n_tokens": (T.LongType(), lambda c, e: len(e.ids)),
    "ids": (T.ArrayType(T.IntegerType()), lambda c, e: np.array(e.ids, np.int32)),
    "begin": (T.ArrayType(T.LongType()), lambda c, e: e.begin),
    "end": (T.ArrayType(T.LongType()), lambda c, e: e.end),
    "spans_sha256": (T.StringType(), lambda c, e: spans_digest(e)),
    "decoded": (T.StringType(), lambda c, e: c.decode(e.ids)),
    "ids_sha256": (T.StringType(), lambda c, e: hashlib.sha256(str(e.ids)[1:-1].replace(" ", "").encode()).hexdigest()),
    "decoded_sha256": (T.StringType(), lambda c, e: hashlib.sha256(c.decode(e.ids).encode()).hexdigest()),
}


def encode(docs: DataFrame, model_file: str, outputs=("ids", "begin", "end")) -> DataFrame:
    """``docs`` plus the ``outputs`` (names of ``OUTPUTS``) of each text's encoding."""
    schema = T.StructType([T.StructField(n, OUTPUTS[n][0]) for n in outputs])
    makers = [OUTPUTS[n][1] for n in outputs]

    @F.pandas_udf(schema)
    def encoded(texts: pd.Series) -> pd.DataFrame:
        c = codec(model_file)
        rows = []
        for t in texts:
            e = c.encode(t)
            rows.append([make(c, e) for make in makers])
        return pd.DataFrame(dict(zip(outputs, map(list, zip(*rows)))) if rows else {n: [] for n in outputs})
    keep = [c for c in docs.columns if c not in outputs]
    return docs.select(*keep, encoded(F.col("text")).alias("__e")).select(*keep, "__e.*")

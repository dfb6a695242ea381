"""Token ids in length-delimited binary records with an offset index.

A record file is a run of frames: an unsigned 64-bit length, the masked
CRC-32C of the length, the payload and the masked CRC-32C of the payload
(little-endian; a checksum is rotated right by 15 bits and a constant
added).  A payload is an id flag, the width of a token id (2 or 4 bytes), the
document id, the number of tokens, and the token ids.  Beside it an index
file holds each frame's offset and length as two unsigned 64-bit numbers, so
that a reader can fetch frames in any order.

Documents are range-partitioned by id and sorted within partitions, so the
shards follow each other in ascending id order and no task sees more than
its range.  Every shard reports its documents and ids; a running sum over the
shards (one row each) gives global positions.

Defined cases: null ids come first; rows that agree in id are ordered by the
hash of their text.  A null or empty text has the end id only.  An empty table writes no
shard and reads back empty.  Other columns are not written.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwise.llm import storage
from martwise.llm.common import cut, shared_dir

HEAD = struct.Struct("<BBqI")
FRAME = struct.Struct("<QI")
MASK_DELTA = 0xA282EAD8
CASTAGNOLI = 0x82F63B78  # the polynomial, bits reversed


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(CASTAGNOLI), t >> 1)
    return t


_TABLE = _byte_table()
_CHUNK = 128


def _shift_tables(steps: int) -> np.ndarray:
    """Four tables that move a checksum ``steps`` zero bytes on."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(steps):
        bits = _TABLE[bits & 255] ^ (bits >> 8)
    out = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for b in range(8):
            out[k] ^= np.where(np.arange(256) >> b & 1, bits[8 * k + b], 0).astype(np.uint32)
    return out


_SHIFT = _shift_tables(_CHUNK)


def crc32c(items: list[bytes]) -> np.ndarray:
    """CRC-32C of every item (4 bytes or more each), computed side by side.

    An item is padded in front with zero bytes, which a checksum started at
    zero ignores; starting at all ones equals flipping the first four bytes.
    """
    if not items:
        return np.empty(0, np.uint32)
    lens = np.array([len(x) for x in items])
    chunks = -(-lens // _CHUNK)
    ends = np.cumsum(chunks)
    flat = np.zeros(int(ends[-1]) * _CHUNK, np.uint8)
    starts = ends * _CHUNK - lens
    data = np.frombuffer(b"".join(items), np.uint8)
    flat[np.repeat(starts - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(len(data))] = data
    for k in range(4):
        flat[starts + k] ^= 0xFF
    rows = flat.reshape(-1, _CHUNK)
    crc = np.zeros(len(rows), np.uint32)
    for k in range(_CHUNK):
        crc = _TABLE[(crc ^ rows[:, k]) & 255] ^ (crc >> 8)
    out = np.zeros(len(items), np.uint32)
    order = np.argsort(-chunks, kind="stable")  # items with the most chunks first
    left = chunks[order]
    for step in range(int(left[0])):
        at = order[: int(np.searchsorted(-left, -step))]
        s = out[at]
        s = _SHIFT[0][s & 255] ^ _SHIFT[1][s >> 8 & 255] ^ _SHIFT[2][s >> 16 & 255] ^ _SHIFT[3][s >> 24]
        out[at] = s ^ crc[ends[at] - chunks[at] + step]
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return (crc >> 15 | crc << 17) + np.uint32(MASK_DELTA)


def payload(doc_id: int | None, width: int, ids: bytes) -> bytes:
    return HEAD.pack(doc_id is not None, width, doc_id or 0, len(ids) // width) + ids


def frame(items: list[bytes]) -> list[bytes]:
    """The frames of payloads."""
    sizes = [struct.pack("<Q", len(x)) for x in items]
    size_crc, item_crc = masked(crc32c(sizes)).tolist(), masked(crc32c(items)).tolist()
    return [n + struct.pack("<I", a) + x + struct.pack("<I", b) for n, a, x, b in zip(sizes, size_crc, items, item_crc)]


class WordTokenizer:
    """Ids of a word-level BPE tokenizer, each word looked up once.

    The tokenizer lower-cases, splits at white space and then into pieces
    that do not depend on each other, so the ids of words and pieces are kept.
    A piece taken alone is one piece, so both share one table.  Texts that
    have a character beyond U+024F, before or after lower-casing (where case
    and normal forms need more rules), go to the library whole.
    """

    LIMIT = 300_000

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        spec["normalizer"] = None
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.pieces = Tokenizer.from_str(json.dumps(spec))
        vocab = self.whole.get_vocab()
        self.width = 2 if max(vocab.values(), default=0) < 1 << 16 else 4
        self.dtype = np.uint16 if self.width == 2 else np.uint32
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # tokens that end a piece
        for token, k in vocab.items():
            self.last[k] = token.endswith("</w>")
        kinds = {k: "".join(re.escape(chr(i)) for i in range(0x250) if unicodedata.category(chr(i))[0] == k) for k in "LN"}
        blank = "\t-\r \x85\xa0"
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[^{blank}{kinds['L']}{kinds['N']}]+").findall
        self.beyond = re.compile("[^\x00-ɏ]").search
        self.words: dict[str, bytes] = {}

    def plain(self, text: str) -> str | None:
        """The lower-cased text; None if the library must read the text whole."""
        if "<|" in text or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return None
        low = text.lower()
        if text.isascii() or not (self.beyond(text) or self.beyond(low)):
            return low
        return None

    def _learn(self, words: set[str]) -> None:
        known = self.words
        new = {w for w in words if w.isalpha()}  # one piece
        parts = [(w, self.split(w)) for w in words.difference(new)]
        new.update(p for _, own in parts for p in own if p not in known)
        if new:
            pieces = list(new)
            ids = np.array(self.pieces.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, self.dtype)
            ends = (np.flatnonzero(self.last[ids]) + 1) * self.width
            if len(ends) != len(pieces):
                raise ValueError("the tokenizer does not mark the ends of words")
            raw, at = ids.tobytes(), 0
            for piece, end in zip(pieces, ends.tolist()):
                known[piece] = raw[at:end]
                at = end
        get = known.__getitem__
        for word, own in parts:
            known[word] = b"".join(map(get, own))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids of every text."""
        out: list[bytes] = []
        for k in range(0, len(texts), 64):
            part = [self.plain(t) if t else "" for t in texts[k:k + 64]]
            part = [None if t is None else t.split() for t in part]
            wanted = set().union(*(w for w in part if w))
            new = wanted.difference(self.words)
            if len(self.words) + len(new) > self.LIMIT:  # start over with what is needed now
                self.words.clear()
                new = wanted
            if new:
                self._learn(new)
            get = self.words.__getitem__
            for text, words in zip(texts[k:k + 64], part):
                if words is None:
                    ids = self.whole.encode(text, add_special_tokens=False).ids
                    out.append(np.array(ids, self.dtype).tobytes())
                else:
                    out.append(b"".join(map(get, words)))
        return out


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


MANIFEST = "shard int, records string, index string, docs long, ids long"


def write_records(docs: DataFrame, model: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Write the files; the result lists the shards in order (one row each)."""
    folder = folder or shared_dir(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = index = None
        at = docs_n = ids_n = 0
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                piece = batch.slice(part, 1000)
                if not piece.num_rows:
                    continue
                if out is None:
                    tok = tokenizer(model)
                    end = np.array([end_id], tok.dtype).tobytes()
                    path, out = storage.create(folder, ".records")
                    index_path, index = storage.create(folder, ".index")
                coded = tok.encode(piece.column(1).to_pylist())
                body = [payload(doc_id, tok.width, ids + end) for doc_id, ids in zip(piece.column(0).to_pylist(), coded)]
                ids_n += sum(map(len, coded)) // tok.width + len(coded)
                marks = []
                for x in frame(body):
                    out.write(x)
                    marks.append((at, len(x)))
                    at += len(x)
                index.write(np.array(marks, np.uint64).tobytes())
                docs_n += piece.num_rows
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([TaskContext.get().partitionId()], pa.int32()), "records": [path], "index": [index_path],
                 "docs": pa.array([docs_n], pa.int64()), "ids": pa.array([ids_n], pa.int64())})

    # the hash deals out the texts of a common id
    ordered = (docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    manifest = cut(ordered.mapInArrow(write, MANIFEST))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return manifest.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")))


def frames(path: str, offsets: np.ndarray):
    """(doc_id, ids) of the frames at ``offsets`` (rows of offset, length), checked."""
    with storage.open_input(path) as f:
        step = 256
        for k in range(0, len(offsets), step):
            raw = []
            for at, size in offsets[k:k + step].tolist():
                f.seek(at)
                raw.append(f.read(size))
            body = [x[12:-4] for x in raw]
            want = np.array([FRAME.unpack(x[:12]) + struct.unpack("<I", x[-4:]) for x in raw], np.uint64)
            bad = ((want[:, 0] != [len(x) for x in body]) | (want[:, 1] != masked(crc32c([x[:8] for x in raw])))
                   | (want[:, 2] != masked(crc32c(body))))
            if bad.any():
                raise ValueError(f"{path}: damaged frame at {offsets[k + int(bad.argmax())][0]}")
            for x in body:
                known, width, doc_id, n = HEAD.unpack(x[:HEAD.size])
                yield doc_id if known else None, np.frombuffer(x, "<u2" if width == 2 else "<u4", n, HEAD.size)


def read_records(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) from the files, shard by shard in parallel.

    ``start`` counts the ids of all documents before; ``with_ids=False``
    leaves the ids out.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with storage.open_input(row["index"]) as f:
                    offsets = np.frombuffer(f.read(), np.uint64).reshape(-1, 2)
                start, rows = row["first"], []
                for n, (doc_id, ids) in enumerate(frames(row["records"], offsets)):
                    wide = ids.astype("<u4")
                    rows.append((doc_id, start, len(ids), zlib.crc32(wide.tobytes()), wide.tolist() if with_ids else None))
                    start += len(ids)
                    if len(rows) == 2000 or n == len(offsets) - 1:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), (*[pa.int64()] * 4, pa.list_(pa.int64())))],
                            names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                        rows = []
    n = max(1, manifest.count())
    out = manifest.repartitionByRange(n, "shard").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")
    return out if with_ids else out.drop("ids")

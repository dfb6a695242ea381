"""WARC archives of pages, with records compressed by a shared Zstandard dictionary.

Each task writes one archive: a skippable frame that holds the dictionary,
then every record as a frame of its own.  The dictionary is built from a
bounded sample of the unlike pages (about ``SAMPLE`` by a hash of the digest;
of those over ``SAMPLE_BYTES`` the first quarter as many characters).  Of the records with one payload that with the
smallest page id is the response; the others are revisits, which name it and
carry no payload.

Defined cases: a null html is the empty payload.  Null page ids come after
all others, and a revisit of a response without an id has a null
``refers_to``.  Rows that agree in page id and payload with the response are
responses too.  Payloads shorter than ``min_bytes`` are all responses.
Without enough text to train on, the dictionary is the sample itself, and
without a sample no frame leads the archive.  An empty table writes nothing
and reads back empty.  Other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwise.llm import storage
from martwise.llm.common import cut, shared_dir

SKIPPABLE = 0x184D2A5D  # the frame type that archives use for a dictionary
DICTIONARY_BYTES = 112_640
SAMPLE = 1500
SAMPLE_BYTES = 65_536
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_dictionary(pages: DataFrame, sample: int = SAMPLE, size: int = DICTIONARY_BYTES) -> bytes:
    """The dictionary, built in one task from the bounded sample."""
    usable = pages.select("html", F.sha1(F.col("html").cast("binary")).alias("digest")).filter(F.length("html") > 0)
    n = usable.select("digest").distinct().count()
    start = F.when(F.octet_length("html") <= SAMPLE_BYTES, F.col("html")).otherwise(F.substring("html", 1, SAMPLE_BYTES // 4))
    share = (usable.filter(F.pmod(F.xxhash64("digest"), F.lit(max(1, n // sample))) == 0)
             .groupBy("digest").agg(F.min(start).alias("html")).select("html").limit(2 * sample))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        texts = sorted({x.encode() for batch in batches for x in batch.column(0).to_pylist()})
        raw = b""
        if texts:
            try:
                raw = zstandard.train_dictionary(size, texts).as_bytes()
            except zstandard.ZstdError:  # too little text to train on
                raw = b"".join(texts)[-size:]
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([raw], pa.binary())})
    got = share.coalesce(1).mapInArrow(train, "dictionary binary").collect()
    return max((r[0] for r in got), key=len, default=b"")


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html`` plus the id of the response of its payload.

    Ids are reduced per digest before the shuffle; a payload on many pages is
    a hot key of the join, which AQE splits.
    """
    rows = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    long_enough = F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "html", F.coalesce(F.col("n") > 1, F.lit(False)).alias("shared"),
        F.when(long_enough, F.col("response_id")).alias("response_id"), long_enough.alias("counts"))


def record(page_id: int | None, url: str | None, html: str | None, revisit_of: int | None, revisit: bool) -> bytes:
    payload = (html or "").encode()
    body = HTTP if revisit else HTTP + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"WARC-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{'' if revisit_of is None else revisit_of}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def write_archives(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write the archives; the result lists them (path, records, bytes)."""
    folder = folder or shared_dir(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(build_dictionary(pages))  # at most DICTIONARY_BYTES

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        raw, out, n, size = shared.value, None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, out = storage.create(folder, ".warc.zst")
                    if raw:
                        size += out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
                    words = zstandard.ZstdCompressionDict(raw) if raw else None
                    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=words)
                revisit = row["shared"] and row["counts"] and row["page_id"] != row["response_id"]
                size += out.write(press.compress(record(row["page_id"], row["url"], row["html"], row["response_id"], revisit)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "path": [path],
                                              "records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())})
    return cut(plan_records(pages, min_bytes).mapInArrow(write, "part int, path string, records long, bytes long"))


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of every record of an archive."""
    import zstandard

    lead = stream.read(8)
    words = None
    if len(lead) == 8 and struct.unpack("<I", lead[:4])[0] == SKIPPABLE:
        words = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<I", lead[4:])[0]))
        lead = b""
    stream.seek(stream.tell() - len(lead))
    plain = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=words).stream_reader(stream, read_across_frames=True), 1 << 20)
    while True:
        line = plain.readline()
        if not line:
            return
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        head = {}
        while (line := plain.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name] = value
        size = int(head["Content-Length"])
        body = plain.read(size)
        if len(body) != size or plain.read(4) != b"\r\n\r\n":
            raise ValueError("a record ends early")
        yield head, body.partition(b"\r\n\r\n")[2]


def _id(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the archives, one task or more per archive, in any order.

    A response's digest and length are checked against its payload.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows):
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with storage.open_input(path) as f:
                    for head, payload in read_archive(f):
                        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(head["WARC-Payload-Length"])
                        if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
                            raise ValueError(f"{path}: payload of {head['WARC-Record-ID']} does not fit its digest")
                        rows.append((_id(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), size, digest, kind,
                                     _id(head.get("WARC-Refers-To")), payload if with_payload else None))
                        if len(rows) == 1000:
                            yield flush(rows)
                            rows = []
                if rows:
                    yield flush(rows)
    n = max(1, archives.count())
    out = archives.repartitionByRange(n, "part").select("path").mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
    return out if with_payload else out.drop("payload")

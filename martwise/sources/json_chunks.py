"""Bounded reading of large gzip JSON arrays (S3, S16), with the place of every record.

``multiLine`` makes all rows of a file's array before it returns the first.
Here Spark's text reader streams the file cut at closing braces, and a small
helper in the task puts the cuts together to one JSON text per record, so a
task holds one Arrow batch, whatever the size of the array.  Decompression,
listing, any Hadoop file system and the file source of Structured Streaming
stay Spark's; the texts are then parsed by ``from_json`` in the JVM.

A gzip file is read by one task from its start, so a record's place in its
file is simply counted.  It does not depend on how Spark packs files into
partitions, nor on batch or stream.

Defined cases: an array of objects gives one record each, a lone object one
record, an empty file or array none.  Any other element, a file that ends
inside the array and braces that do not match fail the load, naming the file.
A lone object that lacks only its last brace is read as if it had it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwise.schemas import RAW_MERCURY_ACCOUNT
from martwise.sources.json_sources import SEQ, file_key, parse_records

CHUNK_SIZE = 50_000
RECORDS = "file string, pos long, text string"

_STRING = re.compile(r'"(?:[^"\\]++|\\.)*+"', re.DOTALL)
_OPENS = re.compile(r"\s*\[\s*")
_NEXT = re.compile(r"\s*,\s*")
_BLANK = re.compile(r"\s*")
_CLOSES = re.compile(r"\s*\]\s*")
_EMPTY = re.compile(r"\s*\[\s*\]\s*")


class RecordSplitter:
    """The records of one file, from its text cut at closing braces."""

    def __init__(self, file: str):
        self.file, self.pos = file, 0
        self.parts: list[str] = []
        self.depth = 0
        self.in_string = self.array = self.started = False

    def _bad(self, what: str) -> ValueError:
        return ValueError(f"{self.file}: {what} after {self.pos} records")

    def add(self, cut: str) -> str | None:
        """Takes in a cut that a brace follows; the record if it is complete."""
        if self.in_string or '"' in cut:
            plain = _STRING.sub("", '"' + cut if self.in_string else cut)
            at = plain.find('"')
            self.in_string = at >= 0
            if at >= 0:
                plain = plain[:at]
        else:
            plain = cut
        if not self.parts:  # between records
            cut = self._begin(cut)
        self.depth += plain.count("{")
        self.parts.append(cut)
        self.parts.append("}")
        if self.in_string:
            return None
        self.depth -= 1
        if self.depth > 0:
            return None
        record = "".join(self.parts)
        self.parts.clear()
        self.pos += 1
        return record

    def _begin(self, cut: str) -> str:
        if not self.started:
            self.started = True
            lead = _OPENS.match(cut)
            self.array = lead is not None
        elif not self.array:
            raise self._bad("text after a lone object")
        else:
            lead = _NEXT.match(cut)
        at = (lead or _BLANK.match(cut)).end()
        if (lead is None and self.array) or not cut.startswith("{", at):
            raise self._bad("an element that is not an object")
        return cut[at:]

    def end(self, cut: str) -> str | None:
        """Takes in the last cut of the file; a lone object's record if it ends there."""
        if not self.parts and (_CLOSES if self.array else _EMPTY if not self.started else _BLANK).fullmatch(cut):
            return None
        if not self.started and _BLANK.fullmatch(cut):
            return None
        record = None if self.array else self.add(cut)
        if record is None or self.array:
            raise self._bad("the file ends inside the array or an object")
        return record


def split_records(chunk_size: int = CHUNK_SIZE):
    """Rows of (file, cut) to rows of ``RECORDS``, at most ``chunk_size`` a batch."""
    def out(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
        file, pos, text = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(file, pa.string()), pa.array(pos, pa.int64()), pa.array(text, pa.string())],
                                          names=["file", "pos", "text"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: RecordSplitter | None = None
        held = ""  # the cut before the current one: whether a brace follows shows with the next
        rows: list[tuple[str, int, str]] = []
        for batch in batches:
            for file, cut in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at is None or at.file != file:
                    if at is not None and (record := at.end(held)) is not None:
                        rows.append((at.file, at.pos - 1, record))
                    at = RecordSplitter(file)
                elif (record := at.add(held)) is not None:
                    rows.append((file, at.pos - 1, record))
                    if len(rows) >= chunk_size:
                        yield out(rows)
                        rows = []
                held = cut
            if rows:
                yield out(rows)
                rows = []
        if at is not None and (record := at.end(held)) is not None:
            rows.append((at.file, at.pos - 1, record))
        if rows:
            yield out(rows)
    return split


def _whole_files(paths: Sequence[str]) -> None:
    plain = [p for p in paths if not p.endswith(".gz")]
    if plain:
        raise ValueError(f"only gzip files are read by one task from their start: {plain[:3]}")


def records(cuts: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """(file, pos, text) from a frame of the text reader (batch or stream)."""
    return cuts.select(file_key().alias("file"), "value").mapInArrow(split_records(chunk_size), RECORDS)


def read_json_chunked(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                      chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """S3: the records of gzip JSON files with their sequence, as S1 gives them, in bounded memory."""
    paths = [path] if isinstance(path, str) else list(path)
    _whole_files(paths)
    cuts = spark.read.option("lineSep", "}").text(paths)
    return parsed(records(cuts, chunk_size), schema)


def stream_json_chunked(spark: SparkSession, source_dir: str, schema: T.StructType, max_files_per_trigger: int = 1,
                        chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """The same as a stream over the gzip files that arrive in a folder."""
    cuts = (spark.readStream.option("lineSep", "}").option("pathGlobFilter", "*.gz")
            .option("maxFilesPerTrigger", max_files_per_trigger).text(source_dir))
    return parsed(records(cuts, chunk_size), schema)


def parsed(found: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of the records' texts plus ``_seq``; a text that does not parse fails the load."""
    rows = found.select(parse_records(F.col("text"), schema).alias("r"), F.struct("file", "pos").alias(SEQ))
    return rows.select("r.*", SEQ)


def read_json_variant(spark: SparkSession, path: str | Sequence[str], chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """(record, _seq): the records whole, as VARIANT (S13).  No field is lost
    that a schema does not list, and types are chosen when a field is read."""
    paths = [path] if isinstance(path, str) else list(path)
    _whole_files(paths)
    found = records(spark.read.option("lineSep", "}").text(paths), chunk_size)
    return found.select(F.parse_json("text").alias("record"), F.struct("file", "pos").alias(SEQ))


def field(name: str, kind: str = "string", record: str = "record") -> Column:
    """A top-level field of a VARIANT record, typed; null where it is absent, null or of another type."""
    return F.try_variant_get(F.col(record), _path(name), kind)


def states_null(name: str, record: str = "record") -> Column:
    """True where a record gives the field as null, false where it has a value, null where it lacks the key (Q9)."""
    value = F.try_variant_get(F.col(record), _path(name), "variant")
    return F.when(value.isNotNull(), F.is_variant_null(value))


def _path(name: str) -> str:
    if "'" in name and '"' in name:
        raise ValueError(f"a path cannot name the field {name!r}")
    return f'$["{name}"]' if "'" in name else f"$['{name}']"


def read_accounts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Bank accounts with the listed fields as text and the whole ``record`` beside them."""
    rows = read_json_variant(spark, path)
    return rows.select(*[field(f.name).alias(f.name) for f in RAW_MERCURY_ACCOUNT.fields], "record", SEQ)

"""Items of JSON documents {"meta": ..., "results": [...]}, one at a time.

A data source that reads a document as a stream: of it a task holds a few blocks and the item at hand, so a
document may be larger than the memory of an executor. The items' text is typed by Spark.
"""

from __future__ import annotations

import codecs
import json
import sys
from collections.abc import Iterator
from fnmatch import fnmatch
from typing import IO

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK, BATCH_BYTES = 1 << 20, 4 << 20
# of a task, and what opening a document counts as
TASK_BYTES, OPEN_BYTES = 32 << 20, 64 << 10
_BLANK = " \t\n\r"
_AFTER = {*_BLANK, *",:]}"}


class Document:
    """The text of one document from a stream of bytes, of which the part not read yet is held."""

    def __init__(self, stream: IO[bytes], block: int = BLOCK) -> None:
        self.stream, self.block = stream, block
        self.scan = json.JSONDecoder().raw_decode
        self.decode = codecs.getincrementaldecoder("utf-8-sig")().decode
        self.text, self.at, self.done = "", 0, 0
        self.ended = False

    def more(self, size: int) -> None:
        """Go on to at least one more character, or the end."""
        parts, got = [self.text[self.at :]], 0
        self.done, self.at = self.done + self.at, 0
        while not self.ended and got < size:
            data = self.stream.read(self.block)
            self.ended = not data
            parts.append(self.decode(data, final=self.ended))
            got += len(parts[-1])
        self.text = "".join(parts)

    def peek(self) -> str:
        """The next character that isn't blank, empty at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in _BLANK:
                self.at += 1
            if self.at < len(self.text) or self.ended:
                return self.text[self.at : self.at + 1]
            self.more(1)

    def expect(self, *wanted: str) -> str:
        found = self.peek()
        if found not in wanted or not found:
            raise ValueError(f"expected {' or '.join(wanted)} at character {self.done + self.at}, found {found or 'the end'}")
        self.at += 1
        return found

    def value(self) -> str:
        """The text of the next value. While it isn't whole, twice as much is read each time."""
        self.peek()
        size = self.block
        while True:
            try:
                _, end = self.scan(self.text, self.at)
            except ValueError as e:
                if self.ended:
                    raise ValueError(f"no value at character {self.done + self.at}: {e}") from None
                end = len(self.text)
            # of a number that goes on after the block, two characters are left at most
            if self.ended or end + 2 < len(self.text) or self.text[end : end + 1] in _AFTER:
                found = self.text[self.at : end]
                self.at = end
                return found
            self.more(size)
            size *= 2

    def elements(self) -> Iterator[str]:
        """The values of the array that begins here."""
        self.expect("[")
        if self.peek() == "]":
            self.at += 1
            return
        while True:
            yield self.value()
            if self.expect(",", "]") == "]":
                return

    def items(self, field: str) -> Iterator[str]:
        """The elements of the root object's arrays of that name; all else is passed over, arrays element by
        element."""
        self.expect("{")
        if self.peek() == "}":
            self.at += 1
        else:
            while True:
                if self.peek() != '"':
                    self.expect('"')
                name = json.loads(self.value())
                self.expect(":")
                if self.peek() != "[":
                    if (other := self.value()) != "null" and name == field:
                        raise ValueError(f"{field} is no array but {other[:20]}")
                else:
                    for element in self.elements():
                        if name == field:
                            yield element
                if self.expect(",", "}") == "}":
                    break
        if self.peek():
            raise ValueError(f"more text after the document at character {self.done + self.at}")


def documents(path: str, glob: str) -> list[tuple[str, int]]:
    """URIs and bytes of the files in a folder, or of the file itself; any file system that Arrow knows."""
    system, at = fs.FileSystem.from_uri(path)
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    info = system.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(path, info.size or 0)]
    found = system.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted((prefix + f.path, f.size or 0) for f in found if f.type == fs.FileType.File and fnmatch(f.base_name, glob) and f.base_name[:1] not in "._")


def shares(files: list[tuple[str, int]], tasks: int) -> list[list[str]]:
    """The files in runs of TASK_BYTES, or of less if there are fewer tasks then; a larger file is a run by
    itself."""
    size = sum(n + OPEN_BYTES for _, n in files)
    most = min(TASK_BYTES, max(OPEN_BYTES, -(-size // tasks)))
    runs: list[list[str]] = []
    held = 0
    for uri, n in files:
        if not runs or held + n + OPEN_BYTES > most:
            runs.append([])
            held = 0
        runs[-1].append(uri)
        held += n + OPEN_BYTES
    return runs


class EnvelopeReader(DataSourceReader):
    """A partition holds documents of some size together; many small ones cost no task each."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.glob, self.field = options["path"], options.get("pathglobfilter", "*"), options.get("field", "results")
        self.tasks = int(options.get("tasks", "1"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(uris) for uris in shares(documents(self.path, self.glob), self.tasks)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for uri in partition.value:
            yield from self.read_document(uri)

    def read_document(self, uri: str) -> Iterator[pa.RecordBatch]:
        system, at = fs.FileSystem.from_uri(uri)

        def batch(held: list[str], first: int) -> pa.RecordBatch:
            n = len(held)
            columns = [pa.array([uri] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), pa.array(held, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["file", "seq", "item"])

        with system.open_input_stream(at, compression="gzip" if at.endswith(".gz") else None) as stream:
            held, size, first = [], 0, 0
            try:
                for item in Document(stream).items(self.field):
                    held.append(item)
                    size += len(item)
                    if size >= BATCH_BYTES:
                        yield batch(held, first)
                        held, size, first = [], 0, first + len(held)
            except ValueError as e:
                raise ValueError(f"{uri}: {e}") from None
            if held:
                yield batch(held, first)


class EnvelopeSource(DataSource):
    """Options: path, pathGlobFilter, field, tasks (how many there should be at least)."""

    @classmethod
    def name(cls) -> str:
        return "json_envelope"

    def schema(self) -> str:
        return "file string, seq bigint, item string"

    def reader(self, schema: StructType) -> EnvelopeReader:
        return EnvelopeReader(self.options)


def stream_envelope(
    spark: SparkSession, path: str, schema: StructType, pulled_at: str, field: str = "results", glob: str = "*.json*"
) -> DataFrame:
    """As `readers.explode_envelope`: one row per item of the array `field` of JSON documents, typed, with its
    document and its place in it. Documents are read as streams, gzipped ones too.

    A document that isn't whole or well formed fails the load. Items must fit in memory, documents need not.
    """
    spark.dataSource.register(EnvelopeSource)
    tasks = spark.sparkContext.defaultParallelism
    items = spark.read.format("json_envelope").options(pathGlobFilter=glob, field=field, tasks=tasks).load(path)
    typed = F.from_json("item", schema, {"mode": "FAILFAST"})
    return items.select(typed.alias("_typed"), "file", "seq").select("_typed.*", "file", "seq", F.lit(pulled_at).alias("_pulled_at"))

"""Files of JSON documents over many lines, read in byte ranges by a Python data source."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.sources.storage import files_under

RANGE_BYTES = 64 << 20  # of a file that one task reads
CHUNK = 1 << 20
BATCH = 8 << 20  # bytes of documents in an Arrow batch
SPACE = b" \t\n\r\f\v"
#: Where one document ends and the next begins: inside a document two objects are always parted by a
#: comma, and a text can't hold a line end as it is.
BORDER = re.compile(rb"\}[ \t\r\f\v]*+\n[ \t\n\r\f\v]*+(?=\{)")


def _context(file: BinaryIO, start: int) -> int:
    """Where the last byte before `start` that is no space lies; 0 if there is none."""
    while start > 0:
        low = max(0, start - CHUNK)
        file.seek(low)
        before = file.read(start - low).rstrip(SPACE)
        if before:
            return low + len(before) - 1
        start = low
    return 0


def documents_in(file: BinaryIO, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of the documents that begin in [start, stop), read to their ends beyond `stop`.

    So the ranges of a file give each document once, wherever they are cut. What comes before a
    document's first bracket at the start of the file belongs to it.
    """
    base = _context(file, start)  # of the buffer
    file.seek(base)
    buffer, searched, ended = b"", 0, False
    begin = 0 if base == 0 and start == 0 else None  # of the document being read, in the buffer
    while True:
        found = BORDER.search(buffer, searched)
        if found is None:
            if ended:
                break
            # A border that isn't complete yet begins at the last byte that is no space.
            searched = max(searched, len(buffer.rstrip(SPACE)) - 1)
            # What is done with goes once a chunk: small documents are many, and each cut copies the rest.
            done = searched if begin is None else begin
            base, buffer, searched = base + done, buffer[done:], searched - done
            begin = None if begin is None else 0
            more = file.read(CHUNK)
            ended = not more
            buffer += more
            continue
        if begin is not None:
            yield base + begin, buffer[begin : found.start() + 1]
        begin = found.end() if base + found.end() >= start else None
        if base + found.end() >= stop:
            return
        searched = found.end()
    last = buffer[begin:].rstrip(SPACE) if begin is not None else b""
    if last:
        yield base + begin, last


def ranges(files: list[tuple[str, int]], range_bytes: int) -> list[list[tuple[str, int, int]]]:
    """What each task reads: a range of a large file, or several small files."""
    tasks, waiting, held = [], [], 0
    for path, size in files:
        for start in range(0, size, range_bytes):
            stop = min(size, start + range_bytes)
            if waiting and held + stop - start > range_bytes:
                tasks.append(waiting)
                waiting, held = [], 0
            waiting.append((path, start, stop))
            held += stop - start
    return [*tasks, waiting] if waiting else tasks


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.files = [tuple(f) for f in json.loads(options["files"])]
        self.range_bytes = int(options.get("rangebytes", options.get("rangeBytes", RANGE_BYTES)))

    def partitions(self):
        return [InputPartition(task) for task in ranges(self.files, self.range_bytes)] or [InputPartition([])]

    def read(self, partition):
        from pyarrow.fs import FileSystem

        rows, held = [], 0

        def batch():
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            kinds = (pa.string(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "start", "document"]
            )

        for path, start, stop in partition.value:
            store, inside = FileSystem.from_uri(path)
            with store.open_input_file(inside) as file:
                for place, document in documents_in(file, start, stop):
                    rows.append((path, place, document.decode("utf-8", "replace")))
                    held += len(document)
                    if held >= BATCH:
                        yield batch()
                        rows.clear()
                        held = 0
        if rows:
            yield batch()


class JsonDocuments(DataSource):
    """Rows of file, start (the place of the document's first byte) and document.

    Options: `files`, a JSON list of [URI, bytes]; `rangeBytes`, how much a task reads. `read_documents`
    lists the files.
    """

    @classmethod
    def name(cls):
        return "json_documents"

    def schema(self):
        return "file string, start long, document string"

    def reader(self, schema):
        return _Reader(self.options)


def read_documents(
    spark: SparkSession, path: str | list[str], feed: str | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """file, start and document of every JSON document in files under paths or globs.

    A file of any size is read by as many tasks as it has ranges; each finds the next document border
    for itself. A document over many lines is one row; it is the only thing that is held whole. With
    `feed`, files in folders `feed=` of others are left out. Files and folders whose names begin with `_` or
    `.` are left out, as Spark does. Files are opened by URI (local, S3, HDFS).
    """
    listed = [f for p in ([path] if isinstance(path, str) else path) for f in files_under(spark, p)]
    if feed is not None:
        listed = [f for f in listed if "/feed=" not in f[0] or f"/feed={feed}/" in f[0]]
    spark.dataSource.register(JsonDocuments)
    reader = spark.read.format("json_documents").option("files", json.dumps(listed)).option("rangeBytes", range_bytes)
    return reader.load()

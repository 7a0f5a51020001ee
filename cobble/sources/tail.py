"""Lines of one growing text file as a stream (IO10).

Spark's file streams take whole new files. A feed that is appended to a single ordered file is read here
by byte offset: a batch is the range from the last batch's end to the last line end now in the file, cut
into parts that tasks read side by side. A part gives the lines that begin in it, so every line is
given once, whole, whatever the cuts. A line that still lacks its end waits for the batch in which it
has one. The offset is kept in the query's checkpoint, and a query that starts again goes on from it.

    register_tail(spark)
    spark.readStream.format("cobble_tail").option("path", path).load()      # value STRING, at BIGINT

``at`` is a line's first byte, so it orders the lines. The path is opened with Arrow's file systems (a
mounted path, hdfs:// or s3://, as that library is set up where the executors run).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes of the file that one task reads, and those read at a time.
PART_BYTES, READ_BYTES = 64 << 20, 1 << 20
#: Lines handed to Spark together.
BATCH_LINES = 8192


class Part(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def _open(path: str):
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def last_line_end(path: str, start: int) -> int:
    """The offset behind the last line end at or after ``start``; ``start`` where there is none."""
    try:
        f = _open(path)
    except FileNotFoundError:  # the feed has not begun
        return start
    with f:
        end = f.size()
        if end < start:
            raise ValueError(f"{path} has become shorter than what was read of it")
        while end > start:
            a = max(start, end - READ_BYTES)
            at = f.read_at(end - a, a).rfind(b"\n")
            if at >= 0:
                return a + at + 1
            end = a
    return start


def lines_between(path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that begin in [start, end). The line that holds byte ``start - 1`` begins
    before it, so reading starts there and its rest is left out."""
    with _open(path) as f:
        at = max(start - 1, 0)
        held, first, where = b"", start > 0, at
        while True:
            block = f.read_at(READ_BYTES, at)
            if not block:
                return
            at += len(block)
            parts = (held + block).split(b"\n")
            held = parts.pop()
            for line in parts:
                if not first:
                    if where >= end:
                        return
                    yield where, line
                first = False
                where += len(line) + 1
            if where >= end and not first:
                return


class TailReader(DataSourceStreamReader):
    def __init__(self, path: str, part_bytes: int):
        self.path, self.part_bytes = path, part_bytes
        self.last = 0

    def initialOffset(self) -> dict:
        return {"at": 0}

    def latestOffset(self) -> dict:
        self.last = last_line_end(self.path, self.last)
        return {"at": self.last}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        edges = [*range(start["at"], end["at"], self.part_bytes), end["at"]]
        return [Part(a, b) for a, b in zip(edges, edges[1:])]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, bytes]] = []

        def batch() -> pa.RecordBatch:
            texts = [line.removesuffix(b"\r").decode("utf-8", "replace") for _, line in rows]
            return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([a for a, _ in rows], pa.int64())], ["value", "at"])

        for row in lines_between(self.path, partition.start, partition.end):
            rows.append(row)
            if len(rows) >= BATCH_LINES:
                yield batch()
                rows = []
        if rows:
            yield batch()


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cobble_tail"

    def schema(self) -> str:
        return "value string, at bigint"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options["path"], int(self.options.get("partBytes", PART_BYTES)))


def register_tail(spark: SparkSession) -> None:
    spark.dataSource.register(TailSource)

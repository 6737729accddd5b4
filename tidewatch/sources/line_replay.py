"""A paced stream of the lines of headered text files: a Spark streaming data source.

The source plans by lines: each trigger takes the next ``lines_per_trigger`` data lines of the
folder's files, in the order of their names. An offset is a file and a byte in it, so a restarted query
goes on at the byte where its last batch ended. The first line of a file is its header, by position;
a data line of the same text stays.

The driver only looks for line ends. What it hands out are segments, byte ranges of at most ``SEGMENT`` lines, which
the executors read. Files are complete when they appear and do not change; names that sort
after the last one read are picked up later. Names that begin with ``_`` or ``.`` are not data. The path is a folder or
a file that ``pyarrow.fs`` can open (local or mounted, ``file:``, ``hdfs:``, ``s3:``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

SEGMENT = 50_000  # lines
CHUNK = 1 << 20  # bytes looked at together


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def data_files(path: str) -> list[str]:
    """Names of the files in the order of the replay."""
    fs, at = _open(path)
    info = fs.get_file_info(at)
    if info.is_file:
        return [at]
    found = fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and f.base_name[0] not in "_.")


def line_end(source: pa.NativeFile, at: int, size: int, lines: int) -> tuple[int, int]:
    """The byte after the next ``lines`` lines from ``at`` on, and how many they are; the last line needs no end."""
    count = 0
    while at < size and count < lines:
        block = source.read_at(min(CHUNK, size - at), at)
        here = block.count(b"\n")
        if count + here < lines:
            count, at = count + here, at + len(block)
            if at >= size and not block.endswith(b"\n"):
                count += 1
            continue
        place = -1
        for _ in range(lines - count):
            place = block.index(b"\n", place + 1)
        return at + place + 1, lines
    return at, count


class LineReader(SimpleDataSourceStreamReader):
    """Segments of the next lines; an offset is the byte ``at`` of ``file``, before which all is read."""

    def __init__(self, path: str, lines: int) -> None:
        self.path, self.lines = path, lines

    def initialOffset(self) -> dict:
        return {"file": "", "at": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        segments, end = self.take(start, self.lines, None)
        return iter(segments), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self.take(start, None, end)[0])

    def take(self, start: dict, lines: int | None, end: dict | None) -> tuple[list[tuple], dict]:
        """Segments of the next ``lines`` lines after ``start``, or of all up to ``end``, and where they end."""
        left = float("inf") if lines is None else lines
        segments, reached = [], start
        fs, _ = _open(self.path)
        for name in data_files(self.path):
            if name < start["file"] or end is not None and name > end["file"]:
                continue
            with fs.open_input_file(name) as source:
                size = source.size()
                if end is not None and name == end["file"]:
                    size = min(size, end["at"])
                at = start["at"] if name == start["file"] else 0
                if at == 0:
                    at, _ = line_end(source, 0, size, 1)  # the header
                while at < size and left > 0:
                    stop, n = line_end(source, at, size, int(min(left, SEGMENT)))
                    segments.append((name, at, stop))
                    at, left = stop, left - n
            reached = {"file": name, "at": at}
            if left <= 0:
                break
        return segments, reached


class LineReplaySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "line_replay"

    def schema(self) -> str:
        return "file string, start bigint, stop bigint"

    def simpleStreamReader(self, schema) -> LineReader:
        return LineReader(self.options["path"], int(self.options.get("lines_per_trigger", "1000")))


def segment_lines(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of segments ``(file, start, stop)`` as ``(file, at, value)``."""
    fs, _ = _open(path)
    for b in batches:
        for name, start, stop in zip(*(c.to_pylist() for c in b.columns), strict=True):
            with fs.open_input_file(name) as source:
                text = source.read_at(stop - start, start)
            lines = text[:-1].split(b"\n") if text.endswith(b"\n") else text.split(b"\n")
            places, at = [], start
            for line in lines:
                places.append(at)
                at += len(line) + 1
            values = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
            yield pa.record_batch([pa.array([name] * len(lines)), pa.array(places, pa.int64()), pa.array(values, pa.string())], ["file", "at", "value"])


def replay_stream(spark: SparkSession, path: str, lines_per_trigger: int = 1000) -> DataFrame:
    """Paced replay: a stream of ``(file, at, value)``, ``lines_per_trigger`` data lines a micro-batch (pair with a
    processing-time trigger), without the spaces around them; ``at`` is the line's byte in its file."""
    if lines_per_trigger < 1:
        raise ValueError("lines_per_trigger must be at least 1")
    spark.dataSource.register(LineReplaySource)
    segments = spark.readStream.format("line_replay").option("path", path).option("lines_per_trigger", lines_per_trigger).load()
    if lines_per_trigger > SEGMENT:  # more than one segment a trigger
        segments = segments.repartition(spark.sparkContext.defaultParallelism)
    lines = segments.mapInArrow(lambda batches: segment_lines(path, batches), "file string, at bigint, value string")
    return lines.withColumn("value", F.trim("value"))

"""Text logs followed while they grow (format ``tail``).

The position of a stream is a number of bytes for each file, always at the end of a line: what a
writer has put down of its last line stays there until the line is complete. A micro-batch
takes up to a number of bytes, and a task of it the lines that begin in its range, so that
neither a large log nor a large step has to be one task.
"""

from __future__ import annotations

import posixpath
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from framelake.sources.feed import Catalogue
from framelake.sources.recording import resolve

SCHEMA = "log string, path string, offset bigint, value string"
MAX_BYTES = 64 << 20
SPLIT_BYTES = 8 << 20
# Read at once when the end of a line is looked for.
LINE_BYTES = 1 << 16
BATCH_BYTES = 1 << 20


class Lines(InputPartition):
    """Ranges (path, first byte, end byte): the lines that begin there."""

    def __init__(self, ranges: list):
        super().__init__(ranges)
        self.ranges = ranges


def _line_end(src, at: int) -> int:
    """End of the last whole line before byte ``at``, or 0."""
    begin = at
    while begin > 0:
        lo = max(0, begin - BATCH_BYTES)
        found = src.read_at(begin - lo, lo).rfind(b"\n")
        if found >= 0:
            return lo + found + 1
        begin = lo
    return 0


class TailReader(DataSourceStreamReader):
    """Options: ``path``, ``catalogue`` (shared folder of this stream), ``max_bytes``,
    ``split_bytes``, ``folder`` (``key=`` of the folders that name a log; else a file is one)."""

    def __init__(self, options):
        self.path, self.folder = options["path"], options["catalogue"]
        self.limit = max(1, int(options.get("max_bytes", MAX_BYTES)))
        self.split = max(1, int(options.get("split_bytes", SPLIT_BYTES)))
        self.key = options.get("folder", "")
        self.at, self.catalogue = None, None

    def initialOffset(self) -> dict:
        return {}

    def _files(self) -> Catalogue:
        if self.catalogue is None:
            self.catalogue = Catalogue(self.folder)
        return self.catalogue

    def latestOffset(self) -> dict:
        system, root = resolve(self.path)
        files = self._files()
        info = system.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(
            fs.FileSelector(root, recursive=True, allow_not_found=True))
        sizes = {f.path: f.size for f in found if f.type == fs.FileType.File and not any(
            p.startswith(("_", ".")) for p in f.path[len(root):].split("/"))}
        files.add(sorted(p for p in sizes if p not in files.known))
        at, left = dict(self.at or {}), self.limit
        for i, path in enumerate(files.files):
            done = at.get(str(i), 0)
            if left <= 0:
                break
            if sizes.get(path, 0) <= done:
                continue
            end = min(sizes[path], done + left)
            with system.open_input_file(path) as src:
                stop = _line_end(src, end)
                while stop <= done and end < sizes[path]:
                    # The line is longer than the limit: go on to its end.
                    end = min(sizes[path], end + max(self.limit, BATCH_BYTES))
                    stop = _line_end(src, end)
            if stop > done:
                at[str(i)] = stop
                left -= stop - done
        return at

    def partitions(self, start: dict, end: dict):
        # Spark calls this with the last offset twice when it goes on from a checkpoint.
        self.at, files = end, self._files().files
        tasks, held, used = [], [], 0
        for i in sorted(end, key=int):
            for lo in range(start.get(i, 0), end[i], self.split):
                hi = min(end[i], lo + self.split)
                if held and used + hi - lo > self.split:
                    tasks.append(Lines(held))
                    held, used = [], 0
                held.append((files[int(i)], lo, hi))
                used += hi - lo
        return tasks + ([Lines(held)] if held else [])

    def read(self, partition):
        system, _ = resolve(self.path)
        for path, lo, hi in partition.ranges:
            log = path
            if self.key:
                log = next((unquote(p[len(self.key) + 1:]) for p in path.split("/") if p.startswith(f"{self.key}=")), None)
            with system.open_input_file(path) as src:
                yield from _lines(src, log, path, lo, hi)


def _lines(src, log, path, lo, hi):
    """Lines that begin in [lo, hi), as batches."""
    at = lo
    if lo > 0 and src.read_at(1, lo - 1) != b"\n":
        # The line this begins in belongs to the range before.
        at = _next_line(src, lo)
    while at < hi:
        # Whole lines of about a batch, the last one to its end.
        stop = _next_line(src, min(hi, at + BATCH_BYTES) - 1)
        if stop == at:
            return
        offsets, values, begin = [], [], at
        for line in src.read_at(stop - at, at).split(b"\n")[:-1]:
            offsets.append(begin)
            values.append(line.rstrip(b"\r").decode("utf-8", "replace"))
            begin += len(line) + 1
        yield _batch(log, path, offsets, values)
        at = stop


def _next_line(src, at: int) -> int:
    """First byte after the line that holds byte ``at``."""
    while True:
        chunk = src.read_at(LINE_BYTES, at)
        found = chunk.find(b"\n")
        if found >= 0:
            return at + found + 1
        if not chunk:
            return at
        at += len(chunk)


def _batch(log, path, offsets, values):
    n = len(offsets)
    return pa.RecordBatch.from_arrays(
        [pa.array([log] * n, pa.string()), pa.array([posixpath.basename(path)] * n, pa.string()),
         pa.array(offsets, pa.int64()), pa.array(values, pa.string())], ["log", "path", "offset", "value"])


class TailSource(DataSource):
    @classmethod
    def name(cls):
        return "tail"

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        return TailReader(dict(self.options))


def follow(spark: SparkSession, path: str, catalogue: str, max_bytes: int = MAX_BYTES, split_bytes: int = SPLIT_BYTES,
           folder: str = "") -> DataFrame:
    """Stream of the lines (log, path, offset, value) of all files below ``path``, as they are completed.

    Every file is a log, or with ``folder`` every folder ``<folder>=<name>`` is one, whose files
    follow each other by name: only the last of them may grow. Empty lines count as lines.
    """
    spark.dataSource.register(TailSource)
    return (spark.readStream.format("tail").option("path", path).option("catalogue", catalogue)
            .option("max_bytes", max_bytes).option("split_bytes", split_bytes).option("folder", folder).load())

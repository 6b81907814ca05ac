"""Landed Parquet packets as a stream that is admitted by bytes (format ``feed``).

The position of a feed is a file and a row in it. A micro-batch takes rows up to a number of
bytes, so one large file is spread over several, and a task of it reads part of a row group.
A feed that may grow takes in more with each micro-batch while more lies behind it, so that a
long backlog is a few large micro-batches and not very many small ones.
Files get their numbers when they are first seen, in a catalogue on shared storage; a restarted
feed finds them in the same order and goes on where the checkpoint of its query stands.
"""

from __future__ import annotations

import json
import posixpath
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from framelake.sources.recording import resolve

MAX_BYTES = 256 << 20
SPLIT_BYTES = 32 << 20
BATCH_ROWS = 8192
# How much more a micro-batch of a growing feed takes in than the one before, while it is behind.
GROWTH = 4
# Entries of the catalogue are merged into one file when there are this many.
MERGE_FILES = 64
OPEN_THREADS = 16
# A stream has come to rest when it was found idle so often.
QUIET = 4
POLL_SECONDS = 0.05


class Catalogue:
    """Files of a feed in the order in which they were first seen.

    A list file holds the numbers from its name on; of two lists that overlap, which an
    interrupted merge can leave, both say the same.
    """

    def __init__(self, folder: str):
        self.system, self.root = resolve(folder)
        self.system.create_dir(self.root, recursive=True)
        self.files, self.lists = [], 0
        found = self.system.get_file_info(fs.FileSelector(self.root))
        for info in sorted((f for f in found if f.base_name.endswith(".list")), key=lambda f: f.base_name):
            first = int(info.base_name.split("-")[0])
            with self.system.open_input_stream(info.path) as src:
                names = json.loads(src.read())
            self.files[first:] = names + self.files[first + len(names):]
            self.lists += 1
        self.known = set(self.files)

    def _write(self, first: int, names: list[str]) -> str:
        target = posixpath.join(self.root, f"{first:012d}-{len(names):012d}.list")
        staged = posixpath.join(self.root, f"_{uuid.uuid4().hex}")
        with self.system.open_output_stream(staged) as out:
            out.write(json.dumps(names).encode())
        self.system.move(staged, target)
        return target

    def add(self, names: list[str]) -> None:
        if not names:
            return
        self._write(len(self.files), names)
        self.files += names
        self.known.update(names)
        self.lists += 1
        if self.lists > MERGE_FILES:
            kept = self._write(0, self.files)
            for info in self.system.get_file_info(fs.FileSelector(self.root)):
                if info.base_name.endswith(".list") and posixpath.basename(kept) != info.base_name:
                    self.system.delete_file(info.path)
            self.lists = 1


class Rows(InputPartition):
    """Ranges (file, row group, first row, end row) for one task."""

    def __init__(self, ranges: list):
        super().__init__(ranges)
        self.ranges = ranges


class FeedReader(DataSourceStreamReader):
    """Options: ``path`` (folder or file), ``catalogue`` (shared folder of this feed),
    ``max_bytes`` (of a micro-batch, as stored without compression), ``most_bytes`` (what that may grow
    to while the feed is behind), ``split_bytes`` (of a task), ``order`` (``time`` or ``name``: how files
    found together follow each other)."""

    def __init__(self, options, schema: T.StructType):
        self.path = options["path"]
        self.folder = options["catalogue"]
        self.limit = max(1, int(options.get("max_bytes", MAX_BYTES)))
        self.most = max(self.limit, int(options.get("most_bytes", 0)))
        self.room = self.limit
        self.split = max(1, int(options.get("split_bytes", SPLIT_BYTES)))
        self.by_name = options.get("order") == "name"
        self.schema = schema
        self.at = None
        self.catalogue = None
        self.groups = {}

    # --- on the driver ---

    def initialOffset(self) -> dict:
        return {"file": 0, "row": 0}

    def _discover(self) -> None:
        if self.catalogue is None:
            self.catalogue = Catalogue(self.folder)
        system, root = resolve(self.path)
        info = system.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(
            fs.FileSelector(root, recursive=True, allow_not_found=True))
        fresh = [f for f in found if f.type == fs.FileType.File and f.size and f.path not in self.catalogue.known
                 and not any(p.startswith(("_", ".")) for p in f.path[len(root):].split("/"))]
        self.catalogue.add([f.path for f in sorted(
            fresh, key=lambda f: (0 if self.by_name else f.mtime_ns or 0, f.path))])

    def _groups(self, index: int) -> list[tuple[int, int]]:
        """Rows and bytes of the row groups of a file, from its footer."""
        if index not in self.groups:
            system, _ = resolve(self.path)
            with system.open_input_file(self.catalogue.files[index]) as src:
                found = pq.read_metadata(src)
            self.groups[index] = [(g.num_rows, g.total_byte_size) for g in map(found.row_group, range(found.num_row_groups))]
        return self.groups[index]

    def latestOffset(self) -> dict:
        """As far as one micro-batch may go from where the last planned one ended."""
        self._discover()
        at = self.at or self.initialOffset()
        file, row, left = at["file"], at["row"], self.room
        while left > 0 and file < len(self.catalogue.files):
            before = 0
            for rows, size in self._groups(file):
                if left > 0 and row < before + rows:
                    skip = max(0, row - before)
                    each = max(1.0, size / rows)
                    # At least one row, so that a row beyond the limit does not stop the stream.
                    take = min(rows - skip, max(1, int(left / each)))
                    row = before + skip + take
                    left = left - take * each if skip + take == rows else 0
                before += rows
            if row < before:
                break
            file, row = file + 1, 0
        return {"file": file, "row": row}

    def partitions(self, start: dict, end: dict):
        # Spark calls this with the last offset twice when it goes on from a checkpoint.
        if self.catalogue is None:
            self.catalogue = Catalogue(self.folder)
        if end != self.at:
            # Planned anew, the same micro-batch changes nothing.
            behind = end["file"] < len(self.catalogue.files)
            self.room = min(self.most, self.room * GROWTH) if behind else self.limit
        self.at = end
        self.groups = {i: g for i, g in self.groups.items() if i >= start["file"]}
        last = end["file"] + (end["row"] > 0)
        with ThreadPoolExecutor(OPEN_THREADS) as pool:
            list(pool.map(self._groups, range(start["file"], last)))
        tasks, held, used = [], [], 0
        for file in range(start["file"], last):
            lo = start["row"] if file == start["file"] else 0
            hi = end["row"] if file == end["file"] else None
            before = 0
            for group, (rows, size) in enumerate(self._groups(file)):
                a, b = max(0, lo - before), rows if hi is None else min(rows, hi - before)
                step = max(1, int(self.split / max(1.0, size / max(1, rows))))
                for c in range(a, b, step):
                    stop = min(b, c + step)
                    cost = (stop - c) * size / rows
                    if held and used + cost > self.split:
                        tasks.append(Rows(held))
                        held, used = [], 0
                    held.append((self.catalogue.files[file], group, c, stop))
                    used += cost
                before += rows
        return tasks + ([Rows(held)] if held else [])

    # --- in a task ---

    def read(self, partition):
        system, _ = resolve(self.path)
        wanted = to_arrow_schema(self.schema)
        for path, group, lo, hi in partition.ranges:
            with system.open_input_file(path) as src:
                stored = pq.ParquetFile(src)
                names = [n for n in wanted.names if n in stored.schema_arrow.names]
                at = 0
                for batch in stored.iter_batches(BATCH_ROWS, row_groups=[group], columns=names):
                    a, b = max(lo, at), min(hi, at + batch.num_rows)
                    if a < b:
                        yield _as(batch.slice(a - at, b - a), wanted)
                    at += batch.num_rows
                    if at >= hi:
                        break


def _as(batch: pa.RecordBatch, wanted: pa.Schema) -> pa.RecordBatch:
    """The wanted columns in their types; those a file lacks are null."""
    columns = []
    for field in wanted:
        at = batch.schema.get_field_index(field.name)
        columns.append(batch.column(at).cast(field.type) if at >= 0 else pa.nulls(batch.num_rows, field.type))
    return pa.RecordBatch.from_arrays(columns, schema=wanted)


class FeedSource(DataSource):
    @classmethod
    def name(cls):
        return "feed"

    def schema(self):
        raise ValueError("a feed is read with the schema of its files: readStream.schema(...)")

    def streamReader(self, schema):
        return FeedReader(dict(self.options), schema)


def follow(spark: SparkSession, path: str, schema: T.StructType, catalogue: str, max_bytes: int = MAX_BYTES,
           split_bytes: int = SPLIT_BYTES, order: str = "time", most_bytes: int = 0) -> DataFrame:
    """Stream over landed Parquet files, at most ``max_bytes`` a micro-batch: the poll limit and the
    back-pressure of the stream. With ``most_bytes`` that limit grows up to there while the stream is
    behind, and falls back when it has caught up. Only the columns of ``schema`` are read. ``catalogue`` is a
    shared folder that belongs to this query alone, as its checkpoint does. Files found together
    follow each other by their times, or with ``order="name"`` by their names."""
    spark.dataSource.register(FeedSource)
    return (spark.readStream.format("feed").schema(schema).option("path", path).option("catalogue", catalogue)
            .option("max_bytes", max_bytes).option("split_bytes", split_bytes)
            .option("most_bytes", most_bytes).option("order", order).load())


def drain(query: StreamingQuery) -> StreamingQuery:
    """Run a query until it has taken in everything that has landed, then end it.

    ``availableNow`` would take a single micro-batch of a feed, whatever lies behind it.
    """
    try:
        query.processAllAvailable()
        # A micro-batch without data may follow, which puts out what the watermark has passed.
        quiet = 0
        while query.isActive and quiet < QUIET:
            status = query.status
            quiet = 0 if status["isTriggerActive"] or status["isDataAvailable"] else quiet + 1
            time.sleep(POLL_SECONDS)
        query.processAllAvailable()
    finally:
        query.stop()
    return query

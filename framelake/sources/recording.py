"""Recording files as a Spark source and sink (format ``recording``).

A recording is a 4096-byte text header followed by blocks of fixed size; a block
is a run of fixed-size packets and, where batches do not divide it, padding.

Reading splits files into ranges of whole blocks. Writing streams packet rows, in
order, from one task per file into a staging folder; the commit moves finished
files into place. No block is ever held in memory.
"""

from __future__ import annotations

import datetime
import posixpath
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan,
    GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage)

from framelake.functions import header, timestamps
from framelake.functions.header import HEADER_BYTES
from framelake.functions.layout import Layout
from framelake.session import durable, settings

SUFFIX = ".rec"
STAGING = "_staging"
# Parts of recordings that are still being written by a stream.
LIVE = "_live"
# Times of the blocks of recordings that were written with them.
INDEX = "_index"
SPLIT_BYTES = 128 << 20
# Recording bytes written by one task, at least one file.
TASK_BYTES = 1 << 30
COMMIT_THREADS = 16
# What opening a file counts for when small files are read together.
OPEN_BYTES = 1 << 20
# Rows per Arrow batch are chosen so that a batch stays around this size.
BATCH_BYTES = 8 << 20
# What a packet row takes beside its payload: names, numbers and offsets.
ROW_BYTES = 64

READ_SCHEMAS = {
    "packet": "file string, block_index bigint, packet_index bigint, payload binary",
    "block": "file string, block_index bigint, payload binary",
    "header": "file string, file_bytes bigint, n_blocks bigint, header_text string",
}


def resolve(path: str):
    """File system and path. Local paths and URIs (hdfs, s3, gs) alike."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def drop_folder(path: str) -> None:
    system, root = resolve(path)
    if system.get_file_info(root).type == fs.FileType.Directory:
        system.delete_dir(root)


def _list(path: str):
    """Recordings under a folder, or the one file given. Lists instead of globbing:
    file names may contain colons."""
    system, root = resolve(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return system, [info]
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    return system, sorted(
        (f for f in found if f.type == fs.FileType.File and f"/{STAGING}" not in f.path
         and f"/{LIVE}/" not in f.path and f"/{INDEX}/" not in f.path and not f.base_name.startswith((".", "_"))),
        key=lambda f: f.path)


@dataclass
class FileRange:
    """Blocks ``first`` up to ``last`` of one file."""

    path: str
    size: int
    first: int
    last: int
    times: list | None = None


class Split(InputPartition):
    """Ranges read by one task: part of a large file, or several small files."""

    def __init__(self, ranges: list):
        super().__init__(ranges)
        self.ranges = ranges


def _pack(ranges, weight, limit):
    """Fill splits up to ``limit`` bytes, counting an opening cost per range."""
    splits, current, used = [], [], 0
    for item in ranges:
        cost = weight(item) + OPEN_BYTES
        if current and used + cost > limit:
            splits.append(Split(current))
            current, used = [], 0
        current.append(item)
        used += cost
    return splits + ([Split(current)] if current else [])


INDEX_SCHEMA = pa.schema([("file", pa.string()), ("block_index", pa.int64()), ("first_us", pa.int64()),
                          ("last_us", pa.int64()), ("written_us", pa.int64())])


def block_times(path: str, lo: int | None = None, hi: int | None = None) -> dict[str, dict[int, tuple[int, int]]]:
    """First and last packet time (microseconds) of the blocks of every recording that has them, of
    blocks with a packet from ``lo`` on and before ``hi`` only. A file written again counts
    as it was written last."""
    system, root = resolve(path)
    folder = posixpath.join(root, INDEX)
    if system.get_file_info(folder).type != fs.FileType.Directory:
        return {}
    rows = pq.read_table(folder, filesystem=system, schema=INDEX_SCHEMA)
    newest = rows.group_by("file").aggregate([("written_us", "max")])
    at = dict(zip(newest["file"].to_pylist(), newest["written_us_max"].to_pylist()))
    out = {name: {} for name in at}
    keep = pa.array(np.ones(len(rows), bool))
    if lo is not None:
        keep = pc.and_(keep, pc.greater_equal(rows["last_us"], lo))
    if hi is not None:
        keep = pc.and_(keep, pc.less(rows["first_us"], hi))
    for batch in rows.filter(keep).to_batches():
        for name, block, first, last, written in zip(*(c.to_pylist() for c in batch.columns)):
            if written == at[name]:
                out[name][block] = (first, last)
    return out


class RecordingReader(DataSourceReader):
    """Options: ``path``; ``record`` (packet, block or header); ``block_bytes``,
    ``pkt_size``, ``pkts_per_block`` (packets stored per block, padding excluded);
    ``blocks`` as "a-b" to read only that range of every file; ``split_bytes`` and
    ``parallelism`` to size the tasks; ``times`` to add the times of the first and the last
    packet of the block; ``between`` as "lo:hi" (microseconds, either may be missing) to read
    only blocks that can hold a packet of that time. Blocks without known times are read."""

    def __init__(self, options):
        self.path = options["path"]
        self.record = options.get("record", "packet")
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.parallelism = int(options.get("parallelism", 1))
        self.times = options.get("times") == "true"
        since, _, until = options.get("between", "").partition(":")
        self.since, self.until = int(since) if since else None, int(until) if until else None
        if self.record == "header":
            self.block_bytes = int(options.get("block_bytes", 0))
            return
        self.block_bytes = int(options["block_bytes"])
        self.pkt_size = int(options.get("pkt_size", self.block_bytes))
        self.per_block = int(options.get("pkts_per_block", self.block_bytes // self.pkt_size))
        lo, _, hi = options.get("blocks", "").partition("-")
        self.lo = int(lo) if lo else 0
        self.hi = int(hi) + 1 if hi else (self.lo + 1 if lo else None)

    def partitions(self):
        _, found = _list(self.path)
        total = sum(f.size + OPEN_BYTES for f in found)
        limit = min(self.split, max(OPEN_BYTES, total // self.parallelism))
        if self.record == "header":
            return _pack([FileRange(f.path, f.size, 0, 0) for f in found], lambda r: 0, limit)
        step = max(1, limit // self.block_bytes)
        timed = self.times or self.since is not None or self.until is not None
        known = block_times(self.path, self.since, self.until) if timed else {}
        ranges = []
        for f in found:
            n = max(0, f.size - HEADER_BYTES) // self.block_bytes
            stop = n if self.hi is None else min(n, self.hi)
            times = known.get(posixpath.basename(f.path))
            for b, end in [(self.lo, stop)] if times is None else _consecutive(times, self.lo, stop):
                ranges += [FileRange(f.path, f.size, c, min(c + step, end), None if times is None else [
                    times[i] for i in range(c, min(c + step, end))]) for c in range(b, end, step)]
        return _pack(ranges, lambda r: (r.last - r.first) * self.block_bytes, limit)

    def read(self, partition):
        for item in getattr(partition, "ranges", ()):
            for batch in self._read_range(item):
                yield self._with_times(batch, item) if self.times else batch

    def _with_times(self, batch, item):
        blocks = batch.column("block_index").to_numpy() - item.first
        for i, name in enumerate(("first_ts", "last_ts")):
            values = None if item.times is None else np.array([t[i] for t in item.times])[blocks]
            column = pa.nulls(len(blocks), pa.int64()) if values is None else pa.array(values, pa.int64())
            batch = batch.append_column(name, column.cast(pa.timestamp("us", "UTC")))
        return batch

    def _read_range(self, partition):
        system, _ = resolve(self.path)
        name = posixpath.basename(partition.path)
        with system.open_input_file(partition.path) as src:
            if self.record == "header":
                text = src.read_at(HEADER_BYTES, 0).rstrip(b"\x00").decode("utf-8", "replace")
                body = max(0, partition.size - HEADER_BYTES)
                n = body // self.block_bytes if self.block_bytes else None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([partition.size], pa.int64()),
                     pa.array([n], pa.int64()), pa.array([text])],
                    names=["file", "file_bytes", "n_blocks", "header_text"])
                return
            # Whole blocks are read together while they are small; a large block is
            # read in pieces.
            step = max(1, BATCH_BYTES // self.block_bytes if self.record == "block"
                       else batch_rows(self.pkt_size) // self.per_block)
            for first in range(partition.first, partition.last, step):
                n = min(step, partition.last - first)
                if self.record == "block":
                    yield self._blocks(src, name, first, n)
                elif self.block_bytes <= BATCH_BYTES:
                    raw = self._read(src, n * self.block_bytes, first, 0)
                    used = self.per_block * self.pkt_size
                    body = np.frombuffer(raw, dtype=np.uint8).reshape(n, -1)[:, :used]
                    yield self._packets(
                        name, np.repeat(np.arange(first, first + n), self.per_block),
                        np.tile(np.arange(self.per_block), n), np.ascontiguousarray(body))
                else:
                    rows = batch_rows(self.pkt_size)
                    for at in range(0, self.per_block, rows):
                        k = min(rows, self.per_block - at)
                        raw = self._read(src, k * self.pkt_size, first, at * self.pkt_size)
                        yield self._packets(
                            name, np.full(k, first), np.arange(at, at + k), raw)

    def _read(self, src, size, block, offset):
        raw = src.read_at(size, HEADER_BYTES + block * self.block_bytes + offset)
        if len(raw) != size:
            raise EOFError(f"block {block} ends after {offset + len(raw)} bytes")
        return raw

    def _blocks(self, src, name, first, n):
        raw = [self._read(src, self.block_bytes, b, 0) for b in range(first, first + n)]
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * n), pa.array(np.arange(first, first + n), pa.int64()),
             pa.array(raw, pa.binary())],
            names=["file", "block_index", "payload"])

    def _packets(self, name, blocks, index, raw):
        """Packets as slices of one buffer."""
        fixed = pa.Array.from_buffers(
            pa.binary(self.pkt_size), len(index), [None, pa.py_buffer(raw)])
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(index)), pa.array(blocks, pa.int64()),
             pa.array(index, pa.int64()), fixed.cast(pa.binary())],
            names=["file", "block_index", "packet_index", "payload"])


def _consecutive(blocks, lo: int, hi: int):
    """Runs [first, end) of consecutive block numbers within [lo, hi)."""
    wanted = np.array(sorted(b for b in blocks if lo <= b < hi), np.int64)
    cuts = np.flatnonzero(np.diff(wanted) > 1) + 1
    return [(int(run[0]), int(run[-1]) + 1) for run in np.split(wanted, cuts) if len(run)]


@dataclass
class Written(WriterCommitMessage):
    moves: list


def _micros(value: datetime.datetime) -> int:
    aware = value if value.tzinfo else value.replace(tzinfo=datetime.timezone.utc)
    return (aware - datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)) // datetime.timedelta(microseconds=1)


class PushdownReader(RecordingReader):
    """Drops files and blocks that filters on ``file`` and ``block_index`` exclude.

    Every filter is handed back, so that Spark still checks each row; only the ranges
    to read get narrower.
    """

    def __init__(self, options):
        super().__init__(options)
        self.names = None

    def pushFilters(self, filters):
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("file",) and isinstance(f, (EqualTo, In)):
                names = {value} if isinstance(f, EqualTo) else set(value)
                self.names = names if self.names is None else self.names & names
            elif column == ("last_ts",) and self.times and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.since = max(_micros(value), self.since if self.since is not None else _micros(value))
            elif column == ("first_ts",) and self.times and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                until = _micros(value) + (not isinstance(f, LessThan))
                self.until = until if self.until is None else min(until, self.until)
            elif column == ("block_index",) and self.record != "header":
                if isinstance(f, (EqualTo, GreaterThanOrEqual, GreaterThan)):
                    self.lo = max(self.lo, value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThanOrEqual, LessThan)):
                    stop = value + (not isinstance(f, LessThan))
                    self.hi = stop if self.hi is None else min(self.hi, stop)
            yield f

    def partitions(self):
        if self.names is None:
            return super().partitions()
        kept = []
        for split in super().partitions():
            ranges = [r for r in split.ranges if posixpath.basename(r.path) in self.names]
            kept += [Split(ranges)] if ranges else []
        return kept


def batch_rows(pkt_size: int) -> int:
    """Packets of an Arrow batch: short ones take more beside their payload than in it."""
    return max(1, BATCH_BYTES // (pkt_size + ROW_BYTES))


def _runs(files, blocks):
    """Ranges of consecutive rows with the same file and block."""
    if len(blocks) == 0:
        return []
    codes = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    ids = blocks.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (ids[1:] != ids[:-1])) + 1
    edges = [0, *cuts.tolist(), len(ids)]
    return zip(edges[:-1], edges[1:])


def _bytes_of(payloads):
    """The values of a binary array back to back: one slice of its data buffer."""
    if payloads.null_count:
        raise ValueError("a packet without payload cannot be recorded")
    wide = pa.types.is_large_binary(payloads.type)
    _, offsets, data = payloads.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    lo, hi = int(ends[payloads.offset]), int(ends[payloads.offset + len(payloads)])
    return data.slice(lo, hi - lo) if data is not None else pa.py_buffer(b"")


def _merged_times(stats) -> pa.Table:
    """One row a block, from pieces of it."""
    names = ["file", "block_index", "first_us", "last_us"]
    table = pa.table({n: [row[i] for row in stats] for i, n in enumerate(names)}).group_by(names[:2]).aggregate(
        [("first_us", "min"), ("last_us", "max")]).rename_columns(names)
    written = pa.array([time.time_ns() // 1000] * len(table), pa.int64())
    return table.append_column("written_us", written).cast(INDEX_SCHEMA)


class RecordingWriter(DataSourceArrowWriter):
    """Rows arrive sorted by (file, block_id, ordinal). Block -1 is the header.

    Each block is padded to ``block_bytes``. Staged names are unique per task
    attempt, so retries and speculative copies never meet.
    """

    def __init__(self, options, overwrite: bool):
        self.path = options["path"]
        self.block_bytes = int(options["block_bytes"])
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex
        self.replace = options.get("replace") == "true"

    def _staging(self, root):
        return posixpath.join(root, f"{STAGING}-{self.job}")

    def write(self, iterator):
        system, root = resolve(self.path)
        folder = posixpath.join(self._staging(root), uuid.uuid4().hex)
        system.create_dir(folder, recursive=True)
        moves, state = [], {"file": None, "out": None, "block": None, "used": 0, "index": -1}
        stats = []

        def finish_block():
            if state["block"] is None:
                return
            want = HEADER_BYTES if state["block"] < 0 else self.block_bytes
            if state["used"] > want:
                raise ValueError(f"block {state['block']} of {state['file']} holds "
                                 f"{state['used']} bytes, more than {want}")
            left = want - state["used"]
            while left:
                chunk = min(left, BATCH_BYTES)
                state["out"].write(bytes(chunk))
                left -= chunk
            state.update(block=None, used=0)

        def finish_file():
            finish_block()
            if state["out"] is not None:
                state["out"].close()
            state.update(out=None, file=None)

        try:
            for batch in iterator:
                files, blocks, payloads = (
                    batch.column(batch.schema.get_field_index(c))
                    for c in ("file", "block_id", "payload"))
                for start, stop in _runs(files, blocks):
                    file, block = files[start].as_py(), blocks[start].as_py()
                    if file != state["file"]:
                        finish_file()
                        if block != -1:
                            raise ValueError(f"{file} does not begin with a header")
                        staged = posixpath.join(folder, file + SUFFIX)
                        state.update(file=file, out=system.open_output_stream(staged), index=-1)
                        moves.append((staged, posixpath.join(root, file + SUFFIX)))
                    if block != state["block"]:
                        finish_block()
                        state["block"] = block
                        state["index"] += block >= 0
                    data = _bytes_of(payloads.slice(start, stop - start))
                    state["out"].write(data)
                    state["used"] += data.size
                    if block >= 0 and "at" in batch.schema.names:
                        span = pc.min_max(batch.column("at").slice(start, stop - start)).as_py()
                        if span["min"] is not None:
                            stats.append((file + SUFFIX, state["index"], span["min"], span["max"]))
            finish_file()
        except BaseException:
            if state["out"] is not None:
                state["out"].close()
            raise
        if stats:
            staged = posixpath.join(folder, "_times")
            pq.write_table(_merged_times(stats), staged, filesystem=system)
            moves.append((staged, posixpath.join(root, INDEX, f"{uuid.uuid4().hex}.parquet")))
        return Written(moves)

    def commit(self, messages):
        system, root = resolve(self.path)
        moves = [move for m in messages if m is not None for move in m.moves]
        targets = {target for _, target in moves}
        if len(targets) != len(moves):
            raise ValueError("one recording was written by two tasks; use recording.write")
        if not self.overwrite and not self.replace:
            found = {f.path for f in _list(self.path)[1]} & targets
            if found:
                raise FileExistsError(f"{len(found)} recordings exist already, {min(found)} among them")

        if any(posixpath.dirname(target) != root.rstrip("/") for target in targets):
            system.create_dir(posixpath.join(root, INDEX), recursive=True)

        def place(move):
            staged, target = move
            if system.get_file_info(target).type == fs.FileType.File:
                # The earlier file stays under another name until the new one is in place.
                earlier = posixpath.join(posixpath.dirname(staged), uuid.uuid4().hex)
                system.move(target, earlier)
            system.move(staged, target)

        # Renames wait on the storage, not on the driver.
        with ThreadPoolExecutor(COMMIT_THREADS) as pool:
            list(pool.map(place, moves))
        if self.overwrite:
            earlier = system.get_file_info(fs.FileSelector(posixpath.join(root, INDEX), allow_not_found=True))
            for f in [*_list(self.path)[1], *earlier]:
                if f.path not in targets:
                    system.delete_file(f.path)
        self._drop_staging(system, root)

    def abort(self, messages):
        system, root = resolve(self.path)
        self._drop_staging(system, root)

    def _drop_staging(self, system, root):
        if system.get_file_info(self._staging(root)).type == fs.FileType.Directory:
            system.delete_dir(self._staging(root))


class RecordingSource(DataSource):
    @classmethod
    def name(cls):
        return "recording"

    def schema(self):
        found = READ_SCHEMAS[self.options.get("record", "packet")]
        return found + ", first_ts timestamp, last_ts timestamp" if self.options.get("times") == "true" else found

    def reader(self, schema):
        # Spark refuses a reader with pushFilters unless its setting is on.
        pushing = self.options.get("push_filters") == "true"
        return (PushdownReader if pushing else RecordingReader)(dict(self.options))

    def writer(self, schema, overwrite):
        return RecordingWriter(dict(self.options), overwrite)

    def streamWriter(self, schema, overwrite):
        from framelake.streaming.sink import LiveWriter

        return LiveWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordingSource)


# Stands for a null stream id in file names; no encoded id looks like it.
NULL_STREAM = "~"


def file_name(stream_id, first_ts, file_id):
    """``yyyy-MM-dd-HHmmss_<stream>_<file>``: no colons or slashes, unique per stream and file.
    The stream id is URL-encoded."""
    return F.concat_ws("_", F.date_format(first_ts, "yyyy-MM-dd-HHmmss"),
                       F.coalesce(F.url_encode(stream_id), F.lit(NULL_STREAM)),
                       F.lpad(file_id.cast("string"), 8, "0"))


def stream_of(file):
    """The stream id in a file name made by :func:`file_name`."""
    encoded = F.regexp_extract(file, r"^[^_]*_(.*)_[0-9]+(?:\.rec)?$", 1)
    return F.when(encoded != NULL_STREAM, F.url_decode(encoded))


def file_number(file):
    return F.regexp_extract(file, r"_([0-9]+)(?:\.rec)?$", 1).cast("bigint")


def headers_for(files: DataFrame, fields: dict, layout: Layout) -> DataFrame:
    """Header bytes per file, from (file, first_ts) and the fixed header fields by
    lower-case name. Start stamps come from the first packet of the file."""
    typed = files.select(
        "file", *[F.lit(v).alias(k) for k, v in fields.items()],
        F.lit(layout.file_bytes).cast("bigint").alias("file_size"),
        timestamps.mjd(F.col("first_ts")).alias("mjd_start"),
        timestamps.utc_stamp(F.col("first_ts")).alias("utc_start"))
    text = typed.select("file", header.render(with_version=True).alias("text"))
    return text.select("file", header.pad(F.col("text")).alias("header"))


def slot_order(block_id, nbufs: int):
    """Sort key for dumping by buffer slot instead of by time."""
    return F.pmod(block_id, F.lit(nbufs))


def write(packets: DataFrame, headers: DataFrame, path: str, layout: Layout,
          mode: str = "append", order_by: str = "block", replace: bool = False) -> None:
    """Write recordings. Appending to a folder that has one of the same name is an error,
    unless ``replace`` allows it.

    ``packets``: file, block_id, ordinal (position in the block), payload; with ``arrival_ts``
    the times of every block are kept beside the recordings.
    ``headers``: file, header (binary, at most 4096 bytes); one row per file.
    A file is at most ``blocks_per_file`` blocks, so hashing by file gives tasks of
    bounded size whatever the share of one stream; payloads move once.
    ``order_by="slot"`` lays blocks out by buffer slot rather than in write order.
    """
    register(packets.sparkSession)
    rows = packets.select(
        "file", F.col("block_id").cast("bigint").alias("block_id"),
        F.col("ordinal").cast("bigint").alias("ordinal"), "payload",
        *([F.unix_micros(F.col("arrival_ts").cast("timestamp")).alias("at")] if "arrival_ts" in packets.columns else []))
    heads = headers.select(
        "file", F.lit(-1).cast("bigint").alias("block_id"),
        F.lit(0).cast("bigint").alias("ordinal"), F.col("header").alias("payload"))
    slot = (F.when(F.col("block_id") < 0, F.lit(-1))
            .otherwise(slot_order(F.col("block_id"), layout.nbufs)))
    order = ["file", slot, "block_id", "ordinal"] if order_by == "slot" else [
        "file", "block_id", "ordinal"]
    heads = durable(heads)
    spread = packets.sparkSession.conf.get("spark.sql.shuffle.partitions")
    parts = -(-heads.count() * layout.file_bytes // TASK_BYTES)
    both = rows.unionByName(heads, allowMissingColumns=True)
    moved = both.repartition(parts, "file") if parts > int(spread) else both.repartition("file")
    with settings(packets.sparkSession, {
            "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch_rows(layout.pkt_size))}):
        (moved.sortWithinPartitions(*order)
         .write.format("recording").mode(mode)
         .option("path", path).option("block_bytes", layout.block_bytes)
         .option("replace", str(replace).lower()).save())


def read(spark: SparkSession, path: str, layout: Layout, record: str = "packet",
         direct: bool = False, blocks: str | None = None,
         split_bytes: int = SPLIT_BYTES, times: bool = False,
         between: tuple[datetime.datetime | None, datetime.datetime | None] | None = None) -> DataFrame:
    """Packets, blocks or headers of all recordings under ``path``.

    Filters on ``file`` and ``block_index`` limit what is read when the session has
    ``spark.sql.python.filterPushdown.enabled`` on; ``blocks`` does so always. So do ``between``, a
    time from which on and one before which a block must have a packet (blocks whose times were
    not written are read), and filters on ``first_ts`` and ``last_ts``, the columns of ``times``.
    """
    register(spark)
    pushing = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    stored = layout.send_n * (1 if direct else layout.batches_per_block)
    reader = (spark.read.format("recording").option("path", path).option("record", record)
              .option("block_bytes", layout.block_bytes).option("pkt_size", layout.pkt_size)
              .option("pkts_per_block", stored).option("split_bytes", split_bytes)
              .option("parallelism", spark.sparkContext.defaultParallelism)
              .option("push_filters", pushing))
    if times and record != "header":
        reader = reader.option("times", "true")
    if between is not None:
        reader = reader.option("between", ":".join("" if t is None else str(_micros(t)) for t in between))
    return (reader.option("blocks", blocks) if blocks else reader).load()

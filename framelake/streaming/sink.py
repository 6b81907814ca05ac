"""Streaming sink of the format ``recording``: packets land as parts, epoch by epoch, and whole
files of them are sealed into recordings.

``df.writeStream.format("recording")`` takes rows (file, block_id, ordinal, arrival_ts, payload), in
any order and from any number of epochs and tasks. Each task writes one part; the commit of an epoch
writes its manifest, under the number of the epoch. What no manifest names was never
written: parts of lost or killed tasks and of epochs that were run twice. A file none of
whose packets is missing becomes a recording by ``seal``, a batch job over the parts.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from framelake.functions.layout import Layout
from framelake.operators import assemble
from framelake.operators.joins import attach
from framelake.session import durable
from framelake.sources import recording
from framelake.sources.recording import LIVE, resolve

PART = "file string, block_id bigint, ordinal bigint, arrival_ts timestamp, payload binary"
MANIFEST = "epoch bigint, part string, file string, packets bigint, first_us bigint"
# Packets sorted in memory at once; a part is a run of such pieces.
SORT_BYTES = 64 << 20


@dataclass
class Part(WriterCommitMessage):
    path: str
    files: list


def _paths(root: str):
    return posixpath.join(root, LIVE, "parts"), posixpath.join(root, LIVE, "epochs"), posixpath.join(root, LIVE, "sealed")


class LiveWriter(DataSourceStreamArrowWriter):
    """Part names are unique for each attempt, so retries and speculative copies never meet."""

    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        system, root = resolve(self.path)
        folder = _paths(root)[0]
        path = posixpath.join(folder, f"{uuid.uuid4().hex}.parquet")
        counts, out, held, size = {}, None, [], 0

        def flush():
            nonlocal out, held, size
            table = pa.Table.from_batches(held).sort_by([("file", "ascending"), ("block_id", "ascending"),
                                                         ("ordinal", "ascending")])
            if out is None:
                system.create_dir(folder, recursive=True)
                out = pq.ParquetWriter(path, table.schema, filesystem=system, compression="zstd")
            out.write_table(table)
            held, size = [], 0

        try:
            for batch in iterator:
                if batch.column("payload").null_count or batch.column("file").null_count:
                    raise ValueError("a packet without a file or a payload cannot be recorded")
                by_file = pa.table({"file": batch.column("file"), "us": batch.column("arrival_ts").cast(pa.int64())})
                for row in by_file.group_by("file").aggregate([("us", "min"), ("us", "count"), ([], "count_all")]).to_pylist():
                    n, us = counts.get(row["file"], (0, None))
                    least = min((u for u in (us, row["us_min"]) if u is not None), default=None)
                    counts[row["file"]] = (n + row["count_all"], least)
                held.append(batch)
                size += batch.nbytes
                if size > SORT_BYTES:
                    flush()
            if held:
                flush()
        finally:
            if out is not None:
                out.close()
        return Part(path if counts else "", [(f, n, us) for f, (n, us) in counts.items()])

    def commit(self, messages, batchId):
        system, root = resolve(self.path)
        _, epochs, _ = _paths(root)
        system.create_dir(epochs, recursive=True)
        target = posixpath.join(epochs, f"{batchId:012d}.json")
        if system.get_file_info(target).type == fs.FileType.File:
            # The epoch was committed before the stream was interrupted: its rows are there.
            self._drop(system, messages)
            return
        staged = posixpath.join(epochs, f"_{uuid.uuid4().hex}")
        lines = [json.dumps({"epoch": batchId, "part": posixpath.basename(m.path), "file": f, "packets": n, "first_us": us})
                 for m in messages if m is not None for f, n, us in m.files]
        with system.open_output_stream(staged) as out:
            out.write("\n".join(lines).encode())
        system.move(staged, target)

    def abort(self, messages, batchId):
        self._drop(resolve(self.path)[0], messages)

    def _drop(self, system, messages):
        for m in messages:
            if m is not None and m.path and system.get_file_info(m.path).type == fs.FileType.File:
                system.delete_file(m.path)


def place(packets: DataFrame, layout: Layout, position: str = "seq") -> DataFrame:
    """Packets (stream_id, arrival_ts, payload) whose ``position`` counts those of their stream, with
    the file, block and place they belong to: arithmetic alone, without state or shuffle."""
    per_block = layout.send_n * layout.batches_per_block
    pos = F.col(position)
    block = assemble.div(pos, per_block)
    number = F.lpad(assemble.div(block, layout.blocks_per_file).cast("string"), 8, "0")
    stream = F.coalesce(F.url_encode("stream_id"), F.lit(recording.NULL_STREAM))
    return packets.select(
        F.concat_ws("_", stream, number).alias("file"), F.pmod(block, F.lit(layout.blocks_per_file)).alias("block_id"),
        F.pmod(pos, F.lit(per_block)).alias("ordinal"), F.col("arrival_ts").cast("timestamp").alias("arrival_ts"), "payload")


def start(placed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Record a stream of placed packets below ``path``."""
    recording.register(placed.sparkSession)
    return (placed.writeStream.format("recording").option("path", path)
            .option("checkpointLocation", checkpoint).start())


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """What was committed: packets and least arrival time for each part and file."""
    system, root = resolve(path)
    epochs = _paths(root)[1]
    if system.get_file_info(epochs).type != fs.FileType.Directory:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(posixpath.join(path, LIVE, "epochs")).filter("file IS NOT NULL")


def _sealed(spark: SparkSession, path: str) -> DataFrame:
    system, root = resolve(path)
    if system.get_file_info(_paths(root)[2]).type != fs.FileType.Directory:
        return spark.createDataFrame([], "file string")
    return spark.read.schema("file string").parquet(posixpath.join(path, LIVE, "sealed"))


def seal(spark: SparkSession, path: str, layout: Layout, header_fields: dict, last: bool = False) -> DataFrame:
    """Turn files all of whose packets are there into recordings, named after their first packet
    as ``recording.file_name`` does, and return their names (``file``, ``recording``).

    ``last`` says that the stream has ended: files then close with their last whole block. A
    seal that was interrupted writes the same recordings again. Parts that hold only sealed
    files are removed. One seal at a time; the stream may go on meanwhile.
    """
    per_block = layout.send_n * layout.batches_per_block
    committed = durable(manifest(spark, path))
    counts = committed.groupBy("file").agg(F.sum("packets").alias("packets"), F.min("first_us").alias("first_us"))
    enough = F.col("packets") >= (per_block if last else per_block * layout.blocks_per_file)
    candidates = durable(attach(counts, _sealed(spark, path), ["file"], "left_anti").filter(enough))
    parts = attach(committed.select("part", "file"), candidates.select("file"), ["file"], "left_semi").select("part").distinct()
    folder = posixpath.join(path, LIVE, "parts")
    # Names of parts, far fewer than packets: a part holds what one task of an epoch took in.
    names = [f"{folder}/{row['part']}" for row in parts.toLocalIterator()]
    first = F.timestamp_micros("first_us")
    named = candidates.select("file", first.alias("first_ts"), F.concat_ws(
        "_", F.date_format(first, "yyyy-MM-dd-HHmmss"), "file").alias("recording"))
    if not names:
        return named.select("file", "recording").limit(0)
    rows = spark.read.schema(PART).parquet(*names)
    blocks = durable(attach(rows.select("file", "block_id"), candidates.select("file"), ["file"], "left_semi")
                     .groupBy("file", "block_id").agg(F.count(F.lit(1)).alias("n")))
    twice = blocks.filter(F.col("n") > per_block).first()
    if twice is not None:
        raise ValueError(f"block {twice['block_id']} of {twice['file']} has more than {per_block} packets")
    # Whole blocks from the first on; at most blocks_per_file rows a file.
    in_order = Window.partitionBy("file").orderBy("block_id")
    whole = (blocks.filter(F.col("n") == per_block).withColumn("i", F.row_number().over(in_order) - 1)
             .filter("i = block_id").groupBy("file").agg(F.count(F.lit(1)).alias("n_blocks")))
    if not last:
        whole = whole.filter(F.col("n_blocks") == layout.blocks_per_file)
    ready = durable(attach(named, whole, ["file"], "inner"))
    body = attach(rows, ready.select("file", "recording", "n_blocks"), ["file"], "inner",
                  spread_by=["block_id", "ordinal"]).filter(F.col("block_id") < F.col("n_blocks")).select(
        F.col("recording").alias("file"), "block_id", "ordinal", "payload")
    heads = recording.headers_for(ready.select(F.col("recording").alias("file"), "first_ts"), header_fields, layout)
    recording.write(body, heads, path, layout, replace=True)
    ready.select("file").write.mode("append").parquet(posixpath.join(path, LIVE, "sealed"))
    _sweep(spark, path, committed)
    return ready.select("file", "recording")


def _sweep(spark: SparkSession, path: str, committed: DataFrame) -> None:
    """Remove parts of which every file is sealed."""
    open_ = attach(committed, _sealed(spark, path), ["file"], "left_anti").select("part").distinct()
    over = attach(committed.select("part").distinct(), open_, ["part"], "left_anti")
    system, root = resolve(path)
    for row in over.toLocalIterator():
        name = posixpath.join(_paths(root)[0], row["part"])
        if system.get_file_info(name).type == fs.FileType.File:
            system.delete_file(name)

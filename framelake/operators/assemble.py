"""Packets to batches, blocks and files, by arithmetic on arrival positions.

Payloads never take part: counts, ids and lengths are enough until a recording
is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.layout import Layout
from framelake.operators import ordered
from framelake.operators.joins import attach
from framelake.session import durable


def div(value: Column, by: int) -> Column:
    """Integer division of a BIGINT column."""
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def position(packets: DataFrame, stream: str = "stream_id", ts: str = "arrival_ts",
             seq: str = "seq") -> DataFrame:
    """Dense arrival position per stream.

    ``seq`` breaks ties between equal arrival times; without it the order, and
    everything built on it, would be undefined.
    """
    if seq not in packets.columns:
        raise ValueError(f"arrival order needs a tie-breaking column, {seq!r} is missing")
    return ordered.positions(packets, [stream], [ts, seq])


def position_dense(packets: DataFrame, stream: str = "stream_id", seq: str = "seq",
                   check: bool = True) -> DataFrame:
    """Position where ``seq`` already counts the packets of each stream without gaps, from
    whatever number it begins at: arithmetic alone, no sort.

    Density is verified by one aggregation (least, greatest and number of ``seq``); a stream
    with gaps or repetitions stops the job instead of shifting all later batches. A table
    known to be dense can skip that.
    """
    spans = packets.groupBy(stream).agg(
        F.min(seq).alias("_lo"), F.max(seq).alias("_hi"), F.count(F.lit(1)).alias("_n"),
        F.count(seq).alias("_known"))
    if check:
        spans = durable(spans)
        # A repetition needs a gap to keep the number right, and then ids are not distinct.
        broken = spans.filter("_n <> _known OR _hi - _lo + 1 <> _n").first()
        if broken is not None:
            raise ValueError(f"{seq} of stream {broken[stream]!r} has gaps or repetitions")
    placed = attach(packets, spans.select(stream, "_lo"), [stream], "left", spread_by=[seq], null_safe=True)
    return placed.withColumn("pos", F.col(seq) - F.col("_lo")).drop("_lo")


def batches(positioned: DataFrame, layout: Layout, keep_tail: bool = False) -> DataFrame:
    """One row per batch of ``send_n`` packets. The incomplete tail of a stream is
    left out, or kept with ``is_complete`` false on request."""
    n = layout.send_n
    grouped = (positioned
               .groupBy("stream_id", div(F.col("pos"), n).alias("batch_id"))
               .agg(F.count(F.lit(1)).alias("n_packets"),
                    F.min_by("seq", "pos").alias("first_seq"),
                    F.max_by("seq", "pos").alias("last_seq"),
                    F.max("arrival_ts").alias("last_ts"))
               .withColumn("bytes", F.col("n_packets") * F.lit(layout.pkt_size)))
    complete = F.col("n_packets") == n
    if keep_tail:
        return grouped.withColumn("is_complete", complete)
    return grouped.filter(complete)


def blocks(positioned: DataFrame, layout: Layout, direct: bool = False) -> DataFrame:
    """One row per published block, straight from the packets in one shuffle.

    A block is published whole once its batches are in, padding included; an
    incomplete last block is not. ``direct`` publishes after a single batch.
    """
    per_block = 1 if direct else layout.batches_per_block
    wanted = per_block * layout.send_n
    return (positioned
            .groupBy("stream_id", div(F.col("pos"), wanted).alias("block_id"))
            .agg(F.count(F.lit(1)).alias("n_packets"),
                 F.min_by("seq", "pos").alias("first_seq"),
                 F.max_by("seq", "pos").alias("last_seq"),
                 F.max("arrival_ts").alias("fill_ts"))
            .filter(F.col("n_packets") == wanted)
            .select("stream_id", "block_id", F.lit(per_block).cast("bigint").alias("n_batches"),
                    "n_packets", "first_seq", "last_seq",
                    F.lit(layout.block_bytes - per_block * layout.batch_bytes)
                    .cast("bigint").alias("pad_bytes"),
                    "fill_ts"))


def countdown(batch_rows: DataFrame, layout: Layout) -> DataFrame:
    """Writes left in the block after each batch. ``logged`` marks every tenth
    batch and the last few of a block."""
    n = layout.batches_per_block
    remaining = F.lit(n - 1) - F.pmod("batch_id", F.lit(n))
    return batch_rows.select(
        "stream_id", div(F.col("batch_id"), n).alias("block_id"), "batch_id",
        remaining.alias("remaining"), (remaining == 0).alias("is_last"),
        (((F.col("batch_id") + 1) % 10 == 0) | (remaining < 5)).alias("logged"))


def ring_slots(block_rows: DataFrame, layout: Layout) -> DataFrame:
    return block_rows.withColumn("slot", F.pmod("block_id", F.lit(layout.nbufs)))


def with_file(block_rows: DataFrame, layout: Layout) -> DataFrame:
    return block_rows.withColumn("file_id", div(F.col("block_id"), layout.blocks_per_file))


def files(block_rows: DataFrame, layout: Layout) -> DataFrame:
    """Blocks grouped into files; the last file of a stream may be partial."""
    return (with_file(block_rows, layout).groupBy("stream_id", "file_id")
            .agg(F.count(F.lit(1)).alias("n_blocks"),
                 F.min("fill_ts").alias("first_ts"), F.max("fill_ts").alias("last_ts"))
            .select("stream_id", "file_id", "n_blocks",
                    (F.col("n_blocks") * F.lit(layout.block_bytes)).alias("bytes"),
                    "first_ts", "last_ts",
                    (F.col("n_blocks") == layout.blocks_per_file).alias("complete")))


def attach_header(block_rows: DataFrame, headers: DataFrame, layout: Layout) -> DataFrame:
    """Every block with the header of the file it belongs to."""
    return attach(with_file(block_rows, layout), headers, ["file_id"], "left",
                  spread_by=["stream_id", "block_id"])


def published(positioned: DataFrame, layout: Layout, direct: bool = False) -> DataFrame:
    """Packets that belong to published blocks, with block, place in it, and file."""
    wanted = layout.send_n * (1 if direct else layout.batches_per_block)
    totals = positioned.groupBy("stream_id").agg((F.max("pos") + 1).alias("_total"))
    placed = attach(positioned, totals, ["stream_id"], "left", spread_by=["pos"], null_safe=True)
    block = div(F.col("pos"), wanted)
    kept = placed.filter(block < div(F.col("_total"), wanted)).drop("_total")
    return with_file(
        kept.withColumn("block_id", block).withColumn("ordinal", F.pmod("pos", F.lit(wanted))),
        layout)

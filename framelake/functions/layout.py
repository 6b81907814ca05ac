"""Block, ring and file sizes; receiver parameter checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """Sizes derived from packet shape and counts.

    ``pkt_size`` already contains the application header; nothing is added to it.
    """

    pkt_header: int
    pkt_data: int
    pkts_per_block: int
    send_n: int
    nbufs: int = 8
    blocks_per_file: int = 10

    def __post_init__(self):
        if self.send_n < 1 or self.batch_bytes > self.block_bytes:
            raise ValueError(
                f"batch of {self.batch_bytes} bytes does not fit a block of {self.block_bytes}")

    @property
    def pkt_size(self) -> int:
        return self.pkt_header + self.pkt_data

    @property
    def batch_bytes(self) -> int:
        return self.pkt_size * self.send_n

    @property
    def block_bytes(self) -> int:
        return self.pkt_size * self.pkts_per_block

    @property
    def batches_per_block(self) -> int:
        return self.block_bytes // self.batch_bytes

    @property
    def pad_bytes(self) -> int:
        return self.block_bytes % self.batch_bytes

    @property
    def ring_bytes(self) -> int:
        return self.block_bytes * self.nbufs

    @property
    def file_bytes(self) -> int:
        return self.block_bytes * self.blocks_per_file


ALIGNED = Layout(64, 8192, 16384, 64)
UNALIGNED = Layout(64, 8000, 16384, 63)
TINY = Layout(16, 64, 50, 16)


def plan(df: DataFrame) -> DataFrame:
    """Derive sizes for a table of candidate layouts.

    Needs pkt_header, pkt_data, pkts_per_block, send_n, nbufs, blocks_per_file.
    A batch larger than a block is rejected: no batch count and no padding.
    """
    big = {n: F.col(n).cast("bigint") for n in (
        "pkt_header", "pkt_data", "pkts_per_block", "send_n", "nbufs", "blocks_per_file")}
    sized = df.withColumn("pkt_size", big["pkt_header"] + big["pkt_data"])
    sized = sized.withColumn("batch_bytes", F.col("pkt_size") * big["send_n"])
    sized = sized.withColumn("block_bytes", F.col("pkt_size") * big["pkts_per_block"])
    rejected = (F.col("batch_bytes") <= 0) | (F.col("batch_bytes") > F.col("block_bytes"))
    pad = F.when(~rejected, F.try_mod(F.col("block_bytes"), F.col("batch_bytes")))
    return sized.select(
        *sized.columns,
        (F.col("block_bytes") * big["nbufs"]).alias("ring_bytes"),
        (F.col("block_bytes") * big["blocks_per_file"]).alias("file_bytes"),
        F.when(rejected, F.lit(0)).otherwise(
            F.expr("block_bytes div nullif(batch_bytes, 0)")).cast("bigint").alias("n_batches"),
        pad.alias("pad_bytes"),
        F.coalesce(pad == 0, F.lit(False)).alias("aligned"),
        rejected.alias("rejected"))


def misaligned(planned: DataFrame) -> DataFrame:
    """Usable layouts that waste bytes in every block."""
    return planned.filter(~F.col("rejected") & ~F.col("aligned"))


def oversized(planned: DataFrame) -> DataFrame:
    return planned.filter("rejected")


# Limits a receiver configuration has to respect.
MIN_PKT_SIZE_EXCLUSIVE = 64
MIN_SEND_N = 8
GPU_LIMIT = 6
DEVICE_LIMIT = 4
CPU_LIMIT = 384
DEFAULT_NSGE = 4
DEPTH_LIMIT_SEND_N = 2048
DEPTH_CAP = 8192

ADDRESS_FIELDS = ("src_mac", "dst_mac", "src_ip", "dst_ip", "src_port", "dst_port")


def effective_nsge(nsge: Column) -> Column:
    return F.coalesce(F.nullif(nsge, F.lit(0)), F.lit(DEFAULT_NSGE))


def queue_depth(mode: Column, send_n: Column) -> Column:
    """Work-queue depth for ``direct``, ``receive`` or ``send``."""
    four = send_n * 4
    return (F.when(mode == "direct", send_n)
            .when((mode == "receive") & (send_n >= DEPTH_LIMIT_SEND_N), F.lit(DEPTH_CAP))
            .otherwise(four))


def check(df: DataFrame) -> DataFrame:
    """Range and presence rules for many receiver configurations at once.

    Needs pkt_size, send_n, gpu_id, device_id, cpu, nsge, mode and the six
    address fields as text. A missing value fails its rule.
    """
    passes = {
        "pkt_size": F.col("pkt_size") > MIN_PKT_SIZE_EXCLUSIVE,
        "send_n": F.col("send_n") >= MIN_SEND_N,
        "gpu_id": F.col("gpu_id") < GPU_LIMIT,
        "device_id": F.col("device_id") < DEVICE_LIMIT,
        "cpu": F.col("cpu") < CPU_LIMIT,
        **{f: F.length(f) > 0 for f in ADDRESS_FIELDS},
    }
    # Removing a marker stays in generated code, unlike dropping nulls with a lambda.
    failed = F.array_remove(F.array(*[
        F.when(F.coalesce(ok, F.lit(False)), F.lit("")).otherwise(rule)
        for rule, ok in passes.items()]), "")
    return df.select(
        "*", failed.alias("failed_rules"),
        effective_nsge(F.col("nsge")).alias("nsge_eff"),
        queue_depth(F.col("mode"), F.col("send_n")).alias("queue_depth"),
        (F.size(failed) == 0).alias("ok"))

"""Packet tables: landed files read once, or followed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions import frames

PACKET_SCHEMA = T.StructType([
    T.StructField("stream_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("arrival_ts", T.TimestampType()),
    T.StructField("src_mac", T.StringType()),
    T.StructField("dst_mac", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("src_port", T.IntegerType()),
    T.StructField("dst_port", T.IntegerType()),
    T.StructField("eth_type", T.IntegerType()),
    T.StructField("payload", T.BinaryType()),
])


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def follow(spark: SparkSession, path: str, schema: T.StructType = PACKET_SCHEMA,
           max_files_per_trigger: int = 8, pattern: str | None = None) -> DataFrame:
    """Stream over a landing folder. ``max_files_per_trigger`` bounds what one
    micro-batch may take in: the poll limit, and the back-pressure, of the stream.
    ``pattern`` picks files by name."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)


def land(raw: DataFrame, path: str, frame: str = "frame", mode: str = "append",
         by_day: bool = False) -> None:
    """Store raw frames with their decoded flow fields next to them, so that flow
    filters are pushed to the scan.

    Captures come in time order, so row-group statistics already prune by time and
    nothing is shuffled. ``by_day`` also splits the table by day of arrival; rows then
    move once, rebalanced so that a busy day takes several files and a quiet one no
    more than it needs.
    """
    decoded = frames.decode(raw, frame).select(
        *raw.columns, "src_mac", "dst_mac", "eth_type", "src_ip", "dst_ip",
        "src_ip_le", "dst_ip_le", "src_port", "dst_port", "payload", "frame_len", "malformed")
    if not by_day:
        decoded.write.mode(mode).parquet(path)
        return
    (decoded.withColumn("arrival_day", F.to_date("arrival_ts"))
     .hint("rebalance", "arrival_day")
     .write.mode(mode).partitionBy("arrival_day").parquet(path))

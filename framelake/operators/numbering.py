"""Arrival positions that continue: an index of counts over time buckets.

A position is the number of packets in the earlier buckets of the stream plus the place in its own.
Packets that are appended, late ones too, are numbered within the buckets they fall into;
every other bucket keeps its numbers and only its start moves, which the counts say. An append
sorts the packets of the buckets it touches, however many there are in all.
"""

from __future__ import annotations

import posixpath

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators import ordered
from framelake.operators.joins import attach
from framelake.session import durable
from framelake.sources.recording import drop_folder, resolve

ROWS = "stream_id string, seq bigint, arrival_ts timestamp, bucket bigint, place bigint"
COUNTS = "stream_id string, bucket bigint, n bigint, holder bigint"
KEYS = ["stream_id", "bucket"]


class Numbering:
    """Packets (stream_id, seq, arrival_ts) below the shared folder ``root``, in buckets of so many
    ``seconds``. Order is arrival time, ties broken by ``seq``; packets without a time are refused.

    Each append writes the buckets it touches anew, and a table of counts that says for every
    bucket which append holds it. The counts are written last: an append that was
    interrupted has not happened, and is repeated under its number.
    """

    def __init__(self, spark: SparkSession, root: str, seconds: int = 60):
        self.spark, self.root, self.seconds = spark, root, seconds

    def _at(self, kind: str, number: int) -> str:
        return f"{self.root}/{kind}/append={number}"

    def last(self) -> int:
        """Number of the last append, -1 before the first."""
        system, root = resolve(f"{self.root}/counts")
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        done = [int(f.base_name.split("=")[1]) for f in found if f.base_name.startswith("append=") and system.get_file_info(
            posixpath.join(f.path, "_SUCCESS")).type == fs.FileType.File]
        return max(done, default=-1)

    def counts(self) -> DataFrame:
        """Packets of every bucket, and the append that holds it."""
        at = self.last()
        if at < 0:
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).parquet(self._at("counts", at))

    def _rows(self, wanted: DataFrame) -> DataFrame:
        """Packets of the buckets that ``wanted`` (stream_id, bucket, holder) names."""
        holders = [r["holder"] for r in wanted.select("holder").distinct().collect()]
        if not holders:
            return self.spark.createDataFrame([], ROWS)
        # One folder for each append with a live bucket; ranges of buckets prune within it.
        stored = self.spark.read.schema(ROWS + ", append bigint").option("basePath", f"{self.root}/rows").parquet(
            *[self._at("rows", h) for h in holders])
        span = wanted.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).first()
        near = stored.filter(F.col("bucket").between(span["lo"], span["hi"])).withColumnRenamed("append", "holder")
        return attach(near, wanted.select(*KEYS, "holder"), [*KEYS, "holder"], "left_semi", spread_by=["seq"],
                      null_safe=True)

    def append(self, packets: DataFrame, number: int | None = None) -> int:
        """Add packets; returns how many were sorted. An append with the number of one that is there
        already changes nothing."""
        at = self.last()
        number = at + 1 if number is None else number
        if number <= at:
            return 0
        if number != at + 1:
            raise ValueError(f"append {number} follows {at}")
        micros = F.unix_micros("arrival_ts")
        fresh = packets.select(
            "stream_id", F.col("seq").cast("bigint").alias("seq"), F.col("arrival_ts").cast("timestamp").alias("arrival_ts"))
        fresh = fresh.withColumn("bucket", F.call_function("div", micros - F.pmod(micros, F.lit(
            self.seconds * 1_000_000)), F.lit(self.seconds * 1_000_000).cast("bigint")))
        per_bucket = durable(fresh.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_new")))
        if per_bucket.filter("bucket IS NULL").first() is not None:
            raise ValueError("a packet without an arrival time cannot be numbered")
        before = durable(self.counts())
        touched = durable(attach(before, per_bucket.select(*KEYS), KEYS, "left_semi", null_safe=True))
        both = fresh.unionByName(self._rows(touched).select(*fresh.columns))
        placed = ordered.positions(both, KEYS, ["arrival_ts", "seq"], "place")
        placed.write.mode("overwrite").parquet(self._at("rows", number))
        written = self.spark.read.schema(ROWS).parquet(self._at("rows", number))
        now = written.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).withColumn("holder", F.lit(number).cast("bigint"))
        kept = attach(before, per_bucket.select(*KEYS), KEYS, "left_anti", null_safe=True)
        kept.unionByName(now).write.mode("overwrite").parquet(self._at("counts", number))
        return written.count()

    def positions(self) -> DataFrame:
        """All packets with their dense position ``pos`` in their stream."""
        starts = ordered.running_sums(self.counts(), ["stream_id"], ["bucket"], {"_upto": F.col("n")}).select(
            *KEYS, "holder", (F.col("_upto") - F.col("n")).alias("_start"))
        starts = durable(starts)
        found = self._rows(starts)
        return attach(found, starts.select(*KEYS, "_start"), KEYS, "inner", spread_by=["seq"], null_safe=True).select(
            "stream_id", "seq", "arrival_ts", (F.col("_start") + F.col("place")).alias("pos"))

    def sweep(self) -> int:
        """Remove rows of appends that hold no bucket any more, and earlier counts."""
        at = self.last()
        live = {r["holder"] for r in self.counts().select("holder").distinct().collect()}
        dropped = [n for n in range(at + 1) if n not in live]
        for n in dropped:
            drop_folder(self._at("rows", n))
        for n in range(at):
            drop_folder(self._at("counts", n))
        return len(dropped)

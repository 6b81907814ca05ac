"""Streaming jobs over packets and block events: steps for ``InOrder``, and two sinks whose
results need no order."""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framelake.functions.layout import Layout
from framelake.functions.timestamps import gbps, whole_kb
from framelake.operators import assemble, chained, metrics
from framelake.operators.joins import attach
from framelake.session import durable
from framelake.sources import logs, tail

STREAM = ["stream_id"]


def with_eod(df: DataFrame) -> DataFrame:
    """Control rows carry ``eod`` = true; without the column every row is data."""
    return df.withColumn("eod", F.coalesce("eod", F.lit(False)) if "eod" in df.columns else F.lit(False))


def merged(parts: list[DataFrame], **aggregates) -> DataFrame:
    """One row for each stream, a null one included, from tables with some of the columns."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.groupBy("stream_id").agg(*[c.alias(n) for n, c in aggregates.items()])


@dataclasses.dataclass
class Groups:
    """Packets in groups of ``size`` as they complete. A row flagged ``eod`` sends on the rest
    of its stream as an incomplete group.

    Carries the packets of incomplete groups (``groups`` null) and, for each stream, how many
    groups there were.
    """

    size: int
    carried = "stream_id string, seq bigint, arrival_ts timestamp, groups bigint"
    output = ("stream_id string, group_id bigint, n_packets bigint, first_seq bigint, last_seq bigint, "
              "last_ts timestamp, is_complete boolean")

    def __call__(self, rows: DataFrame, carry: DataFrame, last: bool):
        rows = with_eod(rows)
        data = rows.filter("NOT eod").select("stream_id", "seq", "arrival_ts")
        body = carry.filter("groups IS NULL").drop("groups").unionByName(data)
        placed = assemble.position(body)
        per_stream = merged(
            [placed.groupBy("stream_id").agg((F.max("pos") + 1).alias("total")),
             carry.filter("groups IS NOT NULL").select("stream_id", "groups"),
             rows.filter("eod").select("stream_id", F.lit(True).alias("ended")).distinct()],
            total=F.coalesce(F.max("total"), F.lit(0)), groups=F.coalesce(F.max("groups"), F.lit(0)),
            ended=F.coalesce(F.bool_or("ended"), F.lit(False)))
        # Packets up to here are in groups that go out.
        upto = F.when(F.col("ended"), F.col("total")).otherwise(
            assemble.div(F.col("total"), self.size) * self.size)
        per_stream = per_stream.withColumn("_upto", upto)
        known = attach(placed, per_stream, STREAM, spread_by=["seq"], null_safe=True)
        out = (known.filter("pos < _upto")
               .groupBy("stream_id", (F.col("groups") + assemble.div(F.col("pos"), self.size)).alias("group_id"))
               .agg(F.count(F.lit(1)).alias("n_packets"), F.min_by("seq", "pos").alias("first_seq"),
                    F.max_by("seq", "pos").alias("last_seq"), F.max("arrival_ts").alias("last_ts"))
               .withColumn("is_complete", F.col("n_packets") == self.size))
        counts = per_stream.select("stream_id", (
            F.col("groups") + assemble.div(F.col("_upto") + (self.size - 1), self.size)).alias("groups"))
        rest = known.filter("pos >= _upto").select("stream_id", "seq", "arrival_ts")
        return out, rest.unionByName(counts, allowMissingColumns=True)


def as_batches(groups: DataFrame, layout: Layout) -> DataFrame:
    return groups.select(
        "stream_id", F.col("group_id").alias("batch_id"), "n_packets", "first_seq", "last_seq",
        (F.col("n_packets") * F.lit(layout.pkt_size)).alias("bytes"), "is_complete")


def as_blocks(groups: DataFrame, layout: Layout, direct: bool = False) -> DataFrame:
    """Published blocks. An incomplete last block never is one."""
    per_block = 1 if direct else layout.batches_per_block
    return groups.filter("is_complete").select(
        "stream_id", F.col("group_id").alias("block_id"), F.lit(per_block).cast("bigint").alias("n_batches"),
        "n_packets", "first_seq", "last_seq",
        F.lit(layout.block_bytes - per_block * layout.batch_bytes).cast("bigint").alias("pad_bytes"),
        F.col("last_ts").alias("fill_ts"))


def batches(layout: Layout) -> Groups:
    return Groups(layout.send_n)


def blocks(layout: Layout, direct: bool = False) -> Groups:
    return Groups(layout.send_n * (1 if direct else layout.batches_per_block))


@dataclasses.dataclass
class Occupancy:
    """Buffer fill after every fill or clear event; carries the two counters of a stream."""

    layout: Layout
    carried = "stream_id string, writes bigint, reads bigint"
    output = ("stream_id string, ts timestamp, kind string, block_id bigint, used_bytes bigint, "
              "free_bytes bigint, fill_pct double, blocks_written bigint")

    def __call__(self, rows: DataFrame, carry: DataFrame, last: bool):
        events = rows.select("stream_id", "ts", "kind", "block_id")
        is_fill = (F.col("kind") == "filled").cast("bigint")
        counted = metrics.counted_events(events)
        shifted = attach(counted, carry, STREAM, spread_by=["block_id"], null_safe=True)
        for name in ("writes", "reads"):
            shifted = shifted.withColumn(f"_{name}", F.col(f"_{name}") + F.coalesce(name, F.lit(0)))
        totals = events.groupBy("stream_id").agg(
            F.sum(is_fill).alias("writes"), F.sum(1 - is_fill).alias("reads"))
        both = merged([carry, totals], writes=F.sum("writes"), reads=F.sum("reads"))
        return metrics.filled(shifted, self.layout), both


@dataclasses.dataclass
class Progress:
    """Throttled sampling of status rows: a row goes out when ``seconds`` passed since the
    last. Carries that last row of each stream, which begins the next release."""

    seconds: int
    values: dict[str, str]
    order: list[str]

    def __post_init__(self):
        kept = ", ".join(f"{n} {t}" for n, t in self.values.items())
        self.output = f"stream_id string, ts timestamp, {kept}"
        self.carried = self.output

    def __call__(self, rows: DataFrame, carry: DataFrame, last: bool):
        columns = ["stream_id", "ts", *self.values]
        both = carry.select(*columns, F.lit(0).alias("_new")).unionByName(
            rows.select(*columns, F.lit(1).alias("_new")))
        kept = chained.progress_exact(both, self.seconds, [*self.values, "_new"], ["_new", *self.order])
        out = kept.filter("_new = 1").select(*columns)
        latest = kept.groupBy("stream_id").agg(
            F.max_by(F.struct("ts", *self.values), F.struct("ts", "_new")).alias("v"))
        return out, latest.select("stream_id", "v.*")


@dataclasses.dataclass
class Packing:
    """Blocks of whole records (``stream_id``, ``size``, the order columns), each sent on when
    the next one opens; a row flagged ``eod`` sends on the open block too. Carries the open
    block of a stream as one record that begins the next release."""

    capacity: int
    order: list[str]
    carried = "stream_id string, block_id bigint, n bigint, used bigint"
    output = "stream_id string, block_id bigint, n_records bigint, used_bytes bigint, pad_bytes bigint"

    def __call__(self, rows: DataFrame, carry: DataFrame, last: bool):
        rows = with_eod(rows)
        order = [c for c in self.order if c != "size"]
        data = rows.filter(~F.col("eod") & F.col("size").between(0, self.capacity)).select(
            "stream_id", F.lit(1).alias("_new"), *order, F.col("size").cast("bigint").alias("size"))
        opened = carry.filter("n > 0").select("stream_id", F.lit(0).alias("_new"), F.col("used").alias("size"))
        packed = chained.pack_variable(opened.unionByName(data, allowMissingColumns=True), self.capacity,
                                       "stream_id", ["_new", *order, "size"], "size")
        packed = durable(packed)
        per_stream = merged(
            [carry.select("stream_id", F.col("block_id").alias("base"), F.col("n").alias("begun")),
             packed.groupBy("stream_id").agg(F.max("block_id").alias("open"), F.min("block_id").alias("first")),
             rows.filter("eod").select("stream_id", F.lit(True).alias("ended")).distinct()],
            base=F.coalesce(F.max("base"), F.lit(0)), begun=F.coalesce(F.max("begun"), F.lit(0)),
            open=F.max("open"), first=F.max("first"), ended=F.coalesce(F.bool_or("ended"), F.lit(False)))
        known = attach(packed, per_stream, STREAM, null_safe=True)
        known = known.withColumn("n_records", F.col("n_records") + F.when(
            (F.col("block_id") == F.col("first")) & (F.col("begun") > 0), F.col("begun") - 1).otherwise(0))
        at = F.col("base") + F.col("block_id") - F.col("first")
        goes = (F.col("block_id") < F.col("open")) | F.col("ended")
        out = known.filter(goes).select("stream_id", at.alias("block_id"), "n_records", "used_bytes", "pad_bytes")
        left = known.filter(~goes).select("stream_id", at.alias("block_id"), F.col("n_records").alias("n"),
                                          F.col("used_bytes").alias("used"))
        after = F.col("base") + F.coalesce(F.col("open") - F.col("first") + 1, F.lit(0))
        closed = per_stream.filter(F.col("ended") | F.col("open").isNull()).select(
            "stream_id", after.alias("block_id"), F.lit(0).alias("n"), F.lit(0).alias("used"))
        return out, left.unionByName(closed)


class WindowCounts:
    """``foreachBatch`` target for throughput: packets per window, counted in each micro-batch
    and added up when read. No watermark is needed, so late packets count where they belong,
    and the windows open at the end are there too."""

    def __init__(self, spark: SparkSession, root: str, layout: Layout, seconds: int):
        self.out, self.layout, self.seconds = f"{root}/counts", layout, seconds
        spark.createDataFrame([], "stream_id string, win_start timestamp, packets bigint").write.mode(
            "overwrite").parquet(f"{self.out}/batch=-1")

    def __call__(self, packets: DataFrame, batch_id: int) -> None:
        typed = packets.select("stream_id", F.col("arrival_ts").cast("timestamp").alias("arrival_ts"))
        metrics.active_windows(typed.filter("arrival_ts IS NOT NULL"), self.seconds).write.mode(
            "overwrite").parquet(f"{self.out}/batch={batch_id}")

    def result(self, spark: SparkSession) -> DataFrame:
        """Every window between the first and last active one of a stream, idle ones with zeros."""
        counts = spark.read.parquet(self.out).groupBy("stream_id", "win_start").agg(
            F.sum("packets").alias("packets"))
        zeros = metrics.all_windows(counts, self.seconds).withColumn("packets", F.lit(0).cast("bigint"))
        every = counts.unionByName(zeros).groupBy("stream_id", "win_start").agg(F.sum("packets").alias("packets"))
        n_bytes = F.col("packets") * F.lit(self.layout.pkt_size)
        return every.select("stream_id", "win_start", "packets", whole_kb(n_bytes).alias("kb"),
                            gbps(n_bytes, F.lit(self.seconds * 1_000_000)).alias("gbps"))


def dwell(filled: DataFrame, cleared: DataFrame, lateness: str, bound: str) -> DataFrame:
    """Fill and clear events joined per block as they arrive; a block not cleared within
    ``bound`` of its fill is reported with nulls once the watermark has passed it."""
    left = filled.select("stream_id", "block_id", F.col("ts").cast("timestamp").alias("fill_ts"))
    right = cleared.select(F.col("stream_id").alias("_s"), F.col("block_id").alias("_b"),
                           F.col("ts").cast("timestamp").alias("clear_ts"))
    joined = left.withWatermark("fill_ts", lateness).join(
        right.withWatermark("clear_ts", lateness),
        (F.col("stream_id") == F.col("_s")) & (F.col("block_id") == F.col("_b"))
        & (F.col("clear_ts") >= F.col("fill_ts"))
        & (F.col("clear_ts") <= F.col("fill_ts") + F.expr(f"interval {bound}")), "left_outer")
    return joined.select(
        "stream_id", "block_id", "fill_ts", "clear_ts",
        F.timestamp_diff("SECOND", F.col("fill_ts"), F.col("clear_ts")).alias("dwell_s"),
        F.col("clear_ts").isNotNull().alias("cleared"))


def start(df: DataFrame, path: str, checkpoint: str, name: str | None = None,
          finite: bool = True) -> StreamingQuery:
    """Append rows to a Parquet sink. ``finite`` drains what has landed, then ends."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if finite else writer).start()


class LogRuns:
    """``foreachBatch`` target for followed log lines: typed rows with the run and the line they
    belong to. Lines of a log arrive in order, so what a micro-batch must know is how many
    runs and lines each log had before; that is carried from one to the next.

    A micro-batch that is repeated replaces what it wrote.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.out = root, f"{root}/out"
        none = logs.classify(spark.createDataFrame([], tail.SCHEMA)).withColumns(
            {c: F.lit(0).cast("bigint") for c in ("run_id", "line_no")})
        none.write.mode("overwrite").parquet(f"{self.out}/batch=-1")
        spark.createDataFrame([], "log string, runs bigint, lines bigint").write.mode("overwrite").parquet(self._carry(-1))

    def _carry(self, batch_id: int) -> str:
        return f"{self.root}/carry/batch={batch_id}"

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        # Micro-batches are numbered without gaps.
        before = spark.read.parquet(self._carry(batch_id - 1))
        numbered = durable(logs.with_run(logs.classify(lines), "log", ["path", "offset"]))
        known = attach(numbered, before, ["log"], "left", spread_by=["offset"], null_safe=True)
        known.select(*[(F.col(c) + F.coalesce(b, F.lit(0))).alias(c) if b else F.col(c) for c, b in (
            (c, {"run_id": "runs", "line_no": "lines"}.get(c)) for c in numbered.columns)]).write.mode(
            "overwrite").parquet(f"{self.out}/batch={batch_id}")
        here = numbered.groupBy("log").agg(
            F.max("run_id").cast("bigint").alias("runs"), F.max("line_no").cast("bigint").alias("lines"))
        both = before.unionByName(here).groupBy("log").agg(F.sum("runs").alias("runs"), F.sum("lines").alias("lines"))
        both.write.mode("overwrite").parquet(self._carry(batch_id))

    def result(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.out).drop("batch")

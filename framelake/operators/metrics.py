"""Throughput, idle time, buffer occupancy, progress and hand-off metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.layout import Layout
from framelake.functions.timestamps import gbps, percent, whole_kb
from framelake.operators import ordered
from framelake.session import durable

# Windows generated per row when empty intervals are filled in.
FILL_CHUNK = 4096


def seconds_interval(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds))


def window_start(ts: str, seconds: int) -> Column:
    return F.window(ts, f"{seconds} seconds")["start"]


def active_windows(packets: DataFrame, seconds: int, stream: str = "stream_id",
                   ts: str = "arrival_ts") -> DataFrame:
    return (packets.groupBy(stream, window_start(ts, seconds).alias("win_start"))
            .agg(F.count(F.lit(1)).alias("packets")))


def all_windows(active: DataFrame, seconds: int, stream: str = "stream_id") -> DataFrame:
    """Every window between the first and last active one, per stream. A stray timestamp
    stretches that span and with it the result, so filter such rows before.

    Generated in two steps with a shuffle between, so that a long stream does
    not unroll inside one task.
    """
    width = seconds_interval(seconds)
    chunk = seconds_interval(seconds * FILL_CHUNK)
    spans = active.groupBy(stream).agg(
        F.min("win_start").alias("_lo"), F.max("win_start").alias("_hi"))
    chunks = (spans.select(stream, "_hi", F.explode(F.sequence("_lo", "_hi", chunk)).alias("_c"))
              .repartition(stream, "_c"))
    last = F.least(F.col("_hi"), F.col("_c") + seconds_interval(seconds * (FILL_CHUNK - 1)))
    return chunks.select(stream, F.explode(F.sequence("_c", last, width)).alias("win_start"))


def throughput(packets: DataFrame, layout: Layout, seconds: int, stream: str = "stream_id",
               ts: str = "arrival_ts") -> DataFrame:
    """Packets, KB and Gbps per aligned window; idle windows appear with zeros.

    The counts, small next to the packets, are stored, so that the packets are read
    once although the counts are used twice. The filler rows meet them in an
    aggregation instead of a join: a window's count is the sum of its zero and its
    activity.
    """
    active = durable(active_windows(packets, seconds, stream, ts))
    filler = all_windows(active, seconds, stream).withColumn("packets", F.lit(0).cast("bigint"))
    merged = (active.unionByName(filler).groupBy(stream, "win_start")
              .agg(F.sum("packets").alias("packets")))
    n_bytes = F.col("packets") * F.lit(layout.pkt_size)
    return merged.select(
        stream, "win_start", "packets", whole_kb(n_bytes).alias("kb"),
        gbps(n_bytes, F.lit(seconds * 1_000_000)).alias("gbps"))


def idle_runs(packets: DataFrame, seconds: int, stream: str = "stream_id",
              ts: str = "arrival_ts") -> DataFrame:
    """Maximal runs of empty windows between two active ones.

    Only active windows are ordered; a run is the hole before one of them.
    """
    width = seconds_interval(seconds)
    active = active_windows(packets, seconds, stream, ts).select(stream, "win_start")
    seen = ordered.previous(active, [stream], ["win_start"], {"_prev": F.col("win_start")})
    gap = F.timestamp_diff("SECOND", F.col("_prev"), F.col("win_start"))
    return (seen.filter(gap > seconds)
            .select(stream, (F.col("_prev") + width).alias("run_start"),
                    (F.col("win_start") - width).alias("run_end"),
                    (F.floor(gap / F.lit(seconds)) - 1).cast("bigint").alias("windows")))


def ring_log(filled: DataFrame, cleared: DataFrame) -> DataFrame:
    """Event log of (stream_id, block_id, ts, kind) from both sides of the buffer."""
    return (filled.withColumn("kind", F.lit("filled"))
            .unionByName(cleared.withColumn("kind", F.lit("cleared"))))


def _used_blocks(writes: Column, reads: Column, nbufs: int) -> Column:
    return F.greatest(F.lit(0), F.least(writes - reads, F.lit(nbufs)))


def counted_events(log: DataFrame) -> DataFrame:
    """Events with the fills (``_writes``) and clears (``_reads``) up to each. At equal times
    fills count before clears."""
    is_fill = F.col("kind") == "filled"
    return ordered.running_sums(
        log.withColumn("_after", F.when(is_fill, 0).otherwise(1)),
        ["stream_id"], ["ts", "_after", "block_id"],
        {"_writes": F.when(is_fill, 1).otherwise(0),
         "_reads": F.when(is_fill, 0).otherwise(1)})


def filled(counted: DataFrame, layout: Layout) -> DataFrame:
    """Buffer fill from the counts of fills and clears."""
    used = _used_blocks(F.col("_writes"), F.col("_reads"), layout.nbufs)
    size = F.lit(layout.block_bytes)
    return counted.select(
        "stream_id", "ts", "kind", "block_id",
        (used * size).alias("used_bytes"),
        ((F.lit(layout.nbufs) - used) * size).alias("free_bytes"),
        percent(used * size, F.lit(layout.ring_bytes)).alias("fill_pct"),
        F.col("_writes").alias("blocks_written"))


def occupancy(log: DataFrame, layout: Layout) -> DataFrame:
    """Buffer fill after every event."""
    return filled(counted_events(log), layout)


def snapshot(log: DataFrame, layout: Layout, at: Column | None = None) -> DataFrame:
    """Counters per stream at a time (default: the end). Sums suffice, no ordering."""
    rows = log if at is None else log.filter(F.col("ts") <= at)
    counts = rows.groupBy("stream_id").agg(
        F.count_if(F.col("kind") == "filled").alias("_w"),
        F.count_if(F.col("kind") == "cleared").alias("_r"))
    used = _used_blocks(F.col("_w"), F.col("_r"), layout.nbufs)
    size = F.lit(layout.block_bytes)
    return counts.select(
        "stream_id", used.alias("blocks_in_use"),
        (F.col("_w") * size).alias("bytes_written"), (F.col("_r") * size).alias("bytes_read"),
        ((F.lit(layout.nbufs) - used) * size).alias("bytes_available"))


def snapshot_at(log: DataFrame, probes: DataFrame, layout: Layout, at: str = "at") -> DataFrame:
    """Counters of the stream of every probe (``stream_id``, ``at``, and what else it has) at its
    time, events of that time included; zeros where nothing had happened yet.

    An as-of join: events of one time are added up, counts run over the times, and a probe takes
    those of the last time before it.
    """
    is_fill = (F.col("kind") == "filled").cast("bigint")
    steps = log.groupBy("stream_id", F.col("ts").alias(at)).agg(
        F.sum(is_fill).alias("_w"), F.sum(1 - is_fill).alias("_r"))
    counted = ordered.running_sums(steps, ["stream_id"], [at], {"_writes": F.col("_w"), "_reads": F.col("_r")})
    found = ordered.as_of(probes, counted.select("stream_id", at, "_writes", "_reads"), ["stream_id"], at,
                          ["_writes", "_reads"])
    writes, reads = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("_writes", "_reads"))
    used = _used_blocks(writes, reads, layout.nbufs)
    size = F.lit(layout.block_bytes)
    return found.select(
        *probes.columns, used.alias("blocks_in_use"), (writes * size).alias("bytes_written"),
        (reads * size).alias("bytes_read"), ((F.lit(layout.nbufs) - used) * size).alias("bytes_available"))


def progress_windowed(rows: DataFrame, values: list[str], order: list[str], seconds: int,
                      stream: str = "stream_id", ts: str = "ts") -> DataFrame:
    """Last row of every window: the scalable form of throttled sampling."""
    packed = rows.withColumn("_v", F.struct(*values)).withColumn("_o", F.struct(*order))
    return (packed.groupBy(stream, window_start(ts, seconds).alias("win_start"))
            .agg(F.max_by("_v", "_o").alias("_v"))
            .select(stream, "win_start", *[F.col("_v").getField(v).alias(v) for v in values]))


def dwell(log: DataFrame) -> DataFrame:
    """Time from fill to clear per block; blocks never cleared stay, with nulls.

    Both events share their key, so one aggregation does the work of the join.
    """
    per_block = log.groupBy("stream_id", "block_id").agg(
        F.min(F.when(F.col("kind") == "filled", F.col("ts"))).alias("fill_ts"),
        F.min(F.when(F.col("kind") == "cleared", F.col("ts"))).alias("clear_ts"))
    return per_block.filter(F.col("fill_ts").isNotNull()).select(
        "stream_id", "block_id", "fill_ts", "clear_ts",
        F.timestamp_diff("SECOND", F.col("fill_ts"), F.col("clear_ts")).alias("dwell_s"),
        F.col("clear_ts").isNotNull().alias("cleared"))


def offset_gaps(extents: DataFrame, key: str, first_only: bool = True) -> DataFrame:
    """Extents that do not start where the one before them ended.

    Needs ``offset`` and ``length``; reports the first break per key, or every
    distinct break with the number of times it occurs. Equal extents are counted
    before the sort, so that a key with many copies shrinks map-side: each copy
    after the first breaks against its twin.
    """
    distinct = extents.groupBy(key, "offset", "length").agg(F.count(F.lit(1)).alias("_n"))
    end = F.col("offset") + F.col("length")
    seen = ordered.previous(distinct, [key], ["offset", "length"], {"_end": end})
    candidates = F.array(
        F.struct(F.col("_end").alias("expected"), F.lit(1).cast("bigint").alias("times")),
        F.struct(end.alias("expected"), (F.col("_n") - 1).alias("times")))
    breaks = (seen.select(key, "offset", F.explode(candidates).alias("_c"))
              .select(key, "offset", "_c.expected", "_c.times")
              .filter((F.col("times") > 0) & (F.col("expected") != F.col("offset"))))
    if not first_only:
        return breaks.groupBy(key, "offset", "expected").agg(
            F.sum("times").alias("times")).withColumn("actual", F.col("offset"))
    return (breaks.groupBy(key).agg(F.min(F.struct("offset", "expected")).alias("_b"))
            .select(key, "_b.offset", "_b.expected", F.col("_b.offset").alias("actual")))

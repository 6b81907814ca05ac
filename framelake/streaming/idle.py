"""Live throughput rows with their idle windows, put out while a stream is silent.

Packets are counted by window in the task that reads them, so that a busy stream reaches the
keyed state as a few rows of a micro-batch. A stream then waits on an event-time timer: when the
watermark passes the end of a window it goes out, with zero packets if none came, and the
timer moves on to the next. The watermark is that of all streams: one that is silent is seen
to be idle as long as any other is not. The state holds counts by spans of many windows, so that
what a task asks of the state store does not grow with every window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from framelake.operators import ordered
from framelake.operators.joins import attach
from framelake.session import ROCKSDB_PROVIDER, settings
from framelake.streaming import jobs

COUNTS = "stream_id string, win bigint, n bigint, last_us bigint"
# Windows whose counts are one entry of the state, and entries that go out as one table.
SPAN = 1024
SPANS_OUT = 64


def _counted(seconds: int):
    def count(batches):
        for batch in batches:
            keep = batch.filter(pc.is_valid(batch.column(1)))
            # Whole windows since the epoch, also before it.
            win = pa.array(keep.column(1).to_numpy(zero_copy_only=False) // (seconds * 1_000_000))
            table = pa.table({"stream_id": keep.column(0), "win": win, "us": keep.column(1)}).group_by(
                ["stream_id", "win"]).aggregate([([], "count_all"), ("us", "max")])
            yield from table.select(["stream_id", "win", "count_all", "us_max"]).rename_columns(
                ["stream_id", "win", "n", "last_us"]).to_batches()

    return count


class Windows(StatefulProcessor):
    """State of a stream: counts of the windows that are not out yet, by spans of ``SPAN`` windows, and
    the next window to go out."""

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle):
        self.handle = handle
        self.counts = handle.getMapState("counts", "span bigint", "n binary")
        self.next = handle.getValueState("next", "win bigint, timer bigint")

    def _wait(self, win: int) -> None:
        """Wake up when the watermark has passed the end of a window."""
        at = (win + 1) * self.seconds * 1000
        self.handle.registerTimer(at)

    def _span(self, span: int) -> np.ndarray | None:
        held = self.counts.getValue((span,))
        return np.frombuffer(held[0], "<i8") if held is not None else None

    def handleInputRows(self, key, rows, timerValues):
        state = self.next.get() if self.next.exists() else None
        begun, first = (state[0], state[1]) if state is not None else (None, None)
        for pdf in rows:
            wins, packets = pdf["win"].to_numpy(), pdf["n"].to_numpy()
            if begun is not None:
                # Behind the watermark: those windows are out.
                wins, packets = wins[wins >= begun], packets[wins >= begun]
            if not len(wins):
                continue
            order = np.argsort(wins, kind="stable")
            wins, packets = wins[order], packets[order]
            spans = wins // SPAN
            for at in np.split(np.arange(len(wins)), np.flatnonzero(np.diff(spans)) + 1):
                span = int(spans[at[0]])
                held = self._span(span)
                counts = held.copy() if held is not None else np.zeros(SPAN, "<i8")
                np.add.at(counts, wins[at] - span * SPAN, packets[at])
                self.counts.updateValue((span,), (counts.tobytes(),))
            least = int(wins[0])
            if first is None or (begun is None and least < first):
                first = least
                self._wait(least)
        if first is not None:
            self.next.update((begun, first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        begun, first = self.next.get()
        win = first if begun is None else begun
        over = timerValues.getCurrentWatermarkInMs() // (self.seconds * 1000)
        if win < over:
            self.next.update((over, first))
            self._wait(over)
        while win < over:
            begin, parts = win, []
            while win < over and len(parts) < SPANS_OUT:
                span = win // SPAN
                stop = min(over, (span + 1) * SPAN)
                held = self._span(span)
                parts.append(held[win - span * SPAN:stop - span * SPAN] if held is not None else np.zeros(stop - win, "<i8"))
                if held is not None and stop == (span + 1) * SPAN:
                    self.counts.removeKey((span,))
                win = stop
            yield pd.DataFrame({"stream_id": pd.Series([key[0]] * (win - begin), dtype=object),
                                "win": np.arange(begin, win), "packets": np.concatenate(parts)})

    def close(self):
        pass


def windows(packets: DataFrame, seconds: int, lateness: str) -> DataFrame:
    """Stream of (stream_id, win_start, packets): every window of a stream from its first packet on,
    idle ones with zero packets, as the watermark passes its end.

    ``lateness`` says how far behind the newest packet another may come; one further behind
    is not counted. Packets without a time are ignored; a null stream id is a stream too.
    """
    micros = packets.select("stream_id", F.unix_micros(F.col("arrival_ts").cast("timestamp")).alias("us"))
    counts = micros.mapInArrow(_counted(seconds), COUNTS)
    stamped = counts.withColumn("at", F.timestamp_micros("last_us")).withWatermark("at", lateness)
    out = stamped.groupBy("stream_id").transformWithStateInPandas(
        statefulProcessor=Windows(seconds), outputStructType="stream_id string, win bigint, packets bigint",
        outputMode="Append", timeMode="EventTime")
    return out.select("stream_id", F.timestamp_seconds(F.col("win") * seconds).alias("win_start"), "packets")


def start(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the windows to a Parquet sink. Timers need the state store that keeps several tables,
    whatever the session has."""
    spark = rows.sparkSession
    with settings(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}):
        return jobs.start(rows, path, checkpoint, finite=False)


def runs(rows: DataFrame) -> DataFrame:
    """Runs of idle windows between active ones, as ``metrics.idle_runs`` gives them, from rows that
    ``windows`` put out. A run that no packet has ended yet is not among them."""
    busy = (F.col("packets") > 0).cast("bigint")
    numbered = ordered.running_sums(rows, ["stream_id"], ["win_start"], {"_before": busy})
    last = rows.groupBy("stream_id").agg(F.sum(busy).alias("_all"))
    found = numbered.filter("packets = 0").groupBy("stream_id", "_before").agg(
        F.min("win_start").alias("run_start"), F.max("win_start").alias("run_end"), F.count(F.lit(1)).alias("windows"))
    return attach(found, last, ["stream_id"], "inner", null_safe=True).filter("_before < _all").select(
        "stream_id", "run_start", "run_end", "windows")

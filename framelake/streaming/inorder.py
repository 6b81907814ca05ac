"""Streams whose results do not depend on how their rows arrived.

Rows land in files, and neither the number of files nor their times say anything about the
order of the rows. ``InOrder`` therefore holds rows back until the watermark has passed them,
releases them in time order, and hands each release to a step: an operator of the batch
library together with what it carries from one release to the next. Every release is sorted
across the cluster, so a busy stream is never one task. The end of the data releases the rest.

Everything is written per micro-batch and replaces what an interrupted attempt of it left;
the ledger entry, written last, commits it.
"""

from __future__ import annotations

import posixpath

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framelake.sources.recording import drop_folder, resolve

LEDGER = "bound bigint, top bigint, carry bigint, open array<struct<id:bigint,top:bigint>>, finished boolean"


class InOrder:
    """``foreachBatch`` target. ``root`` is a shared folder for what is held back, carried
    and put out. ``lateness`` in seconds says how far behind the newest row another may
    still come; None holds everything until the end of the data.

    A row older than what was already released cannot be put in its place any more: it is
    kept in the folder ``late``, out of the results.

    ``hook(rows, release)`` is handed what a release has put out, with its number. A release that
    is repeated calls it again with the same rows and number, so what it does must go by that.
    """

    def __init__(self, spark: SparkSession, root: str, step, ts: str = "arrival_ts",
                 lateness: int | None = None, hook=None):
        self.root, self.step, self.ts, self.lateness, self.hook = root, step, ts, lateness, hook
        self.out = posixpath.join(root, "out")
        spark.createDataFrame([], step.carried).write.mode("overwrite").parquet(self._at("carry", -1))
        spark.createDataFrame([], step.output).write.mode("overwrite").parquet(self._at("out", -1))
        self._commit(spark, -1, (None, None, -1, [], False))

    def _at(self, kind: str, batch_id: int) -> str:
        return f"{self.root}/{kind}/batch={batch_id}"

    def _commit(self, spark, batch_id: int, entry: tuple) -> None:
        spark.createDataFrame([entry], LEDGER).coalesce(1).write.mode("overwrite").parquet(
            self._at("ledger", batch_id))

    def _entry(self, spark, batch_id: int):
        return spark.read.schema(LEDGER).parquet(self._at("ledger", batch_id)).first()

    def _last(self) -> int:
        system, root = resolve(f"{self.root}/ledger")
        names = (f.base_name for f in system.get_file_info(fs.FileSelector(root)))
        return max(int(n.split("=")[1]) for n in names if n.startswith("batch="))

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        # Micro-batches are numbered without gaps, and one starts only after the one before
        # it was committed.
        before = self._entry(spark, batch_id - 1)
        held = self._sweep(before)
        rows.withColumn(self.ts, F.col(self.ts).cast("timestamp")).write.mode("overwrite").parquet(
            self._at("pending", batch_id))
        here = spark.read.parquet(self._at("pending", batch_id))
        micros = F.unix_micros(self.ts)
        span = here.agg(F.min(micros).alias("lo"), F.max(micros).alias("hi")).first()
        if before["bound"] is not None and span["lo"] is not None and span["lo"] < before["bound"]:
            here.filter(micros < before["bound"]).write.mode("overwrite").parquet(self._at("late", batch_id))
        tops = [t for t in (before["top"], span["hi"]) if t is not None]
        top, bound = max(tops, default=None), before["bound"]
        held.append((batch_id, span["hi"]))
        carry = before["carry"]
        if self.lateness is not None and top is not None:
            upto = top - self.lateness * 1_000_000
            if bound is None or upto > bound:
                self._release(spark, batch_id, held, carry, bound, upto)
                bound, carry = upto, batch_id
        self._commit(spark, batch_id, (bound, top, carry, held, False))

    def _sweep(self, before) -> list[tuple]:
        """Held files still needed; those of which every row was released go. The list is
        in the ledger, so no folder is searched."""
        kept = []
        for id, top in before["open"]:
            if before["bound"] is not None and top is not None and top < before["bound"]:
                drop_folder(self._at("pending", id))
            else:
                kept.append((id, top))
        return kept

    def _release(self, spark, batch_id, held, carry, lo, hi, last: bool = False) -> None:
        rows = spark.read.parquet(*[self._at("pending", id) for id, _ in held])
        micros = F.unix_micros(self.ts)
        if lo is not None:
            rows = rows.filter((micros >= lo) | F.col(self.ts).isNull())
        # Rows without a time come at the end of the data.
        rows = rows.filter((micros < hi) if not last else F.lit(True))
        out, carried = self.step(rows, spark.read.parquet(self._at("carry", carry)), last)
        out.write.mode("overwrite").parquet(self._at("out", batch_id))
        carried.write.mode("overwrite").parquet(self._at("carry", batch_id))
        if self.hook is not None:
            self.hook(spark.read.schema(self.step.output).parquet(self._at("out", batch_id)), batch_id)

    def finish(self, spark: SparkSession, slices: int = 1) -> None:
        """End of data: release what is held, in ``slices`` equal spans of time, so that a
        long backlog is not sorted at once. Doing it twice changes nothing."""
        at = self._last()
        entry = self._entry(spark, at)
        if entry["finished"]:
            return
        held, carry, bound, top = [tuple(o) for o in entry["open"]], entry["carry"], entry["bound"], entry["top"]
        if not held:
            return
        if top is not None:
            low = bound
            if low is None:
                rows = spark.read.parquet(*[self._at("pending", id) for id, _ in held])
                low = rows.agg(F.min(F.unix_micros(self.ts))).first()[0]
            for i in range(1, slices):
                at, upto = at + 1, low + (top - low) * i // slices
                self._release(spark, at, held, carry, bound, upto)
                bound, carry = upto, at
                self._commit(spark, at, (bound, top, carry, held, False))
        self._release(spark, at + 1, held, carry, bound, None, last=True)
        self._commit(spark, at + 1, (bound, top, at + 1, [], True))
        drop_folder(f"{self.root}/pending")

    def result(self, spark: SparkSession) -> DataFrame:
        """Rows put out so far."""
        return spark.read.schema(self.step.output).parquet(self.out).drop("batch")


def run(rows: DataFrame, sink, checkpoint: str, finite: bool = True) -> StreamingQuery:
    """Feed a stream to a ``foreachBatch`` target."""
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if finite else writer).start()

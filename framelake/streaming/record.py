"""Live recording: packets to roll-over files, exactly once and in order.

A step for ``InOrder``: each release is numbered with the distributed sort of the batch path
and continues the files of earlier ones. A file becomes a recording in the release that
completes it; the packets of open files, at most one file for each stream, are carried.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions.layout import Layout
from framelake.operators import assemble
from framelake.operators.joins import attach
from framelake.session import durable
from framelake.sources import recording
from framelake.streaming.inorder import InOrder
from framelake.streaming.jobs import STREAM, merged, with_eod


@dataclasses.dataclass
class RollOver:
    """Recordings of ``layout.blocks_per_file`` blocks below ``files``.

    Packets need not have distinct sequence numbers: they are numbered together with their
    payloads. A row flagged ``eod``, and the end of all data, closes the open file of a stream;
    blocks that were not filled stay out. A null stream id is a stream of its own.
    """

    files: str
    layout: Layout
    header_fields: dict
    carried = "stream_id string, seq bigint, arrival_ts timestamp, payload binary, done bigint"
    output = "stream_id string, file string, n_packets bigint"

    def __call__(self, rows: DataFrame, carry: DataFrame, last: bool):
        per_block = self.layout.send_n * self.layout.batches_per_block
        per_file = per_block * self.layout.blocks_per_file
        rows = with_eod(rows)
        data = rows.filter("NOT eod").select("stream_id", "seq", "arrival_ts", "payload")
        placed = assemble.position(carry.filter("done IS NULL").drop("done").unionByName(data))
        per_stream = merged(
            [placed.groupBy("stream_id").agg((F.max("pos") + 1).alias("total")),
             carry.filter("done IS NOT NULL").select("stream_id", "done"),
             rows.filter("eod").select("stream_id", F.lit(True).alias("ended")).distinct()],
            total=F.coalesce(F.max("total"), F.lit(0)), done=F.coalesce(F.max("done"), F.lit(0)),
            ended=F.coalesce(F.bool_or("ended"), F.lit(False)))
        ended = F.col("ended") | F.lit(last)
        unit = F.when(ended, F.lit(per_block)).otherwise(F.lit(per_file)).cast("bigint")
        upto = F.call_function("div", F.col("total"), unit) * unit
        per_stream = durable(per_stream.withColumn("_upto", upto).withColumn("_ended", ended))
        known = attach(placed, per_stream, STREAM, spread_by=["pos"], null_safe=True)
        full = known.filter("pos < _upto").withColumn(
            "file_id", F.col("done") + assemble.div(F.col("pos"), per_file))
        named = durable(full.groupBy("stream_id", "file_id").agg(
            F.min("arrival_ts").alias("first_ts"), F.count(F.lit(1)).alias("n_packets")).withColumn(
            "file", recording.file_name(F.col("stream_id"), F.col("first_ts"), F.col("file_id"))))
        # One name for each open or completed file, far fewer than packets.
        body = attach(full, named.select("stream_id", "file_id", "file"), ["stream_id", "file_id"],
                      "inner", spread_by=["pos"], null_safe=True).select(
            "file", assemble.div(F.col("pos"), per_block).alias("block_id"),
            F.pmod("pos", F.lit(per_block)).alias("ordinal"), "payload")
        heads = recording.headers_for(named, self.header_fields, self.layout)
        # A release that is repeated writes the same files again.
        recording.write(body, heads, self.files, self.layout, replace=True)
        files = F.col("done") + assemble.div(F.col("_upto") + (per_file - 1), per_file)
        rest = known.filter("pos >= _upto AND NOT _ended").select("stream_id", "seq", "arrival_ts", "payload")
        counts = per_stream.select("stream_id", files.alias("done"))
        return named.select("stream_id", "file", "n_packets"), rest.unionByName(counts, allowMissingColumns=True)


def recorder(spark: SparkSession, root: str, layout: Layout, header_fields: dict,
             lateness: int | None = None) -> InOrder:
    """Sink for a packet stream (stream_id, seq, arrival_ts, payload, and eod if there is one);
    recordings go to ``root``/files."""
    return InOrder(spark, root, RollOver(f"{root}/files", layout, header_fields), lateness=lateness)

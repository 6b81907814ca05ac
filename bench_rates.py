"""Packet and byte rates on a replicated event table, one JSON line.

Complements bench.py: rates instead of query times. BENCH_SF_DIR, BENCH_CPUS and
BENCH_COPIES (default 100) set the size; BENCH_RECORD_PACKETS (default 200000) the
number of 8256-byte packets written and read back.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from framelake import session
from framelake.functions import frames
from framelake.functions.layout import Layout
from framelake.operators import assemble, flows, metrics
from framelake.plans import views
from framelake.sources import packets as landing
from framelake.sources import recording

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
COPIES = int(os.environ.get("BENCH_COPIES", "100"))
RECORD_PACKETS = int(os.environ.get("BENCH_RECORD_PACKETS", "200000"))
# Where to leave the line for comparison with other runs.
RATES_FILE = os.environ.get("BENCH_RATES_FILE")
WIDE = Layout(pkt_header=64, pkt_data=8192, pkts_per_block=1024, send_n=64)


def timed(fn):
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session.build("rates", f"local[{CPUS}]", CPUS, extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": str(4 * CPUS)})
    spark.sparkContext.setLogLevel("ERROR")
    session.ship_package(spark)
    work = tempfile.mkdtemp(prefix="spark-")
    copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    base = views.packets(spark, SF_DIR).repartition(4 * CPUS)
    size = base.count()
    # Copies follow each other in time, as one long capture would.
    many = (base.withColumn("copy", copies)
            .withColumn("seq", F.col("seq") + F.col("copy").cast("bigint") * size)
            .withColumn("arrival_ts", F.col("arrival_ts") + F.make_dt_interval(days=F.col("copy") * 30)))
    raw = f"{work}/raw"
    frames.encode_packets(many).select("stream_id", "seq", "arrival_ts", "frame").write.parquet(raw)
    n = size * COPIES
    frame_bytes = spark.read.parquet(raw).agg(F.sum(F.octet_length("frame"))).first()[0]
    rates = {}

    def rate(name, packets, n_bytes, seconds):
        rates[name] = {"sec": round(seconds, 3), "packets_per_s": round(packets / seconds),
                       "gb_per_s": round(n_bytes / seconds / 1e9, 3)}

    rate("decode", n, frame_bytes, timed(lambda: noop(
        frames.decode(spark.read.parquet(raw)).select("seq", *flows.FLOW, "eth_type", "payload"))))
    rate("filter_then_decode", n, frame_bytes, timed(lambda: noop(
        frames.decode(flows.match_frames(spark.read.parquet(raw), views.ONE_RULE)))))
    landed = f"{work}/landed"
    rate("land_decoded", n, frame_bytes,
         timed(lambda: landing.land(spark.read.parquet(raw), landed)))
    rate("filter_landed", n, frame_bytes,
         timed(lambda: noop(flows.match(spark.read.parquet(landed), views.ONE_RULE).select("seq"))))
    arrivals = spark.read.parquet(raw).select("stream_id", "seq", "arrival_ts")
    rate("block_assembly", n, n * views.TINY.pkt_size,
         timed(lambda: noop(assemble.blocks(assemble.position(arrivals), views.TINY))))
    rate("throughput", n, n * views.ALIGNED.pkt_size,
         timed(lambda: noop(metrics.throughput(arrivals, views.ALIGNED, 3600))))

    per_block = WIDE.send_n * WIDE.batches_per_block
    per_file = per_block * WIDE.blocks_per_file
    seq = F.col("id")
    body = spark.range(RECORD_PACKETS // per_block * per_block).select(
        F.concat(F.lit("f"), assemble.div(seq, per_file).cast("string")).alias("file"),
        assemble.div(seq, per_block).alias("block_id"), (seq % per_block).alias("ordinal"),
        F.repeat(F.md5(seq.cast("string").cast("binary")), WIDE.pkt_size // 32)
        .cast("binary").alias("payload"))
    stored = f"{work}/payloads"
    body.write.parquet(stored)
    body = spark.read.parquet(stored)
    heads = body.select("file", F.lit(b"NANT 1\n").alias("header")).distinct()
    k = body.count()
    out = f"{work}/recordings"
    # Starts the Python workers of both directions.
    recording.write(body.filter("block_id = 0"), heads.filter("file = 'f0'"), f"{work}/warm", WIDE)
    noop(recording.read(spark, f"{work}/warm", WIDE))
    rate("recording_write", k, k * WIDE.pkt_size,
         timed(lambda: recording.write(body, heads, out, WIDE)))
    rate("recording_read", k, k * WIDE.pkt_size,
         timed(lambda: noop(recording.read(spark, out, WIDE))))
    line = json.dumps({"metric": "rates", "cpus": CPUS, "packets": n, "rates": rates})
    print(line)
    if RATES_FILE:
        with open(RATES_FILE, "w") as out:
            out.write(line + "\n")
    spark.stop()


if __name__ == "__main__":
    main()

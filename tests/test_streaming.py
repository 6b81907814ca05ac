"""Streams give what the batch operators give over the same packets, however these land."""

import os
import random

import pytest
from pyspark.sql import functions as F

from framelake import session
from framelake.functions.layout import Layout, TINY
from framelake.operators import assemble, chained, metrics
from framelake.plans import views
from framelake.sources import packets as landing
from framelake.sources import recording
from framelake.streaming import jobs
from framelake.streaming.inorder import InOrder, run
from framelake.streaming.record import RollOver, recorder

RECORDED = Layout(pkt_header=4, pkt_data=5, pkts_per_block=11, send_n=5, blocks_per_file=4)
FIELDS = {**views.HEADER_FIELDS, "pkt_header": 4, "pkt_data": 5}
DAY = 86400


def land(df, folder, files, order, seed=None):
    """Land rows as several files; modification times follow the row order, or are shuffled."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(folder, exist_ok=True)
    table = df.orderBy(*order).toArrow()
    step = max(1, -(-table.num_rows // files))
    start = len(os.listdir(folder))
    times = list(range(files))
    if seed is not None:
        random.Random(seed).shuffle(times)
    for i in range(files):
        name = os.path.join(folder, f"part-{start + i:04d}.parquet")
        pq.write_table(pa.table(table.slice(i * step, step)), name, coerce_timestamps="us")
        os.utime(name, (1_700_000_000 + start + times[i],) * 2)


@pytest.fixture(scope="module")
def arrivals(spark, sf):
    return views.packets(spark, sf).select(
        "stream_id", "seq", F.col("arrival_ts").cast("timestamp").alias("arrival_ts"), "payload")


@pytest.fixture(scope="module")
def landed(arrivals, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landing"))
    land(arrivals, folder, 6, ["arrival_ts", "seq"])
    return folder


def drain(df, tmp_path, step, ts="arrival_ts", lateness=None, slices=1, name="out"):
    spark = df.sparkSession
    sink = InOrder(spark, str(tmp_path / name), step, ts, lateness)
    run(df, sink, str(tmp_path / f"{name}-checkpoint")).awaitTermination()
    sink.finish(spark, slices)
    return sink.result(spark)


def rows_of(df):
    columns = sorted(df.columns)
    return columns, sorted(map(repr, df.select(*columns).collect()))


def same(left, right):
    a, b = rows_of(left), rows_of(right)
    assert a == b and a[1]


@pytest.mark.parametrize("files, per_trigger, slices", [(1, 1, 1), (8, 8, 3), (40, 8, 2)])
def test_order_of_files_does_not_matter(spark, arrivals, tmp_path, files, per_trigger, slices):
    folder = str(tmp_path / "in")
    land(arrivals, folder, files, ["arrival_ts", "seq"], seed=files)
    wide = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with session.settings(spark, wide):
        got = drain(landing.follow(spark, folder, arrivals.schema, per_trigger), tmp_path,
                    jobs.batches(TINY), slices=slices)
        same(jobs.as_batches(got, TINY).drop("is_complete"),
             assemble.batches(assemble.position(arrivals), TINY).drop("last_ts"))


def test_released_as_the_watermark_passes(spark, arrivals, landed, tmp_path):
    stream = landing.follow(spark, landed, arrivals.schema, 2)
    sink = InOrder(spark, str(tmp_path / "o"), jobs.blocks(TINY), lateness=DAY)
    run(stream, sink, str(tmp_path / "c")).awaitTermination()
    before = sink.result(spark).count()
    want = assemble.blocks(assemble.position(arrivals), TINY)
    assert 0 < before < want.count()
    # What was released is no longer held.
    held = [n for n in os.listdir(tmp_path / "o" / "pending") if n.startswith("batch=")]
    sink.finish(spark)
    sink.finish(spark)
    same(jobs.as_blocks(sink.result(spark), TINY), want)
    assert len(held) <= 3 and not os.path.exists(tmp_path / "o" / "pending")


def test_late_rows_are_kept_aside(spark, arrivals, tmp_path):
    folder = str(tmp_path / "in")
    land(arrivals.filter("seq >= 500"), folder, 1, ["seq"])
    land(arrivals.filter("seq < 500"), folder, 1, ["seq"])
    got = drain(landing.follow(spark, folder, arrivals.schema, 1), tmp_path, jobs.batches(TINY), lateness=60)
    late = spark.read.parquet(str(tmp_path / "out" / "late"))
    held = assemble.position(arrivals.join(late.select("stream_id", "seq"), ["stream_id", "seq"], "left_anti"))
    assert late.count() == 500
    same(jobs.as_batches(got, TINY).drop("is_complete"), assemble.batches(held, TINY).drop("last_ts"))


def test_repeated_attempt_changes_nothing(spark, arrivals, tmp_path):
    sink = InOrder(spark, str(tmp_path / "o"), jobs.batches(TINY), lateness=DAY)
    first, second = arrivals.filter("seq < 500"), arrivals.filter("seq >= 500")
    for batch_id, part in ((0, first), (1, second), (1, second)):
        sink(part, batch_id)
    sink.finish(spark)
    same(jobs.as_batches(sink.result(spark), TINY).drop("is_complete"),
         assemble.batches(assemble.position(arrivals), TINY).drop("last_ts"))


def test_end_of_data_releases_the_tail(spark, arrivals, tmp_path):
    folder = str(tmp_path / "in")
    flagged = arrivals.drop("payload").withColumn("eod", F.lit(False))
    ends = flagged.select("stream_id").distinct().select(
        "stream_id", F.lit(None).cast("bigint").alias("seq"),
        F.lit(None).cast("timestamp").alias("arrival_ts"), F.lit(True).alias("eod"))
    land(ends, folder, 1, ["stream_id"])
    land(flagged, folder, 2, ["arrival_ts", "seq"])
    got = drain(landing.follow(spark, folder, flagged.schema, 1), tmp_path, jobs.batches(TINY), slices=2)
    same(jobs.as_batches(got, TINY),
         assemble.batches(assemble.position(arrivals), TINY, keep_tail=True).drop("last_ts"))


def test_throughput(spark, arrivals, landed, tmp_path):
    sink = jobs.WindowCounts(spark, str(tmp_path / "o"), TINY, 3600)
    run(landing.follow(spark, landed, arrivals.schema, 1), sink, str(tmp_path / "c")).awaitTermination()
    same(sink.result(spark), metrics.throughput(arrivals, TINY, 3600))


@pytest.fixture(scope="module")
def ring(spark, sf):
    return views.ring_log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))


def test_occupancy_and_progress(spark, ring, tmp_path):
    land(ring, str(tmp_path / "in"), 5, ["block_id", "stream_id"], seed=1)
    got = drain(landing.follow(spark, str(tmp_path / "in"), ring.schema, 2), tmp_path,
                jobs.Occupancy(TINY), "ts", slices=3)
    want = metrics.occupancy(ring, TINY)
    same(got, want)
    status = want.filter("kind = 'filled'").select("stream_id", "ts", "block_id", "fill_pct")
    land(status, str(tmp_path / "status"), 3, ["block_id", "stream_id"], seed=2)
    step = jobs.Progress(3 * DAY, {"block_id": "bigint", "fill_pct": "double"}, ["ts", "block_id"])
    kept = drain(landing.follow(spark, str(tmp_path / "status"), status.schema, 1), tmp_path, step, "ts",
                 slices=4, name="progress")
    same(kept, chained.progress_exact(status, 3 * DAY, ["block_id", "fill_pct"], ["ts", "block_id"]))


def test_dwell(spark, ring, tmp_path):
    split = {k: ring.filter(F.col("kind") == k) for k in ("filled", "cleared")}
    late = ring.agg(F.max("ts")).first()[0]
    for kind, rows in split.items():
        # A last event far in the future moves the watermark past all others.
        last = spark.createDataFrame([("zz", 0, late, kind)], ring.schema).withColumn(
            "ts", F.col("ts") + F.expr("interval 90 days"))
        land(rows, str(tmp_path / kind), 2, ["ts"])
        land(last, str(tmp_path / kind), 1, ["ts"])
    streams = [landing.follow(spark, str(tmp_path / k), ring.schema, 1) for k in split]
    out = str(tmp_path / "out")
    jobs.start(jobs.dwell(*streams, "1 hour", "5 days"), out, str(tmp_path / "c")).awaitTermination()
    same(spark.read.parquet(out).filter("stream_id <> 'zz'"), metrics.dwell(ring))


def test_pack_variable(spark, sf, tmp_path):
    order = ["ts", "l_orderkey", "l_linenumber", "size"]
    records = views.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("stream_id"), F.col("l_shipdate").cast("timestamp").alias("ts"),
        "l_orderkey", "l_linenumber", (F.lit(16) + F.col("l_quantity").cast("bigint") * 8).alias("size"),
        F.lit(False).alias("eod"))
    ends = records.select("stream_id").distinct().select(
        "stream_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("ts", "timestamp"), ("l_orderkey", "bigint"), ("l_linenumber", "int"), ("size", "bigint"))],
        F.lit(True).alias("eod"))
    land(ends, str(tmp_path / "in"), 1, ["stream_id"])
    land(records, str(tmp_path / "in"), 4, ["l_orderkey"], seed=3)
    got = drain(landing.follow(spark, str(tmp_path / "in"), records.schema, 2), tmp_path,
                jobs.Packing(4000, order), "ts", slices=3)
    same(got, chained.pack_variable(records, 4000, "stream_id", order, "size"))


def test_block_hook(spark, arrivals, landed, tmp_path):
    seen = {}
    sink = InOrder(spark, str(tmp_path / "out"), jobs.blocks(TINY), lateness=DAY,
                   hook=lambda df, release: seen.update({release: df.filter("is_complete").count()}))
    run(landing.follow(spark, landed, arrivals.schema, 2), sink, str(tmp_path / "c")).awaitTermination()
    before_end = sum(seen.values())
    sink.finish(spark)
    every = assemble.blocks(assemble.position(arrivals), TINY).count()
    assert sum(seen.values()) == every and len(seen) > 1 and 0 < before_end < every


def test_recording_rolls_over(spark, arrivals, tmp_path):
    # Ids that no path may hold, none at all, and sequence numbers that repeat.
    named = {"click": "a/b_c", "view": None, "purchase": ""}
    stream = F.col("stream_id")
    for old, new in named.items():
        stream = F.when(F.col("stream_id") == old, F.lit(new)).otherwise(stream)
    rows = arrivals.filter(F.octet_length("payload") == 9).withColumns(
        {"stream_id": stream, "seq": F.col("seq") % 10})
    land(rows.withColumn("eod", F.lit(False)), str(tmp_path / "in"), 6, ["arrival_ts"])
    schema = rows.withColumn("eod", F.lit(False)).schema
    sink = recorder(spark, str(tmp_path / "rec"), RECORDED, FIELDS, lateness=DAY)
    run(landing.follow(spark, str(tmp_path / "in"), schema, 2), sink, str(tmp_path / "c")).awaitTermination()
    positioned = assemble.position(rows)
    whole = assemble.files(assemble.blocks(positioned, RECORDED), RECORDED).filter("complete").count()
    assert 5 < len(os.listdir(sink.step.files)) <= whole
    sink.finish(spark)
    sink.finish(spark)
    per_block = RECORDED.send_n * RECORDED.batches_per_block
    got = recording.read(spark, sink.step.files, RECORDED).select(
        recording.stream_of(F.col("file")).alias("stream_id"),
        (recording.file_number(F.col("file")) * 4 + F.col("block_index")).alias("block_id"),
        F.col("packet_index").alias("ordinal"), "payload")
    totals = positioned.groupBy("stream_id").agg((F.max("pos") + 1).alias("n")).withColumnRenamed("stream_id", "s")
    want = positioned.join(totals, F.col("stream_id").eqNullSafe(F.col("s"))).filter(
        assemble.div(F.col("pos"), per_block) < assemble.div(F.col("n"), per_block)).select(
        "stream_id", assemble.div(F.col("pos"), per_block).alias("block_id"),
        F.pmod("pos", F.lit(per_block)).alias("ordinal"), "payload")
    same(got, want)


def test_end_of_a_stream_closes_its_file(spark, arrivals, tmp_path):
    rows = arrivals.filter(F.octet_length("payload") == 9).withColumn("eod", F.lit(False))
    sink = recorder(spark, str(tmp_path / "rec"), RECORDED, FIELDS, lateness=0)
    first = rows.filter("seq < 400")
    end = first.groupBy("stream_id").agg(F.max("arrival_ts").alias("arrival_ts")).filter(
        "stream_id = 'click'").select("stream_id", F.lit(None).cast("bigint").alias("seq"), "arrival_ts",
                                      F.lit(None).cast("binary").alias("payload"), F.lit(True).alias("eod"))
    sink(first.unionByName(end), 0)
    sink(rows.filter("seq >= 400 AND stream_id <> 'click'"), 1)
    closed = recording.read(spark, sink.step.files, RECORDED, "header").filter(
        recording.stream_of(F.col("file")) == "click").count()
    blocks = assemble.blocks(assemble.position(first.filter("stream_id = 'click'")), RECORDED).count()
    assert closed == -(-blocks // RECORDED.blocks_per_file)


def test_appending_does_not_replace(spark, arrivals, tmp_path):
    path = str(tmp_path / "rec")
    step = RollOver(path, RECORDED, FIELDS)
    rows = arrivals.filter("seq < 300 AND octet_length(payload) = 9")
    empty = spark.createDataFrame([], step.carried)
    out, _ = step(rows, empty, True)
    named = out.select("file", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("first_ts"))
    heads = recording.headers_for(named, FIELDS, RECORDED)
    body = recording.read(spark, path, RECORDED).select(
        "file", F.col("block_index").alias("block_id"), F.col("packet_index").alias("ordinal"), "payload")
    body = session.durable(body.withColumn("file", F.regexp_replace("file", r"\.rec$", "")))
    with pytest.raises(Exception, match="exist already"):
        recording.write(body, heads, path, RECORDED)
    recording.write(body, heads, path, RECORDED, replace=True)
    assert recording.read(spark, path, RECORDED).count() == body.count()

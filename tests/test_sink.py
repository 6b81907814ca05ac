"""Recording as a streaming sink."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framelake.functions.layout import Layout
from framelake.plans import views
from framelake.sources import feed, recording
from framelake.streaming import sink

LAYOUT = Layout(pkt_header=4, pkt_data=4, pkts_per_block=11, send_n=5, blocks_per_file=3)
PER_BLOCK, PER_FILE = 10, 30
FIELDS = {**views.HEADER_FIELDS, "pkt_header": 4, "pkt_data": 4}


def packets(spark, n, stream="s/1", start=0):
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    return spark.range(start, n).select(
        F.lit(stream).alias("stream_id"), F.col("id").alias("seq"), ts.alias("arrival_ts"),
        F.encode(F.lpad(F.col("id").cast("string"), 8, "0"), "UTF-8").alias("payload"))


def follow(spark, tmp_path, df, max_bytes=1000):
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return feed.follow(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "files"), max_bytes)


def recorded(spark, path):
    rows = recording.read(spark, path, LAYOUT).select(
        recording.file_number(F.col("file")).alias("f"), "block_index", "packet_index",
        F.decode("payload", "UTF-8").cast("int").alias("v")).collect()
    return sorted((r.f * PER_FILE + r.block_index * PER_BLOCK + r.packet_index, r.v) for r in rows)


def record(spark, tmp_path, df):
    path = str(tmp_path / "rec")
    query = sink.start(sink.place(follow(spark, tmp_path, df), LAYOUT), path, str(tmp_path / "checkpoint"))
    feed.drain(query)
    return path, query


def test_files_are_sealed_as_they_fill_and_close_at_the_end(spark, tmp_path):
    path, query = record(spark, tmp_path, packets(spark, 97))
    assert sum(1 for p in query.recentProgress if p.numInputRows) > 2
    assert sink.seal(spark, path, LAYOUT, FIELDS).count() == 3
    assert recorded(spark, path) == [(i, i) for i in range(90)]
    assert sink.seal(spark, path, LAYOUT, FIELDS).count() == 0
    record(spark, tmp_path, packets(spark, 145, start=97))
    sink.seal(spark, path, LAYOUT, FIELDS, last=True)
    # Five packets of the last block are not recorded.
    assert recorded(spark, path) == [(i, i) for i in range(140)]
    assert not os.listdir(os.path.join(path, "_live", "parts"))
    head = recording.read(spark, path, LAYOUT, "header").orderBy("file").first()
    assert "2023-11-14-22:13:20" in head.header_text
    assert {recording_stream for recording_stream, in recording.read(spark, path, LAYOUT, "header").select(
        recording.stream_of(F.col("file"))).collect()} == {"s/1"}


def batch(spark, n, start=0):
    rows = sink.place(packets(spark, n, start=start), LAYOUT).toArrow()
    return pa.RecordBatch.from_pydict({c: rows[c].combine_chunks() for c in rows.column_names})


def test_a_task_killed_before_the_commit_leaves_nothing_twice(spark, tmp_path):
    writer = sink.LiveWriter({"path": str(tmp_path)})
    half = batch(spark, 30)
    writer.write(iter([half]))                                 # killed: its message never arrives
    again = writer.write(iter([half.slice(0, 10), half.slice(10)]))
    writer.commit([again, None], 0)
    assert sink.manifest(spark, str(tmp_path)).agg(F.sum("packets")).first()[0] == 30
    sink.seal(spark, str(tmp_path), LAYOUT, FIELDS)
    assert recorded(spark, str(tmp_path)) == [(i, i) for i in range(30)]


def test_an_epoch_that_is_run_again_counts_once(spark, tmp_path):
    writer = sink.LiveWriter({"path": str(tmp_path)})
    for _ in range(2):
        writer.commit([writer.write(iter([batch(spark, 30)]))], 0)
    aborted = writer.write(iter([batch(spark, 60, start=30)]))
    writer.abort([aborted], 1)
    assert len(os.listdir(tmp_path / "_live" / "parts")) == 1
    sink.seal(spark, str(tmp_path), LAYOUT, FIELDS)
    assert recorded(spark, str(tmp_path)) == [(i, i) for i in range(30)]


def test_a_seal_that_was_interrupted_is_repeated(spark, tmp_path, monkeypatch):
    writer = sink.LiveWriter({"path": str(tmp_path)})
    writer.commit([writer.write(iter([batch(spark, 35)]))], 0)
    write = recording.write

    def write_and_stop(*args, **options):
        write(*args, **options)
        raise RuntimeError("stopped")

    monkeypatch.setattr(recording, "write", write_and_stop)
    with pytest.raises(RuntimeError):
        sink.seal(spark, str(tmp_path), LAYOUT, FIELDS)
    monkeypatch.setattr(recording, "write", write)
    sink.seal(spark, str(tmp_path), LAYOUT, FIELDS)
    assert recorded(spark, str(tmp_path)) == [(i, i) for i in range(30)]


def test_packets_recorded_twice_are_refused(spark, tmp_path):
    writer = sink.LiveWriter({"path": str(tmp_path)})
    for epoch in (0, 1):
        writer.commit([writer.write(iter([batch(spark, 30)]))], epoch)
    with pytest.raises(ValueError, match="more than 10 packets"):
        sink.seal(spark, str(tmp_path), LAYOUT, FIELDS)


def test_a_gap_ends_a_file_when_the_stream_has_ended(spark, tmp_path):
    writer = sink.LiveWriter({"path": str(tmp_path)})
    rows = batch(spark, 30)
    writer.commit([writer.write(iter([rows.slice(0, 14), rows.slice(15)]))], 0)
    assert sink.seal(spark, str(tmp_path), LAYOUT, FIELDS).count() == 0
    sink.seal(spark, str(tmp_path), LAYOUT, FIELDS, last=True)
    assert recorded(spark, str(tmp_path)) == [(i, i) for i in range(10)]


def test_nulls(spark, tmp_path):
    placed = sink.place(packets(spark, 30, stream=None), LAYOUT)
    assert placed.filter("file IS NULL").count() == 0
    writer = sink.LiveWriter({"path": str(tmp_path)})
    writer.commit([writer.write(iter([]))], 0)
    assert sink.seal(spark, str(tmp_path), LAYOUT, FIELDS, last=True).count() == 0
    bad = batch(spark, 5)
    bad = bad.set_column(4, "payload", pa.array([None] * 5, pa.binary()))
    with pytest.raises(ValueError, match="without a file or a payload"):
        writer.write(iter([bad]))

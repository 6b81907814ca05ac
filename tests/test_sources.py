"""Recordings, header files, logs and landing areas."""

import os

import pytest
from pyspark.sql import functions as F

from framelake.functions import frames, header
from framelake.functions.layout import Layout
from framelake.operators import flows
from framelake.plans import views
from framelake.session import settings
from framelake.sources import headers, logs, packets, recording
from test_functions import FULL, SHORT

SMALL = Layout(pkt_header=4, pkt_data=6, pkts_per_block=11, send_n=5, nbufs=3, blocks_per_file=4)


def placed(spark, n_files=3, n_blocks=4):
    per_block = SMALL.send_n * SMALL.batches_per_block
    rows = [(f"f{f}", b, o, bytes([f, b, o]) + b"x" * 7)
            for f in range(n_files) for b in range(n_blocks) for o in range(per_block)]
    body = spark.createDataFrame(rows, "file string, block_id int, ordinal int, payload binary")
    heads = spark.createDataFrame([(f"f{f}", FULL.encode()) for f in range(n_files)],
                                  "file string, header binary")
    return body.orderBy(F.rand(1)), heads


def test_round_trip_and_file_shape(spark, tmp_path):
    path = str(tmp_path)
    body, heads = placed(spark)
    recording.write(body, heads, path, SMALL)
    assert sorted(os.listdir(path)) == ["f0.rec", "f1.rec", "f2.rec"]
    raw = (tmp_path / "f1.rec").read_bytes()
    assert len(raw) == 4096 + 4 * SMALL.block_bytes
    assert raw[:4096].rstrip(b"\0").decode() == FULL
    assert raw[4096:4099] == b"\x01\x00\x00" and raw[4096 + 100:4096 + 110] == bytes(10)
    back = recording.read(spark, path, SMALL)
    want = {(f"{r['file']}.rec", r["block_id"], r["ordinal"], bytes(r["payload"])) for r in body.collect()}
    got = [(r["file"], r["block_index"], r["packet_index"], bytes(r["payload"])) for r in back.collect()]
    assert set(got) == want and len(got) == len(want)
    tight = recording.read(spark, path, SMALL, split_bytes=1)
    assert tight.count() == len(want) and tight.rdd.getNumPartitions() == 12


def test_large_blocks_are_read_in_pieces(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    body, heads = placed(spark)
    recording.write(body, heads, path, SMALL)
    whole = sorted(recording.read(spark, path, SMALL).collect())
    reader = recording.RecordingReader({
        "path": path, "block_bytes": SMALL.block_bytes, "pkt_size": 10, "pkts_per_block": 10})
    monkeypatch.setattr(recording, "BATCH_BYTES", 30)
    pieces = [tuple(row.values()) for split in reader.partitions()
              for batch in reader.read(split) for row in batch.to_pylist()]
    assert sorted(pieces) == [(r[0], r[1], r[2], bytes(r[3])) for r in whole]


def test_short_packets_come_in_batches_of_bounded_size(spark, tmp_path, monkeypatch):
    """What a row takes beside its few bytes of payload counts too, in writing and in reading."""
    monkeypatch.setattr(recording, "BATCH_BYTES", 1000)
    path = str(tmp_path)
    body, heads = placed(spark)
    recording.write(body, heads, path, SMALL)
    reader = recording.RecordingReader({
        "path": path, "block_bytes": SMALL.block_bytes, "pkt_size": 10, "pkts_per_block": 10})
    sizes = [batch.nbytes for split in reader.partitions() for batch in reader.read(split)]
    assert sum(sizes) > 2000 and max(sizes) <= 1000
    assert recording.batch_rows(9) * (9 + 40) < recording.BATCH_BYTES


def test_block_header_and_range_views(spark, tmp_path):
    path = str(tmp_path)
    body, heads = placed(spark)
    recording.write(body, heads, path, SMALL)
    blocks = recording.read(spark, path, SMALL, "block")
    assert blocks.count() == 12 and len(blocks.first()["payload"]) == SMALL.block_bytes
    head = recording.read(spark, path, SMALL, "header").orderBy("file").first()
    assert (head["file"], head["n_blocks"], head["file_bytes"]) == ("f0.rec", 4, 4096 + 440)
    assert header.parse(spark.createDataFrame([head])).first()["pkt_data"] == 8192
    some = recording.read(spark, path, SMALL, blocks="1-2")
    assert {r["block_index"] for r in some.collect()} == {1, 2}
    one = recording.read(spark, os.path.join(path, "f2.rec"), SMALL)
    assert {r["file"] for r in one.collect()} == {"f2.rec"}


def test_filters_limit_what_is_read(spark, tmp_path):
    path = str(tmp_path)
    body, heads = placed(spark)
    recording.write(body, heads, path, SMALL)
    with settings(spark, {"spark.sql.python.filterPushdown.enabled": "true"}):
        rows = recording.read(spark, path, SMALL, split_bytes=1)
        assert rows.rdd.getNumPartitions() == 12
        some = rows.filter("file in ('f0.rec', 'f2.rec') and block_index > 1 and block_index <= 2")
        assert some.rdd.getNumPartitions() == 2 and some.count() == 20
        assert rows.filter("block_index = 3").rdd.getNumPartitions() == 3
        assert rows.filter("file = 'none'").count() == 0


def test_overwrite_append_and_slot_order(spark, tmp_path):
    path = str(tmp_path)
    body, heads = placed(spark)
    recording.write(body, heads, path, SMALL)
    again = body.filter("file = 'f0'"), heads.filter("file = 'f0'")
    with pytest.raises(Exception, match="exist already"):
        recording.write(*again, path, SMALL)
    recording.write(*again, path, SMALL, replace=True)
    assert len(os.listdir(path)) == 3
    recording.write(body.filter("file = 'f1'"), heads.filter("file = 'f1'"), path, SMALL,
                    mode="overwrite", order_by="slot")
    assert os.listdir(path) == ["f1.rec"]
    raw = (tmp_path / "f1.rec").read_bytes()[4096:]
    # Three slots: blocks 0 and 3 share the first one.
    assert [raw[i * 110 + 1] for i in range(4)] == [0, 3, 1, 2]


def test_failed_write_leaves_nothing(spark, tmp_path):
    body, heads = placed(spark)
    bad = body.withColumn("payload", F.concat("payload", "payload"))
    with pytest.raises(Exception, match="more than"):
        recording.write(bad, heads, str(tmp_path), SMALL)
    with pytest.raises(Exception, match="without payload"):
        recording.write(body.withColumn("payload", F.lit(None).cast("binary")), heads,
                        str(tmp_path), SMALL)
    assert [n for n in os.listdir(tmp_path) if n.endswith(".rec")] == []


def test_names_with_colons(spark, tmp_path):
    body, heads = placed(spark, 1)
    recording.write(body, heads, str(tmp_path), SMALL)
    os.rename(tmp_path / "f0.rec", tmp_path / "2026-02-10-12:00:00.rec")
    assert recording.read(spark, str(tmp_path), SMALL).count() == 40


def test_header_files(spark, tmp_path):
    for name, text in {"a.txt": FULL, "b.txt": SHORT, "c.txt": FULL.replace("NANT  ", "NANT\t")}.items():
        (tmp_path / name).write_text(text)
    good, bad = headers.read(spark, str(tmp_path))
    assert good.count() == 2 and {r["nant"] for r in good.collect()} == {4}
    assert [len(r["missing_keys"]) for r in bad.collect()] == [8]
    out = str(tmp_path / "out")
    stamped = good.limit(1).withColumns({
        "file_size": F.lit(10).cast("bigint"), "mjd_start": F.lit(61081.5), "utc_start": F.lit("x")})
    headers.write_text(stamped, out, "key")
    text = headers.read_text(spark, out).first()["header_text"]
    assert text.startswith("HDR_VERSION         1.0\nHDR_SIZE            4096\nNANT                4\n")


LOG = """
Run started at: 2026-02-10 12:00:00
[WARN] sample warning
[Progress] Blocks written: 10 | Ring buffer: 25.3% full (256/1024 MB)
NowTime:year:2026,gpu_id:0,total_recv:1234    KB,Process Bandwidth: 16.512 Gbps,cost time:1000ms
total_recv: 0          Bandwidth: 0 Gbps, cost time us_elapsed: 1000123
Run ended at: 2026-02-10 12:01:00
Run started at: 2026-02-10 13:00:00
[ERROR] sample error
[Progress] Blocks written: 20 | Ring buffer: 5.0.1% full (512/1024 MB)
Run started at: 2026-13-10 13:00:00
[Progress] Blocks written: 99999999999999999999 | Ring buffer: 1% full (1/2 MB)
bytes_read : 77
[Progress] Blocks written: 20 | Ring buffer: 50.1% full (512/1024 MB)
"""


def test_log_files(spark, tmp_path):
    (tmp_path / "a.log").write_text(LOG)
    (tmp_path / "b.log").write_text("[DEBUG] x\n" + LOG)
    rows = logs.read(spark, str(tmp_path)).filter("kind <> 'other'").orderBy("file", "block", "line").collect()
    first = [r for r in rows if r["file"].endswith("a.log")]
    assert [(r["kind"], r["run_id"]) for r in first] == [
        ("started", 1), ("warn", 1), ("progress", 1), ("bandwidth", 1), ("idle", 1), ("ended", 1),
        ("started", 2), ("error", 2), ("snapshot", 2), ("progress", 2)]
    assert (first[8]["counter"], first[8]["amount"]) == ("bytes_read", 77)
    assert (first[2]["blocks"], first[2]["fill_pct"], first[2]["used_mb"], first[2]["total_mb"]) == (
        10, 25.3, 256, 1024)
    assert (first[3]["kb"], first[3]["gbps"], first[3]["elapsed_ms"]) == (1234, 16.512, 1000)
    assert (first[4]["kb"], first[4]["gbps"], first[4]["elapsed_ms"]) == (0, 0.0, 1000)
    assert rows[len(first)]["kind"] == "debug" and rows[len(first)]["run_id"] == 0


def test_large_log_is_split(spark, tmp_path):
    lines = []
    for i in range(3000):
        lines.append("Run started at: 2026-02-10 12:00:00" if i % 100 == 0
                     else f"[Progress] Blocks written: {i} | Ring buffer: 1.0% full (1/2 MB)")
    (tmp_path / "big.log").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert logs.read_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 4
        rows = logs.read(spark, str(tmp_path)).filter("kind = 'progress'").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 2970 and all(r["run_id"] == r["blocks"] // 100 + 1 for r in rows)


def test_snapshot_text(spark):
    text = ("header_state   : full\nblocks_in_use  : 5\nbytes_written  : 4000 (4 kB)\n"
            "bytes_read\t: 1200\nbytes_available : 0\n")
    row = logs.parse_snapshot(spark.createDataFrame([(text,)], "value string")).first()
    assert list(row)[1:] == ["full", 5, 4000, 1200, 0]


@pytest.mark.parametrize("by_day", [False, True])
def test_landed_frames_prune(spark, sf, tmp_path, by_day):
    path = str(tmp_path / "land")
    framed = frames.encode_packets(views.packets(spark, sf)).select(
        "stream_id", "seq", "arrival_ts", "frame")
    packets.land(framed, path, by_day=by_day)
    landed = packets.read(spark, path)
    want = flows.match(views.packets(spark, sf), views.ONE_RULE).count()
    found = flows.match(landed, views.ONE_RULE)
    assert found.count() == want > 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = found.select("seq")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = plan[plan.index("ReadSchema"):]
    assert "EqualTo(src_port,60000)" in plan and "frame" not in read and "payload" not in read

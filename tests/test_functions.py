"""Worked figures, round trips and malformed input for the column functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from framelake.functions import address, frames, header, layout, timestamps
from framelake.functions.layout import ALIGNED, TINY, UNALIGNED, Layout


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_worked_layouts():
    assert (ALIGNED.batch_bytes, ALIGNED.block_bytes) == (528384, 135266304)
    assert (ALIGNED.batches_per_block, ALIGNED.pad_bytes) == (256, 0)
    assert (UNALIGNED.batch_bytes, UNALIGNED.block_bytes) == (508032, 132120576)
    assert (UNALIGNED.batches_per_block, UNALIGNED.pad_bytes) == (260, 32256)
    assert (TINY.batch_bytes, TINY.block_bytes, TINY.batches_per_block, TINY.pad_bytes) == (
        1280, 4000, 3, 160)
    assert ALIGNED.ring_bytes == 1082130432 and ALIGNED.file_bytes == 1352663040
    assert Layout(42, 6414, 64, 64).block_bytes == 413184
    assert (135266304 // 532480, 135266304 % 532480) == (254, 16384)
    with pytest.raises(ValueError):
        Layout(16, 64, 50, 64)


def test_layout_table(spark):
    rows = spark.createDataFrame(
        [("aligned", 64, 8192, 16384, 64), ("unaligned", 64, 8000, 16384, 63),
         ("ring example", 8, 4096, 64, 64), ("too large", 16, 64, 50, 64),
         ("empty batch", 16, 64, 50, 0)],
        "name string, pkt_header int, pkt_data int, pkts_per_block int, send_n int").withColumns(
        {"nbufs": F.lit(8), "blocks_per_file": F.lit(10)})
    planned = layout.plan(rows)
    got = {r["name"]: (r["n_batches"], r["pad_bytes"], r["aligned"], r["rejected"])
           for r in planned.collect()}
    assert got == {"aligned": (256, 0, True, False), "unaligned": (260, 32256, False, False),
                   "ring example": (1, 0, True, False), "too large": (0, None, False, True),
                   "empty batch": (0, None, False, True)}
    assert [r["name"] for r in layout.misaligned(planned).collect()] == ["unaligned"]
    assert layout.oversized(planned).count() == 2


@pytest.mark.parametrize("field,bad,good", [
    ("pkt_size", 64, 65), ("send_n", 7, 8), ("gpu_id", 6, 5), ("device_id", 4, 3),
    ("cpu", 384, 383), ("src_ip", "", "10.0.0.1"), ("dst_mac", None, "00:00:00:00:00:01")])
def test_config_limits(spark, field, bad, good):
    base = {"pkt_size": 8256, "send_n": 64, "gpu_id": 0, "device_id": 0, "cpu": -1, "nsge": 0,
            "mode": "receive", "src_mac": "a", "dst_mac": "b", "src_ip": "c", "dst_ip": "d",
            "src_port": "1", "dst_port": "2"}
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in base.items())
    rows = spark.createDataFrame([tuple({**base, field: v}.values()) for v in (bad, good)], schema)
    failed, passed = layout.check(rows).collect()
    assert failed["failed_rules"] == [field] and not failed["ok"]
    assert passed["ok"] and passed["nsge_eff"] == 4


def test_queue_depth(spark):
    depth = lambda mode, n: layout.queue_depth(F.lit(mode), F.lit(n))
    assert list(one(spark, depth("direct", 64), depth("receive", 2047), depth("receive", 2048),
                    depth("send", 4096))) == [64, 8188, 8192, 16384]


def test_addresses(spark):
    ip = F.lit("10.17.16.60")
    row = one(spark, address.ip_to_le(ip), address.ip_to_be(ip),
              address.ip_from_le(address.ip_to_le(ip)), address.ip_from_be(address.ip_to_be(ip)),
              address.ip_to_le(F.lit("10.17.16")), address.ip_to_le(F.lit("10.17.16.256")),
              address.hex_key(F.lit("0x1f2e")), address.port(F.lit("17201")),
              address.port(F.lit("70000")))
    assert list(row) == [1007685898, 168890428, "10.17.16.60", "10.17.16.60", None, None,
                         7982, 17201, None]


def test_time_stamps(spark):
    def mjd(text):
        return timestamps.mjd(F.lit(text).cast("timestamp_ntz"))

    row = one(spark, mjd("2000-01-01 00:00:00"), mjd("2026-02-10 00:00:00"),
              mjd("2026-02-10 12:00:00.9"), mjd("1858-11-17 00:00:00"),
              timestamps.utc_stamp(F.lit("2026-02-10 12:34:56").cast("timestamp_ntz")))
    assert list(row) == [51544.0, 61081.0, 61081.5, 0.0, "2026-02-10-12:34:56"]


@pytest.mark.parametrize("value", [61081.0, 61081.5, 60310.52425925926, 59999.99998842592])
def test_mjd_digits(spark, value):
    assert one(spark, timestamps.mjd_text(F.lit(value)))[0] == "%.15f" % value


def test_units(spark):
    row = one(spark, timestamps.whole_kb(F.lit(1535)), timestamps.gbps(F.lit(125_000_000), F.lit(1_000_000)),
              timestamps.percent(F.lit(1), F.lit(0)), timestamps.percent(F.lit(1), F.lit(8)))
    assert list(row) == [1, 1.0, 0.0, 12.5]


def packets(spark):
    return spark.createDataFrame(
        [("10:70:fd:11:e2:e3", "02:a2:02:00:02:fa", 0x0800, "10.17.255.12", "10.17.16.11",
          60000, 17201, bytearray(range(256))),
         ("ff:ff:ff:ff:ff:ff", "00:00:00:00:00:00", 0x0806, "0.0.0.0", "255.255.255.255",
          0, 65535, bytearray())],
        "dst_mac string, src_mac string, eth_type int, src_ip string, dst_ip string, "
        "src_port int, dst_port int, payload binary")


def test_decode_inverts_encode(spark):
    rows = packets(spark)
    back = frames.decode(frames.encode_packets(rows).select("frame"))
    assert back.select(*rows.columns).collect() == rows.collect()
    first = back.first()
    assert first["udp_len"] == first["frame_len"] - 34
    assert first["ip_len"] == first["udp_len"] + 20
    assert (first["ip_version_ihl"], first["ip_ttl"], first["ip_proto"]) == (0x45, 0x40, 0x11)
    assert not first["malformed"]


def test_checksum(spark):
    """Summing all ten header words, checksum included, must give all ones."""
    for row in frames.encode_packets(packets(spark)).collect():
        words = [int.from_bytes(row["frame"][i:i + 2], "big") for i in range(14, 34, 2)]
        total = sum(words)
        while total >> 16:
            total = (total & 0xFFFF) + (total >> 16)
        assert total == 0xFFFF
    fixed = frames.decode(frames.encode_packets(packets(spark), checksum="reference").select("frame"))
    assert {r["ip_checksum"] for r in fixed.collect()} == {0xAFB6}


def test_short_frames(spark):
    cut = frames.encode_packets(packets(spark)).limit(1).select(
        F.substring("frame", 1, 20).alias("frame"))
    row = frames.decode(cut).first()
    assert row["malformed"] and row["eth_type"] == 0x0800
    assert row["src_ip"] is None and row["dst_port"] is None and row["payload"] is None


def test_payload_hook(spark):
    @F.pandas_udf("binary")
    def fill(seq):
        return seq.map(lambda n: bytes([n % 256]) * 3)

    filled = frames.fill_payload(spark.range(2), lambda df: fill(df["id"]))
    assert [bytes(r["payload"]) for r in filled.orderBy("id").collect()] == [b"\0\0\0", b"\1\1\1"]


FULL = """HDR_VERSION         1.0
HDR_SIZE            4096
OBS_OFFSET          0
OBS_ID              100
RESOLUTION          98304
NANT                4          #天线
PKT_HEADER          64         # bytes
PKT_DATA            8192       # bytes
PKT_NSAMP           512
PKT_TSAMP           1e-3       # µs
PKT_NPOL            2
PKT_NBIT            2#no blank
BYTES_PER_SECOND    2064000000
SITE\tnorth
"""
SHORT = "HDR_VERSION\t1.0\nHDR_SIZE\t4096\nOBS_OFFSET\t0\nRESOLUTION\t1\n"


def texts(spark, *values):
    return spark.createDataFrame([(i, t) for i, t in enumerate(values)], "id int, header_text string")


def test_header_parse(spark):
    row = header.parse(header.extra(texts(spark, FULL))).first()
    assert (row["nant"], row["pkt_data"], row["pkt_tsamp"], row["pkt_nbit"]) == (4, 8192, 0.001, 2)
    assert row["bytes_per_second"] == 2064000000 and row["obs_id"] == "100"
    assert row["extra"] == {"SITE": "north"}


def test_header_validate(spark):
    repeated = FULL + "NANT 9\nSITE a\nSITE b\n"
    full, short, twice, unreadable = header.validate(
        texts(spark, FULL, SHORT, repeated, FULL.replace("8192", "many"))).orderBy("id").collect()
    assert full["ok"] and full["duplicate_keys"] == []
    assert len(short["missing_keys"]) == 8 and not short["ok"]
    assert twice["ok"] and twice["duplicate_keys"] == ["NANT", "SITE"]
    assert unreadable["missing_keys"] == ["PKT_DATA"]
    assert header.parse(texts(spark, repeated)).first()["nant"] == 4


def test_header_consistency(spark):
    row = header.consistency(header.parse(texts(spark, FULL)), 16384).first()
    assert row["data_ok"] and row["resolution_ok"] and row["pkt_per_s"] == 250000.0
    assert (row["implied_us"], row["declared_us"], row["rate_ok"]) == (0.512, 4.0, False)


def test_header_round_trip(spark):
    typed = header.parse(texts(spark, FULL)).withColumns({
        "file_size": F.lit(1352663040).cast("bigint"), "mjd_start": F.lit(61081.5),
        "utc_start": F.lit("2026-02-10-12:00:00")})
    text = typed.select("id", header.render(with_version=True).alias("header_text"))
    padded = text.select(header.pad(F.col("header_text")).alias("raw")).first()["raw"]
    assert len(padded) == 4096 and bytes(padded).rstrip(b"\0").endswith(b"\n")
    back = header.parse(spark.createDataFrame(
        [(bytes(padded).decode(),)], "header_text string")).first()
    for key in [*header.WRITTEN, "HDR_VERSION"]:
        assert back[key.lower()] == ("1.0" if key == "HDR_VERSION" else typed.first()[key.lower()])
    assert "PKT_TSAMP           0.001000\n" in text.first()["header_text"]
    with pytest.raises(Exception):
        one(spark, header.pad(F.lit("x" * 4097)))


def test_dates_agree_with_calendar(spark):
    days = spark.range(0, 80000, 97).select(
        F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    rows = days.select("d", timestamps.mjd(F.col("d").cast("timestamp_ntz")).alias("m")).collect()
    zero = datetime.date(1858, 11, 17)
    assert all(r["m"] == (r["d"] - zero).days for r in rows)


def test_an_address_beyond_four_octets_makes_no_frame(spark):
    """Null rather than bytes that would decode to another address."""
    rows = packets(spark).withColumn("src_ip", F.lit("10.17.256.12"))
    framed = frames.encode_packets(rows)
    assert [r["frame"] for r in framed.collect()] == [None, None]
    assert {r["src_ip"] for r in frames.decode(framed.select("frame")).collect()} == {None}

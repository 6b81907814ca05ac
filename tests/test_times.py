"""Recordings read by time."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from framelake import session
from framelake.functions.layout import Layout
from framelake.plans import views
from framelake.sources import recording

LAYOUT = Layout(pkt_header=4, pkt_data=4, pkts_per_block=11, send_n=5, blocks_per_file=4)
FIELDS = {**views.HEADER_FIELDS, "pkt_header": 4, "pkt_data": 4}
BASE = datetime.datetime(2024, 1, 1)


def at(seconds):
    return BASE + datetime.timedelta(seconds=seconds)


def write(spark, path, files=3, times=True, shift=0, **options):
    """Packet i of 40 a file arrives after i seconds, ten to a block."""
    rows = spark.range(files * 40).select(
        F.format_string("f%d", F.expr("id div 40")).alias("file"), F.expr("id div 10").alias("block_id"),
        F.expr("id % 10").alias("ordinal"), F.encode(F.lpad(F.col("id").cast("string"), 8, "0"), "UTF-8").alias("payload"),
        F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + F.col("id") + shift).alias("arrival_ts"))
    heads = recording.headers_for(rows.groupBy("file").agg(F.min("arrival_ts").alias("first_ts")), FIELDS, LAYOUT)
    recording.write(rows if times else rows.drop("arrival_ts"), heads, path, LAYOUT, **options)


def ids(df):
    return sorted(int(r.payload.decode()) for r in df.select("payload").collect())


@pytest.mark.parametrize("lo, hi, want", [(35, 52, range(30, 60)), (None, 1, range(0, 10)), (119, None, range(110, 120)),
                                          (40, 40, []), (500, 600, []), (None, None, range(120)), (9, 10, range(0, 10))])
def test_blocks_that_reach_into_a_range(spark, tmp_path, lo, hi, want):
    write(spark, str(tmp_path))
    between = tuple(None if t is None else at(t) for t in (lo, hi))
    found = recording.read(spark, str(tmp_path), LAYOUT, times=True, between=between)
    assert ids(found) == list(want)
    for r in found.collect():
        i = int(r.payload.decode()) // 10 * 10
        assert (r.first_ts, r.last_ts) == (at(i), at(i + 9))


def opened(path, **options):
    """Files and bytes that a read opens."""
    reader = recording.RecordingReader({"path": path, "block_bytes": str(LAYOUT.block_bytes), "pkt_size": "8",
                                        "pkts_per_block": "10", **options})
    ranges = [r for split in reader.partitions() for r in split.ranges]
    return len({r.path for r in ranges}), sum(r.last - r.first for r in ranges) * LAYOUT.block_bytes


def test_other_files_and_blocks_are_not_opened(spark, tmp_path):
    write(spark, str(tmp_path), files=10)
    assert opened(str(tmp_path)) == (10, 40 * 88)
    lo, hi = (recording._micros(at(t)) for t in (85, 95))
    assert opened(str(tmp_path), between=f"{lo}:{hi}") == (1, 2 * 88)
    assert opened(str(tmp_path), between=f"{hi}:") == (8, 31 * 88)


def test_filters_are_pushed(spark, tmp_path):
    write(spark, str(tmp_path))
    with session.settings(spark, {"spark.sql.python.filterPushdown.enabled": "true"}):
        found = recording.read(spark, str(tmp_path), LAYOUT, times=True).filter(
            (F.col("last_ts") >= F.lit(at(35))) & (F.col("first_ts") < F.lit(at(52))))
        assert ids(found) == list(range(30, 60))
        # Blocks that the filters exclude are in no partition.
        assert found.rdd.getNumPartitions() <= 3
    reader = recording.PushdownReader({"path": str(tmp_path), "block_bytes": "88", "pkt_size": "8", "times": "true"})
    filters = [recording.GreaterThanOrEqual(("last_ts",), at(35)), recording.LessThan(("first_ts",), at(52))]
    assert list(reader.pushFilters(filters)) == filters
    assert sum(r.last - r.first for s in reader.partitions() for r in s.ranges) == 3


def test_a_file_written_again_counts_as_it_is_now(spark, tmp_path):
    path = str(tmp_path)
    write(spark, path)
    write(spark, path, shift=1000, replace=True)
    assert ids(recording.read(spark, path, LAYOUT, between=(at(0), at(500)))) == []
    assert ids(recording.read(spark, path, LAYOUT, between=(at(1000), at(1005)))) == list(range(10))
    write(spark, path, files=1, mode="overwrite")
    assert len(os.listdir(tmp_path / "_index")) == 1
    assert ids(recording.read(spark, path, LAYOUT)) == list(range(40))


def test_files_without_times_are_read(spark, tmp_path):
    path = str(tmp_path)
    write(spark, path, times=False)
    found = recording.read(spark, path, LAYOUT, times=True, between=(at(0), at(5)))
    assert ids(found) == list(range(120)) and found.filter("first_ts IS NOT NULL").count() == 0

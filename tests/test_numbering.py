"""Numbering that continues over appends."""

import os
import random

import pytest
from pyspark.sql import functions as F

from framelake.operators import assemble
from framelake.operators.numbering import Numbering

SCHEMA = "stream_id string, seq bigint, t bigint"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA).select("stream_id", "seq", F.timestamp_seconds("t").alias("arrival_ts"))


def places(df):
    return sorted((r.stream_id or "", r.seq, r.pos) for r in df.collect())


def sample(seed, n=900):
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "hot", "a", None]), i, rng.randint(-500, 5000)) for i in range(n)]


@pytest.mark.parametrize("seed, seconds", [(0, 60), (1, 1), (2, 100_000)])
def test_equals_numbering_at_once(spark, tmp_path, seed, seconds):
    data = sample(seed)
    numbering = Numbering(spark, str(tmp_path / "n"), seconds)
    for part in (data[:300], data[300:310], data[310:]):
        numbering.append(rows(spark, part))
    assert places(numbering.positions()) == places(assemble.position(rows(spark, data)))


def test_only_touched_buckets_are_sorted(spark, tmp_path):
    numbering = Numbering(spark, str(tmp_path / "n"), 100)
    assert numbering.append(rows(spark, [("s", i, i) for i in range(2000)])) == 2000
    # Appended behind the last: two buckets of their own.
    assert numbering.append(rows(spark, [("s", i, i) for i in range(2000, 2150)])) == 150
    # One late packet: its bucket, of a hundred packets.
    assert numbering.append(rows(spark, [("s", 9999, 550)])) == 101
    want = sorted([*range(2150), 9999], key=lambda s: (550 if s == 9999 else s, s))
    assert [r.seq for r in numbering.positions().orderBy("pos").collect()] == want
    assert numbering.sweep() == 0
    everything = numbering.append(rows(spark, [("s", 10_000 + t, t) for t in range(0, 2150, 100)]))
    assert everything == 2150 + 1 + 22 and numbering.sweep() == 3
    assert numbering.positions().count() == everything and os.listdir(tmp_path / "n" / "rows") == ["append=3"]


def test_an_append_happens_once(spark, tmp_path):
    numbering = Numbering(spark, str(tmp_path / "n"), 10)
    data = rows(spark, sample(3, 50))
    numbering.append(data, 0)
    assert numbering.append(data, 0) == 0
    with pytest.raises(ValueError, match="follows"):
        numbering.append(data, 5)
    # Interrupted: rows are there, counts are not.
    data.withColumn("bucket", F.lit(0)).write.parquet(str(tmp_path / "n" / "rows" / "append=1"))
    assert Numbering(spark, str(tmp_path / "n"), 10).positions().count() == 50
    numbering.append(rows(spark, [("x", 1, 1)]))
    assert numbering.positions().count() == 51


def test_nothing_and_no_time(spark, tmp_path):
    numbering = Numbering(spark, str(tmp_path / "n"))
    assert numbering.positions().count() == 0
    assert numbering.append(rows(spark, [])) == 0 and numbering.positions().count() == 0
    with pytest.raises(ValueError, match="without an arrival time"):
        numbering.append(rows(spark, [("s", 1, None)]))
    numbering.append(rows(spark, [("s", 1, 5), ("s", 1, 5)]))
    assert places(numbering.positions()) == [("s", 1, 0), ("s", 1, 1)]

"""Packets admitted by bytes."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.sources import feed
from framelake.streaming import jobs

SCHEMA = T.StructType([T.StructField("seq", T.LongType()), T.StructField("body", T.StringType())])


def land(folder, name, lo, hi, group=50):
    os.makedirs(folder, exist_ok=True)
    table = pa.table({"unused": list(range(lo, hi)), "body": [f"packet {i}" * 3 for i in range(lo, hi)],
                      "seq": pa.array(range(lo, hi), pa.int32())})
    pq.write_table(table, os.path.join(folder, name), row_group_size=group)


def run(spark, tmp_path, max_bytes, out="out", order="time"):
    rows = feed.follow(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / f"{out}-files"), max_bytes, order=order)
    query = feed.drain(jobs.start(rows, str(tmp_path / out), str(tmp_path / f"{out}-checkpoint"), finite=False))
    steps = [p for p in query.recentProgress if p.numInputRows]
    return sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(str(tmp_path / out)).collect()), steps


@pytest.mark.parametrize("max_bytes", [1 << 10, 4 << 10, 1 << 30])
def test_same_rows_whatever_the_limit(spark, tmp_path, max_bytes):
    land(tmp_path / "in", "a.parquet", 0, 170)
    land(tmp_path / "in", "b.parquet", 170, 200)
    rows, steps = run(spark, tmp_path, max_bytes)
    assert rows == [(i, f"packet {i}" * 3) for i in range(200)]
    assert len(steps) == 1 if max_bytes > 1 << 20 else len(steps) > 2
    # No micro-batch takes in much more than the limit.
    groups = [meta.row_group(i) for meta in map(pq.read_metadata, (tmp_path / "in").iterdir()) for i in range(meta.num_row_groups)]
    least = min(g.total_byte_size / g.num_rows for g in groups)
    assert max(s.numInputRows for s in steps) <= max_bytes / least + 2


def test_goes_on_from_its_checkpoint_and_finds_new_files(spark, tmp_path):
    land(tmp_path / "in", "b.parquet", 0, 100)
    first, steps = run(spark, tmp_path, 2000)
    assert len(first) == 100 and len(steps) > 1
    # An earlier name and an earlier time: neither hides a file that was not seen before.
    land(tmp_path / "in", "a.parquet", 100, 160)
    os.utime(tmp_path / "in" / "a.parquet", (1, 1))
    land(tmp_path / "in", "_hidden.parquet", 900, 910)
    rows, steps = run(spark, tmp_path, 2000)
    assert [r[0] for r in rows] == list(range(160)) and sum(s.numInputRows for s in steps) == 60
    again, steps = run(spark, tmp_path, 2000)
    assert again == rows and not steps


def test_restart_in_the_middle_of_a_file(spark, tmp_path):
    land(tmp_path / "in", "a.parquet", 0, 400)
    rows = feed.follow(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / "files"), 1500)
    seen = []

    def stop_after_two(df, batch):
        if len(seen) == 2:
            raise RuntimeError("stopped")
        df.write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={batch}"))
        seen.append(batch)

    def keep(df, batch):
        df.write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={batch}"))

    checkpoint = str(tmp_path / "checkpoint")
    with pytest.raises(Exception, match="stopped"):
        feed.drain(rows.writeStream.foreachBatch(stop_after_two).option("checkpointLocation", checkpoint).start())
    rows = feed.follow(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / "files"), 1500)
    feed.drain(rows.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).start())
    got = [r.seq for r in spark.read.parquet(str(tmp_path / "out")).select("seq").collect()]
    assert sorted(got) == list(range(400))


def test_a_micro_batch_is_many_tasks(tmp_path):
    land(tmp_path / "in", "a.parquet", 0, 1000, group=300)
    reader = feed.FeedReader({"path": str(tmp_path / "in"), "catalogue": str(tmp_path / "files"), "max_bytes": "1000000",
                              "split_bytes": "4000"}, SCHEMA)
    end = reader.latestOffset()
    parts = reader.partitions(reader.initialOffset(), end)
    assert len(parts) > 3 and sum(hi - lo for p in parts for _, _, lo, hi in p.ranges) == 1000
    rows = [i for p in parts for b in reader.read(p) for i in b.column("seq").to_pylist()]
    assert rows == list(range(1000)) and reader.partitions(end, end) == []


def test_a_feed_of_nothing(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    assert run(spark, tmp_path, 1000) == ([], [])
    land(tmp_path / "in", "a.parquet", 0, 0)
    land(tmp_path / "in", "b.parquet", 5, 6)
    assert [r[0] for r in run(spark, tmp_path, 1)[0]] == [5]


def test_lists_of_files_are_merged(tmp_path, monkeypatch):
    monkeypatch.setattr(feed, "MERGE_FILES", 3)
    folder = str(tmp_path / "files")
    for i in range(9):
        feed.Catalogue(folder).add([f"f{i}", f"g{i}"])
    want = [f"{c}{i}" for i in range(9) for c in "fg"]
    assert feed.Catalogue(folder).files == want and len(os.listdir(folder)) < 5
    # What an interrupted merge leaves behind says the same.
    with open(os.path.join(folder, f"{2:012d}-{4:012d}.list"), "w") as out:
        json.dump(want[2:6], out)
    assert feed.Catalogue(folder).files == want


def test_order_by_name(tmp_path):
    for name, time in (("b", 1), ("a", 2), ("c", 3)):
        land(tmp_path / "in", f"{name}.parquet", 0, 1)
        os.utime(tmp_path / "in" / f"{name}.parquet", (time, time))
    found = {}
    for order in ("time", "name"):
        reader = feed.FeedReader({"path": str(tmp_path / "in"), "catalogue": str(tmp_path / order), "order": order}, SCHEMA)
        reader.latestOffset()
        found[order] = [os.path.basename(f)[0] for f in reader.catalogue.files]
    assert found == {"time": ["b", "a", "c"], "name": ["a", "b", "c"]}


def test_missing_columns_are_null_and_types_are_those_asked_for(spark, tmp_path):
    land(tmp_path / "in", "a.parquet", 0, 3)
    schema = T.StructType([*SCHEMA.fields, T.StructField("later", T.TimestampType())])
    rows = feed.follow(spark, str(tmp_path / "in"), schema, str(tmp_path / "files"))
    feed.drain(jobs.start(rows.filter(F.col("later").isNull()), str(tmp_path / "out"), str(tmp_path / "c"), finite=False))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_a_feed_that_is_behind_takes_in_more(spark, tmp_path):
    """Twice the backlog is not twice the micro-batches; caught up, the limit is the first one again."""
    steps = {}
    for n in (800, 3200):
        folder = tmp_path / str(n)
        land(folder / "in", "a.parquet", 0, n)
        options = {"path": str(folder / "in"), "catalogue": str(folder / "files"), "max_bytes": "1000", "most_bytes": "1000000"}
        reader = feed.FeedReader(options, SCHEMA)
        at, rows, steps[n] = reader.initialOffset(), [], 0
        while (end := reader.latestOffset()) != at:
            for part in reader.partitions(at, end):
                rows += [i for b in reader.read(part) for i in b.column("seq").to_pylist()]
            reader.partitions(at, end)
            at, steps[n] = end, steps[n] + 1
        assert rows == list(range(n)) and reader.room == reader.limit
    assert steps[3200] <= steps[800] + 2 < 8
    small = feed.follow(spark, str(tmp_path / "3200" / "in"), SCHEMA, str(tmp_path / "f"), 1000, most_bytes=4000)
    query = feed.drain(jobs.start(small, str(tmp_path / "out"), str(tmp_path / "c"), finite=False))
    sizes = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert sum(sizes) == 3200 and sizes[1] > 2 * sizes[0] and max(sizes) < 6 * sizes[0]

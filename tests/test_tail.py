"""Logs followed while they grow."""

import os

import pytest

from framelake.sources import feed, logs, tail
from framelake.streaming import jobs

LINES = ["before any run", "Run started at: 2026-02-10 12:00:00", "[WARN] look", "",
         "[Progress] Blocks written: 10 | Ring buffer: 25.3% full (256/1024 MB)", "Run started at: 2026-02-11 12:00:00",
         "total_recv: 0          Bandwidth: 0 Gbps, cost time us_elapsed: 5000 ", "ünïcode ✓", "blocks_in_use : 7"] * 3
TEXT = ("\n".join(LINES) + "\n").encode()


def step(spark, tmp_path, max_bytes=1 << 20, split=1 << 20):
    rows = tail.follow(spark, str(tmp_path / "in"), str(tmp_path / "files"), max_bytes, split)
    runs = jobs.LogRuns(spark, str(tmp_path / "sink"))
    feed.drain(rows.writeStream.foreachBatch(runs).option("checkpointLocation", str(tmp_path / "state")).start())
    return sorted((os.path.basename(r.log), r.line_no, r.run_id, r.kind, r.blocks, r.kb, r.counter, r.amount)
                  for r in runs.result(spark).collect())


def whole(spark, tmp_path):
    rows = logs.read(spark, str(tmp_path / "in"))
    return sorted((os.path.basename(r.file), r.line_no, r.run_id, r.kind, r.blocks, r.kb, r.counter, r.amount)
                  for r in rows.collect())


@pytest.mark.parametrize("cuts", [(0.33, 0.5), (0.1, 0.101)])
def test_equals_the_batch_form_for_any_cut(spark, tmp_path, cuts):
    os.makedirs(tmp_path / "in")
    at = [0, *[int(len(TEXT) * c) for c in cuts], len(TEXT)]
    for lo, hi in zip(at, at[1:]):
        for name in ("a.log", "b.log"):
            with open(tmp_path / "in" / name, "ab") as out:
                out.write(TEXT[lo:hi])
        found = step(spark, tmp_path)
        # The torn last line waits.
        assert len(found) == 2 * TEXT[:hi].count(b"\n")
    assert found == whole(spark, tmp_path)


def test_steps_of_few_bytes_and_new_files(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "b.log").write_bytes(TEXT)
    step(spark, tmp_path, max_bytes=400, split=50)
    (tmp_path / "in" / "a.log").write_bytes(TEXT)
    (tmp_path / "in" / "b.log").write_bytes(TEXT + TEXT)
    assert step(spark, tmp_path, max_bytes=900, split=70) == whole(spark, tmp_path)


@pytest.mark.parametrize("split", [1, 3, 10, 1000])
def test_every_line_is_in_one_task(tmp_path, split):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.log").write_bytes(TEXT + b"torn")
    reader = tail.TailReader({"path": str(tmp_path / "in"), "catalogue": str(tmp_path / "f"), "split_bytes": str(split)})
    end = reader.latestOffset()
    assert end == {"0": len(TEXT)}
    rows = [(o, v) for p in reader.partitions({}, end) for b in reader.read(p)
            for o, v in zip(b.column("offset").to_pylist(), b.column("value").to_pylist())]
    assert [v for _, v in sorted(rows)] == LINES


def test_a_line_longer_than_the_limit(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.log").write_bytes(b"x" * 5000 + b"\nshort\n" + b"y" * 300)
    reader = tail.TailReader({"path": str(tmp_path / "in"), "catalogue": str(tmp_path / "f"), "max_bytes": "10"})
    end = reader.latestOffset()
    rows = [v for p in reader.partitions({}, end) for b in reader.read(p) for v in b.column("value").to_pylist()]
    assert rows[0] == "x" * 5000

"""Header files by the thousand."""

import os

import pytest
from pyspark.sql import functions as F

from framelake.sources import headers


def texts(spark, n):
    return spark.range(0, n, 1, 6).select(F.col("id").alias("n"), F.format_string("NANT %d # number\n", "id").alias("header_text"))


def files_below(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(headers.SUFFIX)]


def test_written_and_read_back(spark, tmp_path):
    path = str(tmp_path / "heads")
    headers.write_files(texts(spark, 5000), path, "n")
    assert len(files_below(path)) == 5000
    # No folder of its own for any file.
    assert len(os.listdir(path)) < 20
    back = headers.read_text(spark, path)
    assert back.rdd.getNumPartitions() < 20
    rows = {r.key: r.header_text for r in back.collect()}
    assert rows == {str(i): f"NANT {i} # number\n" for i in range(5000)}
    narrow = headers.read_text(spark, path, split_bytes=1)
    assert narrow.rdd.getNumPartitions() >= 6 and narrow.count() == 5000


def test_appending_and_replacing(spark, tmp_path):
    path = str(tmp_path / "heads")
    headers.write_files(texts(spark, 10), path, "n")
    headers.write_files(texts(spark, 3), path, "n")
    assert headers.read_text(spark, path).count() == 13
    headers.write_files(texts(spark, 4), path, "n", mode="overwrite")
    assert headers.read_text(spark, path).count() == 4


def test_files_of_attempts_that_failed_are_not_read(spark, tmp_path):
    path = str(tmp_path / "heads")
    headers.write_files(texts(spark, 20), path, "n")
    writer = headers.HeaderWriter({"path": path}, False)
    batches = texts(spark, 7).toArrow().select([0, 1]).rename_columns(["key", "header_text"]).to_batches()
    writer.write(iter(batches))                      # lost: its message never arrives
    assert headers.read_text(spark, path).count() == 20
    writer.commit([writer.write(iter(batches)), None])
    assert headers.read_text(spark, path).count() == 27
    other = headers.HeaderWriter({"path": path}, False)
    before = len(files_below(path))
    other.write(iter(batches))
    other.abort([None])
    assert len(files_below(path)) == before


def test_a_folder_of_plain_files(spark, tmp_path):
    for name, text in (("a.header", "NANT 1\n"), ("b:c.txt", "NANT 2\n" + "\0" * 20), ("_skip", "x"), ("empty.header", "")):
        (tmp_path / name).write_text(text)
    rows = {r.key: r.header_text for r in headers.read_text(spark, str(tmp_path)).collect()}
    assert rows == {"a": "NANT 1\n", "b:c.txt": "NANT 2\n", "empty": ""}
    one = headers.read_text(spark, str(tmp_path / "a.header")).collect()
    assert [r.header_text for r in one] == ["NANT 1\n"]


def test_too_long_and_null_and_empty(spark, tmp_path):
    long = spark.createDataFrame([(1, "x" * 5000)], "n int, header_text string")
    with pytest.raises(Exception, match="more than 4096 bytes"):
        headers.write_files(long, str(tmp_path / "long"), "n")
    some = spark.createDataFrame([(None, None), (2, "")], "n int, header_text string")
    headers.write_files(some, str(tmp_path / "some"), "n")
    assert sorted((r.key or "", r.header_text) for r in headers.read_text(spark, str(tmp_path / "some")).collect()) == [
        ("", ""), ("2", "")]
    headers.write_files(some.limit(0), str(tmp_path / "none"), "n")
    assert headers.read_text(spark, str(tmp_path / "none")).count() == 0


def test_a_table_in_one_partition_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "heads")
    headers.write_files(texts(spark, 400).coalesce(1), path, "n")
    sizes = [len(files_below(os.path.join(path, f))) for f in os.listdir(path) if f.startswith("part-")]
    assert sum(sizes) == 400 and len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) < 100


def test_files_are_opened_once_for_good_and_bad(spark, tmp_path):
    path = str(tmp_path / "heads")
    headers.write_files(texts(spark, 20), path, "n")
    good, bad = headers.read(spark, path)
    for name in files_below(path):
        os.remove(name)
    assert (good.count(), bad.count()) == (0, 20)

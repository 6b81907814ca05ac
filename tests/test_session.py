"""Shuffle widths and the shared folder."""

import os

import pytest

from framelake import session


def test_shuffle_partitions():
    assert session.shuffle_partitions(0, 8) == 16
    assert session.shuffle_partitions(1 << 40, 8) == 8192


def test_width_follows_the_estimate(spark, monkeypatch):
    monkeypatch.setattr(session, "shuffle_partitions", lambda estimate, cores: 100)
    assert spark.conf.get(session.INITIAL, None) is None
    with session.wide_enough(spark.range(10)):
        assert spark.conf.get(session.INITIAL) == "100"
    assert spark.conf.get(session.INITIAL, None) is None
    with session.wide_enough(spark.createDataFrame([(1,)], "a int")):
        assert spark.conf.get(session.INITIAL, None) is None


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert session.shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())


def test_cluster_needs_a_named_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_stored_tables_are_discarded(spark):
    table = session.stored(spark.range(5), "test")
    folder = table._stored_in.removeprefix("file:")
    assert table.count() == 5 and os.path.isdir(folder)
    session.discard(table)
    assert not os.path.exists(folder)
    session.discard()

"""Idle windows put out while a stream is silent."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framelake.operators import metrics
from framelake.sources import feed
from framelake.streaming import idle

BASE = 1_700_000_000 // 60 * 60
SCHEMA = "stream_id string, t bigint"


@pytest.fixture
def live(spark, tmp_path):
    """Lands packets (stream, seconds after the base) and runs the stream over what has landed."""
    def step(rows, lateness="0 seconds"):
        df = spark.createDataFrame(rows, SCHEMA).select(
            "stream_id", F.timestamp_seconds(F.lit(BASE) + F.col("t")).alias("arrival_ts"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        packets = feed.follow(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "files"))
        out = idle.windows(packets, 60, lateness)
        feed.drain(idle.start(out, str(tmp_path / "out"), str(tmp_path / "state")))
        found = spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
        base = datetime.datetime.fromtimestamp(BASE, datetime.timezone.utc).replace(tzinfo=None)
        return found, {(r.stream_id, (r.win_start - base).total_seconds() // 60): r.packets
                       for r in found.withColumn("win_start", F.col("win_start").cast("timestamp_ntz")).collect()}

    return step


def test_an_idle_window_goes_out_before_the_next_packet(live):
    live([("quiet", 5), ("busy", 5)])
    _, seen = live([("busy", t) for t in range(60, 400)])
    # Nothing of the quiet stream has come since its first window.
    assert seen["quiet", 0] == 1 and [seen["quiet", w] for w in range(1, 5)] == [0, 0, 0, 0]
    _, seen = live([("quiet", 405), ("busy", 700)])
    assert [seen["quiet", w] for w in range(0, 10)] == [1, 0, 0, 0, 0, 0, 1, 0, 0, 0]
    assert [seen["busy", w] for w in range(0, 7)] == [1, 60, 60, 60, 60, 60, 40]


def test_runs_equal_the_batch_form(spark, live):
    rows = [(s, t) for s, k in (("a", 130), ("b", 7), (None, 333)) for t in range(0, 3000, k)] + [("c", 100), ("c", 2000)]
    live(rows[:len(rows) // 2], "1 hour")
    live(rows[len(rows) // 2:], "1 hour")
    found, _ = live([("end", 3000 + 2 * 3600), ("end", 3000 + 4 * 3600)], "1 hour")
    packets = spark.createDataFrame(rows, SCHEMA).select(
        "stream_id", F.timestamp_seconds(F.lit(BASE) + F.col("t")).alias("arrival_ts"))
    want = sorted(map(str, metrics.idle_runs(packets, 60).collect()))
    assert sorted(map(str, idle.runs(found).filter("stream_id IS DISTINCT FROM 'end'").collect())) == want and want


def test_late_packets_within_the_bound_count_and_those_beyond_do_not(live):
    live([("a", 1000)], "10 minutes")
    live([("a", 500), ("a", 2)], "10 minutes")
    _, seen = live([("a", 5000), ("a", 6000)], "10 minutes")
    assert seen["a", 8] == 1 and seen["a", 16] == 1 and ("a", 0) not in seen


def test_packets_without_a_time_are_ignored(live):
    live([("a", None), ("a", 10), ("a", 15)])
    _, seen = live([("a", 500)])
    assert seen["a", 0] == 2


class _State:
    """What the processor asks of its handle, counted."""

    def __init__(self):
        self.calls, self.held, self.value, self.timers = 0, {}, None, []

    def getMapState(self, *schema):
        return self

    def getValueState(self, *schema):
        return _Value(self)

    def registerTimer(self, at):
        self.timers.append(at)

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self.held[key]

    def getCurrentWatermarkInMs(self):
        return self.watermark


class _Value:
    def __init__(self, state):
        self.state = state

    def exists(self):
        return self.state.value is not None

    def get(self):
        return self.state.value

    def update(self, value):
        self.state.calls += 1
        self.state.value = value


def test_calls_to_the_state_do_not_grow_with_every_window():
    state, processor = _State(), idle.Windows(60)
    processor.init(state)
    rng = np.random.default_rng(4)
    want = np.zeros(100_000, np.int64)
    out = []
    for lo in (-50_000, -20_000, 20_000):
        wins = rng.integers(lo, lo + 30_000, 40_000)
        np.add.at(want, wins + 50_000, 1)
        processor.handleInputRows(("a",), [pd.DataFrame({"win": wins[at:at + 10_000], "n": 1}) for at in range(0, 40_000, 10_000)], None)
        state.watermark = (lo + 29_990) * 60_000 + 5
        out += list(processor.handleExpiredTimer(("a",), state, None))
        if lo < 0:
            # Behind the watermark.
            processor.handleInputRows(("a",), [pd.DataFrame({"win": [lo, lo + 29_989], "n": [7, 7]})], None)
    out = pd.concat(out)
    first = int(out["win"].iloc[0])
    assert out["win"].tolist() == list(range(first, 49_990)) and set(out["stream_id"]) == {"a"}
    assert not want[:first + 50_000].any() and out["packets"].tolist() == want[first + 50_000:99_990].tolist()
    assert state.timers[-1] == (49_990 + 1) * 60_000
    # 100,000 windows; every one was asked for and removed before.
    assert state.calls < 2_000

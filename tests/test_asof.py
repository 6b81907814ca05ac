"""As-of joins and snapshots at many times."""

import random

import pytest
from pyspark.sql import functions as F

from framelake import session
from framelake.functions.layout import Layout
from framelake.operators import metrics, ordered

EVENTS, PROBES = "stream_id string, t bigint, n bigint, v string", "stream_id string, t bigint, id bigint, extra map<string,int>"
RING = Layout(pkt_header=16, pkt_data=64, pkts_per_block=50, send_n=16)


def sample(seed, n_events=400, n_probes=300, hot=0.99):
    rng = random.Random(seed)

    def stream():
        return "hot" if rng.random() < hot else rng.choice(["a", None, "late"])

    events = [(stream(), rng.randint(0, 500), i, rng.choice([None, f"v{i}"])) for i in range(n_events)]
    probes = [(stream(), rng.choice([rng.randint(-50, 600), None]) if i % 20 == 0 else rng.randint(-50, 600), i, {"k": i})
              for i in range(n_probes)]
    return events, probes + [("nobody", 5, -1, None)]


def brute(events, probes):
    out = []
    for s, t, i, extra in probes:
        before = [e for e in events if e[0] == s and t is not None and e[1] <= t]
        last = max(before, key=lambda e: (e[1], e[2])) if before else (None,) * 4
        out.append((s, t, i, extra, last[2], last[3]))
    return sorted(out, key=lambda r: r[2])


@pytest.mark.parametrize("seed, parts", [(0, 1), (1, 4), (2, 32)])
def test_as_of_equals_brute_force(spark, seed, parts):
    events, probes = sample(seed)
    with session.settings(spark, {"spark.sql.shuffle.partitions": str(parts),
                                  "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        found = ordered.as_of(spark.createDataFrame(probes, PROBES), spark.createDataFrame(events, EVENTS), ["stream_id"],
                              "t", ["n", "v"], ["n"])
        rows = sorted(map(tuple, found.collect()), key=lambda r: r[2])
    assert rows == brute(events, probes)


def test_probes_far_from_their_event(spark):
    # Ranges between hold probes alone.
    events = [("s", 1, 1, "first")]
    probes = [("s", t, t, None) for t in range(2, 4000)]
    with session.settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        found = ordered.as_of(spark.createDataFrame(probes, PROBES).repartition(8), spark.createDataFrame(events, EVENTS),
                              ["stream_id"], "t", ["v"])
    assert found.filter("v = 'first'").count() == len(probes)


def test_nothing_on_either_side(spark):
    events, probes = (spark.createDataFrame(rows, schema) for rows, schema in zip(sample(3, 20, 20), (EVENTS, PROBES)))
    assert ordered.as_of(probes.limit(0), events, ["stream_id"], "t", ["v"]).count() == 0
    assert ordered.as_of(probes, events.limit(0), ["stream_id"], "t", ["v"]).filter("v IS NULL").count() == 21


def test_a_hot_stream_is_many_tasks(spark):
    n = 20_000
    events = spark.range(n).select(F.lit("hot").alias("stream_id"), F.col("id").alias("t"), F.col("id").alias("n"),
                                   F.lit("x").alias("v"))
    with session.settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        rows = ordered.lay_out(events, ["stream_id"], ["t"])
    counts = [r["count"] for r in rows.groupBy(ordered.PART).count().collect()]
    assert len(counts) == 8 and max(counts) < n / 2


def log_of(rng, n):
    log = []
    for b in range(n):
        t = rng.randint(0, 300)
        log.append(("s" if b % 5 else "u", b, t, "filled"))
        if b % 3:
            log.append(("s" if b % 5 else "u", b, t + rng.randint(0, 40), "cleared"))
    return log


@pytest.mark.parametrize("seed", [0, 1])
def test_snapshot_at_counts_what_happened_by_then(spark, seed):
    log = log_of(random.Random(seed), 60)
    ts = F.timestamp_seconds(F.col("t"))
    events = spark.createDataFrame(log, "stream_id string, block_id bigint, t bigint, kind string").withColumn("ts", ts)
    asked = [(s, t) for s in ("s", "u", "none") for t in range(-10, 360, 7)]
    probes = spark.createDataFrame(asked, "stream_id string, t bigint").withColumn("at", ts)
    got = {(r.stream_id, r.t): tuple(r)[3:] for r in metrics.snapshot_at(events, probes, RING).collect()}
    size = RING.block_bytes
    for s, t in asked:
        w = sum(1 for e in log if e[0] == s and e[2] <= t and e[3] == "filled")
        r = sum(1 for e in log if e[0] == s and e[2] <= t and e[3] == "cleared")
        used = max(0, min(w - r, RING.nbufs))
        assert got[s, t] == (used, w * size, r * size, (RING.nbufs - used) * size)


def test_the_last_snapshot_is_the_plain_one(spark):
    log = spark.createDataFrame(log_of(random.Random(4), 50), "stream_id string, block_id bigint, t bigint, kind string")
    log = log.withColumn("ts", F.timestamp_seconds("t"))
    probes = log.select("stream_id", F.lit("2030-01-01").cast("timestamp").alias("at")).distinct()
    assert sorted(map(tuple, metrics.snapshot_at(log, probes, RING).drop("at").collect())) == sorted(
        map(tuple, metrics.snapshot(log, RING).collect()))

"""Order-dependent operators against plain Python, with one key holding most rows and
many partitions, so that every carry across a partition boundary is exercised."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from framelake.functions import frames
from framelake.functions.layout import Layout, TINY
from framelake.operators import assemble, chained, flows, joins, metrics, ordered
from framelake.plans import views

START = datetime.datetime(2026, 2, 10)


@pytest.fixture(params=[1, 4, 32])
def spread(spark, request):
    """Fixed shuffle width: small data must really span partitions."""
    names = {"spark.sql.shuffle.partitions": str(request.param),
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield spark
    for n, v in before.items():
        spark.conf.set(n, v)


def hot_rows(n=3000, seed=7):
    """(stream, ts, seq): two thirds in one stream, with equal times, shuffled."""
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "hot", "hot", "a", None]),
             START + datetime.timedelta(seconds=i // 3), i) for i in range(n)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "stream_id string, arrival_ts timestamp_ntz, seq bigint")


def by_stream(rows):
    ordered_rows = sorted(rows, key=lambda r: (r[0] or "", r[1], r[2]))
    return {k: list(g) for k, g in itertools.groupby(ordered_rows, key=lambda r: r[0])}


def test_positions(spread):
    rows = hot_rows()
    want = {(s, r[2]): i for s, g in by_stream(rows).items() for i, r in enumerate(g)}
    got = assemble.position(frame(spread, rows)).collect()
    assert {(r["stream_id"], r["seq"]): r["pos"] for r in got} == want


def test_positions_when_side_is_large(spread, monkeypatch):
    """The shuffled form of the boundary join gives the same answer."""
    bounded = joins.attach_bounded
    monkeypatch.setattr(ordered, "attach_bounded", lambda f, s, on: bounded(f, s, on, max_rows=0))
    test_positions(spread)


def test_running_sums_and_previous(spread):
    rows = hot_rows()
    df = frame(spread, rows)
    order = ["arrival_ts", "seq"]
    want_sum, want_prev = {}, {}
    for s, g in by_stream(rows).items():
        total, last = 0, None
        for r in g:
            total += r[2]
            want_sum[s, r[2]], want_prev[s, r[2]], last = total, last, r[2]
    sums = ordered.running_sums(df, ["stream_id"], order, {"total": F.col("seq")}).collect()
    assert {(r["stream_id"], r["seq"]): r["total"] for r in sums} == want_sum
    prev = ordered.previous(df, ["stream_id"], order, {"last": F.col("seq")}).collect()
    assert {(r["stream_id"], r["seq"]): r["last"] for r in prev} == want_prev


def test_unkeyed_positions(spread):
    got = ordered.positions(spread.range(1000).select((-F.col("id")).alias("v")), [], ["v"]).collect()
    assert all(r["pos"] == r["v"] + 999 for r in got)


def test_order_needs_a_tie_breaker(spark):
    with pytest.raises(ValueError):
        assemble.position(frame(spark, hot_rows(10)).drop("seq"))


@pytest.mark.parametrize("n,n_batches,n_blocks", [
    (0, 0, 0), (15, 0, 0), (16, 1, 0), (47, 2, 0), (48, 3, 1), (96, 6, 2), (100, 6, 2)])
def test_assembly_edges(spark, n, n_batches, n_blocks):
    rows = [("s", START + datetime.timedelta(seconds=i), i) for i in range(n)]
    positioned = assemble.position(frame(spark, rows))
    whole = assemble.batches(positioned, TINY)
    everything = assemble.batches(positioned, TINY, keep_tail=True)
    blocks = assemble.blocks(positioned, TINY).collect()
    assert whole.count() == n_batches and len(blocks) == n_blocks
    assert everything.agg(F.sum("n_packets")).first()[0] == (n or None)
    for b in blocks:
        assert b["n_batches"] * TINY.batch_bytes + b["pad_bytes"] == TINY.block_bytes
    assert assemble.published(positioned, TINY).count() == n_blocks * 48


def test_dense_sequence_needs_no_sort(spark):
    rows = [("s", START, i + 10) for i in range(40)] + [(None, START, i) for i in range(5)]
    dense = assemble.position_dense(frame(spark, rows))
    assert [tuple(r) for r in dense.groupBy("stream_id").agg(F.min("pos"), F.max("pos")).orderBy("stream_id").collect()
            ] == [(None, 0, 4), ("s", 0, 39)]
    plan = dense._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("seqs", [[1, 2, 4], [1, 1, 2], [1, None, 2]])
def test_dense_sequence_is_checked(spark, seqs):
    with pytest.raises(ValueError, match="gaps or repetitions"):
        assemble.position_dense(frame(spark, [("s", START, q) for q in seqs]))


def test_dimension_join_refuses_kept_rows(spark):
    one = spark.createDataFrame([(1, 2)], "k int, v int")
    for how in ("right", "full", "outer"):
        with pytest.raises(ValueError, match="join"):
            joins.attach(one, one.withColumnRenamed("v", "w"), ["k"], how)


def pack_by_hand(sizes, capacity):
    blocks, used = [[]], 0
    for s in sizes:
        if used + s > capacity:
            blocks.append([])
            used = 0
        blocks[-1].append(s)
        used += s
    return [(i, len(b), sum(b)) for i, b in enumerate(blocks) if b]


@pytest.mark.parametrize("low,high,fan", [(1, 60, 64), (10, 10, 3), (1, 100, 2), (0, 5, 64)])
def test_pack_variable(spread, monkeypatch, low, high, fan):
    monkeypatch.setattr(chained, "FAN_IN", fan)
    rng = random.Random(low * 100 + high)
    rows = [(rng.choice(["hot", "hot", "hot", "a"]), i, rng.randint(low, high)) for i in range(2500)]
    want = set()
    for s in ("hot", "a"):
        want |= {(s, *b) for b in pack_by_hand([r[2] for r in rows if r[0] == s], 100)}
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spread.createDataFrame(shuffled, "stream_id string, i bigint, size int")
    got = chained.pack_variable(df, 100, "stream_id", ["i"], "size").collect()
    assert {(r["stream_id"], r["block_id"], r["n_records"], r["used_bytes"]) for r in got} == want
    assert len(got) == len(want) and all(r["used_bytes"] + r["pad_bytes"] == 100 for r in got)


def test_records_larger_than_a_block(spark):
    df = spark.createDataFrame([("s", 1, 50), ("s", 2, 101), ("s", 3, 50), ("s", 4, None)],
                               "stream_id string, i bigint, size int")
    got = chained.pack_variable(df, 100, "stream_id", ["i"], "size").collect()
    assert [(r["block_id"], r["n_records"]) for r in got] == [(0, 2)]
    assert {r["i"] for r in chained.unpackable(df, 100, "size").collect()} == {2, 4}


@pytest.mark.parametrize("period,fan", [(1, 64), (2, 2), (7, 3), (500, 2)])
def test_progress_exact(spread, monkeypatch, period, fan):
    monkeypatch.setattr(chained, "FAN_IN", fan)
    rng = random.Random(period)
    rows, at = [], {"hot": 0.0, "a": 0.0}
    for i in range(1500):
        s = rng.choice(["hot", "hot", "a"])
        at[s] += rng.choice([0.0, 0.2, 0.9, 1.5, 4.0])
        rows.append((s, START + datetime.timedelta(seconds=at[s]), i))
    want = set()
    for s in at:
        last = None
        for r in sorted((r for r in rows if r[0] == s), key=lambda r: (r[1], r[2])):
            now = int((r[1] - START).total_seconds())
            if last is None or now - last >= period:
                want.add((s, r[2]))
                last = now
    rng.shuffle(rows)
    df = spread.createDataFrame(rows, "stream_id string, ts timestamp_ntz, i bigint")
    got = chained.progress_exact(df, period, ["i"], ["ts", "i"]).collect()
    assert {(r["stream_id"], r["i"]) for r in got} == want and len(got) == len(want)


def ring(spark, rows):
    return spark.createDataFrame(
        [(s, b, START + datetime.timedelta(hours=h), k) for s, b, h, k in rows],
        "stream_id string, block_id bigint, ts timestamp_ntz, kind string")


def test_occupancy_bounds(spread):
    early = [("early", 0, 0, "cleared"), ("early", 0, 1, "filled"), ("early", 1, 2, "filled")]
    never = [("never", b, b, "filled") for b in range(20)]
    got = metrics.occupancy(ring(spread, early + never), TINY).collect()
    used = {(r["stream_id"], r["ts"]): r["used_bytes"] // TINY.block_bytes for r in got}
    assert [used["early", START + datetime.timedelta(hours=h)] for h in range(3)] == [0, 0, 1]
    assert used["never", START + datetime.timedelta(hours=19)] == TINY.nbufs
    assert all(r["used_bytes"] + r["free_bytes"] == TINY.ring_bytes for r in got)
    at = F.lit(START + datetime.timedelta(hours=3)).cast("timestamp_ntz")
    part = {r["stream_id"]: r for r in metrics.snapshot(ring(spread, never), TINY, at).collect()}
    assert part["never"]["blocks_in_use"] == 4 and part["never"]["bytes_written"] == 16000


def test_dwell_keeps_open_blocks(spark):
    rows = [("s", 0, 0, "filled"), ("s", 0, 5, "cleared"), ("s", 1, 1, "filled"), ("s", 9, 2, "cleared")]
    got = {r["block_id"]: r["dwell_s"] for r in metrics.dwell(ring(spark, rows)).collect()}
    assert got == {0: 18000, 1: None}


def test_throughput_fills_idle_windows(spread, monkeypatch):
    monkeypatch.setattr(metrics, "FILL_CHUNK", 3)
    hours = [0, 0, 1, 5, 23]
    rows = [("s", START + datetime.timedelta(hours=h), i) for i, h in enumerate(hours)]
    got = metrics.throughput(frame(spread, rows), TINY, 3600).orderBy("win_start").collect()
    assert [r["packets"] for r in got] == [hours.count(h) for h in range(24)]
    runs = metrics.idle_runs(frame(spread, rows), 3600).orderBy("run_start").collect()
    assert [r["windows"] for r in runs] == [3, 17]


def test_every_offset_break(spread):
    extents = [("f", 0, 10), ("f", 10, 5), ("f", 20, 5), ("f", 25, 5), ("f", 31, 1), ("g", 7, 1)]
    df = spread.createDataFrame(extents, "key string, offset bigint, length bigint")
    every = metrics.offset_gaps(df, "key", first_only=False).orderBy("offset").collect()
    assert [(r["offset"], r["expected"], r["times"]) for r in every] == [(20, 15, 1), (31, 30, 1)]
    assert metrics.offset_gaps(df, "key").count() == 1


def test_offset_breaks_between_copies(spread):
    extents = [("f", 0, 10)] * 500 + [("f", 10, 5), ("g", 0, 0), ("g", 0, 0), ("g", 0, 3)]
    df = spread.createDataFrame(extents, "key string, offset bigint, length bigint")
    every = metrics.offset_gaps(df, "key", first_only=False).collect()
    assert [(r["key"], r["offset"], r["expected"], r["times"]) for r in every] == [("f", 0, 10, 499)]
    assert metrics.offset_gaps(df, "key").collect()[0]["expected"] == 10


def test_large_dimension_is_salted(spark):
    fact = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 > 0, 1).otherwise(
        F.col("id")).alias("k"))
    dim = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = joins.attach(fact, dim, ["k"], "left", ["id"])
    large = joins.attach(fact, dim, ["k"], "left", ["id"], limit=0)
    assert sorted(small.collect()) == sorted(large.collect()) and large.count() == 1000
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "broadcast" not in plan


def flow_packets(spark, sf):
    return views.packets(spark, sf)


def test_flow_split_is_complete(spark, sf):
    packets = flow_packets(spark, sf)
    n = flows.match(packets, views.ONE_RULE).count() + flows.unmatched(packets, views.ONE_RULE).count()
    assert n == packets.count()
    rules = views.flow_rules(spark)
    hit = flows.match_rules(packets, rules, ["seq"])
    semi = flows.match_rules(packets, rules, ["seq"], "left_semi").count()
    anti = flows.match_rules(packets, rules, ["seq"], "left_anti").count()
    assert hit.count() == semi and semi + anti == packets.count()
    counted = {r["rule_id"]: r["packets"] for r in flows.count_by_rule(
        packets, rules, F.octet_length("payload")).collect()}
    assert sum(counted.values()) == semi and counted[3] == 0


def test_undecoded_frames(spark, sf):
    packets = flow_packets(spark, sf)
    raw = frames.encode_packets(packets).select("seq", "frame")
    raw = raw.unionByName(raw.limit(3).withColumns(
        {"seq": -F.col("seq") - 1, "frame": F.substring("frame", 1, 20)}))
    hit = flows.match_frames(raw, views.ONE_RULE)
    want = flows.match(packets, views.ONE_RULE)
    assert sorted(r["seq"] for r in hit.collect()) == sorted(r["seq"] for r in want.collect())
    assert flows.unmatched_frames(raw, views.ONE_RULE).count() == raw.count() - want.count()
    rules = views.flow_rules(spark)
    by_rule = flows.match_frame_rules(raw, rules).select("seq", "rule_id")
    assert sorted(by_rule.collect()) == sorted(
        flows.match_rules(packets, rules).select("seq", "rule_id").collect())
    anti = flows.match_frame_rules(raw, rules, how="left_anti")
    assert anti.count() == raw.count() - by_rule.count()


def test_masked_flow(spark, sf):
    packets = flow_packets(spark, sf)
    masked = packets.filter(flows.masked_predicate({"src_port": (60003, 0x3), "eth_type": (2048, 0xFFFF)}))
    plain = packets.filter("src_port % 4 = 3 and eth_type = 2048")
    assert masked.count() == plain.count() > 0


def test_flow_filter_reaches_the_scan(spark, sf, tmp_path):
    path = str(tmp_path / "landed")
    flow_packets(spark, sf).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = flows.match(spark.read.parquet(path), views.ONE_RULE)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(src_port,60000)" in text and "EqualTo(eth_type,2048)" in text


def test_layout_of_direct_mode(spark):
    layout = Layout(16, 64, 50, 16)
    rows = [("s", START + datetime.timedelta(seconds=i), i) for i in range(33)]
    direct = assemble.blocks(assemble.position(frame(spark, rows)), layout, direct=True).collect()
    assert [(r["n_batches"], r["pad_bytes"]) for r in direct] == [(1, 2720)] * 2


def test_slices_are_cut_by_rows(spark, monkeypatch):
    """However many rows a partition has, a task holds those of one slice."""
    monkeypatch.setattr(chained, "SLICE_ROWS", 50)
    monkeypatch.setattr(chained, "FAN_IN", 3)
    rows = [(s, i, i * 37 % 61) for s, n in (("a", 1000), (None, 30), ("b", 333)) for i in range(n)]
    df = spark.createDataFrame(rows, "stream_id string, i bigint, size bigint").repartition(2)
    laid = ordered.lay_out(df.coalesce(1), ["stream_id"], ["i"])
    cut = chained._cut(laid)
    assert max(r["count"] for r in cut.groupBy(ordered.PART).count().collect()) <= 50
    assert cut.groupBy().agg(F.max_by(ordered.PART, ordered.ROW), F.max(ordered.PART)).first()[:1] == (
        cut.agg(F.max(ordered.PART)).first()[0],)
    got = {(r["stream_id"], r["block_id"]): (r["n_records"], r["used_bytes"])
           for r in chained.pack_variable(df, 100, "stream_id", ["i"], "size").collect()}
    want = {}
    for s in ("a", None, "b"):
        block, used, n = -1, 101, 0
        for _, _, size in (r for r in rows if r[0] == s):
            if used + size > 100:
                block, used, n = block + 1, 0, 0
            used, n = used + size, n + 1
            want[s, block] = (n, used)
    assert got == want


@pytest.mark.parametrize("spread_by", [None, ["id"]])
@pytest.mark.parametrize("null_safe", [False, True])
def test_a_side_measured_too_large_is_not_broadcast(spark, spread_by, null_safe):
    """Nor by Spark itself, whose estimate of the same side can be far below its size."""
    fact = spark.range(100).withColumn("k", F.col("id") % 7)
    dim = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    joined = joins.attach(fact, dim, ["k"], "left", spread_by, limit=0, null_safe=null_safe)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {(r["id"], r["w"]) for r in joined.collect()} == {(i, i % 7 * 10) for i in range(100)}

"""The named queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake import session
from framelake.functions import address, frames, header, layout, timestamps
from framelake.operators import assemble, chained, flows, joins, metrics, ordered, rules
from framelake.operators.numbering import Numbering
from framelake.plans import views
from framelake.plans.views import ALIGNED, SHORT, SMALL_BATCH, TINY
from framelake.sources import feed, headers, logs, recording, tail
from framelake.streaming import idle, jobs, sink
from framelake.streaming.inorder import InOrder, run
from framelake.streaming.record import recorder

HOUR = 3600
# Days read from recordings.
RANGE = (datetime.datetime(2024, 1, 10), datetime.datetime(2024, 1, 15))
# Bytes of logs that a micro-batch takes in.
LOG_BYTES = 256 << 10
PROGRESS_SECONDS = 2 * 24 * HOUR


def _joined(keys):
    return F.array_join(keys, ",")


# --- frames and scalars -------------------------------------------------------------

def pkt_decode(spark, sf_dir):
    framed = frames.encode_packets(views.packets(spark, sf_dir)).select("seq", "frame")
    return frames.decode(framed).select(
        "seq", "src_mac", "dst_mac", "eth_type", "src_ip", "dst_ip", "src_port", "dst_port",
        "udp_len", F.col("payload").cast("string").alias("payload_text"), "frame_len")


def pkt_encode(spark, sf_dir):
    framed = frames.encode_packets(views.packets(spark, sf_dir))
    return framed.select("seq", F.hex("frame").alias("frame_hex"))


def pkt_generate(spark, sf_dir):
    """Packets whose payload comes from a generator, encoded into frames."""
    def fill(df):
        return F.concat(F.encode(F.col("stream_id"), "UTF-8"), F.unhex(F.lpad(F.hex("seq"), 16, "0")))

    made = frames.fill_payload(views.packets(spark, sf_dir), fill)
    return frames.encode_packets(made).select("seq", F.hex("frame").alias("frame_hex"))


def pkt_split(spark, sf_dir):
    split = frames.split_payload(views.packets(spark, sf_dir).select("seq", "payload"), 4, 5)
    return split.select("seq", F.hex("head").alias("head_hex"), F.hex("data").alias("data_hex"),
                        "size_ok")


def ip_codec(spark, sf_dir):
    ip = F.col("src_ip")
    le = address.ip_to_le(ip)
    key = F.concat(F.lit("0x"), F.lower(F.hex("seq")))
    return views.packets(spark, sf_dir).select(
        "seq", ip.alias("ip"), le.alias("ip_le"), address.ip_to_be(ip).alias("ip_be"),
        address.ip_from_le(le).alias("ip_back"), key.alias("key_text"),
        address.hex_key(key).alias("key_value"))


def mac_codec(spark, sf_dir):
    number = F.col("event_id") * F.lit(2654435761) % F.lit(1 << 48)
    text = address.mac_from_bytes(address.packed_bytes((number, 6)))
    raw = address.mac_to_bytes(F.col("mac"))
    return (views.table(spark, sf_dir, "events")
            .select(F.col("event_id").alias("seq"), text.alias("mac"))
            .select("seq", "mac", F.hex(raw).alias("mac_hex"),
                    address.mac_from_bytes(raw).alias("mac_back")))


def utc_mjd(spark, sf_dir):
    ts = F.col("ts")
    mjd = timestamps.mjd(ts)
    return views.table(spark, sf_dir, "events").select(
        "event_id", F.round(mjd, 9).alias("mjd"), timestamps.mjd_text(mjd).alias("mjd_text"),
        timestamps.utc_stamp(ts).alias("utc_start"))


# --- layouts, configurations, headers -----------------------------------------------

def layout_plan(spark, sf_dir):
    return layout.plan(views.layouts(spark, sf_dir)).select(
        "name", "pkt_size", "batch_bytes", "block_bytes", "ring_bytes", "file_bytes",
        "n_batches", "pad_bytes", "aligned", "rejected")


def config_check(spark, sf_dir):
    return layout.check(views.configs(spark, sf_dir)).select(
        "id", _joined("failed_rules").alias("failed_rules"), "nsge_eff", "queue_depth", "ok")


def header_parse(spark, sf_dir):
    return header.parse(views.headers(spark, sf_dir)).select(
        "file_id", "nant", "pkt_header", "pkt_data", "pkt_nsamp", "pkt_tsamp", "pkt_npol",
        "pkt_nbit", "bytes_per_second", "hdr_version", "resolution")


def header_validate(spark, sf_dir):
    return header.validate(views.headers(spark, sf_dir)).select(
        "file_id", _joined("missing_keys").alias("missing_keys"),
        _joined("duplicate_keys").alias("duplicate_keys"), "ok")


def header_render(spark, sf_dir):
    rendered = _stamped(spark, sf_dir).select("file_id", header.render().alias("header_text"))
    return rendered.select("file_id", "header_text",
                           F.octet_length(header.pad(F.col("header_text"))).alias("header_len"))


def header_files(spark, sf_dir):
    """Headers written as text files and read back: parsed ones, and the rejects."""
    folder = f"{session.scratch(spark, 'headers')}/text"
    headers.write_files(views.headers(spark, sf_dir), folder, "file_id")
    good, bad = headers.read(spark, folder)
    columns = ["file_id", "nant", "bytes_per_second", "n_missing"]
    number = F.col("key").cast("bigint").alias("file_id")
    read = good.select(number, "nant", "bytes_per_second", F.lit(0).alias("n_missing"))
    return read.unionByName(bad.select(
        number, F.lit(None).cast("int").alias("nant"), F.lit(None).cast("bigint").alias("bytes_per_second"),
        F.size("missing_keys").alias("n_missing"))).select(*columns)


def _stamped(spark, sf_dir):
    """Typed headers with the fields that a recording adds."""
    started = (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
               + F.make_dt_interval(secs=F.col("file_id") * 4321))
    return (header.parse(views.headers(spark, sf_dir))
            .withColumn("file_size", F.lit(TINY.file_bytes).cast("bigint"))
            .withColumn("mjd_start", timestamps.mjd(started))
            .withColumn("utc_start", timestamps.utc_stamp(started))
            .filter(F.col("pkt_nbit").isNotNull()))


def header_versions(spark, sf_dir):
    """Typed headers written as files with version lines, and what stands in them."""
    folder = f"{session.scratch(spark, 'headers')}/text"
    headers.write_text(_stamped(spark, sf_dir), folder, "file_id")
    return headers.read_text(spark, folder).select(
        F.col("key").cast("bigint").alias("file_id"), F.col("header_text"))


def header_consistency(spark, sf_dir):
    checked = header.consistency(
        header.parse(views.headers(spark, sf_dir)), TINY.pkts_per_block)
    return checked.select(
        "file_id", "data_ok", "resolution_ok", F.round("pkt_per_s", 9).alias("pkt_per_s"),
        F.round("implied_us", 9).alias("implied_us"),
        F.round("declared_us", 9).alias("declared_us"), "rate_ok")


# --- flows ---------------------------------------------------------------------------

def flow_filter(spark, sf_dir):
    return flows.match(views.packets(spark, sf_dir), views.ONE_RULE).select(
        "seq", "stream_id", "src_ip")


def flow_filter_raw(spark, sf_dir):
    raw = frames.encode_packets(views.packets(spark, sf_dir)).select("seq", "stream_id", "frame")
    return frames.decode(flows.match_frames(raw, views.ONE_RULE)).select(
        "seq", "stream_id", "src_ip")


def flow_unmatched(spark, sf_dir):
    return flows.unmatched(views.packets(spark, sf_dir), views.ONE_RULE).select(
        "seq", "stream_id", "src_ip")


def _frame_length():
    return F.octet_length("payload") + F.lit(frames.HEADER_BYTES)


def flow_rules(spark, sf_dir):
    return flows.count_by_rule(
        views.packets(spark, sf_dir), views.flow_rules(spark), _frame_length())


def flow_match_rows(spark, sf_dir):
    """Every packet with the rule it satisfies, and those that satisfy none."""
    packets, wanted = views.packets(spark, sf_dir), views.flow_rules(spark)
    matched = flows.match_rules(packets, wanted).select("stream_id", "seq", "rule_id")
    none = flows.match_rules(packets, wanted, how="left_anti").select(
        "stream_id", "seq", F.lit(None).cast("int").alias("rule_id"))
    return matched.unionByName(none)


def flow_match_frames(spark, sf_dir):
    """Stored, undecoded frames that satisfy a rule, decoded afterwards."""
    raw = session.stored(frames.encode_packets(views.packets(spark, sf_dir)).select("seq", "frame"), "frames")
    found = flows.match_frame_rules(raw, views.flow_rules(spark))
    return frames.decode(found, "frame").select("seq", "rule_id", "src_ip", "src_port")


def flow_masked(spark, sf_dir):
    """Packets from either port of a pair: the lowest bit is not compared."""
    wanted = flows.masked_predicate({"dst_port": (17202, 0xFFFF), "src_port": (60000, 0xFFFE)})
    return views.packets(spark, sf_dir).filter(wanted).select("stream_id", "seq", "src_port", "dst_port")


def flow_masked_rules(spark, sf_dir):
    """Every packet with the rule of highest precedence among those it satisfies under their masks."""
    packets = views.packets(spark, sf_dir).drop("payload")
    found = rules.best_rule(packets, views.masked_rules(spark, sf_dir), spread_by=["seq"])
    return found.select("stream_id", "seq", "rule_id", "priority")


def flow_summary(spark, sf_dir):
    return flows.summary(views.packets(spark, sf_dir), ["src_ip", "dst_port"], _frame_length())


# --- assembly ------------------------------------------------------------------------

def arrival_position(spark, sf_dir):
    return views.positioned(spark, sf_dir).select("stream_id", "seq", "pos")


def position_dense(spark, sf_dir):
    """Sequence numbers of the table count all its packets: one dense stream."""
    packets = views.packets(spark, sf_dir).select(F.lit("all").alias("stream_id"), "seq")
    return assemble.position_dense(packets)


def position_append(spark, sf_dir):
    """Positions after three appends: the first half of the time but for some packets, the second
    half, and those that were late."""
    packets = views.arrivals(spark, sf_dir)
    late = F.col("seq") % 97 == 5
    span = packets.agg(F.unix_micros(F.min("arrival_ts").cast("timestamp")).alias("lo"),
                       F.unix_micros(F.max("arrival_ts").cast("timestamp")).alias("hi")).first()
    numbering = Numbering(spark, session.scratch(spark, "numbering"), HOUR)
    if span["lo"] is not None:
        early = F.unix_micros(F.col("arrival_ts").cast("timestamp")) < (span["lo"] + span["hi"]) // 2
        for part in (early & ~late, ~early, early & late):
            numbering.append(packets.filter(part))
    return numbering.positions().select("stream_id", "seq", "pos")


def batch_assemble(spark, sf_dir):
    return assemble.batches(views.positioned(spark, sf_dir), TINY).select(
        "stream_id", "batch_id", "n_packets", "first_seq", "last_seq", "bytes")


def block_assemble(spark, sf_dir):
    return assemble.blocks(views.positioned(spark, sf_dir), TINY)


def block_assemble_direct(spark, sf_dir):
    return assemble.blocks(views.positioned(spark, sf_dir), TINY, direct=True)


def block_countdown(spark, sf_dir):
    small = assemble.batches(views.positioned(spark, sf_dir), SMALL_BATCH)
    return assemble.countdown(small, SMALL_BATCH)


def ring_slots(spark, sf_dir):
    return assemble.ring_slots(block_assemble(spark, sf_dir), TINY).select(
        "stream_id", "block_id", "slot")


def file_rollover(spark, sf_dir):
    return assemble.files(block_assemble(spark, sf_dir), TINY)


def blocks_with_header(spark, sf_dir):
    parsed = header.parse(views.headers(spark, sf_dir)).select(
        "file_id", "nant", "bytes_per_second")
    return assemble.attach_header(block_assemble(spark, sf_dir), parsed, TINY).select(
        "stream_id", "block_id", "file_id", "nant", "bytes_per_second")


def lookup_fallback(spark, sf_dir):
    suppliers = ordered.positions(
        views.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), [], ["s_suppkey"],
        "s_index")
    lines = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("address"),
        (F.col("l_suppkey") + F.col("l_linenumber") * 4).alias("slot"))
    return joins.lookup_with_fallback(
        lines, suppliers, "address", "slot", "s_suppkey", "s_index", "s_name",
        spread_by=["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "address", "slot", "s_name", "how")


def pack_variable(spark, sf_dir):
    records = views.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("stream_id"), "l_orderkey", "l_linenumber",
        (F.lit(16) + F.col("l_quantity").cast("bigint") * 8).alias("size"),
        "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    # The columns after the size change nothing in the result: they let the sort cut
    # through an order with very many lines.
    order = ["l_orderkey", "l_linenumber", "size", "l_partkey", "l_suppkey", "l_shipdate",
             "l_extendedprice"]
    return chained.pack_variable(records, TINY.block_bytes, "stream_id", order, "size")


# --- metrics -------------------------------------------------------------------------

def throughput(spark, sf_dir):
    rows = metrics.throughput(
        views.packets(spark, sf_dir).select("stream_id", "arrival_ts"), ALIGNED, HOUR)
    return rows.withColumn("gbps", F.round("gbps", 12))


def idle_runs(spark, sf_dir):
    return metrics.idle_runs(
        views.packets(spark, sf_dir).select("stream_id", "arrival_ts"), 600)


def block_dwell(spark, sf_dir):
    return metrics.dwell(views.ring_log(spark, sf_dir))


def ring_occupancy(spark, sf_dir):
    rows = metrics.occupancy(views.ring_log(spark, sf_dir), TINY)
    return rows.withColumn("fill_pct", F.round("fill_pct", 9))


def ring_snapshot(spark, sf_dir):
    return metrics.snapshot(views.ring_log(spark, sf_dir), TINY)


def ring_snapshot_at(spark, sf_dir):
    """Counters of its stream's buffer when each packet arrived."""
    probes = views.arrivals(spark, sf_dir).select("stream_id", "seq", F.col("arrival_ts").alias("at"))
    return metrics.snapshot_at(views.ring_log(spark, sf_dir), probes, TINY).select(
        "stream_id", "seq", "blocks_in_use", "bytes_written", "bytes_read", "bytes_available")


def block_as_of(spark, sf_dir):
    """The block filled last when each packet arrived."""
    probes = views.arrivals(spark, sf_dir)
    filled = views.ring_log(spark, sf_dir).filter("kind = 'filled'").select(
        "stream_id", F.col("ts").alias("arrival_ts"), "block_id", F.col("ts").alias("fill_ts"))
    return ordered.as_of(probes, filled, ["stream_id"], "arrival_ts", ["block_id", "fill_ts"], ["block_id"]).select(
        "stream_id", "seq", "block_id", "fill_ts")


def progress_windowed(spark, sf_dir):
    # At one time fills precede clears ("filled" sorts after "cleared").
    rows = metrics.occupancy(views.ring_log(spark, sf_dir), TINY).withColumn(
        "_after", F.when(F.col("kind") == "filled", 0).otherwise(1))
    out = metrics.progress_windowed(rows, ["blocks_written", "fill_pct"],
                                    ["ts", "_after", "block_id"], PROGRESS_SECONDS)
    return out.withColumn("fill_pct", F.round("fill_pct", 9))


def progress_exact(spark, sf_dir):
    rows = metrics.occupancy(views.ring_log(spark, sf_dir), TINY).filter(
        F.col("kind") == "filled")
    out = chained.progress_exact(rows, PROGRESS_SECONDS, ["blocks_written", "fill_pct"],
                                 ["ts", "block_id"])
    return out.withColumn("fill_pct", F.round("fill_pct", 9))


def offset_gaps(spark, sf_dir):
    extents = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", ((F.col("l_linenumber") - 1) * F.lit(4000).cast("bigint")).alias("offset"),
        F.when(F.col("l_linestatus") == "F", 4000).otherwise(3920).cast("bigint").alias("length"))
    return metrics.offset_gaps(extents, "l_orderkey")


def _write_logs(spark, sf_dir):
    """Hourly log lines per stream, written as text files below the folder returned. A run starts
    each week, with two damaged lines and a counter of the buffer; every event counts as one
    aligned block."""
    per_hour = metrics.throughput(
        views.packets(spark, sf_dir).select("stream_id", "arrival_ts"), ALIGNED, HOUR)
    size = F.lit(ALIGNED.block_bytes)
    n_bytes = F.col("packets") * size
    week = F.timestamp_diff(
        "HOUR", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("win_start")) % 168 == 0
    used = F.pmod("packets", F.lit(ALIGNED.nbufs + 1))
    report = F.when(F.col("packets") > 0, F.format_string(
        logs.BANDWIDTH_LINE, F.date_format("win_start", "'year:'yyyy',month:'MM',day:'dd',hours:'HH"),
        timestamps.whole_kb(n_bytes), timestamps.gbps(n_bytes, F.lit(HOUR * 1_000_000)),
        F.lit(HOUR * 1000))).otherwise(F.format_string(logs.IDLE_LINE, F.lit(HOUR * 1_000_000).cast("bigint")))
    progress = F.format_string(
        logs.PROGRESS_LINE, F.col("packets"), timestamps.percent(used, F.lit(ALIGNED.nbufs)),
        F.shiftright(used * size, 20), F.lit(ALIGNED.ring_bytes >> 20))
    marks = (F.format_string(logs.STARTED_LINE, F.date_format("win_start", "yyyy-MM-dd HH:mm:ss")),
             F.lit("[Progress] Blocks written: 7 | Ring buffer: 1.2.3% full (5/8 MB)"),
             F.lit("Run started at: 2024-13-01 00:00:00"),
             F.format_string(logs.COUNTER_LINE, F.lit("blocks_in_use"), used))
    lines = per_hour.select(
        F.col("stream_id").alias("file"), F.col("win_start"),
        F.posexplode(F.array(*[F.when(week, m) for m in marks], progress, report)).alias("part", "value")
    ).filter("value is not null")
    path = f"{session.scratch(spark, 'logs')}/text"
    logs.write(lines, path, "file", ["win_start", "part"])
    return path


LOG_COLUMNS = ["run_id", "line_no", "kind", "blocks", "fill_pct", "kb", "gbps", "counter", "amount"]


def log_metrics(spark, sf_dir):
    """Log lines read back as typed rows with their runs."""
    return logs.read_folders(spark, _write_logs(spark, sf_dir)).select("file", *LOG_COLUMNS)


def stream_log_metrics(spark, sf_dir):
    """Live form of log_metrics: the logs followed by steps of some bytes, which cut them anywhere."""
    path = _write_logs(spark, sf_dir)
    rows = tail.follow(spark, path, session.scratch(spark, "tail"), LOG_BYTES, folder="file")
    runs = jobs.LogRuns(spark, session.scratch(spark, "stream"))
    _run(rows, runs)
    return runs.result(spark).select(F.col("log").alias("file"), *LOG_COLUMNS)


# --- recordings ----------------------------------------------------------------------

def record_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the document packets as recordings: only published blocks, padded.

    Documents are numbered, by a running sum of their packets; the packets follow by adding
    up, so payloads move once, to their file.
    """
    sizes = views.document_sizes(spark, sf_dir)
    upto = ordered.running_sums(sizes, ["stream_id"], ["doc_id"], {"_upto": F.col("n_chunks")})
    starts = session.durable(upto.select(
        "stream_id", "doc_id", (F.col("_upto") - F.col("n_chunks")).alias("start")))
    totals = sizes.groupBy("stream_id").agg(F.sum("n_chunks").alias("_total"))
    placed = joins.attach(views.document_packets(spark, sf_dir, starts), totals, ["stream_id"], "left",
                          spread_by=["pos"], null_safe=True)
    per_block = TINY.send_n * TINY.batches_per_block
    block = assemble.div(F.col("pos"), per_block)

    def name(file_id):
        return F.concat_ws("_", "stream_id", F.lpad(file_id.cast("string"), 8, "0"))

    body = placed.filter(block < assemble.div(F.col("_total"), per_block)).select(
        name(assemble.div(block, TINY.blocks_per_file)).alias("file"), block.alias("block_id"),
        F.pmod("pos", F.lit(per_block)).alias("ordinal"), "payload")
    last = assemble.div(assemble.div(F.col("_total"), per_block) - 1, TINY.blocks_per_file)
    files = totals.filter(F.col("_total") >= per_block).select(
        "stream_id", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("file_id"))
    started = (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
               + F.make_dt_interval(hours=F.col("file_id").cast("int")))
    heads = recording.headers_for(
        files.select(name(F.col("file_id")).alias("file"), started.alias("first_ts")),
        views.HEADER_FIELDS, TINY)
    recording.write(body, heads, path, TINY)


def recording_roundtrip(spark, sf_dir):
    path = f"{session.scratch(spark, 'recordings')}/files"
    record_documents(spark, sf_dir, path)
    return recording.read(spark, path, TINY).select(
        "file", "block_index", "packet_index", F.md5("payload").alias("payload_md5"))


def recording_range(spark, sf_dir):
    """All packets recorded with their times, then those of blocks that reach into five days."""
    path = f"{session.scratch(spark, 'recordings')}/files"
    padded = F.expr(f"substring(concat(payload, unhex(repeat('00', {SHORT.pkt_size}))), 1, {SHORT.pkt_size})")
    placed = assemble.position(views.packets(spark, sf_dir).select(
        "stream_id", "seq", "arrival_ts", padded.alias("payload")))
    per_block = SHORT.send_n * SHORT.batches_per_block
    totals = placed.groupBy("stream_id").agg(F.count(F.lit(1)).alias("_n"))
    block = assemble.div(F.col("pos"), per_block)
    rows = joins.attach(placed, totals, ["stream_id"], "left", null_safe=True).filter(
        block < assemble.div(F.col("_n"), per_block)).select(
        F.concat_ws("_", "stream_id", F.lpad(assemble.div(block, SHORT.blocks_per_file).cast("string"), 8, "0")).alias("file"),
        block.alias("block_id"), F.pmod("pos", F.lit(per_block)).alias("ordinal"), "payload", "arrival_ts")
    rows = session.stored(rows, "placed")
    firsts = rows.groupBy("file").agg(F.min("arrival_ts").alias("first_ts"))
    fields = {**views.HEADER_FIELDS, "pkt_header": SHORT.pkt_header, "pkt_data": SHORT.pkt_data}
    recording.write(rows, recording.headers_for(firsts, fields, SHORT), path, SHORT)
    found = recording.read(spark, path, SHORT, times=True, between=RANGE)
    return found.select(
        F.regexp_extract("file", "^(.*)_[0-9]+[.]rec$", 1).alias("stream_id"),
        (recording.file_number(F.col("file")) * SHORT.blocks_per_file + F.col("block_index")).alias("block_id"),
        "packet_index", F.md5("payload").alias("payload_md5"),
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_ts", "last_ts")])


# --- streams -------------------------------------------------------------------------
# The events, or what was derived from them, followed as a stream until drained.

# What a micro-batch takes in at first and what that grows to behind a backlog, what a task of it
# reads, and how far behind the newest row another may come: results go out while the stream
# runs, the rest at its end.
FEED_BYTES = 1 << 20
FEED_LIMITS = {"max_bytes": FEED_BYTES, "most_bytes": feed.MAX_BYTES, "split_bytes": 8 << 20}
LATENESS = 24 * HOUR


def _run(rows, sink):
    feed.drain(run(rows, sink, session.scratch(rows.sparkSession, "state"), finite=False))


def _drained(rows, step, ts="arrival_ts", hook=None):
    spark = rows.sparkSession
    sink = InOrder(spark, session.scratch(spark, "stream"), step, ts, LATENESS, hook)
    _run(rows, sink)
    sink.finish(spark)
    return sink.result(spark)


def _followed(spark, sf_dir):
    return views.packets_of(views.follow(spark, sf_dir, "events", **FEED_LIMITS))


def _landed(rows, label, ts):
    """Rows written as files in the order of their times, and followed as a stream."""
    spark = rows.sparkSession
    path = f"{session.scratch(spark, label)}/landed"
    rows.repartitionByRange(ts).sortWithinPartitions(ts).write.parquet(path)
    return feed.follow(spark, path, rows.schema, session.scratch(spark, "feed"), order="name", **FEED_LIMITS)


def _in_order(spark, sf_dir, *columns):
    """Packets landed in the order of their times: a table that is not, such as one appended to
    with older rows, would be further behind than the lateness and lose them."""
    return _landed(views.packets(spark, sf_dir).select(*columns), "packets", "arrival_ts")


def stream_source(spark, sf_dir):
    """The events, admitted by bytes, appended to a Parquet sink."""
    folder = f"{session.scratch(spark, 'appended')}/rows"
    rows = _followed(spark, sf_dir).select("stream_id", "seq", "src_ip", F.md5("payload").alias("payload_md5"))
    feed.drain(jobs.start(rows, folder, session.scratch(spark, "state"), finite=False))
    return spark.read.schema(rows.schema).parquet(folder)


def stream_idle(spark, sf_dir):
    """Live form of idle_runs: windows go out as the watermark passes them, idle ones too. A row
    behind the last packet moves the watermark past it."""
    arrivals = views.arrivals(spark, sf_dir)
    end = arrivals.agg(F.max("arrival_ts").alias("arrival_ts")).select(
        F.lit("end of data").alias("stream_id"), (F.col("arrival_ts") + F.expr("interval 2 days")).alias("arrival_ts"))
    packets = _landed(arrivals.select("stream_id", "arrival_ts").unionByName(end), "packets", "arrival_ts")
    folder = f"{session.scratch(spark, 'idle')}/rows"
    rows = idle.windows(packets, 600, "1 day")
    feed.drain(idle.start(rows, folder, session.scratch(spark, "state")))
    found = idle.runs(spark.read.schema(rows.schema).parquet(folder))
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("run_start", "run_end")})


def stream_status(spark, sf_dir):
    """Status rows of the buffer's log, appended to a Parquet sink as they come."""
    folder = f"{session.scratch(spark, 'status')}/rows"
    log = _landed(views.ring_log(spark, sf_dir), "ring", "ts")
    rows = log.select("stream_id", "ts", "kind", "block_id", F.pmod("block_id", F.lit(TINY.nbufs)).alias("slot"))
    feed.drain(jobs.start(rows, folder, session.scratch(spark, "state"), finite=False))
    return spark.read.schema(rows.schema).parquet(folder)


def stream_dwell(spark, sf_dir):
    """Live form of block_dwell: fills and clears joined as they come. A row far behind the
    log on either side moves the watermark past its end."""
    log = views.ring_log(spark, sf_dir)
    end = log.agg(F.max("ts").alias("ts")).select(
        F.lit("end of data").alias("stream_id"), F.lit(-1).cast("bigint").alias("block_id"),
        (F.col("ts") + F.expr("interval 400 days")).alias("ts"))
    sides = [_landed(log.filter(F.col("kind") == kind).select("stream_id", "block_id", "ts").unionByName(end), kind, "ts")
             for kind in ("filled", "cleared")]
    rows = jobs.dwell(*sides, lateness="1 day", bound="97 hours")
    folder = f"{session.scratch(spark, 'dwell')}/rows"
    feed.drain(jobs.start(rows, folder, session.scratch(spark, "state"), finite=False))
    found = spark.read.schema(rows.schema).parquet(folder).filter("block_id >= 0")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("fill_ts", "clear_ts")})


def stream_sink(spark, sf_dir):
    """All packets as one stream, whose sequence numbers count it, recorded by the streaming
    sink and sealed at its end."""
    folder = f"{session.scratch(spark, 'sink')}/files"
    padded = F.expr(f"substring(concat(payload, unhex(repeat('00', {SHORT.pkt_size}))), 1, {SHORT.pkt_size})")
    rows = _followed(spark, sf_dir).select(F.lit("all").alias("stream_id"), "seq", "arrival_ts", padded.alias("payload"))
    feed.drain(sink.start(sink.place(rows, SHORT), folder, session.scratch(spark, "state")))
    fields = {**views.HEADER_FIELDS, "pkt_header": SHORT.pkt_header, "pkt_data": SHORT.pkt_data}
    sink.seal(spark, folder, SHORT, fields)
    sink.seal(spark, folder, SHORT, fields, last=True)
    return recording.read(spark, folder, SHORT).select(
        (recording.file_number(F.col("file")) * SHORT.blocks_per_file + F.col("block_index")).alias("block_id"),
        "packet_index", F.md5("payload").alias("payload_md5"))


def stream_batches(spark, sf_dir):
    """Batches, with the incomplete last one of every stream that ends: an end-of-data row
    follows the last packet of every stream but the purchases."""
    packets = views.arrivals(spark, sf_dir)
    ends = packets.groupBy("stream_id").agg(F.max("arrival_ts").alias("arrival_ts")).filter(
        "stream_id <> 'purchase'").select(
        "stream_id", F.lit(None).cast("bigint").alias("seq"), "arrival_ts", F.lit(True).alias("eod"))
    both = _landed(packets.withColumn("eod", F.lit(False)).unionByName(ends), "packets", "arrival_ts")
    return jobs.as_batches(_drained(both, jobs.batches(TINY)), TINY)


def stream_blocks(spark, sf_dir):
    rows = jobs.as_blocks(_drained(_in_order(spark, sf_dir, "stream_id", "seq", "arrival_ts"), jobs.blocks(TINY)), TINY)
    return rows.withColumn("fill_ts", F.col("fill_ts").cast("timestamp_ntz"))


def stream_throughput(spark, sf_dir):
    counts = jobs.WindowCounts(spark, session.scratch(spark, "stream"), ALIGNED, HOUR)
    _run(_followed(spark, sf_dir), counts)
    rows = counts.result(spark)
    return rows.select("stream_id", F.col("win_start").cast("timestamp_ntz").alias("win_start"),
                       "packets", "kb", F.round("gbps", 12).alias("gbps"))


def stream_occupancy(spark, sf_dir):
    log = _landed(views.ring_log(spark, sf_dir), "ring", "ts")
    rows = _drained(log, jobs.Occupancy(TINY), "ts")
    return rows.withColumns({"ts": F.col("ts").cast("timestamp_ntz"),
                             "fill_pct": F.round("fill_pct", 9)})


def stream_progress(spark, sf_dir):
    filled = _landed(views.ring_log(spark, sf_dir).filter(F.col("kind") == "filled"), "ring", "ts")
    rows = _drained(filled, jobs.Progress(PROGRESS_SECONDS, {"block_id": "bigint"}, ["ts", "block_id"]), "ts")
    return rows.select("stream_id", "block_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


def stream_recording(spark, sf_dir):
    """All packets recorded live, short payloads padded, end of data included, and read back.
    One stream has no id, and ids of others hold a slash and an underscore."""
    stream = (F.when(F.col("stream_id") == "view", None).when(F.col("stream_id") == "click", "a/b_c")
              .otherwise(F.col("stream_id")))
    padded = F.expr(f"substring(concat(payload, unhex(repeat('00', {SHORT.pkt_size}))), 1, {SHORT.pkt_size})")
    rows = _in_order(spark, sf_dir, stream.alias("stream_id"), "seq", "arrival_ts", padded.alias("payload"))
    live = recorder(spark, session.scratch(spark, "live"), SHORT, {
        **views.HEADER_FIELDS, "pkt_header": SHORT.pkt_header, "pkt_data": SHORT.pkt_data}, LATENESS)
    _run(rows, live)
    live.finish(spark)
    return recording.read(spark, live.step.files, SHORT).select(
        recording.stream_of(F.col("file")).alias("stream_id"),
        (recording.file_number(F.col("file")) * SHORT.blocks_per_file + F.col("block_index")).alias("block_id"),
        "packet_index", F.md5("payload").alias("payload_md5"))


def stream_hook(spark, sf_dir):
    """Blocks handed to a user's function as they are published: it writes what it got, under the
    number of the release."""
    folder = f"{session.scratch(spark, 'hook')}/blocks"

    def publish(blocks, release):
        jobs.as_blocks(blocks, TINY).write.mode("overwrite").parquet(f"{folder}/release={release}")

    _drained(_in_order(spark, sf_dir, "stream_id", "seq", "arrival_ts"), jobs.blocks(TINY), hook=publish)
    return spark.read.parquet(folder).select("stream_id", "block_id", "n_packets")


def stream_packing(spark, sf_dir):
    """Live form of pack_variable; every stream ends with an end-of-data row, which sends on
    its last block."""
    rows = views.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("stream_id"), F.col("l_shipdate").cast("timestamp").alias("ts"),
        "l_orderkey", "l_linenumber", (F.lit(16) + F.col("l_quantity").cast("bigint") * 8).alias("size"),
        F.lit(False).alias("eod"))
    empty = {c: F.lit(None).cast(rows.schema[c].dataType) for c in ("l_orderkey", "l_linenumber", "size")}
    ends = rows.groupBy("stream_id").agg(F.max("ts").alias("ts")).select(
        "stream_id", "ts", *[v.alias(c) for c, v in empty.items()], F.lit(True).alias("eod"))
    return _drained(_landed(rows.unionByName(ends), "records", "ts"),
                    jobs.Packing(4000, ["ts", "l_orderkey", "l_linenumber", "size"]), "ts")


QUERIES = {fn.__name__: fn for fn in (
    pkt_decode, pkt_encode, pkt_split, ip_codec, mac_codec, utc_mjd,
    layout_plan, config_check, header_parse, header_validate, header_render,
    header_consistency, flow_filter, flow_filter_raw, flow_unmatched, flow_rules, flow_summary,
    arrival_position, batch_assemble, block_assemble, block_assemble_direct,
    block_countdown, ring_slots, file_rollover, blocks_with_header, lookup_fallback,
    pack_variable, throughput, idle_runs, block_dwell, ring_occupancy, ring_snapshot,
    progress_windowed, progress_exact, offset_gaps, log_metrics, recording_roundtrip,
    stream_batches, stream_blocks, stream_throughput, stream_occupancy, stream_progress,
    stream_recording, stream_packing, flow_match_rows, flow_match_frames, flow_masked,
    position_dense, header_files, pkt_generate, stream_hook, stream_source, stream_status, stream_dwell, stream_idle,
    position_append, stream_log_metrics, recording_range,
    stream_sink, flow_masked_rules, ring_snapshot_at, block_as_of, header_versions)}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return throughput(spark, sf_dir)

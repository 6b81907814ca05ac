"""Capture data derived from the benchmark tables.

Everything is a per-row expression over the given tables, so each view grows with
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake import session
from framelake.functions.layout import ALIGNED, TINY, Layout  # noqa: F401
from framelake.operators import assemble
from framelake.operators.joins import attach
from framelake.operators.rules import prefix_mask
from framelake.sources import feed

# Twelve batches per block, so that the countdown has something to count.
SMALL_BATCH = Layout(pkt_header=16, pkt_data=64, pkts_per_block=50, send_n=4)
# Nine-byte packets, ten to a block, as the event payloads are short.
SHORT = Layout(pkt_header=4, pkt_data=5, pkts_per_block=11, send_n=5, blocks_per_file=100)

HEADER_FIELDS = {
    "nant": 2, "pkt_header": 16, "pkt_data": 64, "pkt_nsamp": 8, "pkt_tsamp": 0.001,
    "pkt_npol": 2, "pkt_nbit": 2, "bytes_per_second": 80000}

SRC_MAC = "02:a2:02:00:02:fa"
DST_MAC = "10:70:fd:11:e2:e3"
DST_IP = "10.17.16.11"
ONE_RULE = {"src_mac": SRC_MAC, "dst_mac": DST_MAC, "src_ip": "10.17.0.12", "dst_ip": DST_IP,
            "src_port": 60000, "dst_port": 17202}
RULES = [(1, "10.17.0.12", 60000), (2, "10.17.0.13", 60001), (3, "10.17.0.12", 60002)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session.pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def follow(spark: SparkSession, sf_dir: str, name: str, **limits) -> DataFrame:
    """A table as a stream; ``limits`` say how much of it a micro-batch takes in."""
    rows = table(spark, sf_dir, name)
    return feed.follow(spark, f"{sf_dir}/{name}.parquet", rows.schema, session.scratch(spark, "feed"), **limits)


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_of(table(spark, sf_dir, "events"))


def packets_of(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    return events.select(
        F.col("event_type").alias("stream_id"), F.col("event_id").alias("seq"),
        F.col("ts").alias("arrival_ts"),
        F.lit(SRC_MAC).alias("src_mac"), F.lit(DST_MAC).alias("dst_mac"),
        F.concat(F.lit("10.17."), assemble.div(user, 256).cast("string"), F.lit("."),
                 (user % 256).cast("string")).alias("src_ip"),
        F.lit(DST_IP).alias("dst_ip"),
        (F.lit(60000) + user % 4).cast("int").alias("src_port"),
        F.when(F.col("event_type") == "purchase", 17201).otherwise(17202).alias("dst_port"),
        F.when(F.col("event_id") % 50 == 0, 2054).otherwise(2048).alias("eth_type"),
        F.col("props").cast("binary").alias("payload"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that ordering and counting need."""
    return packets(spark, sf_dir).select("stream_id", "seq", "arrival_ts")


def positioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.position(arrivals(spark, sf_dir))


def flow_rules(spark: SparkSession) -> DataFrame:
    rows = [(i, SRC_MAC, DST_MAC, ip, DST_IP, port, 17202) for i, ip, port in RULES]
    return spark.createDataFrame(
        rows, "rule_id int, src_mac string, dst_mac string, src_ip string, dst_ip string, "
              "src_port int, dst_port int")


# Prefix lengths and port masks of the rules below, by customer.
PREFIXES = (32, 30, 28, 24)
PORT_MASKS = (0xFFFF, 0xFFFE, 0)


def masked_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per customer: address prefixes of four lengths, port masks, every fifth without a
    port of destination, priorities that tie."""
    key = F.col("c_custkey")
    address = F.concat(F.lit("10.17."), F.pmod(assemble.div(key, 256), F.lit(256)).cast("string"), F.lit("."),
                       F.pmod(key, F.lit(256)).cast("string"))

    def pick(values, by):
        return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), (F.pmod(by, F.lit(len(values))) + 1).cast("int"))

    return table(spark, sf_dir, "customer").select(
        key.alias("rule_id"), (key * 7919 % 100).alias("priority"),
        F.lit(None).cast("string").alias("src_mac"), F.lit(DST_MAC).alias("dst_mac"), address.alias("src_ip"),
        pick([prefix_mask(n) for n in PREFIXES], key).alias("src_ip_mask"), F.lit(DST_IP).alias("dst_ip"),
        (F.lit(60000) + key % 4).cast("int").alias("src_port"), pick(PORT_MASKS, key).alias("src_port_mask"),
        F.when(key % 5 != 0, 17202).cast("int").alias("dst_port"))


def ring_log_of(blocks: DataFrame) -> DataFrame:
    """Fill and clear events; every tenth block is never cleared."""
    block = F.col("block_id")
    delay = F.make_dt_interval(hours=((block * 37) % 97).cast("int"))
    events = F.array(
        F.struct(F.lit("filled").alias("kind"), F.col("fill_ts").alias("ts")),
        F.struct(F.lit("cleared").alias("kind"),
                 F.when(block % 10 != 9, F.col("fill_ts") + delay).alias("ts")))
    # One pass over the blocks instead of a union that would compute them twice.
    return (blocks.select("stream_id", "block_id", F.explode(events).alias("e"))
            .select("stream_id", "block_id", "e.ts", "e.kind").filter("ts is not null"))


def ring_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_log_of(assemble.blocks(positioned(spark, sf_dir), TINY))


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header text per customer: some lack PKT_NBIT, some use tabs, some repeat NANT."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    tab = key % 5 == 2

    def line(name, value, comment=""):
        return F.concat(F.lit(name), F.when(tab, F.lit("\t")).otherwise(F.lit("    ")),
                        value, F.lit(comment + "\n"))

    text = F.concat(
        F.lit("# recording header\n"),
        line("HDR_VERSION", F.lit("1.0")),
        line("RESOLUTION", (nation % 3 + 1).cast("string"), " # bytes"),
        line("NANT", (nation % 4 + 1).cast("string"), " #antennas"),
        line("PKT_HEADER", F.lit("16")),
        line("PKT_DATA", F.lit("64"), "# no blank before the comment"),
        line("PKT_NSAMP", F.lit("8")),
        line("PKT_TSAMP", F.lit("1e-3"), "   # µs"),
        line("PKT_NPOL", F.lit("2")),
        F.when(nation % 7 == 3, F.lit("")).otherwise(line("PKT_NBIT", F.lit("2"))),
        F.when(key % 11 == 4, line("NANT", F.lit("9"))).otherwise(F.lit("")),
        line("BYTES_PER_SECOND", (F.lit(80000).cast("bigint") * (nation + 1)).cast("string")))
    return table(spark, sf_dir, "customer").select(key.alias("file_id"), text.alias("header_text"))


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receiver settings per part, on both sides of every limit."""
    key = F.col("p_partkey")
    k = (key % 25).cast("int")
    mode = F.element_at(F.array(*map(F.lit, ("direct", "receive", "send"))),
                        (key % 3 + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        key.alias("id"), (k + 60).alias("pkt_size"),
        (k * F.when(key % 4 == 0, 200).otherwise(1)).alias("send_n"),
        (k % 8).alias("gpu_id"), (k % 6).alias("device_id"), (k * 16 + key % 2).alias("cpu"),
        (k % 3).alias("nsge"), mode.alias("mode"),
        F.lit(SRC_MAC).alias("src_mac"), F.lit(DST_MAC).alias("dst_mac"),
        F.when(key % 11 == 0, "").otherwise("10.17.0.12").alias("src_ip"),
        F.lit(DST_IP).alias("dst_ip"), F.lit("60000").alias("src_port"),
        F.when(key % 13 == 0, "").otherwise("17202").alias("dst_port"))


def layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate layouts per part: aligned, wasteful, and with batches too large."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("layout_"), key.cast("string")).alias("name"),
        (size % 9 * 8).alias("pkt_header"), ((key % 128 + 1) * 64).alias("pkt_data"),
        ((key % 7 + 1) * 50).alias("pkts_per_block"), ((size % 10 + 1) * 8).alias("send_n"),
        F.lit(8).alias("nbufs"), F.lit(10).alias("blocks_per_file"))


DATA = 64


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(F.octet_length("text") > 0)


def _seq(doc, chunk):
    return doc * F.lit(1 << 24) + chunk


def document_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream and sequence number of every document packet, without the bytes."""
    last = assemble.div(F.octet_length("text").cast("bigint") - 1, DATA)
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("chunk")
    return (_documents(spark, sf_dir).select("doc_id", "lang", chunk)
            .select(F.col("lang").alias("stream_id"),
                    _seq(F.col("doc_id"), F.col("chunk")).alias("seq")))


def document_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of packets of every document, without the bytes."""
    return _documents(spark, sf_dir).select(
        F.col("lang").alias("stream_id"), "doc_id",
        (assemble.div(F.octet_length("text").cast("bigint") - 1, DATA) + 1).alias("n_chunks"))


def document_packets(spark: SparkSession, sf_dir: str, starts: DataFrame | None = None) -> DataFrame:
    """Documents cut into packets: a 16-byte header (document, chunk) and 64 data bytes,
    the last chunk filled with zero bytes. The language is the stream.

    ``starts`` gives the position of the first packet of each document (``stream_id``,
    ``doc_id``, ``start``); the packets then have a column ``pos``.
    """
    raw = F.col("text").cast("binary")
    at = F.sequence(F.lit(1), F.octet_length("text"), F.lit(DATA))
    pieces = F.transform(at, lambda i: F.substring(raw, i, F.lit(DATA)))
    docs = _documents(spark, sf_dir).select(F.col("lang").alias("stream_id"), "doc_id", "text")
    if starts is not None:
        docs = attach(docs, starts, ["stream_id", "doc_id"], "inner", null_safe=True)
    docs = docs.select(*[c for c in docs.columns if c != "text"], F.posexplode(pieces).alias("chunk", "data"))
    head = F.unhex(F.concat(F.lpad(F.hex("doc_id"), 16, "0"),
                            F.lpad(F.hex(F.col("chunk").cast("bigint")), 16, "0")))
    placed = [] if starts is None else [(F.col("start") + F.col("chunk")).alias("pos")]
    return docs.select(
        "stream_id", _seq(F.col("doc_id"), F.col("chunk")).alias("seq"), *placed,
        F.concat(head, F.rpad(F.col("data"), F.lit(DATA), F.lit(b"\x00"))).alias("payload"))

"""Matching packets to flow rules and summarising traffic per flow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.address import ip_to_be, mac_to_bytes, packed_bytes, u16_bytes
from framelake.functions.frames import ETH_IPV4, LAYOUT
from framelake.operators.joins import attach

# MACs and type; addresses and ports.
LINK_BYTES = 14
END_BYTES = 12
FLOW = ["src_mac", "dst_mac", "src_ip", "dst_ip", "src_port", "dst_port"]


def rule_predicate(rule: dict) -> Column:
    """IPv4 frames whose six flow fields all equal the rule.

    Plain equality on columns, so it reaches the scan wherever the decoded
    fields are stored.
    """
    tests = [F.col("eth_type") == ETH_IPV4] + [F.col(f) == F.lit(rule[f]) for f in FLOW]
    return reduce(lambda a, b: a & b, tests)


def match(packets: DataFrame, rule: dict) -> DataFrame:
    return packets.filter(rule_predicate(rule))


def unmatched(packets: DataFrame, rule: dict) -> DataFrame:
    """Everything the rule does not select, rows with missing fields included."""
    return packets.filter(~F.coalesce(rule_predicate(rule), F.lit(False)))


def frame_key(frame: str = "frame") -> Column:
    """The bytes of an undecoded frame that identify its flow: both MACs and the type,
    then both addresses and ports. Two slices, against a dozen for decoding."""
    f = F.col(frame)
    (head, _), (ips, _) = LAYOUT["dst_mac"], LAYOUT["src_ip"]
    return F.concat(F.substring(f, head + 1, LINK_BYTES), F.substring(f, ips + 1, END_BYTES))


def rule_key(rule: dict | None = None) -> Column:
    """The same bytes from a rule: literals, or the columns of a rule table."""
    c = {f: F.lit(rule[f]) if rule else F.col(f) for f in FLOW}
    return F.concat(
        mac_to_bytes(c["dst_mac"]), mac_to_bytes(c["src_mac"]), u16_bytes(F.lit(ETH_IPV4)),
        packed_bytes((ip_to_be(c["src_ip"]), 4)), packed_bytes((ip_to_be(c["dst_ip"]), 4)),
        packed_bytes((c["src_port"], 2), (c["dst_port"], 2)))


def match_frames(raw: DataFrame, rule: dict, frame: str = "frame") -> DataFrame:
    """Undecoded frames of one flow; decode what is left."""
    return raw.filter(frame_key(frame) == rule_key(rule))


def unmatched_frames(raw: DataFrame, rule: dict, frame: str = "frame") -> DataFrame:
    """The other frames, for diagnosis; short ones among them."""
    return raw.filter(~F.coalesce(frame_key(frame) == rule_key(rule), F.lit(False)))


def match_frame_rules(raw: DataFrame, rules: DataFrame, frame: str = "frame",
                      spread_by: list[str] | None = None, how: str = "inner") -> DataFrame:
    """Undecoded frames against a table of rules, by one binary key."""
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keyed = rules.select("rule_id", rule_key().alias("_key"))
    return attach(raw.withColumn("_key", frame_key(frame)), keyed, ["_key"], how,
                  spread_by).drop("_key")


def masked_predicate(masks: dict[str, tuple[int, int]]) -> Column:
    """``value & mask = wanted & mask`` for integer columns, all at once."""
    return reduce(lambda a, b: a & b, [
        F.col(name).bitwiseAND(F.lit(mask)) == F.lit(wanted & mask)
        for name, (wanted, mask) in masks.items()])


def match_rules(packets: DataFrame, rules: DataFrame, spread_by: list[str] | None = None,
                how: str = "inner") -> DataFrame:
    """Packets with the rule they satisfy (``inner``), or just the packets that
    satisfy any (``left_semi``) or none (``left_anti``)."""
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keyed = rules.withColumn("eth_type", F.lit(ETH_IPV4))
    return attach(packets, keyed, ["eth_type", *FLOW], how, spread_by)


def count_by_rule(packets: DataFrame, rules: DataFrame, length: Column) -> DataFrame:
    """Packets and bytes per rule; rules without traffic show zero.

    Packets meet the rules first, where these are small without moving, and what matches is
    summed per rule map-side.
    """
    keyed = rules.select("rule_id", *FLOW)
    ipv4 = packets.filter(F.col("eth_type") == ETH_IPV4).select(*FLOW, length.alias("_length"))
    per_rule = (attach(ipv4, keyed, FLOW, "inner").groupBy("rule_id")
                .agg(F.count(F.lit(1)).alias("packets"), F.sum("_length").alias("bytes")))
    return rules.select("rule_id").join(per_rule, "rule_id", "left").select(
        "rule_id", F.coalesce("packets", F.lit(0)).alias("packets"),
        F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"))


def summary(packets: DataFrame, keys: list[str], length: Column,
            ts: str = "arrival_ts") -> DataFrame:
    """Packets, bytes, first and last time seen per flow."""
    return packets.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("packets"), F.sum(length).cast("bigint").alias("bytes"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))

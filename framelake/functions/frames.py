"""Ethernet + IPv4 + UDP frames as columns. Everything stays in Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.address import (
    ip_to_be, mac_from_bytes, mac_to_bytes, packed_bytes, u16_bytes)

# Fixed values of the frame format: byte offset and length of each header field.
LAYOUT = {
    "dst_mac": (0, 6),
    "src_mac": (6, 6),
    "eth_type": (12, 2),
    "ip_version_ihl": (14, 1),
    "ip_tos": (15, 1),
    "ip_len": (16, 2),
    "ip_id": (18, 2),
    "ip_flags": (20, 2),
    "ip_ttl": (22, 1),
    "ip_proto": (23, 1),
    "ip_checksum": (24, 2),
    "src_ip": (26, 4),
    "dst_ip": (30, 4),
    "src_port": (34, 2),
    "dst_port": (36, 2),
    "udp_len": (38, 2),
    "udp_checksum": (40, 2),
}
HEADER_BYTES = 42
# Ethernet (14) plus IPv4 (20) header: what is not counted in the UDP length.
BEFORE_UDP = 34
IP_HEADER = 20
ETH_IPV4 = 0x0800
# Fixed values of the IPv4 header: version/IHL and TOS, id, flags, TTL and UDP.
IP_VERSION_TOS = 0x4500
IP_ID = 0x5400
IP_FLAGS = 0x0000
IP_TTL_PROTO = 0x4011
# Checksum that senders with a fixed header template leave in place.
TEMPLATE_CHECKSUM = 0xAFB6


def udp_length(payload: Column) -> Column:
    return F.octet_length(payload) + F.lit(HEADER_BYTES - BEFORE_UDP)


def ip_checksum(ip_len: Column, src_ip: Column, dst_ip: Column) -> Column:
    """Ones' complement sum of the ten header words, the checksum itself as zero."""
    total = ip_len.cast("bigint") + F.lit(IP_VERSION_TOS + IP_ID + IP_FLAGS + IP_TTL_PROTO)
    for ip in (ip_to_be(src_ip), ip_to_be(dst_ip)):
        total = total + F.shiftright(ip, 16) + ip.bitwiseAND(F.lit(0xFFFF))
    for _ in range(2):
        total = total.bitwiseAND(F.lit(0xFFFF)) + F.shiftright(total, 16)
    return F.lit(0xFFFF) - total


def encode(dst_mac: Column, src_mac: Column, eth_type: Column, src_ip: Column, dst_ip: Column,
           src_port: Column, dst_port: Column, payload: Column,
           checksum: str = "computed") -> Column:
    """Frame bytes from decoded columns. The UDP checksum is left zero.

    ``checksum="reference"`` writes the constant of the fixed header template.
    """
    udp_len = udp_length(payload)
    ip_len = udp_len + F.lit(IP_HEADER)
    if checksum == "computed":
        check = ip_checksum(ip_len, src_ip, dst_ip)
    elif checksum == "reference":
        check = F.lit(TEMPLATE_CHECKSUM)
    else:
        raise ValueError(f"unknown checksum mode {checksum!r}")
    return F.concat(
        mac_to_bytes(dst_mac), mac_to_bytes(src_mac), u16_bytes(eth_type),
        packed_bytes((F.lit(IP_VERSION_TOS), 2), (ip_len, 2), (F.lit(IP_ID), 2), (F.lit(IP_FLAGS), 2)),
        packed_bytes((F.lit(IP_TTL_PROTO), 2), (check, 2), (ip_to_be(src_ip), 4)),
        packed_bytes((ip_to_be(dst_ip), 4)),
        packed_bytes((src_port, 2), (dst_port, 2), (udp_len, 2), (F.lit(0), 2)),
        payload)


def encode_packets(df: DataFrame, name: str = "frame", checksum: str = "computed") -> DataFrame:
    c = F.col
    return df.withColumn(name, encode(
        c("dst_mac"), c("src_mac"), c("eth_type"), c("src_ip"), c("dst_ip"),
        c("src_port"), c("dst_port"), c("payload"), checksum))


def _field(frame: Column, name: str, value) -> Column:
    """``value(start, size)`` of a header field, null when the frame ends before it does."""
    start, size = LAYOUT[name]
    return F.when(F.octet_length(frame) >= start + size, value(start + 1, size))


def decode(df: DataFrame, frame: str = "frame") -> DataFrame:
    """Add every header field, the payload, the frame length and a ``malformed`` flag.

    Each field slices the bytes it needs; fields nobody selects are pruned by the
    optimizer.
    """
    f = F.col(frame)

    def number(at: int, size: int) -> Column:
        return F.conv(F.hex(F.substring(f, at, size)), 16, 10)

    def u16(at: int, size: int) -> Column:
        return number(at, size).cast("int")

    def mac(at: int, size: int) -> Column:
        return mac_from_bytes(f, at)

    def dotted(at: int, size: int) -> Column:
        return F.concat_ws(".", *[number(i, 1) for i in range(at, at + size)])

    def low_first(at: int, size: int) -> Column:
        swapped = F.concat(*[F.substring(f, i, 1) for i in reversed(range(at, at + size))])
        return F.conv(F.hex(swapped), 16, 10).cast("bigint")

    def high_first(at: int, size: int) -> Column:
        return number(at, size).cast("bigint")

    shapes = {"dst_mac": mac, "src_mac": mac, "src_ip": dotted, "dst_ip": dotted}
    return df.select(
        *df.columns,
        *[_field(f, n, shapes.get(n, u16)).alias(n) for n in LAYOUT],
        _field(f, "src_ip", low_first).alias("src_ip_le"),
        _field(f, "dst_ip", low_first).alias("dst_ip_le"),
        _field(f, "src_ip", high_first).alias("src_ip_be"),
        _field(f, "dst_ip", high_first).alias("dst_ip_be"),
        F.when(F.octet_length(f) >= HEADER_BYTES,
               F.substring(f, HEADER_BYTES + 1, 1 << 30)).alias("payload"),
        F.octet_length(f).alias("frame_len"),
        (F.octet_length(f) < HEADER_BYTES).alias("malformed"))


def split_payload(df: DataFrame, header_bytes: int, data_bytes: int,
                  payload: str = "payload") -> DataFrame:
    """Application header, data, and whether the packet has exactly the expected size."""
    p = F.col(payload)
    return df.select(
        "*",
        F.substring(p, 1, header_bytes).alias("head"),
        F.substring(p, header_bytes + 1, data_bytes).alias("data"),
        (F.octet_length(p) == header_bytes + data_bytes).alias("size_ok"))


def fill_payload(df: DataFrame, fill, name: str = "payload") -> DataFrame:
    """Payload generator hook: ``fill`` is a column expression or a pandas UDF call
    returning BINARY, to be framed by :func:`encode_packets`."""
    column = fill(df) if callable(fill) else fill
    return df.withColumn(name, column.cast("binary"))

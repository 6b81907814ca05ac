"""IPv4, MAC, port and key text to numbers or bytes, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _octets(ip: Column) -> list[Column]:
    # An escaped single character is split without a regular expression.
    parts = F.split(ip, "\\.")
    return [F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4)]


def _pack(octets: list[Column]) -> Column:
    total, seen = octets[0], octets[0]
    for i, octet in enumerate(octets[1:], start=1):
        total = total + F.shiftleft(octet, 8 * i)
        seen = seen.bitwiseOR(octet)
    # Null unless every octet is within 0..255. Written without a branch around the
    # octets, so that generated code splits the text once.
    outside = seen.bitwiseAND(F.lit(~0xFF))
    return F.get(F.array(total), F.when(outside == 0, 0))


def ip_to_le(ip: Column) -> Column:
    """First octet in the low byte: 10.17.16.60 -> 1007685898."""
    return _pack(_octets(ip))


def ip_to_be(ip: Column) -> Column:
    """First octet in the high byte (network order)."""
    return _pack(_octets(ip)[::-1])


def _dotted(shifts: list[int], value: Column) -> Column:
    return F.concat_ws(".", *[
        F.shiftright(value, s).bitwiseAND(F.lit(255)).cast("string") for s in shifts])


def ip_from_le(value: Column) -> Column:
    return F.when(value.isNotNull(), _dotted([0, 8, 16, 24], value))


def ip_from_be(value: Column) -> Column:
    return F.when(value.isNotNull(), _dotted([24, 16, 8, 0], value))


def _fixed_bytes(value: Column, size: int) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 2 * size, "0"))


def ip_bytes(ip: Column) -> Column:
    """Four bytes in network order."""
    return _fixed_bytes(ip_to_be(ip), 4)


def mac_to_bytes(mac: Column) -> Column:
    return F.unhex(F.replace(mac, F.lit(":"), F.lit("")))


def mac_from_bytes(raw: Column, at: int = 1) -> Column:
    """Six bytes, from position ``at``, as lower-case text with colons."""
    return F.lower(F.concat_ws(":", *[F.hex(F.substring(raw, at + i, 1)) for i in range(6)]))


def u16_bytes(value: Column) -> Column:
    """Two bytes, high byte first."""
    return _fixed_bytes(value, 2)


def packed_bytes(*words: tuple[Column, int]) -> Column:
    """Up to eight bytes from (value, size) pairs: one conversion for all of them."""
    total, left = F.lit(0).cast("bigint"), sum(size for _, size in words)
    size_all = left
    for value, size in words:
        left -= size
        total = total.bitwiseOR(F.shiftleft(value.cast("bigint"), 8 * left))
    return _fixed_bytes(total, size_all)


def port(text: Column) -> Column:
    number = text.try_cast("int")
    return F.when(number.between(0, 65535), number)


def hex_key(text: Column) -> Column:
    """Hexadecimal key, with or without a leading 0x."""
    return F.conv(F.regexp_replace(text, "^0[xX]", ""), 16, 10).cast("bigint")

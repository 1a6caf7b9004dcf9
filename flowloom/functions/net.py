"""Addresses, flags, time buckets, and the 5-tuple keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Protocol numbers, EtherTypes and TCP flag bits.
ICMP, TCP, UDP = 1, 6, 17
ETH_IPV4, ETH_IPV6 = 0x0800, 0x86DD
FLAG_FIN, FLAG_SYN, FLAG_RST, FLAG_ACK = 0x01, 0x02, 0x04, 0x10

FIVE_TUPLE = ["src_addr", "dst_addr", "src_port", "dst_port", "proto"]


def ip_text(addr: Column) -> Column:
    """Dotted text of an unsigned 32-bit address; null stays null."""
    return F.concat(
        F.shiftright(addr, 24).bitwiseAND(255).cast("string"), F.lit("."),
        F.shiftright(addr, 16).bitwiseAND(255).cast("string"), F.lit("."),
        F.shiftright(addr, 8).bitwiseAND(255).cast("string"), F.lit("."),
        addr.bitwiseAND(255).cast("string"),
    )


def ip_number(text: Column) -> Column:
    """Unsigned number of a dotted address; null if it is not four octets."""
    parts = F.split(F.ltrim(text, F.lit("/")), r"\.")
    octets = [F.try_element_at(parts, F.lit(i + 1)).try_cast("bigint") for i in range(4)]
    valid = (F.size(parts) == 4)
    for octet in octets:
        valid = valid & octet.between(0, 255)
    number = octets[0] * (1 << 24) + octets[1] * (1 << 16) + octets[2] * (1 << 8) + octets[3]
    return F.when(valid, number)


def parse_ip(text: str) -> int:
    """Number of a dotted address given as a Python string."""
    octets = [int(part) for part in text.split(".")]
    if len(octets) != 4 or any(not 0 <= o <= 255 for o in octets):
        raise ValueError(f"not an IPv4 address: {text!r}")
    return sum(octet << shift for octet, shift in zip(octets, (24, 16, 8, 0)))


def subnet(addr: Column, mask_bits: Column | int) -> Column:
    """Network part of an address: the top ``mask_bits`` bits kept, the rest zero."""
    bits = F.lit(mask_bits) if isinstance(mask_bits, int) else mask_bits
    drop = (F.lit(32) - bits).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", addr, drop), drop)


def in_network(addr: Column, cidr: str) -> Column:
    """Whether an address lies in ``a.b.c.d/n``, as one range test that a scan can use."""
    base, _, bits = cidr.partition("/")
    width = 1 << (32 - int(bits or 32))
    low = parse_ip(base) // width * width
    return addr.between(low, low + width - 1)


def bucket(ts: Column, interval: int) -> Column:
    """Start of the interval that holds ``ts``."""
    return ts - F.pmod(ts, F.lit(interval))


def bucket_s(ts_us: Column, interval_s: int) -> Column:
    """Start, in epoch seconds, of the interval that holds a microsecond time."""
    start_us = bucket(ts_us, interval_s * 1_000_000)
    return F.call_function("div", start_us, F.lit(1_000_000).cast("bigint"))


def has_flag(flags: Column, bit: int) -> Column:
    """1 if the TCP flag is set, else 0."""
    return F.when(flags.bitwiseAND(bit) == bit, 1).otherwise(0)


def absolute_us(export_us: Column, uptime_ms: Column, t_ms: Column) -> Column:
    """Absolute microseconds of a router-uptime time in milliseconds."""
    return export_us - (uptime_ms - t_ms) * 1000


def date_label(ts_us: Column, pattern: str) -> Column:
    """Date text of a microsecond time, in UTC whatever the session time zone is."""
    ntz = F.timestamp_add("MICROSECOND", ts_us, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.date_format(ntz, pattern)


def forward_key() -> Column:
    """Client-to-server key: protocol, source, destination, ports."""
    return F.struct("proto", "src_addr", "dst_addr", "src_port", "dst_port")


def reverse_key() -> Column:
    """Server-to-client key of the same conversation, field names as in the forward key."""
    return F.struct(
        F.col("proto"), F.col("dst_addr").alias("src_addr"), F.col("src_addr").alias("dst_addr"),
        F.col("dst_port").alias("src_port"), F.col("src_port").alias("dst_port"),
    )


def direction() -> Column:
    """1 if the packet goes from the smaller to the larger end point, else -1."""
    here = F.struct("src_addr", "src_port")
    there = F.struct(F.col("dst_addr").alias("src_addr"), F.col("dst_port").alias("src_port"))
    return F.when(here <= there, 1).otherwise(-1)

"""Header fields of captured frames, and frames from header fields, as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowloom.functions.binary import be_hex, bytes_of, field_of, word
from flowloom.functions.net import ETH_IPV4, ETH_IPV6, ICMP, TCP, UDP

# Byte offsets in an Ethernet frame, and the smallest record
# (with its 16-byte record header) that is decoded.
ETH_TYPE, IP = 12, 14
IP_LEN, IPV6_LEN, TTL, PROTO, SRC, DST = 16, 18, 22, 23, 26, 30
MIN_RECORD = 42
HEADER_BYTES = 14 + 60 + 20


def decode_packets(raw: DataFrame, min_record: int = MIN_RECORD) -> DataFrame:
    """Packet columns out of captured frames; fields a frame does not have are null.

    The headers become hex text once and then five eight-byte words, out of
    which all fields are shifted.
    """
    # Padded, so that a word is whole even where a short frame ends inside it.
    head = F.rpad(F.hex(F.substring("frame", 1, HEADER_BYTES)), 2 * (HEADER_BYTES + 8), "0")
    words = raw.where(F.length("frame") >= min_record - 16).withColumns(
        {"head": head, "held": F.length("frame")}).withColumns({
            "w_eth": word(F.col("head"), ETH_TYPE), "w_ttl": word(F.col("head"), TTL),
            "w_addr": word(F.col("head"), SRC)})

    def header(name: str, base: int, at: int, nbytes: int) -> Column:
        value = field_of(F.col(name), at - base, nbytes)
        return F.when(F.col("held") >= at + nbytes, value)

    first = header("w_eth", ETH_TYPE, IP, 1)
    step = words.withColumn("eth_type", header("w_eth", ETH_TYPE, ETH_TYPE, 2).cast("int"))
    is_ip = F.col("eth_type").isin(ETH_IPV4, ETH_IPV6)
    step = step.withColumn("ip_version", F.when(is_ip, F.shiftright(first, 4)).cast("int"))
    v4 = (F.col("eth_type") == ETH_IPV4) & (F.col("ip_version") == 4)
    v6 = (F.col("eth_type") == ETH_IPV6) | ((F.col("eth_type") == ETH_IPV4) & (F.col("ip_version") == 6))
    ipv6_len = header("w_eth", ETH_TYPE, IPV6_LEN, 2)
    step = step.withColumns({
        "ihl": F.when(v4, first.bitwiseAND(15) * 4).cast("int"),
        "ipv6_len": F.when(v6, ipv6_len).cast("int"),
        "ip_len": F.when(v4, header("w_eth", ETH_TYPE, IP_LEN, 2)).when(v6, ipv6_len).cast("int"),
        "ttl": F.when(v4, header("w_ttl", TTL, TTL, 1)).cast("int"),
        "proto": F.when(v4, header("w_ttl", TTL, PROTO, 1)).cast("int"),
        "src_addr": F.when(v4, header("w_addr", SRC, SRC, 4)),
        "dst_addr": F.when(v4, header("w_addr", SRC, DST, 4)),
    })
    transport = F.lit(IP) + F.col("ihl")
    step = step.withColumns({"w_port": word(F.col("head"), transport), "w_tcp": word(F.col("head"), transport + 8)})
    # Rows of one each: a filter on a field is taken down to here and no further, where it would repeat all of the above.
    step = step.select(F.inline(F.array(F.struct(*[c for c in step.columns if c != "head"]))))

    def segment(name: str, base: int, at: int, nbytes: int) -> Column:
        return F.when(F.col("held") >= transport + at + nbytes, field_of(F.col(name), at - base, nbytes))

    is_tcp = F.col("proto") == TCP
    step = step.withColumns({
        "src_port": segment("w_port", 0, 0, 2).cast("int"),
        "dst_port": segment("w_port", 0, 2, 2).cast("int"),
        "tcp_hlen": F.when(is_tcp, F.shiftright(segment("w_tcp", 8, 12, 1), 4) * 4).cast("int"),
        "tcp_seq": F.when(is_tcp, segment("w_port", 0, 4, 4)),
        "tcp_ack": F.when(is_tcp, segment("w_tcp", 8, 8, 4)),
        "tcp_flags": F.when(is_tcp, segment("w_tcp", 8, 13, 1)).cast("int"),
        "window": F.when(is_tcp, segment("w_tcp", 8, 14, 2)).cast("int"),
    })
    hlen = F.when(is_tcp, F.col("tcp_hlen")).when(F.col("proto").isin(UDP, ICMP), 8)
    step = step.withColumns({
        "icmp_type_code": F.when(F.col("proto") == ICMP, F.col("src_port")),
        "payload_len": F.col("ip_len") - F.col("ihl") - hlen,
    })
    payload = F.substr("frame", transport + hlen + 1, F.greatest(F.col("payload_len"), F.lit(0)))
    return step.withColumn("payload", payload).drop(
        "held", "frame", "w_eth", "w_ttl", "w_addr", "w_port", "w_tcp")


def encode_frames(packets: DataFrame) -> DataFrame:
    """(ts_us, wire_len, frame) rows out of packet columns: Ethernet, then IP and transport headers.

    The headers are complete; of the payload only the bytes given are stored, as
    a capture with a small snapshot length would. Sequence and ACK number, flags and
    window of TCP and the time to live are those of the columns, if there are any.
    """
    def field(name: str, nbytes: int, other: str) -> Column:
        return F.coalesce(be_hex(F.col(name), nbytes), F.lit(other)) if name in packets.columns else F.lit(other)
    port = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("src_port", "dst_port")}
    tcp = F.concat(be_hex(port["src_port"], 2), be_hex(port["dst_port"], 2), field("tcp_seq", 4, "00" * 4),
                   field("tcp_ack", 4, "00" * 4), F.lit("50"), field("tcp_flags", 1, "18"), field("window", 2, "ffff"),
                   F.lit("00" * 4))
    short = F.concat(be_hex(port["src_port"], 2), be_hex(port["dst_port"], 2), F.lit("00" * 4))
    ipv4 = F.concat(F.lit("4500"), be_hex(F.col("ip_len"), 2), F.lit("00000000"), field("ttl", 1, "40"),
                    be_hex(F.col("proto"), 1), F.lit("0000"),
                    be_hex(F.col("src_addr"), 4), be_hex(F.col("dst_addr"), 4))
    ipv6 = F.concat(F.lit("60000000"), be_hex(F.col("ip_len"), 2), F.lit("0640"), F.lit("00" * 32))
    body = (
        F.when(F.col("eth_type") == ETH_IPV4, F.concat(
            ipv4, F.when(F.col("proto") == TCP, tcp).otherwise(short), F.hex(F.col("payload").cast("binary"))))
        .when(F.col("eth_type") == ETH_IPV6, ipv6)
        .otherwise(F.lit("00" * 28))
    )
    frame = bytes_of(F.lit("00" * 12), be_hex(F.col("eth_type"), 2), body)
    return packets.select("ts_us", frame.alias("frame")).withColumn("wire_len", F.length("frame"))

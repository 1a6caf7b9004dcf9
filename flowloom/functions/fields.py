"""Short field names of flow rows, as used by the detection rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from flowloom.functions.net import FLAG_ACK, FLAG_FIN, FLAG_SYN, has_flag, subnet

# Short field name -> column of a flow row.
FLOW_FIELDS = {
    "sip": "src_addr",
    "dip": "dst_addr",
    "nexthop": "nexthop",
    "input": "input",
    "output": "output",
    "pkts": "dpkts",
    "bytes": "doctets",
    "first": "first_us",
    "last": "last_us",
    "sport": "src_port",
    "dport": "dst_port",
    "pad1": "pad1",
    "tcp_flags": "tcp_flags",
    "prot": "prot",
    "tos": "tos",
    "sas": "src_as",
    "das": "dst_as",
    "smask": "src_mask",
    "dmask": "dst_mask",
    "pad2": "pad2",
}

# Short names whose value is derived from other columns.
DERIVED_FIELDS = ("syn", "ack", "fin", "flows", "recs", "ssubnet", "dsubnet")


def flow_field(name: str) -> Column:
    """Column, as a long, for a short field name."""
    if name in FLOW_FIELDS:
        return F.col(FLOW_FIELDS[name]).cast("bigint")
    if name == "syn":
        return has_flag(F.col("tcp_flags"), FLAG_SYN).cast("bigint")
    if name == "ack":
        return has_flag(F.col("tcp_flags"), FLAG_ACK).cast("bigint")
    if name == "fin":
        return has_flag(F.col("tcp_flags"), FLAG_FIN).cast("bigint")
    if name in ("flows", "recs"):
        return F.lit(1).cast("bigint")
    if name == "ssubnet":
        return subnet(F.col("src_addr"), F.col("src_mask"))
    if name == "dsubnet":
        return subnet(F.col("dst_addr"), F.col("dst_mask"))
    raise KeyError(f"unknown flow field: {name!r}")

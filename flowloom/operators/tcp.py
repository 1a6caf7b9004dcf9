"""TCP counters that depend on sequence state: repeats, disorder, duplicate ACKs, round trips.

Sequence numbers are laid out without wraps: a packet's place is the one of the
packet before plus the signed difference of their numbers modulo 2^32. A flow is cut
into time chunks as for gaps: places, the highest end so far and runs of equal
ACKs are found inside (flow, chunk), and one summary row per chunk carries them
over the seams, so a flow that holds most packets is spread over many tasks and
the counters are the same for any cut.

What is counted, per flow (direction), over packets in order of arrival:

* a data packet *repeats* if an earlier one of the flow starts at the same place; as
  many of its bytes as the longest of those had are repeated bytes;
* a data packet is *out of order* if it starts below the highest end of earlier data
  and doesn't repeat;
* an ACK is a *duplicate* if it has no payload, no SYN, FIN or RST, and the number and
  window of the flow's ACK before; a run of three or more is one ``dup3ack``;
* a *round trip* is the time from a data packet to the next ACK of the other direction
  with exactly its end as number, if no other data packet with that end comes within
  ``MAX_RTT_US`` before or in between, and if it takes no longer than that.

Packets without a sequence number (cut off before it) are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowloom.functions.net import FIVE_TUPLE, FLAG_ACK, FLAG_FIN, FLAG_RST, FLAG_SYN, TCP, has_flag
from flowloom.operators.packets import ipv4
from flowloom.plans.gaps import CHUNK_US, HOT_ROWS, arrival_order, in_chunks, original_keys
from flowloom.plans.lineage import as_table

MAX_RTT_US = 60_000_000
NUMBERS = 1 << 32
DUPLICATES = 3


def signed_difference(later: Column, earlier: Column) -> Column:
    """How far ``later`` is ahead of ``earlier`` on the circle of 2^32 numbers, negative if behind."""
    half = F.lit(NUMBERS // 2)
    return F.pmod(later - earlier + half, F.lit(NUMBERS)) - half


def _same_ack(ack: str, window: str, ack_before: str, window_before: str) -> Column:
    return F.coalesce((F.col(ack) == F.col(ack_before)) & (F.col(window) == F.col(window_before)), F.lit(False))


def segments(packets: DataFrame, chunk_us: int = CHUNK_US, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """TCP packets with ``start`` (place of the first byte in the flow, 0 for its first packet), ``high`` (highest end
    of earlier data, null before any), ``acks`` (its ACK), ``duplicate``, and ``run`` (number of the run of equal ACKs)."""
    flags = F.col("tcp_flags")
    tcp = ipv4(packets).where((F.col("proto") == TCP) & F.col("tcp_seq").isNotNull())
    order = [F.col(c) for c in arrival_order(tcp)]
    kept = [c for c in arrival_order(tcp) if c != "ts_us"]
    raw = tcp.select(*FIVE_TUPLE, "ts_us", *kept, "tcp_seq", "tcp_ack", "tcp_flags", "window", "payload_len")
    # What follows is computed after the shuffle, out of decoded numbers.
    acks = has_flag(flags, FLAG_ACK) == 1
    quiet = (F.col("payload_len") == 0) & (flags.bitwiseAND(FLAG_SYN | FLAG_FIN | FLAG_RST) == 0)
    rows = in_chunks(raw, FIVE_TUPLE, chunk_us, hot_rows).repartition(*FIVE_TUPLE, "chunk").withColumns({
        "acks": acks, "ack": F.when(acks, F.col("tcp_ack")), "may_repeat": acks & quiet})
    here = Window.partitionBy(*FIVE_TUPLE, "chunk").orderBy(*order)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    last_ack = F.last(F.when(F.col("acks"), F.struct("ack", "window")), ignorenulls=True).over(before)
    placed = rows.withColumns({
        "step": F.coalesce(signed_difference(F.col("tcp_seq"), F.lag("tcp_seq").over(here)), F.lit(0)),
        "place": F.row_number().over(here), "seen": last_ack})
    placed = placed.withColumns({
        "inner": F.sum("step").over(here),
        "ack_before": F.col("seen.ack"), "window_before": F.col("seen.window"),
        "first_ack": F.col("acks") & F.col("seen").isNull()})
    placed = placed.withColumn("duplicate", F.col("may_repeat") & _same_ack("ack", "window", "ack_before", "window_before"))
    placed = placed.withColumns({
        "end": F.when(F.col("payload_len") > 0, F.col("inner") + F.col("payload_len")),
        # Of a chunk's first ACK the summary decides.
        "break": F.when(F.col("acks") & ~F.col("first_ack") & ~F.col("duplicate"), 1).otherwise(0)})
    placed = placed.withColumns({"inner_high": F.max("end").over(before), "inner_run": F.sum("break").over(here)})
    first = F.when(F.col("first_ack"), F.struct("ack", "window", "may_repeat"))
    summary = placed.groupBy(*FIVE_TUPLE, "chunk").agg(
        F.min(F.when(F.col("place") == 1, F.col("tcp_seq"))).alias("first_seq"),
        F.max(F.struct("place", "tcp_seq", "inner")).alias("last"), F.max("end").alias("top"),
        F.max(first).alias("first_of"), F.sum("break").alias("breaks"),
        F.max(F.when(F.col("acks"), F.struct("place", "ack", "window"))).alias("last_of"))
    flow = Window.partitionBy(*FIVE_TUPLE).orderBy("chunk")
    earlier = flow.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumns({
        "seam": F.coalesce(signed_difference(F.col("first_seq"), F.lag("last.tcp_seq").over(flow)), F.lit(0)),
        "carried": F.last("last_of", ignorenulls=True).over(earlier)})
    summary = summary.withColumns({
        "base": F.sum("seam").over(flow) + F.coalesce(F.sum("last.inner").over(earlier), F.lit(0)),
        "new_ack": F.col("first_of.ack"), "new_window": F.col("first_of.window"),
        "old_ack": F.col("carried.ack"), "old_window": F.col("carried.window")})
    goes_on = F.coalesce(F.col("first_of.may_repeat"), F.lit(False)) & _same_ack("new_ack", "new_window", "old_ack", "old_window")
    summary = summary.withColumns({
        "goes_on": goes_on, "opened": F.when(F.col("first_of").isNotNull() & ~goes_on, 1).otherwise(0)})
    carry = summary.select(
        *FIVE_TUPLE, "chunk", "base", "goes_on", F.max(F.col("base") + F.col("top")).over(earlier).alias("carry_high"),
        (F.coalesce(F.sum(F.col("breaks") + F.col("opened")).over(earlier), F.lit(0)) + F.col("opened")).alias("carry_run"))
    return (
        placed.join(carry.hint("merge"), [*FIVE_TUPLE, "chunk"])
        .withColumns({
            "start": F.col("base") + F.col("inner"),
            "high": F.greatest("carry_high", F.col("base") + F.col("inner_high")),
            "duplicate": F.col("duplicate") | (F.col("first_ack") & F.col("goes_on")),
            "run": F.col("carry_run") + F.col("inner_run")})
        .select(*FIVE_TUPLE, "ts_us", *kept, "tcp_seq", "ack", "payload_len", "start", "high", "acks", "duplicate", "run")
    )


def _repeats(data: DataFrame) -> DataFrame:
    """Counters of repeated and disordered data: one row per packet of each place, in order, sees the earlier ones."""
    same = Window.partitionBy(*FIVE_TUPLE, "start").orderBy(*arrival_order(data)).rowsBetween(Window.unboundedPreceding, -1)
    longest = F.max("payload_len").over(same)
    seen = data.withColumn("longest", longest)
    repeats = F.col("longest").isNotNull()
    late = F.coalesce(F.col("start") < F.col("high"), F.lit(False)) & ~repeats
    return seen.groupBy(*FIVE_TUPLE).agg(
        F.count(F.when(repeats, 1)).alias("rexmt_pkts"),
        F.coalesce(F.sum(F.when(repeats, F.least("payload_len", "longest"))), F.lit(0)).cast("bigint").alias("rexmt_bytes"),
        F.count(F.when(late, 1)).alias("out_of_order"))


def _triples(rows: DataFrame) -> DataFrame:
    """Duplicate ACKs, and runs of ``DUPLICATES`` or more."""
    runs = rows.where("duplicate").groupBy(*FIVE_TUPLE, "run").agg(F.count("*").alias("n"))
    return runs.groupBy(*FIVE_TUPLE).agg(
        F.sum("n").alias("dup_acks"), F.count(F.when(F.col("n") >= DUPLICATES, 1)).alias("dup3ack"))


def _round_trips(rows: DataFrame, max_rtt_us: int) -> DataFrame:
    """Round trips per flow: data and the other direction's ACKs meet on (flow, number), in order of time."""
    swapped = {"src_addr": "dst_addr", "dst_addr": "src_addr", "src_port": "dst_port", "dst_port": "src_port", "proto": "proto"}
    sent = rows.where("payload_len > 0").select(
        *FIVE_TUPLE, F.pmod(F.col("tcp_seq") + F.col("payload_len"), F.lit(NUMBERS)).alias("number"), "ts_us", F.lit(0).alias("kind"))
    answered = rows.where("acks").select(
        *[F.col(swapped[c]).alias(c) for c in FIVE_TUPLE], F.col("ack").alias("number"), "ts_us", F.lit(1).alias("kind"))
    meet = Window.partitionBy(*FIVE_TUPLE, "number").orderBy("ts_us", "kind")
    sent_before = F.last(F.when(F.col("kind") == 0, F.col("ts_us")), ignorenulls=True).over(
        meet.rowsBetween(Window.unboundedPreceding, -1))
    trips = sent.unionByName(answered).withColumns({
        "before": sent_before, "next_kind": F.lead("kind").over(meet), "next_us": F.lead("ts_us").over(meet)})
    rtt = F.col("next_us") - F.col("ts_us")
    alone = F.col("before").isNull() | (F.col("ts_us") - F.col("before") > max_rtt_us)
    return (
        trips.where((F.col("kind") == 0) & (F.col("next_kind") == 1) & alone & (rtt <= max_rtt_us))
        .groupBy(*FIVE_TUPLE).agg(F.count("*").alias("rtt_cnt"), F.sum(rtt).alias("tot_rtt"), F.min(rtt).alias("rtt_min"),
                                  F.max(rtt).alias("rtt_max"))
    )


COUNTERS = ("packets", "rexmt_pkts", "rexmt_bytes", "out_of_order", "dup_acks", "dup3ack", "rtt_cnt", "tot_rtt")


def tcp_quality(packets: DataFrame, chunk_us: int = CHUNK_US, hot_rows: int | None = HOT_ROWS,
                max_rtt_us: int = MAX_RTT_US) -> DataFrame:
    """Per TCP flow: packets, repeated packets and bytes, packets out of order, duplicate ACKs, runs of three, and
    count, sum, least and largest round trip in microseconds (null without one)."""
    rows = as_table(segments(packets, chunk_us, hot_rows), "tcp-segments")
    counted = [rows.groupBy(*FIVE_TUPLE).agg(F.count("*").alias("packets")), _repeats(rows.where("payload_len > 0")),
               _triples(rows), _round_trips(rows, max_rtt_us)]
    # Every part has a row per flow at most; they are added up rather than joined four times.
    every = counted[0]
    for part in counted[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    return every.groupBy(*FIVE_TUPLE).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS], F.min("rtt_min").alias("rtt_min"),
        F.max("rtt_max").alias("rtt_max")).where("packets > 0").withColumns(original_keys(FIVE_TUPLE))

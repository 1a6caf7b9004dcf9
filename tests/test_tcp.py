"""Sequence-state counters against a walk over each flow in plain Python."""

import random
from collections import defaultdict

import pytest

from flowloom.operators.tcp import MAX_RTT_US, tcp_quality

SCHEMA = ("pkt_id long, ts_us long, eth_type int, src_addr long, dst_addr long, src_port int, dst_port int, proto int, "
          "payload_len int, tcp_seq long, tcp_ack long, tcp_flags int, window int")
WRAP = 1 << 32


def brute_force(rows, max_rtt_us=MAX_RTT_US):
    flows = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        if r[2] == 2048 and r[7] == 6 and r[9] is not None:
            flows[r[3:8]].append(r)
    out = []
    for key, packets in flows.items():
        place, last, high, longest, acked, run = 0, None, None, {}, None, 0
        c = dict(packets=len(packets), rexmt_pkts=0, rexmt_bytes=0, out_of_order=0, dup_acks=0, dup3ack=0)
        trips = []
        for r in packets:
            pkt, ts, _, *_, size, seq, ack, flags, window = r
            if last is not None:
                place += (seq - last + WRAP // 2) % WRAP - WRAP // 2
            last = seq
            if size > 0:
                if place in longest:
                    c["rexmt_pkts"] += 1
                    c["rexmt_bytes"] += min(size, longest[place])
                elif high is not None and place < high:
                    c["out_of_order"] += 1
                longest[place] = max(size, longest.get(place, 0))
                high = place + size if high is None else max(high, place + size)
                number = (seq + size) % WRAP
                same = [q[1] for q in packets if q[8] > 0 and (q[9] + q[8]) % WRAP == number and q is not r]
                back = (key[1], key[0], key[3], key[2], key[4])
                answers = [q[1] for q in flows.get(back, []) if q[11] & 16 and q[10] == number and q[1] >= ts]
                if answers and not any(0 <= ts - t <= max_rtt_us and t < ts for t in same) and not any(
                        ts < t <= min(answers) for t in same) and min(answers) - ts <= max_rtt_us:
                    trips.append(min(answers) - ts)
            if flags & 16:
                if size == 0 and not flags & 7 and acked == (ack, window):
                    run += 1
                    c["dup_acks"] += 1
                    c["dup3ack"] += run == 3
                else:
                    run = 0
                acked = (ack, window)
        out.append((*key, *c.values(), len(trips), sum(trips), min(trips, default=None), max(trips, default=None)))
    return sorted(out, key=repr)


def connection(rng, a, b, start_us, packets, isn):
    """Packets of both directions with losses, repeats, swaps, late ACKs and a wrap of numbers."""
    rows, ts, sent, top, acked = [], start_us, [], isn, isn
    for _ in range(packets):
        ts += rng.choice([1, 50, 3000, 400_000, 20_000_000])
        kind = rng.random()
        if kind < 0.5 or not sent:
            size = rng.choice([1, 500, 1460])
            sent.append((top, size))
            top += size
            if kind < 0.07:  # lost before the capture
                continue
            rows.append((ts, *a, *b, 6, size, sent[-1][0] % WRAP, 9, 24, 100))
        elif kind < 0.65:
            seq, size = rng.choice(sent[-6:])
            rows.append((ts, *a, *b, 6, rng.choice([size, max(1, size // 2)]), seq % WRAP, 9, 24, 100))
        elif kind < 0.68:
            rows.append((ts, *a, *b, 6, 0, (top - 1) % WRAP, 9, 16, 100))
        else:
            if rng.random() < 0.2:
                acked = sum(rng.choice(sent[-4:]))
            rows.append((ts, *b, *a, 6, 0, 9, acked % WRAP, rng.choice([16] * 12 + [17, 20, 18]), rng.choice([7] * 9 + [8])))
    return rows


def frame(spark, rows):
    """Rows with distinct times, so that both directions have one order."""
    seen, out = set(), []
    for i, (ts, sa, sp, da, dp, proto, *rest) in enumerate(rows):
        while ts in seen:
            ts += 1
        seen.add(ts)
        out.append((i, ts, 2048, sa, da, sp, dp, proto, *rest))
    return out, spark.createDataFrame(out, SCHEMA)


def answer(df):
    names = ["src_addr", "dst_addr", "src_port", "dst_port", "proto", "packets", "rexmt_pkts", "rexmt_bytes", "out_of_order",
             "dup_acks", "dup3ack", "rtt_cnt", "tot_rtt", "rtt_min", "rtt_max"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("chunk_us, hot_rows", [(10_000_000, None), (1, None), (700_000, None), (10**12, 7)])
def test_equals_a_walk_over_each_flow(spark, chunk_us, hot_rows):
    rng = random.Random(chunk_us)
    rows = []
    for i in range(5):
        rows += connection(rng, (10 + i, 1000), (20, 80), rng.randint(0, 10**6), 200, rng.choice([0, WRAP - 5000, 77]))
    rows, packets = frame(spark, rows)
    want = brute_force(rows)
    got = answer(tcp_quality(packets, chunk_us, hot_rows))
    assert got == want
    assert all(sum(r[i] for r in want) > 0 for i in (6, 7, 8, 9, 10, 11)), want


def test_packets_without_numbers_are_left_out(spark):
    rows = [(0, 1, 2048, 1, 2, 3, 4, 6, 10, None, None, None, None), (1, 2, 2048, 1, 2, 3, 4, 6, 10, 5, 0, 24, 1),
            (2, 3, 2048, 1, 2, None, None, 6, 10, 5, 0, 24, 1), (3, 4, 34525, 1, 2, 3, 4, 6, 10, 5, 0, 24, 1),
            (4, 5, 2048, 1, 2, 3, 4, 17, 10, 5, 0, 24, 1)]
    got = answer(tcp_quality(spark.createDataFrame(rows, SCHEMA)))
    assert got == sorted([(1, 2, 3, 4, 6, 1, 0, 0, 0, 0, 0, 0, 0, None, None),
                          (1, 2, None, None, 6, 1, 0, 0, 0, 0, 0, 0, 0, None, None)], key=repr)


def test_a_repeat_hides_its_round_trip(spark):
    data = (1, 2, 3, 4, 6, 100, 1000, 0, 24, 1)
    ack = (2, 1, 4, 3, 6, 0, 0, 1100, 16, 1)
    rows = [(0, 10, 2048, *data), (1, 20, 2048, *data), (2, 30, 2048, *ack)]
    got = {r[0]: r for r in answer(tcp_quality(spark.createDataFrame(rows, SCHEMA)))}
    assert got[1][6:8] == (1, 100) and got[1][11] == 0
    late = [(0, 10, 2048, *data), (1, 20 + MAX_RTT_US, 2048, *ack)]
    assert answer(tcp_quality(spark.createDataFrame(late, SCHEMA)))[0][11] == 0


def test_empty_table(spark):
    assert tcp_quality(spark.createDataFrame([], SCHEMA)).collect() == []

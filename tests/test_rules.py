"""The rule language and the single-scan evaluation."""

import warnings

import pytest

from flowloom.functions.fields import DERIVED_FIELDS, FLOW_FIELDS, flow_field
from flowloom.operators import rules
from tests.conftest import flow_rows


def found(df, text, *columns):
    return sorted(tuple(r[c] for c in columns) for r in rules.detect(df, rules.load_rules(text)).collect())


def matching_ports(spark, pattern, values):
    df = flow_rows(spark, [dict(dst_port=v) for v in values])
    rule = rules.Rule("r", 300, (rules.Pattern.parse(pattern),), ())
    return sorted(r.dst_port for r in df.where(rule.matches()).collect())


def test_right_hand_sides(spark):
    ports = [1, 5, 6, 7, 9, 10]
    assert matching_ports(spark, "dport=5", ports) == [5]
    assert matching_ports(spark, "dport=5-7", ports) == [5, 6, 7]
    assert matching_ports(spark, "dport=7-", ports) == [7, 9, 10]
    assert matching_ports(spark, "dport=1|6|10", ports) == [1, 6, 10]  # every alternative counts
    assert matching_ports(spark, "dport=7-7", ports) == [7]


@pytest.mark.parametrize("pattern, ports", [
    ("dport+pkts=12", [10]), ("dport-pkts=3", [5]), ("dport*pkts=20", [10]), ("dport/pkts=2", [5]),
])
def test_arithmetic_left_hand_sides(spark, pattern, ports):
    df = flow_rows(spark, [dict(dst_port=v, dpkts=2) for v in (5, 10, 1)])
    rule = rules.Rule("r", 300, (rules.Pattern.parse(pattern),), ())
    assert sorted(r.dst_port for r in df.where(rule.matches()).collect()) == ports


def test_division_by_zero_matches_nothing(spark):
    df = flow_rows(spark, [dict(dpkts=0)])
    rule = rules.Rule("r", 300, (rules.Pattern.parse("bytes/pkts=0-"),), ())
    assert df.where(rule.matches()).count() == 0


@pytest.mark.parametrize("pattern", ["dport", "dport=", "dport=a", "a b=1", "dport=1-2-3"])
def test_bad_patterns_are_named(pattern):
    with pytest.raises(ValueError):
        rules.Pattern.parse(pattern)


def test_shipped_rules():
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        shipped = rules.load_rules()
    assert len(shipped) == 39 and len({r.name for r in shipped}) == 39
    assert [str(w.message) for w in caught] == ["rule 'wincrash_v2' is given more than once"]
    by_name = {r.name: r for r in shipped}
    assert by_name["synflood"].returned == ("sip", "sport", "dip", "dport")
    assert by_name["port_scan"].unique and not by_name["vnc"].unique
    assert "kamun" not in by_name


def test_last_of_two_rules_with_one_name_counts(spark):
    text = "a;300;dport=1;sip;dip;count;null;sip\na;300;dport=2;sip;dip;count;null;sip"
    df = flow_rows(spark, [dict(dst_port=1), dict(dst_port=2, src_addr=9)])
    with pytest.warns(UserWarning):
        assert found(df, text, "rule", "sip", "flows") == [("a", 9, 1)]


def test_unique_counts_distinct_sort_keys_and_count_counts_flows(spark):
    rows = [dict(dst_port=port) for port in (1, 1, 2, 2, 3)]
    text = "u;300;prot=6;sip,dip;dport;unique;flows=3-;sip\nc;300;prot=6;sip,dip;dport;count;flows=5;sip"
    assert found(flow_rows(spark, rows), text, "rule", "flows") == [("c", 5), ("u", 3)]
    assert found(flow_rows(spark, rows), "u;300;prot=6;sip;dport;unique;flows=4-;sip", "rule") == []


def test_detector_uses_the_named_sum(spark):
    rows = [dict(dpkts=4, doctets=10), dict(dpkts=6, doctets=10)]
    text = ("p;300;prot=6;sip;dip;count;pkts=10;sip\nb;300;prot=6;sip;dip;count;bytes=20-30;sip\n"
            "both;300;prot=6;sip;dip;count;bytes=20,flows=3-;sip")
    assert found(flow_rows(spark, rows), text, "rule", "pkts", "bytes") == [("b", 10, 20), ("p", 10, 20)]


def test_bins_and_key_columns(spark):
    rows = [dict(first_us=1_000_000), dict(first_us=299_999_999), dict(first_us=300_000_000)]
    text = "a;300;prot=6;sip;dip;count;null;sip\nb;600;prot=6;dport;dip;count;null;dport"
    assert found(flow_rows(spark, rows), text, "rule", "bin_start", "sip", "dport", "flows") == sorted([
        ("a", 0, 1, None, 2), ("a", 300, 1, None, 1), ("b", 0, None, 80, 3)],
        key=lambda r: r[:2])


def test_port_scan_and_synflood_of_the_shipped_rules(spark):
    scan = [dict(src_addr=7, dst_port=1000 + i, tcp_flags=18) for i in range(30)]
    flood = [dict(src_addr=8, dst_port=80, tcp_flags=2) for _ in range(20)]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        got = {(r.rule, r.sip, r.flows) for r in rules.detect(flow_rows(spark, scan + flood)).collect()}
    assert got == {("port_scan", 7, 30), ("synflood", 8, 20)}


def test_flow_field_names(spark):
    df = flow_rows(spark, [dict(tcp_flags=0x13, src_addr=0x0A010203, src_mask=16)])
    row = df.select(*[flow_field(n).alias(n) for n in ("sip", "syn", "ack", "fin", "ssubnet", "recs")]).first()
    assert tuple(row) == (0x0A010203, 1, 1, 1, 0x0A010000, 1)
    assert len(FLOW_FIELDS) + len(DERIVED_FIELDS) == 27
    with pytest.raises(KeyError):
        flow_field("dstport")


def test_legacy_rules(spark):
    text = "#comment\nweb;proto=6,dstport=80|443,octets=50-150\ndns;proto=17,dstport=53\nping;proto=1,pkts=1\nx;proto=47,pkts=1"
    groups = rules.load_legacy_rules(text)
    assert {g: list(r) for g, r in groups.items()} == {"TCP": ["web"], "UDP": ["dns"], "ICMP": ["ping"]}
    rows = [dict(), dict(dst_port=443, doctets=50), dict(dst_port=443, doctets=151), dict(prot=17, dst_port=53, dpkts=3)]
    got = sorted(tuple(r) for r in rules.legacy_matches(flow_rows(spark, rows), groups).collect())
    assert got == [("dns", "UDP", 1, 3, 100), ("web", "TCP", 2, 2, 150)]


def test_name_lists(tmp_path):
    (tmp_path / "keys").write_text("#keys\nsip;dip\ndport;sip\n")
    assert rules.load_names(tmp_path / "keys") == ["sip", "dip", "dport"]


def test_rules_with_and_without_ports_together(spark):
    """Port rules go through the port table, others through expressions; both see every flow once."""
    rows = [dict(dst_port=port, prot=prot, src_addr=port) for port in (80, 443, 70000) for prot in (6, 17)]
    text = ("web;300;prot=6,dport=80|80|443;sip;dip;count;null;sip\nhigh;300;dport=400-,prot=17;sip;dip;count;null;sip\n"
            "any;300;dport=80,dport=70-90;sip;dip;count;null;sip\ntcp;300;prot=6;prot;dip;count;null;prot\n"
            "all;300;null;prot;dip;count;null;prot")
    got = found(flow_rows(spark, rows), text, "rule", "flows")
    assert got == [("all", 3), ("all", 3), ("any", 2), ("high", 1), ("tcp", 3), ("web", 1), ("web", 1)]


def test_returned_fields(spark):
    rows = [dict(src_addr=8, src_port=i, first_us=1) for i in range(3)] + [dict(src_addr=9, src_port=5)]
    df = flow_rows(spark, rows)
    flood, plain = rules.load_rules(
        "flood;300;prot=6;sip,dip;sport;count;flows=3-;sip,sport,dip,dport\nplain;300;prot=6;sip;dip;count;null;sip,flows")
    assert sorted(tuple(r) for r in rules.returned_rows(df, plain).collect()) == [(0, 8, 3), (0, 9, 1)]
    got = sorted(tuple(r) for r in rules.returned_rows(df, flood).collect())
    assert got == [(0, 8, port, 2, 80) for port in range(3)]


def test_all_rules_return_their_fields_and_null_keys_stay(spark):
    rows = [dict(src_addr=None, src_port=i, first_us=1) for i in range(3)] + [dict(src_addr=9, src_port=5, prot=17)]
    chosen = rules.load_rules("flood;300;prot=6;sip;sport;unique;flows=3-;sip,sport\nany;300;prot=17;sip,dip;dip;count;null;dip,prot,flows")
    df = flow_rows(spark, rows)
    assert {(r.rule, r.sip) for r in rules.detect(df, chosen).collect()} == {("flood", None), ("any", 9)}
    got = rules.detect_returned(df, chosen).select("rule", "sip", "dip", "flows", "ret_sport", "ret_prot")
    assert {tuple(r) for r in got.collect()} == {
        *(("flood", None, None, 3, port, None) for port in range(3)), ("any", 9, 2, 1, None, 17)}
    assert {tuple(r) for r in rules.returned_rows(df, chosen[0]).collect()} == {(0, None, port) for port in range(3)}


def test_legacy_rules_of_other_protocols_are_told():
    with pytest.warns(UserWarning, match="'gre'.*left out"):
        groups = rules.load_legacy_rules("gre;proto=47,pkts=1\nweb;proto=6,dstport=80")
    assert [list(r) for r in groups.values()] == [["web"], [], []]

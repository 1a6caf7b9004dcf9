"""Detection rules: text lines that become filters, groupings and thresholds.

A rule line reads ``name;bin seconds;filter;group by;sort by;unique|count;
detector|null;returned fields``.  Filter and detector are comma-separated
patterns ``field=value``, where the left side may be two fields joined by one
of ``+ - * /`` and the right side is ``v``, ``a-b``, ``a-`` or ``a|b|…``.

All rules are evaluated in one scan and one aggregation.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from flowloom.functions.fields import flow_field
from flowloom.functions.net import bucket_s
from flowloom.plans.lineage import as_table

MAX_PORT = 65_535
TOTALS = ("flows", "pkts", "bytes")
SHIPPED_RULES = Path(__file__).resolve().parent.parent / "rules" / "detection_rules.txt"


@dataclass(frozen=True)
class Pattern:
    """One condition: a field or two combined fields against ranges of values."""

    left: tuple[str, ...]
    operator: str | None
    ranges: tuple[tuple[int, int | None], ...]

    @classmethod
    def parse(cls, text: str) -> "Pattern":
        left, _, right = text.strip().partition("=")
        names = re.fullmatch(r"(\w+)(?:([-+*/])(\w+))?", left.strip())
        values = re.fullmatch(r"\d+(?:-\d*|(?:\|\d+)*)", right.strip())
        if not names or not values:
            raise ValueError(f"bad pattern: {text!r}")
        low, dash, high = right.strip().partition("-")
        if dash:
            ranges = ((int(low), int(high) if high else None),)
        else:
            ranges = tuple((int(v), int(v)) for v in low.split("|"))
        return cls(tuple(n for n in (names[1], names[3]) if n), names[2], ranges)

    def column(self, value_of) -> Column:
        """Condition, with ``value_of(name)`` giving the column of a field."""
        value = value_of(self.left[0])
        if self.operator:
            other = value_of(self.left[1])
            value = {
                "+": lambda a, b: a + b,
                "-": lambda a, b: a - b,
                "*": lambda a, b: a * b,
                "/": lambda a, b: F.when(b != 0, F.call_function("div", a, b)),
            }[self.operator](value, other)
        points = [low for low, high in self.ranges if low == high]
        tests = [value.isin(*points)] if len(points) > 1 else [value == p for p in points]
        tests += [value >= low if high is None else value.between(low, high)
                  for low, high in self.ranges if low != high]
        return reduce(lambda a, b: a | b, tests)


def _patterns(text: str) -> tuple[Pattern, ...]:
    return () if text.strip() == "null" else tuple(Pattern.parse(p) for p in text.split(","))


def _names(text: str) -> tuple[str, ...]:
    return tuple(name.strip() for name in text.split(",") if name.strip())


@dataclass(frozen=True)
class Rule:
    name: str
    bin_s: int
    filters: tuple[Pattern, ...]
    group_by: tuple[str, ...]
    sort_by: tuple[str, ...] = ()
    unique: bool = False
    detector: tuple[Pattern, ...] = ()
    returned: tuple[str, ...] = field(default=())

    @classmethod
    def parse(cls, line: str) -> "Rule":
        parts = line.strip().split(";")
        if len(parts) != 8:
            raise ValueError(f"a rule has 8 fields: {line!r}")
        name, bin_s, filters, group_by, sort_by, count, detector, returned = parts
        return cls(name, int(bin_s), _patterns(filters), _names(group_by), _names(sort_by),
                   count == "unique", _patterns(detector), _names(returned))

    def matches(self) -> Column:
        """Whether a flow row passes the filter; null (a division by zero) is no match."""
        return reduce(lambda a, b: a & b, [p.column(flow_field) for p in self.filters], F.lit(True))


def _lines(source: str | Path) -> list[str]:
    text = source.read_text() if isinstance(source, Path) else source
    return [line for line in text.splitlines() if line.strip() and not line.startswith("#")]


def load_rules(source: str | Path = SHIPPED_RULES) -> list[Rule]:
    """Rules of a file or text; of two rules with one name the last one counts."""
    rules: dict[str, Rule] = {}
    for line in _lines(source):
        rule = Rule.parse(line)
        if rule.name in rules:
            warnings.warn(f"rule {rule.name!r} is given more than once", stacklevel=2)
        rules[rule.name] = rule
    return list(rules.values())


def load_names(source: str | Path) -> list[str]:
    """A flat list of field names, separated by ``;`` or line ends (filter and key lists)."""
    return list(dict.fromkeys(n.strip() for line in _lines(source) for n in line.split(";") if n.strip()))


def _matching_ids(rules: list[Rule], at: list[int] | None = None) -> Column:
    """Positions of the rules a flow matches, as an array that compiles to one loop."""
    at = range(len(rules)) if at is None else at
    tested = [F.when(rules[i].matches(), F.lit(i)).otherwise(F.lit(-1)) for i in at]
    return F.array_remove(F.array(*tested), -1) if tested else F.array().cast("array<int>")


def _port_of(rule: Rule) -> Pattern | None:
    return next((p for p in rule.filters if p.left == ("dport",)), None)


def _hits(flows: DataFrame, rules: list[Rule]) -> DataFrame:
    """A row per flow and rule it matches, with the rule's position as ``rule_id``.

    Rules that name destination ports are found through a table of ports, which
    is broadcast: it has at most 65536 rows, however many rules there are.  The
    rest of their filter, and whole filters of the other rules, are expressions.
    """
    by_port: dict[int, list[int]] = {}
    for i, rule in enumerate(rules):
        if port := _port_of(rule):
            for low, high in port.ranges:
                for value in range(max(low, 0), min(MAX_PORT if high is None else high, MAX_PORT) + 1):
                    if i not in by_port.setdefault(value, []):
                        by_port[value].append(i)
    others = [i for i, rule in enumerate(rules) if not _port_of(rule)]
    ids = _matching_ids(rules, others)
    if not by_port:
        return flows.withColumn("rule_id", F.explode(ids))
    ports = flows.sparkSession.createDataFrame(
        [(port, found) for port, found in by_port.items()], "rule_port int, port_rules array<int>")
    found = F.coalesce("port_rules", F.array().cast("array<int>"))
    rows = flows.join(F.broadcast(ports), F.col("dst_port") == F.col("rule_port"), "left")
    rows = rows.withColumn("rule_id", F.explode(F.concat(found, ids))).drop("rule_port", "port_rules")
    # Rules often share what is left of their filters, so each such rest is tested once.
    rests: dict[tuple[Pattern, ...], list[int]] = {(): list(others)}
    for i, rule in enumerate(rules):
        if port := _port_of(rule):
            rests.setdefault(tuple(p for p in rule.filters if p is not port), []).append(i)
    tests = [reduce(lambda a, b: a & b, [p.column(flow_field) for p in rest], F.col("rule_id").isin(ids_of))
             for rest, ids_of in rests.items() if ids_of]
    return rows.where(reduce(lambda a, b: a | b, tests))


def _by_rule(values: list) -> Column:
    """The entry of a per-rule list that belongs to the row's ``rule_id``."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("rule_id") + 1)


def matched(flows: DataFrame, rules: list[Rule], returned: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row per flow and rule it matches, with the rule's bin, group key and sort key.

    Flows that match nothing, which are nearly all, end here.  Key fields that
    a rule does not group by are null.  With ``returned`` the fields that rules
    return beside keys and totals come along, as ``ret_`` columns, and so do the
    columns to ``keep``.
    """
    keys = list(dict.fromkeys(k for r in rules for k in r.group_by))
    sorts = list(dict.fromkeys(k for r in rules for k in r.sort_by if r.unique))
    others = list(dict.fromkeys(k for r in rules for k in _beside_keys(r))) if returned else []
    hits = _hits(flows, rules)
    bins = list({r.bin_s for r in rules})
    start = F
    for size in bins:
        start = start.when(_by_rule([r.bin_s for r in rules]) == size, bucket_s(F.col("first_us"), size))
    return hits.select(
        "rule_id", start.alias("bin_start"),
        *[F.when(_by_rule([k in r.group_by for r in rules]), flow_field(k)).alias(f"key_{k}") for k in keys],
        *[F.when(_by_rule([r.unique and k in r.sort_by for r in rules]), flow_field(k)).alias(f"sort_{k}")
          for k in sorts],
        *[F.when(_by_rule([k in _beside_keys(r) for r in rules]), flow_field(k)).alias(f"ret_{k}") for k in others],
        F.col("dpkts").alias("pkts"), F.col("doctets").alias("bytes"), *keep,
    )


def matching(flows: DataFrame, rules: list[Rule]) -> DataFrame:
    """The flows that a rule matches, once for each such rule."""
    return _hits(flows, rules).select(*flows.columns)


def _beside_keys(rule: Rule) -> list[str]:
    """Fields a rule returns that are neither its keys nor totals."""
    return [n for n in rule.returned if n not in rule.group_by and n not in TOTALS]


def partial_groups(hits: DataFrame, returned: bool = False) -> DataFrame:
    """Sums per rule, bin, key and sort key (and returned fields): these add up over any pieces of the input."""
    names = [c for c in hits.columns if c not in ("pkts", "bytes", "n") and (returned or not c.startswith("ret_"))]
    n = F.sum("n") if "n" in hits.columns else F.count("*")
    return hits.groupBy(*names).agg(n.alias("n"), F.sum("pkts").alias("pkts"), F.sum("bytes").alias("bytes"))


def final_groups(groups: DataFrame, rules: list[Rule], by: tuple[str, ...] = ()) -> DataFrame:
    """Groups that their rule's detector reports; ``by`` names columns that groups are told apart by too.

    In the detector ``flows`` is the number of flows, or of distinct sort keys
    for a ``unique`` rule; ``pkts`` and ``bytes`` are sums.
    """
    keys = [c for c in groups.columns if c.startswith("key_")]
    totals = groups.groupBy(*by, "rule_id", "bin_start", *keys).agg(
        F.sum("n").alias("n"), F.count("*").alias("sorts"),
        F.sum("pkts").cast("bigint").alias("pkts"), F.sum("bytes").cast("bigint").alias("bytes"))
    counted = totals.withColumn(
        "flows", F.when(_by_rule([r.unique for r in rules]), F.col("sorts")).otherwise(F.col("n")))
    # Rules often share a detector, or have none, so each is tested once.
    shared: dict[tuple[Pattern, ...], list[int]] = {}
    for i, rule in enumerate(rules):
        shared.setdefault(rule.detector, []).append(i)
    tests = [reduce(lambda a, b: a & b, [p.column(F.col) for p in detector], F.col("rule_id").isin(ids))
             for detector, ids in shared.items()]
    reported = reduce(lambda a, b: a | b, tests, F.lit(False))
    return counted.where(reported).select(
        _by_rule([r.name for r in rules]).alias("rule"), "bin_start",
        *[F.col(k).alias(k.removeprefix("key_")) for k in keys], "flows", "pkts", "bytes")


def detect(flows: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Groups of flows reported by the rules.

    Flows are first combined per rule, bin, key and sort key, so a hot pair of
    hosts reaches the second aggregation as few rows.
    """
    rules = load_rules() if rules is None else rules
    return final_groups(partial_groups(matched(flows, rules)), rules)


def detect_returned(flows: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """What the rules declare to return, for every group they report.

    One scan finds the combinations of keys and returned fields and their sums;
    groups are summed and tested from these, and meet them again, not the flows.
    A row has the rule, the bin, all key fields, totals and returned fields of
    any rule; those a rule does not have are null.
    """
    rules = load_rules() if rules is None else rules
    combined = as_table(partial_groups(matched(flows, rules, returned=True), returned=True), "rule-groups")
    reports = final_groups(partial_groups(combined), rules)
    others = [c for c in combined.columns if c.startswith("ret_")]
    keys = [c for c in combined.columns if c.startswith("key_")]
    found = combined.select(_by_rule([r.name for r in rules]).alias("name"), F.col("bin_start").alias("bin"),
                            *keys, *others).distinct()
    same = (F.col("rule") == F.col("name")) & (F.col("bin_start") == F.col("bin"))
    for key in keys:
        same &= F.col(key).eqNullSafe(reports[key.removeprefix("key_")])
    return reports.join(found, same).select(*reports.columns, *others)


def returned_rows(flows: DataFrame, rule: Rule) -> DataFrame:
    """The returned fields of a rule, per bin, for the groups it reports."""
    rows = detect_returned(flows, [rule])
    return rows.select("bin_start", *[
        F.col(f"ret_{n}" if n in _beside_keys(rule) else n).alias(n) for n in rule.returned]).distinct()


# Field names of the older rule syntax -> short field names.
LEGACY_FIELDS = {"srcport": "sport", "dstport": "dport", "proto": "prot", "octets": "bytes", "pkts": "pkts"}
LEGACY_GROUPS = {6: "TCP", 17: "UDP", 1: "ICMP"}


def load_legacy_rules(source: str | Path) -> dict[str, dict[str, Rule]]:
    """Rules ``name;proto=6,dstport=a|b,octets=x-y``, as protocol -> name -> rule.

    Rules that name none of the three protocols, or none at all, belong to no group; a warning tells their names.
    """
    groups: dict[str, dict[str, Rule]] = {name: {} for name in LEGACY_GROUPS.values()}
    for line in _lines(source):
        name, _, patterns = line.strip().partition(";")
        renamed = []
        for text in patterns.split(","):
            key, _, value = text.partition("=")
            renamed.append(Pattern.parse(f"{LEGACY_FIELDS[key.strip()]}={value}"))
        proto = next((p.ranges[0][0] for p in renamed if p.left == ("prot",)), None)
        if proto in LEGACY_GROUPS:
            groups[LEGACY_GROUPS[proto]][name] = Rule(name, 300, tuple(renamed), ())
        else:
            warnings.warn(f"rule {name!r} is for none of {', '.join(LEGACY_GROUPS.values())} and is left out", stacklevel=2)
    return groups


def legacy_matches(flows: DataFrame, groups: dict[str, dict[str, Rule]]) -> DataFrame:
    """Flows, packets and octets per older-syntax rule and its protocol group."""
    tagged = [(group, rule) for group, rules in groups.items() for rule in rules.values()]
    return (
        _hits(flows, [rule for _, rule in tagged])
        .groupBy("rule_id")
        .agg(F.count("*").alias("flows"), F.sum("dpkts").alias("pkts"), F.sum("doctets").alias("octets"))
        .select(_by_rule([r.name for _, r in tagged]).alias("rule"),
                _by_rule([group for group, _ in tagged]).alias("protocol"), "flows", "pkts", "octets")
    )

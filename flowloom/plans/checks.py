"""For each query the SQL text that another engine runs over the same tables."""

from __future__ import annotations

from flowloom.operators import rules
from flowloom.operators.flows import FAN_OUT
from flowloom.plans import queries as q
from flowloom.plans.views import check_text

_TUPLE = "src_addr, dst_addr, src_port, dst_port, proto"
_V4 = "eth_type = 2048"


def _ip(column: str) -> str:
    return (f"CAST({column} >> 24 & 255 AS VARCHAR) || '.' || CAST({column} >> 16 & 255 AS VARCHAR) || '.' || "
            f"CAST({column} >> 8 & 255 AS VARCHAR) || '.' || CAST({column} & 255 AS VARCHAR)")


def _net(addr: str, mask: str) -> str:
    return f"(({addr} >> (32 - {mask})) << (32 - {mask}))"


def _over(name: str, body: str) -> str:
    """The text over one view; the view is ``{name}``."""
    view = f"WITH {name} AS ({check_text(name)})"
    body = body.strip()
    if body.startswith("WITH RECURSIVE "):
        return f"{view.replace('WITH', 'WITH RECURSIVE', 1)}, {body.removeprefix('WITH RECURSIVE ')}"
    return f"{view}, {body[5:]}" if body.startswith("WITH ") else f"{view} {body}"


def _count_up(column: str, text: bool = False) -> str:
    key = _ip(column) if text else column
    return _over("packets", f"""
        SELECT {key} AS {column}, CAST(SUM(ip_len) AS BIGINT) AS bytes, COUNT(*) AS packets
        FROM packets WHERE {_V4} GROUP BY {column}""")


def _top(measure: str) -> str:
    return _over("packets", f"""
        SELECT src_addr, CAST(SUM(ip_len) AS BIGINT) AS bytes, COUNT(*) AS packets
        FROM packets WHERE {_V4} GROUP BY src_addr ORDER BY {measure} DESC, src_addr LIMIT 10""")


def _distinct(metric: str, column: str, condition: str) -> str:
    return f"SELECT '{metric}' AS metric, COUNT(DISTINCT {column}) AS value FROM packets WHERE {condition}"


def _sum(metric: str, expression: str, condition: str) -> str:
    return (f"SELECT '{metric}' AS metric, CAST(COALESCE({expression}, 0) AS BIGINT) AS value "
            f"FROM packets WHERE {condition}")


_V6, _OTHER = "eth_type = 34525", "eth_type NOT IN (2048, 34525)"

_TOTAL_STATS = " UNION ALL ".join([
    _sum("IPv4 bc", "SUM(ip_len)", _V4), _sum("IPv4 pc", "COUNT(*)", _V4),
    "SELECT 'IPv4 addr' AS metric, COUNT(*) AS value FROM (SELECT src_addr FROM packets WHERE "
    f"{_V4} UNION SELECT dst_addr FROM packets WHERE {_V4})",
    _distinct("IPv4 srcaddr", "src_addr", _V4), _distinct("IPv4 dstaddr", "dst_addr", _V4),
    _distinct("ICMP type/codes", "src_port", f"{_V4} AND proto = 1"),
    _distinct("IPv4 tcp srcPort", "src_port", f"{_V4} AND proto = 6"),
    _distinct("IPv4 tcp dstPort", "dst_port", f"{_V4} AND proto = 6"),
    _distinct("IPv4 udp srcPort", "src_port", f"{_V4} AND proto = 17"),
    _distinct("IPv4 udp dstPort", "dst_port", f"{_V4} AND proto = 17"),
    f"SELECT 'IPv4 flows' AS metric, COUNT(*) AS value FROM (SELECT DISTINCT {_TUPLE}, ts_us // 60000000 "
    f"FROM packets WHERE {_V4})",
    _sum("IPv6 bc", "SUM(ip_len)", _V6), _sum("IPv6 pc", "COUNT(*)", _V6),
    _distinct("non-IP protocols", "eth_type", _OTHER), _sum("non-IP pc", "COUNT(*)", _OTHER),
])

_FLOW_GEN = f"""SELECT {_TUPLE}, ts_us // 60000000 * 60 AS bucket, CAST(SUM(ip_len) AS BIGINT) AS bytes,
    COUNT(*) AS packets, CAST(1 AS BIGINT) AS flows FROM packets WHERE {_V4} GROUP BY ALL"""

_RATE = """
    SELECT ts_us // 60000000 * 60 AS bucket,
      CASE WHEN eth_type = 2048 THEN 'IPv4' WHEN eth_type = 34525 THEN 'IPv6' ELSE 'non-IP' END AS family,
      CAST(SUM(CASE WHEN eth_type IN (2048, 34525) THEN ip_len ELSE 0 END) AS BIGINT) AS bytes,
      COUNT(*) AS packets,
      SUM(CASE WHEN eth_type IN (2048, 34525) THEN ip_len ELSE 0 END) / 60.0::DOUBLE AS bytes_per_s,
      COUNT(*) / 60.0::DOUBLE AS packets_per_s
    FROM packets GROUP BY 1, 2"""

_USAGE = """
    SELECT ts_s // 15 * 15 AS bucket, COUNT(*) AS readings, AVG(capacity) AS avg_capacity,
      AVG(containers) AS avg_containers FROM usage_samples GROUP BY 1"""

_STAT_KEYS = {
    "srcPort": "CAST(src_port AS VARCHAR)", "dstPort": "CAST(dst_port AS VARCHAR)",
    "srcSubnet": _ip(_net("src_addr", "src_mask")), "dstSubnet": _ip(_net("dst_addr", "dst_mask")),
    "srcAs": "CAST(src_as AS VARCHAR)", "dstAs": "CAST(dst_as AS VARCHAR)",
    "totalProtocol": "CAST(prot AS VARCHAR)", "totalVolume": "'all'",
}
_STAT_SUMS = "CAST(SUM(doctets) AS BIGINT) AS octets, CAST(SUM(dpkts) AS BIGINT) AS pkts, COUNT(*) AS flows"

_FLOWSTATS = " UNION ALL ".join(
    f"SELECT '{name}' AS type, {key} AS aggr_key, {_STAT_SUMS} FROM flows GROUP BY 2"
    for name, key in _STAT_KEYS.items())

_PERIODS = f"""WITH timed AS (
      SELECT *, {q.HOUR_US} + ((first_us // 86400000000) % 24) // 2 * 300000000 AS start FROM flows),
    dated AS (SELECT *, strftime(make_timestamp(start), '%Y-%m-%d') AS ds, strftime(make_timestamp(start), '%H%M') AS ts
      FROM timed) """ + " UNION ALL ".join(
    f"SELECT ds, ts, '{name}' AS type, {key} AS aggr_key, {_STAT_SUMS} FROM dated GROUP BY 1, 2, 4"
    for name, key in _STAT_KEYS.items())

_REPORT_TABLES = " UNION ALL ".join(
    f"""SELECT '{table}' AS report, '2024-01-01' AS ds, CASE WHEN first_us // 86400000000 % 2 = 0 THEN '0000' ELSE '0005'
      END AS ts, {_STAT_KEYS[kind] if key else 'CAST(NULL AS VARCHAR)'} AS key, {_STAT_SUMS} FROM flows GROUP BY ALL"""
    for table, (kind, key) in FAN_OUT.items())

_SPOOF = """WITH nets AS (
      SELECT DISTINCT prefix >> (32 - mask) AS net, mask, asn FROM mixed WHERE prefix IS NOT NULL AND mask IS NOT NULL),
    best AS (
      SELECT src_addr, MAX(mask) AS mask FROM (SELECT DISTINCT src_addr FROM flows)
      JOIN nets ON src_addr >> (32 - mask) = net GROUP BY 1),
    known AS (
      SELECT DISTINCT src_addr, asn FROM best JOIN nets ON best.mask = nets.mask AND src_addr >> (32 - nets.mask) = net)
    SELECT flows.src_addr, dst_addr, first_us, src_as FROM flows
    LEFT JOIN known ON flows.src_addr = known.src_addr AND src_as = asn WHERE asn IS NULL"""

_ALL_RETURNED = """WITH a AS (
      SELECT first_us // 2592000000000 * 2592000 AS bin_start, src_addr AS sip, dst_addr AS dip,
        CAST(src_port AS BIGINT) AS ret_sport, CAST(dst_port AS BIGINT) AS ret_dport, dpkts, doctets
      FROM flows WHERE prot = 6 AND tcp_flags & 19 = 2),
    b AS (
      SELECT first_us // 300000000 * 300 AS bin_start, src_addr AS sip, dst_addr AS dip,
        CAST(prot AS BIGINT) AS ret_prot, dpkts, doctets FROM flows WHERE doctets >= 1000),
    groups_a AS (
      SELECT bin_start, sip, dip, COUNT(*) AS flows, CAST(SUM(dpkts) AS BIGINT) AS pkts,
        CAST(SUM(doctets) AS BIGINT) AS bytes FROM a GROUP BY 1, 2, 3 HAVING COUNT(*) >= 2),
    groups_b AS (
      SELECT bin_start, dip, COUNT(DISTINCT sip) AS flows, CAST(SUM(dpkts) AS BIGINT) AS pkts,
        CAST(SUM(doctets) AS BIGINT) AS bytes FROM b GROUP BY 1, 2 HAVING COUNT(DISTINCT sip) >= 2)
    SELECT DISTINCT 'synflood' AS rule, g.*, ret_sport, ret_dport, NULL AS ret_prot
    FROM groups_a g JOIN a ON a.bin_start = g.bin_start AND a.sip = g.sip AND a.dip = g.dip
    UNION ALL
    SELECT DISTINCT 'big', g.bin_start, NULL, g.dip, flows, pkts, bytes, NULL, NULL, ret_prot
    FROM groups_b g JOIN b ON b.bin_start = g.bin_start AND b.dip = g.dip"""

_PLACES = "PARTITION BY src_addr, dst_addr, src_port, dst_port, proto"
_DIFFERENCE = "((x - y + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648"

# Sequence state with one window over whole flows.
_TCP_QUALITY = f"""WITH stepped AS (
      SELECT *, (tcp_flags & 16) > 0 AS acks, CASE WHEN (tcp_flags & 16) > 0 THEN tcp_ack END AS ack,
        tcp_seq AS x, LAG(tcp_seq) OVER ({_PLACES} ORDER BY ts_us) AS y FROM segments),
    placed AS (
      SELECT *, SUM(COALESCE({_DIFFERENCE}, 0)) OVER ({_PLACES} ORDER BY ts_us) AS start FROM stepped),
    data AS (
      SELECT *, MAX(start + payload_len) OVER ({_PLACES} ORDER BY ts_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high,
        MAX(payload_len) OVER ({_PLACES}, start ORDER BY ts_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS longest
      FROM placed WHERE payload_len > 0),
    repeated AS (
      SELECT {_TUPLE}, COUNT(longest) AS rexmt_pkts, COALESCE(SUM(LEAST(payload_len, longest)) FILTER (longest IS NOT NULL), 0) AS rexmt_bytes,
        COUNT(*) FILTER (longest IS NULL AND start < high) AS out_of_order FROM data GROUP BY ALL),
    acked AS (
      SELECT *, COALESCE(payload_len = 0 AND (tcp_flags & 7) = 0
        AND ack = LAG(ack) OVER ({_PLACES} ORDER BY ts_us)
        AND "window" = LAG("window") OVER ({_PLACES} ORDER BY ts_us), FALSE) AS again FROM placed WHERE acks),
    runs AS (
      SELECT *, SUM(CASE WHEN again THEN 0 ELSE 1 END) OVER ({_PLACES} ORDER BY ts_us) AS run FROM acked),
    doubles AS (
      SELECT {_TUPLE}, SUM(n) AS dup_acks, COUNT(*) FILTER (n >= 3) AS dup3ack
      FROM (SELECT {_TUPLE}, run, COUNT(*) AS n FROM runs WHERE again GROUP BY ALL) GROUP BY {_TUPLE}),
    answers AS (
      SELECT d.*, (SELECT MIN(a.ts_us) FROM acked a WHERE a.src_addr = d.dst_addr AND a.dst_addr = d.src_addr
          AND a.src_port = d.dst_port AND a.dst_port = d.src_port
          AND a.ack = (d.tcp_seq + d.payload_len) % 4294967296 AND a.ts_us >= d.ts_us) AS answered_us,
        (SELECT COUNT(*) FROM data e WHERE e.src_addr = d.src_addr AND e.dst_addr = d.dst_addr AND e.src_port = d.src_port
          AND e.dst_port = d.dst_port AND (e.tcp_seq + e.payload_len) % 4294967296 = (d.tcp_seq + d.payload_len) % 4294967296
          AND e.ts_us < d.ts_us AND d.ts_us - e.ts_us <= 60000000) AS sent_before,
        (SELECT MIN(e.ts_us) FROM data e WHERE e.src_addr = d.src_addr AND e.dst_addr = d.dst_addr AND e.src_port = d.src_port
          AND e.dst_port = d.dst_port AND (e.tcp_seq + e.payload_len) % 4294967296 = (d.tcp_seq + d.payload_len) % 4294967296
          AND e.ts_us > d.ts_us) AS sent_after
      FROM data d),
    trips AS (
      SELECT {_TUPLE}, COUNT(*) AS rtt_cnt, SUM(answered_us - ts_us) AS tot_rtt, MIN(answered_us - ts_us) AS rtt_min,
        MAX(answered_us - ts_us) AS rtt_max FROM answers
      WHERE answered_us - ts_us <= 60000000 AND sent_before = 0 AND (sent_after IS NULL OR sent_after > answered_us)
      GROUP BY ALL),
    counts AS (SELECT {_TUPLE}, COUNT(*) AS packets FROM segments GROUP BY ALL)
    SELECT {_TUPLE}, packets, CAST(COALESCE(rexmt_pkts, 0) AS BIGINT) AS rexmt_pkts,
      CAST(COALESCE(rexmt_bytes, 0) AS BIGINT) AS rexmt_bytes, CAST(COALESCE(out_of_order, 0) AS BIGINT) AS out_of_order,
      CAST(COALESCE(dup_acks, 0) AS BIGINT) AS dup_acks, CAST(COALESCE(dup3ack, 0) AS BIGINT) AS dup3ack,
      CAST(COALESCE(rtt_cnt, 0) AS BIGINT) AS rtt_cnt, CAST(COALESCE(tot_rtt, 0) AS BIGINT) AS tot_rtt, rtt_min, rtt_max
    FROM counts LEFT JOIN repeated USING ({_TUPLE}) LEFT JOIN doubles USING ({_TUPLE}) LEFT JOIN trips USING ({_TUPLE})"""

_REPORTS = {
    "totalvolume": ("totalVolume", None), "totalprotocol": ("totalProtocol", "protocol"),
    "portegress": ("srcPort", "port"), "portingress": ("dstPort", "port"),
    "subnetegress": ("srcSubnet", "subnet"), "subnetingress": ("dstSubnet", "subnet"),
    "asegress": ("srcAs", "asn"), "asingress": ("dstAs", "asn"),
}


def _report(stat_type: str, key: str | None) -> str:
    if key is None:
        return _over("flows", f"SELECT {_STAT_SUMS} FROM flows")
    return _over("flows", f"SELECT {_STAT_KEYS[stat_type]} AS {key}, {_STAT_SUMS} FROM flows GROUP BY 1")


_DATA = f"{_V4} AND proto = 6 AND payload_len <> 0"
_GAPS = f"""
    gaps AS (SELECT {_TUPLE}, ts_us, ip_len, pkt_id,
      ts_us - LAG(ts_us) OVER (PARTITION BY {_TUPLE} ORDER BY ts_us, pkt_id) AS gap_us,
      ROW_NUMBER() OVER (PARTITION BY {_TUPLE} ORDER BY ts_us, pkt_id) - 1 AS seq
      FROM packets WHERE {{where}})"""


def _pdf(x: str, mean: float, sd: float) -> str:
    return f"(EXP(-(({x} - {mean}) * ({x} - {mean})) / (2 * {sd}::DOUBLE * {sd})) / ({sd} * SQRT(2 * PI())))"


def _mixture(components) -> str:
    return " + ".join(f"{w}::DOUBLE * {_pdf('s', *size)} * {_pdf('g', *gap)}" for w, size, gap in components)


def _labels(http: str, smtp: str) -> str:
    gaps = _GAPS.format(where=_DATA)
    return f"""WITH {gaps.strip()},
      x AS (SELECT {_TUPLE}, CAST(ip_len AS DOUBLE) AS s, gap_us / 1000000.0::DOUBLE AS g FROM gaps),
      classified AS (
      SELECT {_TUPLE}, COUNT(*) AS packets,
        CASE WHEN COALESCE(SUM({http}), 0) > COALESCE(SUM({smtp}), 0) THEN 'HTTP' ELSE 'SMTP' END AS label
      FROM x GROUP BY {_TUPLE})"""


def _mixture_term(components) -> str:
    p = _mixture(components)
    return f"CASE WHEN g IS NULL THEN 0 WHEN ({p}) > 0 THEN LN({p}) ELSE 0 END"


def _normal_term(size, gap) -> str:
    def term(x: str, parameters) -> str:
        p = _pdf(x, *parameters)
        return f"CASE WHEN {x} <= 0 THEN 0 WHEN {p} > 0 THEN LN({p}) ELSE '-Infinity'::DOUBLE END"
    return f"CASE WHEN g IS NULL THEN 0 ELSE ({term('s', size)}) + ({term('g', gap)}) END"


_GMM = _labels(
    _mixture_term([(0.6, (424.217, 162.760), (2.592, 57.180)), (0.4, (1205.283, 204.101), (2.566, 56.458))]),
    _mixture_term([(0.6, (821.138, 173.548), (0.612, 4.032)), (0.4, (101.601, 53.341), (2.792, 22.558))]))
_NORMAL = _labels(_normal_term((628.7194, 385.1892), (2.584803, 56.99175)),
                  _normal_term((222.4691, 282.4612), (2.425682, 20.6584)))

_TRAINING = f"""{_GAPS.format(where=_DATA).strip()},
    labelled AS (SELECT CASE WHEN 80 IN (src_port, dst_port) THEN 'HTTP' WHEN 25 IN (src_port, dst_port) THEN 'SMTP' END AS label,
      CAST(ip_len AS DOUBLE) AS size, gap_us / 1000000.0::DOUBLE AS gap_s FROM gaps),
    training AS (SELECT * FROM labelled WHERE label IS NOT NULL AND gap_s IS NOT NULL)"""

# Reweighted least squares: nine sums a step, the 3 x 3 system by Cramer's rule.
_DET = "a00 * (a11 * a22 - a12 * a12) - a01 * (a01 * a22 - a12 * a02) + a02 * (a01 * a12 - a11 * a02)"
_FIT_LOGIT = f"""WITH RECURSIVE {_TRAINING},
    steps AS (
      SELECT 0 AS step, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2,
        NULL::DOUBLE AS v0, NULL::DOUBLE AS v1, NULL::DOUBLE AS v2
      UNION ALL
      SELECT step + 1,
        b0 + ((a11 * a22 - a12 * a12) * g0 + (a02 * a12 - a01 * a22) * g1 + (a01 * a12 - a02 * a11) * g2) / det,
        b1 + ((a12 * a02 - a01 * a22) * g0 + (a00 * a22 - a02 * a02) * g1 + (a02 * a01 - a00 * a12) * g2) / det,
        b2 + ((a01 * a12 - a11 * a02) * g0 + (a01 * a02 - a00 * a12) * g1 + (a00 * a11 - a01 * a01) * g2) / det,
        (a11 * a22 - a12 * a12) / det, (a00 * a22 - a02 * a02) / det, (a00 * a11 - a01 * a01) / det
      FROM (SELECT *, {_DET} AS det FROM (
        SELECT step, b0, b1, b2, SUM(s) AS a00, SUM(s * size) AS a01, SUM(s * gap_s) AS a02, SUM(s * size * size) AS a11,
          SUM(s * size * gap_s) AS a12, SUM(s * gap_s * gap_s) AS a22, SUM(y - mu) AS g0, SUM((y - mu) * size) AS g1,
          SUM((y - mu) * gap_s) AS g2
        FROM (SELECT *, mu * (1 - mu) AS s FROM (
          SELECT step, b0, b1, b2, size, gap_s, CASE WHEN label = 'SMTP' THEN 1 ELSE 0 END AS y,
            1 / (1 + EXP(-(b0 + b1 * size + b2 * gap_s))) AS mu FROM training, steps WHERE step < 12))
        GROUP BY ALL))),
    last AS (SELECT * FROM steps WHERE step = 12),
    terms AS (
      SELECT '(Intercept)' AS term, b0 AS b, SQRT(v0) AS e FROM last
      UNION ALL SELECT 'size', b1, SQRT(v1) FROM last UNION ALL SELECT 'gap_s', b2, SQRT(v2) FROM last),
    -- The normal distribution's tail by Simpson's rule over 2000 steps.
    tails AS (
      SELECT term, 1 - 2 * SUM(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * EXP(-POW(LEAST(ABS(b / e), 12) * i / 2000, 2) / 2)) * LEAST(MAX(ABS(b / e)), 12) / 6000 / SQRT(2 * PI()) AS p
      FROM terms, generate_series(0, 2000) AS g(i) GROUP BY term)
    SELECT term, ROUND(b, 8) AS estimate, ROUND(e, 8) AS std_error, ABS(ROUND(p, 5)) AS p_value FROM terms JOIN tails USING (term)"""

# Mixture of two normals per class, thirty steps; one row per class and step.
_FIT_GMM = f"""WITH RECURSIVE {_TRAINING},
    whole AS (
      SELECT label, AVG(size) AS m1, AVG(gap_s) AS m2, VAR_POP(size) AS v1, VAR_POP(gap_s) AS v2 FROM training GROUP BY label),
    em AS (
      SELECT label, 0 AS step, 0.5::DOUBLE AS pa, m1 - SQRT(v1) AS a1, v1 AS va1, m2 AS a2, v2 AS va2,
        0.5::DOUBLE AS pb, m1 + SQRT(v1) AS b1, v1 AS vb1, m2 AS b2, v2 AS vb2, v1 * 1e-6::DOUBLE AS l1, v2 * 1e-6::DOUBLE AS l2
      FROM whole
      UNION ALL
      SELECT label, step + 1, na / n, a1 + da1 / na, GREATEST(qa1 / na - POW(da1 / na, 2), l1), a2 + da2 / na,
        GREATEST(qa2 / na - POW(da2 / na, 2), l2), nb / n, b1 + db1 / nb, GREATEST(qb1 / nb - POW(db1 / nb, 2), l1),
        b2 + db2 / nb, GREATEST(qb2 / nb - POW(db2 / nb, 2), l2), l1, l2
      FROM (
        SELECT label, step, a1, a2, b1, b2, l1, l2, COUNT(*) AS n, SUM(ra) AS na, SUM(1 - ra) AS nb,
          SUM(ra * (size - a1)) AS da1, SUM(ra * (gap_s - a2)) AS da2, SUM((1 - ra) * (size - b1)) AS db1,
          SUM((1 - ra) * (gap_s - b2)) AS db2, SUM(ra * POW(size - a1, 2)) AS qa1, SUM(ra * POW(gap_s - a2, 2)) AS qa2,
          SUM((1 - ra) * POW(size - b1, 2)) AS qb1, SUM((1 - ra) * POW(gap_s - b2, 2)) AS qb2
        FROM (SELECT *, 1 / (1 + EXP(LEAST(lb - la, 700))) AS ra FROM (
          SELECT em.*, size, gap_s,
            LN(pa) - (LN(va1) + LN(va2)) / 2 - POW(size - a1, 2) / (2 * va1) - POW(gap_s - a2, 2) / (2 * va2) AS la,
            LN(pb) - (LN(vb1) + LN(vb2)) / 2 - POW(size - b1, 2) / (2 * vb1) - POW(gap_s - b2, 2) / (2 * vb2) AS lb
          FROM training JOIN em USING (label) WHERE step < 30))
        GROUP BY ALL)),
    done AS (SELECT * FROM em WHERE step = 30)
    SELECT label, ROUND(pa, 5) AS weight, ROUND(a1, 3) AS size_mean, ROUND(SQRT(va1), 3) AS size_sd, ROUND(a2, 3) AS gap_mean,
      ROUND(SQRT(va2), 3) AS gap_sd FROM done
    UNION ALL SELECT label, ROUND(pb, 5), ROUND(b1, 3), ROUND(SQRT(vb1), 3), ROUND(b2, 3), ROUND(SQRT(vb2), 3) FROM done"""

_FLOW_FIELDS = f"""SELECT src_addr, dst_addr, src_port, dst_port, prot, dpkts, doctets, tcp_flags,
    src_as, dst_as, src_mask, dst_mask, first_us, CAST((tcp_flags & 2) // 2 AS INT) AS syn,
    CAST((tcp_flags & 16) // 16 AS INT) AS ack, CAST(tcp_flags & 1 AS INT) AS fin,
    {_net('src_addr', 'src_mask')} AS src_subnet FROM flows"""

# Fields of a record that the flows have no value for are written as zero, and a flow ends when it starts.
_RECORD_FIELDS = f"""SELECT f.*, first_us AS last_us, 0::BIGINT AS nexthop, 1::BIGINT AS flows,
    {_net('dst_addr', 'dst_mask')} AS dst_subnet, {', '.join(f'0 AS {n}' for n in ('input', 'output', 'tos', 'pad1', 'pad2'))}
    FROM ({_FLOW_FIELDS}) f"""

# The rules once more as SQL, written from the parsed rules: one SELECT per rule.
_RULE_FIELDS = {
    "sip": "src_addr", "dip": "dst_addr", "sport": "src_port", "dport": "dst_port", "prot": "prot",
    "pkts": "dpkts", "bytes": "doctets", "sas": "src_as", "das": "dst_as", "smask": "src_mask",
    "syn": "((tcp_flags >> 1) & 1)", "ack": "((tcp_flags >> 4) & 1)", "fin": "(tcp_flags & 1)",
    "ssubnet": _net("src_addr", "src_mask"),
}


def _condition(pattern: rules.Pattern, names: dict[str, str]) -> str:
    left = names[pattern.left[0]]
    if pattern.operator == "/":
        left = f"({left} // NULLIF({names[pattern.left[1]]}, 0))"
    elif pattern.operator:
        left = f"({left} {pattern.operator} {names[pattern.left[1]]})"
    tests = [f"{left} >= {low}" if high is None else f"({left} >= {low} AND {left} <= {high})"
             for low, high in pattern.ranges]
    return "(" + " OR ".join(tests) + ")"


def _detect(source) -> str:
    chosen = rules.load_rules(source)
    keys = list(dict.fromkeys(k for r in chosen for k in r.group_by))
    parts = []
    for rule in chosen:
        where = " AND ".join(_condition(p, _RULE_FIELDS) for p in rule.filters) or "TRUE"
        sort = ", ".join(_RULE_FIELDS[k] for k in rule.sort_by)
        flows = f"COUNT(DISTINCT ({sort}))" if rule.unique else "COUNT(*)"
        having = " AND ".join(_condition(p, {
            "flows": flows, "pkts": "SUM(dpkts)", "bytes": "SUM(doctets)"}) for p in rule.detector) or "TRUE"
        size = rule.bin_s * 1_000_000
        columns = ", ".join(
            f"CAST({_RULE_FIELDS[k]} AS BIGINT) AS {k}" if k in rule.group_by else f"CAST(NULL AS BIGINT) AS {k}"
            for k in keys)
        grouped = ", ".join(["2", *[str(i + 3) for i, k in enumerate(keys) if k in rule.group_by]])
        parts.append(f"""SELECT '{rule.name}' AS rule, first_us // {size} * {rule.bin_s} AS bin_start, {columns},
          {flows} AS flows, CAST(SUM(dpkts) AS BIGINT) AS pkts, CAST(SUM(doctets) AS BIGINT) AS bytes
          FROM flows WHERE {where} GROUP BY {grouped} HAVING {having}""")
    return _over("flows", " UNION ALL ".join(parts))


def _legacy() -> str:
    parts = []
    for group, named in rules.load_legacy_rules(q.LEGACY_RULES).items():
        for name, rule in named.items():
            where = " AND ".join(_condition(p, _RULE_FIELDS) for p in rule.filters)
            parts.append(f"""SELECT '{name}' AS rule, '{group}' AS protocol, COUNT(*) AS flows,
              CAST(SUM(dpkts) AS BIGINT) AS pkts, CAST(SUM(doctets) AS BIGINT) AS octets
              FROM flows WHERE {where} HAVING COUNT(*) > 0""")
    return _over("flows", " UNION ALL ".join(parts))


_LOW, _HIGH = 10 << 24, (10 << 24) + 63


def checks() -> dict[str, str]:
    day = 86_400_000_000
    begin, end = q.RANGE
    both = "SELECT src_addr AS addr, * FROM flows UNION ALL SELECT dst_addr AS addr, * FROM flows"
    return {
        "pcap_roundtrip": _over("packets", f"""
            SELECT ts_us, eth_type, CASE WHEN {_V4} OR {_V6} THEN ip_len END AS ip_len,
              {', '.join(f'CASE WHEN {_V4} THEN {c} END AS {c}' for c in _TUPLE.split(', '))} FROM packets"""),
        "capture_range": _over("packets", f"""
            SELECT * FROM packets WHERE ts_us >= {begin - day} AND ts_us <= {end + day}"""),
        "capture_range_files": _over("packets", f"""
            SELECT ts_us, eth_type, CASE WHEN {_V4} OR {_V6} THEN ip_len END AS ip_len,
              {', '.join(f'CASE WHEN {_V4} THEN {c} END AS {c}' for c in _TUPLE.split(', '))}
            FROM packets WHERE ts_us >= {begin - day} AND ts_us <= {end + day}"""),
        "netflow_decode": _over("flows", _RECORD_FIELDS),
        "flowtools_decode": _over("flows", _RECORD_FIELDS),
        "flow_print": _over("flows", _FLOW_FIELDS),
        "flow_partitions": _over("flows", """
            SELECT 'backbone' AS area, strftime(make_timestamp(first_us), '%Y-%m') AS month, COUNT(*) AS flows,
              CAST(SUM(doctets) AS BIGINT) AS octets, CAST(SUM(dpkts) AS BIGINT) AS pkts
            FROM flows GROUP BY 2"""),
        "task_durations": _over("history", """WITH events AS (
              SELECT json_extract_string(line, '$.type') AS type, json_extract_string(line, '$.attemptId') AS attempt,
                CAST(json_extract_string(line, '$.time_ms') AS BIGINT) AS time_ms FROM history)
            SELECT s.attempt, s.time_ms AS start_ms, f.time_ms AS finish_ms, f.time_ms - s.time_ms AS duration_ms
            FROM events s JOIN events f ON s.attempt = f.attempt
            WHERE s.type = 'MAP_ATTEMPT_STARTED' AND f.type = 'MAP_ATTEMPT_FINISHED'"""),
        "proto_mix": _over("packets", f"""
            SELECT proto, COUNT(*) AS n, CAST(SUM(ip_len) AS BIGINT) AS bytes FROM packets WHERE {_V4} GROUP BY 1"""),
        "udp_port_filter": _over("packets", f"SELECT * FROM packets WHERE {_V4} AND proto = 17 AND dst_port = 53"),
        "packet_filter": _over("packets", f"""
            SELECT * FROM packets WHERE {_V4} AND proto = 6 AND 443 IN (src_port, dst_port)
              AND (src_addr >> 6 = {_LOW} >> 6 OR dst_addr >> 6 = {_LOW} >> 6)"""),
        "http_requests": _over("packets", f"""
            SELECT * FROM packets WHERE {_V4} AND proto = 6 AND payload_len > 0
              AND regexp_matches(payload, 'GET /.* HTTP/[0-9].[0-9]')"""),
        "legacy_rules": _legacy(),
        "count_up_src_ip": _count_up("src_addr", text=True),
        "count_up_dst_ip": _count_up("dst_addr", text=True),
        "count_up_src_port": _count_up("src_port"),
        "count_up_dst_port": _count_up("dst_port"),
        "count_up_proto": _count_up("proto"),
        "top_n_bytes": _top("bytes"),
        "top_n_packets": _top("packets"),
        "total_stats": _over("packets", _TOTAL_STATS),
        "rate": _over("packets", _RATE),
        "flow_gen": _over("packets", _FLOW_GEN),
        "flow_stats": _over("packets", f"""
            SELECT bucket, CAST(SUM(bytes) AS BIGINT) AS bytes, CAST(SUM(packets) AS BIGINT) AS packets,
              CAST(SUM(flows) AS BIGINT) AS flows, COUNT(DISTINCT ({_TUPLE})) AS endpoints,
              SUM(bytes) / 60.0::DOUBLE AS bytes_per_s, SUM(packets) / 60.0::DOUBLE AS packets_per_s,
              SUM(flows) / 60.0::DOUBLE AS flows_per_s
            FROM ({_FLOW_GEN}) GROUP BY bucket"""),
        "packet_count": _over("packets", f"""
            SELECT key, COUNT(*) AS n FROM (
              SELECT CAST(src_port AS VARCHAR) AS key FROM packets WHERE {_V4} AND proto IN (6, 17)
              UNION ALL SELECT CAST(dst_port AS VARCHAR) FROM packets WHERE {_V4} AND proto IN (6, 17)
              UNION ALL SELECT 'HTTP2' FROM packets WHERE {_V4} AND proto = 6 AND payload_len > 0
                AND regexp_matches(payload, 'GET /.* HTTP/[0-9].[0-9]'))
            GROUP BY key"""),
        "flow_totals": _over("packets", f"""
            SELECT {_TUPLE}, CAST(SUM(ip_len) AS BIGINT) AS bytes, COUNT(*) AS packets
            FROM packets WHERE {_V4} GROUP BY {_TUPLE}"""),
        "bidir_flows": _over("packets", f"""WITH sides AS (
              SELECT *, src_addr < dst_addr OR (src_addr = dst_addr AND src_port <= dst_port) AS forward
              FROM packets WHERE {_V4})
            SELECT proto, CASE WHEN forward THEN src_addr ELSE dst_addr END AS a_addr,
              CASE WHEN forward THEN src_port ELSE dst_port END AS a_port,
              CASE WHEN forward THEN dst_addr ELSE src_addr END AS b_addr,
              CASE WHEN forward THEN dst_port ELSE src_port END AS b_port,
              COUNT(*) FILTER (forward) AS packets_ab, COUNT(*) FILTER (NOT forward) AS packets_ba,
              CAST(SUM(ip_len) AS BIGINT) AS bytes
            FROM sides GROUP BY 1, 2, 3, 4, 5"""),
        "packets_per_src": _over("packets", f"SELECT src_addr, COUNT(*) AS n FROM packets WHERE {_V4} GROUP BY 1"),
        "packet_total": _over("packets", "SELECT COUNT(*) AS n FROM packets"),
        "popularity": _over("packets", f"""
            SELECT dst_addr, COUNT(DISTINCT src_addr) AS n FROM packets WHERE {_V4} GROUP BY 1"""),
        "distinct_sketches": _over("packets", f"""WITH later AS (
              SELECT * FROM packets WHERE {_V4} AND ts_us // 60000000 > (SELECT MIN(ts_us) // 60000000 FROM packets WHERE {_V4}))
            SELECT CAST(SUM(ip_len) AS BIGINT) AS bytes, COUNT(*) AS packets, COUNT(DISTINCT src_addr) AS sources,
              COUNT(DISTINCT dst_addr) AS destinations, (SELECT COUNT(DISTINCT addr) FROM (
                SELECT src_addr AS addr FROM later UNION ALL SELECT dst_addr FROM later)) AS addresses,
              COUNT(DISTINCT ({_TUPLE})) AS flows, TRUE AS sources_close, TRUE AS destinations_close,
              TRUE AS addresses_close, TRUE AS flows_close FROM later"""),
        "adjacency": _over("packets", f"""WITH pairs AS (
              SELECT DISTINCT src_addr, dst_addr FROM packets WHERE {_V4})
            SELECT src_addr, {_net('dst_addr', '16')} AS dst_block,
              string_agg({_ip('dst_addr')}, ' ' ORDER BY dst_addr) AS neighbours FROM pairs GROUP BY 1, 2"""),
        "tcp_summary": _over("packets", f"""
            SELECT {_TUPLE}, COUNT(*) AS packets, COUNT(*) FILTER (payload_len > 0) AS data_packets,
              CAST(COALESCE(SUM(payload_len) FILTER (payload_len > 0), 0) AS BIGINT) AS data_bytes,
              MIN(ts_us) AS first_us, MAX(ts_us) AS last_us, MIN(ip_len) AS min_size, MAX(ip_len) AS max_size
            FROM packets WHERE {_V4} AND proto = 6 GROUP BY {_TUPLE}"""),
        "tcp_summary_decoded": _over("packets", f"""
            SELECT {_TUPLE}, COUNT(*) AS packets, COUNT(*) FILTER (payload_len > 0) AS data_packets,
              CAST(COALESCE(SUM(payload_len) FILTER (payload_len > 0), 0) AS BIGINT) AS data_bytes,
              MIN(ts_us) AS first_us, MAX(ts_us) AS last_us, MIN(ip_len) AS min_size, MAX(ip_len) AS max_size,
              0::BIGINT AS syn, 0::BIGINT AS fin, 0::BIGINT AS rst, COUNT(*) AS ack, 0::BIGINT AS pure_ack,
              65535 AS win_min, 65535 AS win_max, 0::BIGINT AS cnt_zerowin, 64 AS ttl_min, 64 AS ttl_max
            FROM packets WHERE {_V4} AND proto = 6 GROUP BY {_TUPLE}"""),
        "tcp_summary_segments": _over("segments", f"""
            SELECT {_TUPLE}, COUNT(*) AS packets, COUNT(*) FILTER (payload_len > 0) AS data_packets,
              CAST(COALESCE(SUM(payload_len) FILTER (payload_len > 0), 0) AS BIGINT) AS data_bytes,
              MIN(ts_us) AS first_us, MAX(ts_us) AS last_us, MIN(ip_len) AS min_size, MAX(ip_len) AS max_size,
              CAST(SUM((tcp_flags >> 1) & 1) AS BIGINT) AS syn, CAST(SUM(tcp_flags & 1) AS BIGINT) AS fin,
              CAST(SUM((tcp_flags >> 2) & 1) AS BIGINT) AS rst, CAST(SUM((tcp_flags >> 4) & 1) AS BIGINT) AS ack,
              COUNT(*) FILTER (tcp_flags = 16 AND payload_len = 0) AS pure_ack, MIN("window") AS win_min,
              MAX("window") AS win_max, COUNT(*) FILTER ("window" = 0) AS cnt_zerowin, MIN(ttl) AS ttl_min, MAX(ttl) AS ttl_max
            FROM segments GROUP BY {_TUPLE}"""),
        "tcp_quality": _over("segments", _TCP_QUALITY),
        "word_count": """
            SELECT word, COUNT(*) AS n FROM (
              SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents)
            WHERE word <> '' GROUP BY word""",
        "path_adjacency": _over("traceroute", """WITH parts AS (
              SELECT string_split(line, '|') AS p FROM traceroute),
            hops AS (SELECT p[5] AS from_node, p[11] AS hop, p[13] AS to_node, TRY_CAST(p[15] AS DOUBLE) AS rtt
              FROM parts WHERE len(p) = 15)
            SELECT from_node, to_node, COUNT(*) AS n, CAST(FLOOR(AVG(rtt) + 0.5) AS BIGINT) AS avg_rtt
            FROM hops WHERE hop NOT IN ('0.0.0.0', '0') AND rtt IS NOT NULL GROUP BY 1, 2"""),
        "flowstats": _over("flows", _FLOWSTATS),
        **{f"flowstats_{name}": _report(*spec) for name, spec in _REPORTS.items()},
        "scan": _over("flows", f"""
            SELECT src_addr, dst_addr, COUNT(DISTINCT dst_port) AS cnt, MIN(first_us) AS first_us
            FROM flows GROUP BY 1, 2 HAVING COUNT(DISTINCT dst_port) > {q.SCAN_PORTS}"""),
        "spoof": _over("flows", f"""WITH registry AS ({check_text('registry')})
            SELECT src_addr, dst_addr, first_us, src_as FROM flows LEFT JOIN registry ON src_addr = prefix
            WHERE prefix IS NULL OR asn <> src_as"""),
        "spoof_masks": _over("flows", _SPOOF.replace("FROM mixed", f"FROM ({check_text('mixed_registry')})")),
        "spoof_large": _over("flows", _SPOOF.replace("FROM mixed", f"FROM ({check_text('mixed_registry')})")),
        "active_ips": _over("flows", f"""
            SELECT DISTINCT addr FROM ({both}) WHERE addr >= {_LOW} AND addr <= {_HIGH}"""),
        "active_ip_count": _over("flows", f"""
            SELECT strftime(make_timestamp(first_us), '%Y-%m-%d') AS ds, COUNT(DISTINCT addr) AS cnt
            FROM ({both}) GROUP BY 1"""),
        "active_subnets": _over("flows", f"SELECT DISTINCT {_net('addr', '24')} AS subnet FROM ({both})"),
        "heavy_users": _over("flows", f"""
            SELECT addr, CAST(SUM(doctets) AS BIGINT) AS octets FROM ({both}) GROUP BY 1 ORDER BY 2 DESC, 1"""),
        "detect_rules": _detect(rules.SHIPPED_RULES),
        "detect_port_scan": _detect(q.PORT_SCAN_RULES),
        "detect_synflood": _detect(q.SYNFLOOD_RULES),
        "detect_patterns": _detect(q.PATTERN_RULES),
        "detect_returned": _over("flows", """WITH members AS (
              SELECT first_us // 2592000000000 * 2592000 AS bin_start, src_addr AS sip,
                CAST(src_port AS BIGINT) AS sport, dst_addr AS dip, CAST(dst_port AS BIGINT) AS dport
              FROM flows WHERE prot = 6 AND tcp_flags & 19 = 2)
            SELECT DISTINCT bin_start, sip, sport, dip, dport FROM members
            WHERE (bin_start, sip, dip) IN (
              SELECT (bin_start, sip, dip) FROM members GROUP BY bin_start, sip, dip HAVING COUNT(*) >= 2)"""),
        "detect_all_returned": _over("flows", _ALL_RETURNED),
        "flow_key_list": _over("flows", f"""
            SELECT CAST(prot AS BIGINT) AS prot, CAST((tcp_flags >> 4) & 1 AS BIGINT) AS ack,
              CAST(dst_as AS BIGINT) AS das, {_STAT_SUMS} FROM flows GROUP BY 1, 2, 3"""),
        "url_users_views": _over("http_log", """
            SELECT url, COUNT(DISTINCT src_addr) AS users, COUNT(*) AS views FROM http_log GROUP BY 1"""),
        "user_urls": _over("http_log", "SELECT DISTINCT src_addr, url FROM http_log"),
        "usage_avg": _over("usage_samples", _USAGE),
        "upload_stats": _over("uploads", """
            SELECT site, COUNT(*) AS files, CAST(SUM(size_mb) AS BIGINT) AS size_mb,
              CAST(SUM(duration_s) AS BIGINT) AS duration_s, AVG(duration_s) AS avg_duration_s,
              MIN(start_s) AS first_start_s, MAX(end_s) AS last_end_s,
              SUM(size_mb) / SUM(duration_s)::DOUBLE AS mb_per_s FROM uploads GROUP BY 1"""),
        "packet_gaps": _over("packets", f"""WITH {_GAPS.format(where=_V4).strip()}
            SELECT {_TUPLE}, ts_us, ip_len, pkt_id, gap_us, seq FROM gaps"""),
        "flow_gap_list": _over("packets", f"""WITH {_GAPS.format(where=_V4).strip()}
            SELECT {_TUPLE}, seq // 1000 AS page, string_agg(CAST(gap_us AS VARCHAR), ' ' ORDER BY seq) AS gaps
            FROM gaps WHERE gap_us IS NOT NULL GROUP BY {_TUPLE}, seq // 1000"""),
        "flow_means": _over("packets", f"""
            SELECT {_TUPLE}, COUNT(*) AS packets, AVG(ip_len) AS mean_size,
              CASE WHEN COUNT(*) > 1 THEN (MAX(ts_us) - MIN(ts_us)) / (COUNT(*) - 1)::DOUBLE / 1000000.0::DOUBLE
                   ELSE 0 END AS mean_gap_s
            FROM packets WHERE {_V4} GROUP BY {_TUPLE}"""),
        "classify_gmm": _over("packets", f"{_GMM} SELECT {_TUPLE}, packets, label FROM classified"),
        "classify_normal": _over("packets", f"{_NORMAL} SELECT {_TUPLE}, packets, label FROM classified"),
        "success_ratio": _over("packets", f"""{_GMM}, truths AS (
              SELECT label, CASE WHEN 80 IN (src_port, dst_port) THEN 'HTTP'
                WHEN 25 IN (src_port, dst_port) THEN 'SMTP' END AS truth FROM classified)
            SELECT truth, label AS predicted, COUNT(*) AS flows,
              COUNT(*) / (SUM(COUNT(*)) OVER (PARTITION BY truth))::DOUBLE AS ratio
            FROM truths WHERE truth IS NOT NULL GROUP BY 1, 2"""),
        "fit_normal": _over("packets", f"""WITH {_GAPS.format(where=_DATA).strip()},
            training AS (SELECT CASE WHEN 80 IN (src_port, dst_port) THEN 'HTTP'
                WHEN 25 IN (src_port, dst_port) THEN 'SMTP' END AS label,
              CAST(ip_len AS DOUBLE) AS size, gap_us / 1000000.0::DOUBLE AS gap_s FROM gaps)
            SELECT label, COUNT(*) AS n, ROUND(AVG(size), 6) AS size_mean, ROUND(STDDEV_SAMP(size), 6) AS size_sd,
              ROUND(STDDEV_POP(size), 6) AS size_sd_mle, ROUND(AVG(gap_s), 6) AS gap_s_mean,
              ROUND(STDDEV_SAMP(gap_s), 6) AS gap_s_sd, ROUND(STDDEV_POP(gap_s), 6) AS gap_s_sd_mle
            FROM training WHERE label IS NOT NULL AND gap_s IS NOT NULL GROUP BY 1"""),
        "fit_logit": _over("packets", _FIT_LOGIT),
        "fit_gmm": _over("packets", _FIT_GMM),
        "stream_flowstats": _over("flows", _FLOWSTATS),
        "report_tables": _over("flows", _REPORT_TABLES),
        "period_join": _over("flows", """WITH halves AS (
              SELECT src_addr, CAST(SUM(doctets) FILTER (first_us // 86400000000 % 2 = 0) AS BIGINT) AS before,
                CAST(SUM(doctets) FILTER (first_us // 86400000000 % 2 = 1) AS BIGINT) AS after FROM flows GROUP BY 1)
            SELECT * FROM halves"""),
        "text_roundtrip": _over("flows", _FLOW_FIELDS),
        "flow_periods": _over("flows", _PERIODS.split(" SELECT ds, ts, '")[0] + """
            SELECT 'backbone' AS area, ds, ts, COUNT(*) AS flows, CAST(SUM(doctets) AS BIGINT) AS octets,
              CAST(SUM(dpkts) AS BIGINT) AS pkts FROM dated GROUP BY ds, ts"""),
        "stream_periods": _over("flows", _PERIODS),
        "stream_captures": _over("flows", _FLOWSTATS),
        "monitor_findings": _over("flows", _PERIODS.split(" SELECT ds, ts, '")[0] + f""",
            registry AS ({check_text('registry')})
            SELECT 'scan' AS kind, ds, ts, src_addr, dst_addr, COUNT(DISTINCT dst_port) AS n FROM dated
              GROUP BY ds, ts, src_addr, dst_addr HAVING COUNT(DISTINCT dst_port) > {q.SCAN_PORTS}
            UNION ALL
            SELECT 'spoof', ds, ts, src_addr, dst_addr, COUNT(*) FROM dated LEFT JOIN registry ON src_addr = prefix
              WHERE prefix IS NULL OR asn <> src_as GROUP BY ds, ts, src_addr, dst_addr
            UNION ALL
            SELECT 'volume', ds, ts, NULL, NULL, CAST(SUM(doctets) AS BIGINT) FROM dated GROUP BY ds, ts"""),
        "stream_rate": _over("packets", _RATE),
        "stream_usage": _over("usage_samples", _USAGE),
        "stream_detect": _detect(q.PATTERN_RULES),
        "stream_detect_state": _detect(q.PATTERN_RULES),
    }

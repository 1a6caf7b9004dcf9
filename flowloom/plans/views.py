"""Input views over the given Parquet tables.

Each view is one SQL text with two tokens, so that Spark and a checking engine
build the same rows: ``{us:COL}`` is the microseconds of a timestamp column and
``{div}`` is integer division.  A view has a row for every row of its table
(``http_log`` for every page event); suppliers that are not to be found as a
source get an unused network, attempts that never finish end as killed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "packets": ("events", """
        SELECT event_id AS pkt_id,
          CAST(1704067200000000 + ({us:ts} - 1704067200000000) {div} 10000 AS BIGINT) AS ts_us,
          CASE WHEN event_id % 23 = 0 THEN 34525 WHEN event_id % 29 = 0 THEN 2054 ELSE 2048 END AS eth_type,
          CAST(167772160 + user_id AS BIGINT) AS src_addr,
          CAST(3232235520 + event_id % 4 AS BIGINT) AS dst_addr,
          CAST(1024 + user_id % 8 AS INT) AS src_port,
          CASE event_type WHEN 'click' THEN 80 WHEN 'view' THEN 443 WHEN 'purchase' THEN 25
                          WHEN 'signup' THEN 53 ELSE 0 END AS dst_port,
          CASE event_type WHEN 'signup' THEN 17 WHEN 'error' THEN 1 ELSE 6 END AS proto,
          CAST(40 + CAST(FLOOR(value * 10) AS BIGINT) % 1461 AS INT) AS ip_len,
          CAST(CAST(FLOOR(value * 10) AS BIGINT) % 1461 AS INT) AS payload_len,
          CASE WHEN event_type = 'click' AND event_id % 3 = 0 THEN 'GET /index HTTP/1.1' ELSE 'data' END AS payload
        FROM events"""),
    # Sixteen TCP connections: three data packets of the client, some sent again or swapped, then an ACK of the
    # server, which for the second half of 32 packets stays the same; numbers wrap after 40 packets.
    "segments": ("events", """
        SELECT event_id AS pkt_id, CAST(1704067200000000 + event_id * 1000 + user_id % 700 AS BIGINT) AS ts_us,
          2048 AS eth_type, 6 AS proto,
          CAST(CASE WHEN back THEN 3232235520 + conn % 4 ELSE 167772160 + conn END AS BIGINT) AS src_addr,
          CAST(CASE WHEN back THEN 167772160 + conn ELSE 3232235520 + conn % 4 END AS BIGINT) AS dst_addr,
          CAST(CASE WHEN back THEN 443 ELSE 1024 + conn END AS INT) AS src_port,
          CAST(CASE WHEN back THEN 1024 + conn ELSE 443 END AS INT) AS dst_port,
          CAST(CASE WHEN back THEN 40 ELSE 1040 END AS INT) AS ip_len,
          CAST(CASE WHEN back THEN 0 ELSE 1000 END AS INT) AS payload_len, '' AS payload,
          CAST((CASE WHEN back THEN 77 ELSE 4294927296 + place * 1000 END) % 4294967296 AS BIGINT) AS tcp_seq,
          CAST((CASE WHEN back THEN 4294927296 + acked * 1000 ELSE 77 END) % 4294967296 AS BIGINT) AS tcp_ack,
          CAST(CASE WHEN nth = 0 THEN 2 WHEN event_id % 997 = 0 THEN 20 WHEN event_id % 499 = 0 THEN 17
                    WHEN back THEN 16 ELSE 24 END AS INT) AS tcp_flags,
          CAST(CASE WHEN event_id % 211 = 0 THEN 0 ELSE 4096 + nth {div} 64 END AS INT) AS "window",
          CAST(64 - user_id % 9 AS INT) AS ttl
        FROM (SELECT *, nth % 4 = 3 AS back,
                CASE WHEN nth % 28 = 5 THEN nth - 1 WHEN nth % 44 = 9 THEN nth + 1 WHEN nth % 44 = 10 THEN nth - 1
                     ELSE nth END AS place,
                CASE WHEN nth % 32 >= 19 THEN nth - nth % 32 + 19 ELSE nth END AS acked
              FROM (SELECT *, event_id % 16 AS conn, event_id {div} 16 AS nth FROM events)) AS numbered"""),
    "flows": ("lineitem", """
        SELECT CAST(167772160 + l_suppkey AS BIGINT) AS src_addr,
          CAST(3232235520 + l_partkey % 50 AS BIGINT) AS dst_addr,
          CAST(1024 + l_orderkey % 100 AS INT) AS src_port,
          CASE l_linenumber WHEN 1 THEN 80 WHEN 2 THEN 2001 WHEN 3 THEN 5900 WHEN 4 THEN 12345
                            WHEN 5 THEN 445 WHEN 6 THEN 4662 ELSE 13500 END AS dst_port,
          CASE l_returnflag WHEN 'A' THEN 6 WHEN 'N' THEN 17 ELSE 1 END AS prot,
          CAST(l_quantity AS BIGINT) AS dpkts,
          CAST(FLOOR(l_extendedprice) AS BIGINT) AS doctets,
          CASE WHEN l_linestatus = 'O' THEN 2 ELSE 18 END AS tcp_flags,
          CAST(CASE WHEN l_linenumber = 7 THEN 99 ELSE l_suppkey % 25 END AS INT) AS src_as,
          CAST(l_partkey % 64 AS INT) AS dst_as,
          CAST(24 + l_linenumber % 4 AS INT) AS src_mask, 24 AS dst_mask,
          CAST({us:l_shipdate} AS BIGINT) AS first_us
        FROM lineitem"""),
    "registry": ("supplier", """
        SELECT s_name AS organ, CAST(s_suppkey % 25 AS INT) AS asn,
          CAST(CASE WHEN s_suppkey % 5 = 0 THEN 184549376 ELSE 167772160 END + s_suppkey AS BIGINT) AS prefix,
          32 AS mask
        FROM supplier"""),
    "mixed_registry": ("supplier", """
        SELECT s_name AS organ, CAST(s_suppkey % 25 AS INT) AS asn,
          CAST(167772160 + s_suppkey * CASE WHEN s_suppkey % 4 = 0 THEN 64 ELSE 1 END AS BIGINT) AS prefix,
          CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 50 = 1 THEN 24 WHEN s_suppkey % 100 = 2 THEN 8
               WHEN s_suppkey % 4 = 0 THEN 28 WHEN s_suppkey % 4 = 1 THEN 30 ELSE 32 END AS mask
        FROM supplier"""),
    "traceroute": ("orders", """
        SELECT concat_ws('|', 'a','b','c','d', CAST(o_custkey % 20 AS VARCHAR(20)), 'f','g','h','i','j',
          CASE WHEN o_orderkey % 17 = 0 THEN '0.0.0.0' ELSE '10.1.1.1' END, 'l',
          CAST(o_custkey % 30 AS VARCHAR(20)), 'n',
          CASE WHEN o_orderkey % 13 = 0 THEN NULL
               ELSE CAST(CAST(FLOOR(o_totalprice / 100) AS BIGINT) AS VARCHAR(20)) END) AS line
        FROM orders"""),
    "history": ("events", """
        SELECT concat('{"type":"', CASE WHEN event_id % 2 = 0 THEN 'MAP_ATTEMPT_STARTED'
                                        WHEN event_id % 10 = 9 THEN 'MAP_ATTEMPT_KILLED'
                                        ELSE 'MAP_ATTEMPT_FINISHED' END,
          '","attemptId":"attempt_', CAST(event_id {div} 2 AS VARCHAR(20)), '","time_ms":',
          CAST({us:ts} {div} 1000 AS VARCHAR(20)), '}') AS line
        FROM events"""),
    "http_log": ("events", """
        SELECT CAST(167772160 + user_id AS BIGINT) AS src_addr,
          concat('http://h', CAST(event_id % 20 AS VARCHAR(20)), '.example/') AS url, {us:ts} AS ts_us
        FROM events"""),
    "usage_samples": ("events", """
        SELECT {us:ts} {div} 1000000 AS ts_s, CAST(FLOOR(value) AS BIGINT) AS capacity,
          user_id % 40 AS containers
        FROM events"""),
    "uploads": ("orders", """
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'PUBLIC CLOUD' ELSE 'LOCAL DATA CENTER' END AS site,
          concat('dump_', CAST(o_orderkey AS VARCHAR(20)), '.pcap') AS file,
          CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS size_mb,
          CAST(1 + o_custkey % 90 AS BIGINT) AS duration_s,
          CAST({us:o_orderdate} {div} 1000000 AS BIGINT) AS start_s,
          CAST({us:o_orderdate} {div} 1000000 + 1 + o_custkey % 90 AS BIGINT) AS end_s
        FROM orders"""),
}


def _render(text: str, us: str, div: str) -> str:
    text = re.sub(r"\{us:(\w+)\}", lambda m: us.format(m.group(1)), text)
    return text.replace("{div}", div)


def spark_text(name: str) -> str:
    """View text for Spark; independent of the session time zone."""
    return _render(
        VIEWS[name][1].replace('"window"', "`window`"), "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {})", "DIV"
    )


def check_text(name: str) -> str:
    """View text for the checking engine."""
    return _render(VIEWS[name][1], "epoch_us({})", "//")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over one of the given tables, as a DataFrame."""
    return view_over(table(spark, sf_dir, VIEWS[name][0]), name)


def view_over(source: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The view ``name`` over a given batch or streaming table, with table columns to ``keep``."""
    text = spark_text(name).replace("{", "{{").replace("}", "}}")
    text = text.replace(f"FROM {VIEWS[name][0]}", "FROM {source}")
    if keep:
        text = text.replace("SELECT ", f"SELECT {', '.join(keep)}, ", 1)
    return source.sparkSession.sql(text, source=source)

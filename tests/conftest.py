import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from flowloom.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session("4", 4, **{
        "spark.checkpoint.dir": str(folder),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


def packet_rows(spark, rows):
    """Packets from (pkt_id, ts_us, src, dst, sport, dport, proto, ip_len, payload_len, payload[, eth_type])."""
    schema = ("pkt_id long, ts_us long, src_addr long, dst_addr long, src_port int, dst_port int, "
              "proto int, ip_len int, payload_len int, payload string, eth_type int")
    return spark.createDataFrame([r if len(r) == 11 else (*r, 2048) for r in rows], schema)


def flow_rows(spark, rows):
    """Flows from dicts; columns that are not given get plain values."""
    base = dict(src_addr=1, dst_addr=2, src_port=1000, dst_port=80, prot=6, dpkts=1, doctets=100,
                tcp_flags=2, src_as=1, dst_as=2, src_mask=24, dst_mask=24, first_us=0)
    schema = ("src_addr long, dst_addr long, src_port int, dst_port int, prot int, dpkts long, doctets long, "
              "tcp_flags int, src_as int, dst_as int, src_mask int, dst_mask int, first_us long")
    return spark.createDataFrame([tuple((base | row).values()) for row in rows], schema)

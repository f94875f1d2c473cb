"""Truth tables of the rule classification and the labels."""

from __future__ import annotations

import pytest

from perimeter.functions import scalars

COLUMNS = (
    "name string, source string, protocol string, has_tcp boolean, tcp_port_min bigint, "
    "tcp_port_max bigint, udp_port_min bigint, udp_port_max bigint, direction string"
)
ANY = "0.0.0.0/0"

# name, source, protocol, has_tcp, tcp range, udp range -> case, other, service
RULES = [
    ("all", ANY, "all", False, (None, None), (None, None), "ALL", False, "ALL_PORTS"),
    ("all with ports", ANY, "all", True, (80, 80), (None, None), "ALL", False, "80"),
    ("tcp without options", ANY, "6", False, (None, None), (None, None), "ALL", False, "ALL_PORTS"),
    ("ssh", ANY, "6", True, (22, 22), (None, None), "22", False, "22"),
    ("ssh in range", ANY, "6", True, (20, 25), (None, None), "22", False, "20-25"),
    ("both ports", ANY, "6", True, (20, 4000), (None, None), "22", False, "20-4000"),
    ("rdp", ANY, "6", True, (3389, 3389), (None, None), "3389", False, "3389"),
    ("web", ANY, "6", True, (443, 443), (None, None), None, True, "443"),
    ("no range", ANY, "6", True, (None, None), (None, None), None, True, "ALL_PORTS"),
    ("only min", ANY, "6", True, (22, None), (None, None), None, True, "ALL_PORTS"),
    ("only max", ANY, "6", True, (None, 22), (None, None), None, True, "ALL_PORTS"),
    ("udp", ANY, "17", False, (None, None), (53, 53), None, True, "53"),
    ("udp with tcp ports", ANY, "17", True, (22, 22), (53, 54), None, True, "53-54"),
    ("udp without ports", ANY, "17", True, (22, 22), (None, None), None, True, "ALL_PORTS"),
    ("icmp", ANY, "1", False, (None, None), (None, None), None, True, "ALL_PORTS"),
    ("no protocol", ANY, None, False, (None, None), (None, None), None, None, "ALL_PORTS"),
    ("no protocol, ssh", ANY, None, True, (22, 22), (None, None), None, None, "22"),
    ("ipv6 any", "::/0", "all", False, (None, None), (None, None), None, False, "ALL_PORTS"),
    ("network", "10.0.0.0/8", "6", True, (22, 22), (None, None), None, False, "22"),
    ("no source", None, "6", True, (443, 443), (None, None), None, None, "443"),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(n, s, p, t, *tcp, *udp, "INGRESS") for n, s, p, t, tcp, udp, *_ in RULES]
    df = spark.createDataFrame(rows, COLUMNS).select(
        "name",
        scalars.insecure_case().alias("sl_case"),
        scalars.insecure_case(direction="direction").alias("nsg_case"),
        scalars.is_other().alias("sl_other"),
        scalars.is_other(direction="direction").alias("nsg_other"),
        scalars.service_label().alias("service"),
    )
    return {r["name"]: r for r in df.collect()}


@pytest.mark.parametrize("rule", RULES, ids=[r[0] for r in RULES])
def test_classification(classified, rule):
    name, *_, case, other, service = rule
    found = classified[name]
    assert (found.sl_case, found.nsg_case) == (case, case)
    assert (found.sl_other, found.nsg_other) == (other, other)
    assert found.service == service


def test_open_rules_are_insecure_or_other(classified):
    for name, source, protocol, *_ in RULES:
        if source == ANY and protocol is not None:
            found = classified[name]
            assert (found.sl_case is not None) != found.sl_other


def test_egress_is_neither(spark):
    row = (spark.createDataFrame([("e", ANY, "all", False, *[None] * 4, "EGRESS")], COLUMNS)).select(
        scalars.insecure_case(direction="direction"), scalars.is_other(direction="direction")
    )
    assert tuple(row.first()) == (None, False)


def test_protocol_labels(spark):
    values = [("6",), ("17",), ("all",), ("1",), (None,)]
    df = spark.createDataFrame(values, "protocol string").select(
        scalars.protocol_label(), scalars.protocol_label(upper_all=True)
    )
    assert [tuple(r) for r in df.collect()] == [
        ("TCP", "TCP"),
        ("UDP", "UDP"),
        ("all", "ALL"),
        ("1", "1"),
        (None, None),
    ]


def test_port_text(spark):
    values = [("22",), ("22.0",), ("x",), ("",), (None,)]
    df = spark.createDataFrame(values, "value string").selectExpr(scalars.port("value"))
    assert [r[0] for r in df.collect()] == [22, 22, None, None, None]


def test_text_is_null_only_when_empty(spark):
    values = [("abc",), ("x" * 100_000,), ("",), (None,)]
    df = spark.createDataFrame(values, "value string").selectExpr(scalars.text("value"))
    assert [r[0] for r in df.collect()] == ["abc", "x" * 100_000, None, None]


def test_vcn_name(spark):
    values = [("s.vcn1.oraclevcn.com",), ("s.vcn1.example.com",), ("oraclevcn.com",), (None,)]
    df = spark.createDataFrame(values, "domain_name string")
    intended = df.select(scalars.vcn_name())
    assert [r[0] for r in intended.collect()] == ["vcn1", None, None, None]
    doubled = df.select(scalars.vcn_name(pattern=r"\\.([^.]+)\\.oraclevcn\\.com$"))
    assert [r[0] for r in doubled.collect()] == [None] * 4

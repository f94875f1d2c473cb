"""The exposure lattice against the eight reports, and how often it reads the interfaces."""

from __future__ import annotations

import json
import re
from collections import Counter

import pytest

from perimeter import constants as K
from perimeter.plans import lattice, reports
from perimeter.schemas import document_schema
from perimeter.sources.inventory import Inventory
from perimeter.testbed.workspace import workspace

SF_DIR = "/root/testdata/sf0.001"
CASES = [(scope, kind, table) for scope in lattice.SCOPES for kind in lattice.KINDS for table in ("vnics", "subnets")]


def scans(frame, table: str) -> int:
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(rf"Relation \[{table}#", text))


@pytest.fixture(scope="module")
def stored(spark):
    return workspace(spark, SF_DIR)


@pytest.mark.parametrize(("scope", "kind", "table"), CASES)
def test_equal_to_the_reports(stored, scope, kind, table):
    found = getattr(stored.lattice, f"exposed_{table}")(scope, kind)
    expected = reports.SCOPED_REPORTS[f"{kind}_{table}"](stored.inventory, scope)
    assert found.columns == expected.columns
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in expected.collect()]


def test_interfaces_are_read_once(stored):
    vnics = lattice.vnic_lattice(stored.inventory)
    assert scans(vnics, "vnic_id") == 1
    subnets = lattice.subnet_lattice(stored.inventory, stored.lattice.vnics)
    assert scans(subnets, "vnic_id") == 1  # the written rows
    files = subnets.inputFiles()
    assert any("/lattice/vnics/" in f for f in files) and not any("/tables/vnics/" in f for f in files)


def test_reports_join_nothing(stored):
    for scope, kind, table in CASES:
        found = getattr(stored.lattice, f"exposed_{table}")(scope, kind, ordered=False)
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in text and "Exchange" not in text


@pytest.fixture(scope="module")
def odd(spark):
    """Ids in several subnets, repeated and missing ids, subnets of both scopes under one id."""

    def rows(name, schema, *values):
        frame = spark.createDataFrame(list(values), schema)
        missing = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in document_schema(name) if f.name not in frame.columns]
        return frame.selectExpr("*", *missing)

    rule = {"source": "0.0.0.0/0", "protocol": "all"}
    other = {"source": "0.0.0.0/0", "protocol": "6", "tcpOptions": {"destinationPortRange": {"min": "443", "max": "443"}}}
    subnet = "identifier string, additional_details struct<routeTableId:string,prohibitPublicIpOnVnic:string,securityListIds:string,vcnId:string,subnetDomainName:string>"
    vnic = "identifier string, additional_details struct<subnetId:string,privateIp:string,publicIp:string>"
    listed = "identifier string, additional_details struct<vcnId:string,ingressSecurityRules:string>"
    documents = {
        "routes": rows("routes", "identifier string, additional_details struct<routeRules:string>", ("rt", (json.dumps([{"networkEntityId": "internetgateway-1"}]),)), ("nat", ("[]",))),
        "subnets": rows(
            "subnets", subnet,
            ("s1", ("rt", "false", '["sl1","sl2"]', None, None)), ("s1", ("nat", "false", '["sl2"]', None, None)),
            ("s2", ("nat", None, '["sl1"]', None, None)), ("s3", ("rt", "false", "[]", None, None)), (None, ("rt", "false", '["sl1"]', None, None)),
            ("s4", ("rt", None, '["sl1"]', None, None)),
        ),
        "securitylists": rows("securitylists", listed, ("sl1", (None, json.dumps([rule]))), ("sl2", (None, json.dumps([other, other]))), (None, (None, json.dumps([rule])))),
        "vnics": rows(
            "vnics", vnic,
            ("v1", ("s1", "1", None)), ("v1", ("s2", "2", None)), ("v1", ("s2", "2", None)), ("v2", ("s3", None, None)), ("v3", ("s3", None, "9")),
            (None, ("s1", None, None)), ("v4", (None, None, None)), ("v5", ("s4", None, None)), ("v6", ("absent", None, None)), ("v7", ("s1", None, None)), ("v7", ("s3", None, None)),
        ),
        "nsgdata": rows("nsgdata", "identifier string"),
        "nsgrules": rows("nsgrules", "`nsg-id` string, id string, direction string, source string, protocol string", ("g1", "r1", "INGRESS", "0.0.0.0/0", "all"), ("g2", "r2", "INGRESS", "0.0.0.0/0", "1"), (None, "r3", "INGRESS", "0.0.0.0/0", "all")),
        "nsgvnic": rows("nsgvnic", "`nsg-id` string, vnic_id string", ("g1", "v2"), ("g1", "v2"), ("g2", "v3"), ("g2", "v1"), (None, "v4"), ("g1", None), ("g1", "v6"), ("g1", "v4")),
        "privateips": rows("privateips", "id string"),
        "publicips": rows("publicips", "id string"),
    }
    return Inventory.from_documents({name: documents[name] for name in K.COLLECTIONS})


def test_odd_rows_against_the_reports(odd, tmp_path):
    found = lattice.Lattice.store(odd, str(tmp_path / "lattice"))
    seen = 0
    for scope, kind, table in CASES:
        rows = Counter(map(tuple, getattr(found, f"exposed_{table}")(scope, kind).collect()))
        expected = Counter(map(tuple, reports.SCOPED_REPORTS[f"{kind}_{table}"](odd, scope).collect()))
        assert rows == expected, (scope, kind, table)
        seen += rows.total()
    assert seen > 12


def test_unknown_scope_or_kind(stored):
    with pytest.raises(ValueError, match="no exposure"):
        stored.lattice.exposed_vnics("both", "insecure")
    with pytest.raises(ValueError, match="no exposure"):
        stored.lattice.exposed_subnets("public", "all")

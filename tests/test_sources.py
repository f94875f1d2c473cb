"""Reading, consolidating, tagging, auditing and writing documents."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException

from perimeter import Inventory
from perimeter.constants import COLLECTIONS
from perimeter.operators import attachments, rules, scope
from perimeter.sources import audit, children, documents, regions


def put(path, *docs, raw=()):
    lines = [json.dumps(d, ensure_ascii=False) for d in docs] + list(raw)
    path.write_text("".join(line + "\n" for line in lines), encoding="utf-8")


@pytest.fixture
def consolidated(tmp_path):
    put(
        tmp_path / "securitylists.jsonl",
        {
            "identifier": "sl-1",
            "additional_details": {
                "ingressSecurityRules": [
                    {"source": "0.0.0.0/0", "protocol": "6", "tcpOptions": None},
                    {"source": "0.0.0.0/0", "protocol": "6"},
                    {"source": "0.0.0.0/0", "protocol": "6", "tcpOptions": {}},
                    {
                        "source": "0.0.0.0/0",
                        "protocol": "6",
                        "tcpOptions": {"destinationPortRange": {"min": "22", "max": 22.0}},
                    },
                ]
            },
        },
        # one object instead of a list: a list of one
        {"identifier": "sl-2", "additional_details": {"ingressSecurityRules": {"source": "x"}}},
        {"identifier": "sl-3", "additional_details": {"ingressSecurityRules": []}},
        {"identifier": "sl-4"},
        raw=["", '{"identifier": "sl-5", "additional', "   "],
    )
    put(
        tmp_path / "subnets.jsonl",
        {
            "identifier": "subnet-1",
            "display_name": "x" * 201,
            "additional_details": {
                "routeTableId": "rt-1",
                "prohibitPublicIpOnVnic": False,
                "securityListIds": ["sl-1", "", None],
            },
        },
        {"identifier": "subnet-2", "additional_details": {"routeTableId": "rt-1"}},
        {"identifier": "subnet-3", "additional_details": {"routeTableId": "rt-none"}},
        {
            "identifier": "subnet-4",
            "additional_details": {"routeTableId": "rt-2", "prohibitPublicIpOnVnic": False},
        },
    )
    put(
        tmp_path / "routes.jsonl",
        {
            "identifier": "rt-1",
            "additional_details": {"routeRules": [{"networkEntityId": "a.internetgateway.b"}]},
        },
        {
            "identifier": "rt-2",
            "additional_details": {"routeRules": [{"networkEntityId": "InternetGateway"}]},
        },
    )
    put(
        tmp_path / "privateips.jsonl",
        {"id": "", "identifier": "pip-1", "vnic_id": "", "vnic-id": "v-1", "ipAddress": "10.0.0.1"},
    )
    return str(tmp_path)


@pytest.fixture
def inventory(spark, consolidated):
    return Inventory.from_jsonl(spark, consolidated, allow_missing=True)


def test_rules_keep_their_place_and_options(inventory):
    found = rules.sl_rule_cases(inventory.securitylists).orderBy("securitylist_id", "rule_no").collect()
    assert [(r.rule_no, r.has_tcp, r.insecure_case) for r in found] == [
        (1, False, "ALL"),
        (2, False, "ALL"),
        (3, True, None),
        (4, True, "22"),
        (1, False, None),
    ]


def test_unreadable_and_blank_lines_are_left_out(inventory):
    ids = {r[0] for r in inventory.securitylists.select("securitylist_id").collect()}
    assert ids == {"sl-1", "sl-2", "sl-3", "sl-4"}


def test_missing_file_raises_or_is_an_empty_collection(spark, inventory, consolidated, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        Inventory.from_jsonl(spark, consolidated)
    with pytest.raises(Exception, match="FileNotFound"):
        Inventory.from_regional_jsonl(spark, str(tmp_path / "absent"), "ten")
    with pytest.raises(FileNotFoundError, match="nsgdata"):
        Inventory.from_regional_jsonl(spark, consolidated, "ten", "r-1")
    assert inventory.vnics.count() == 0
    assert inventory.vnics.columns[:3] == ["vnic_id", "vnic_name", "subnet_id"]


def test_scopes(inventory):
    def ids(name):
        found = scope.scope_subnets(inventory.subnets, inventory.routes, name)
        return {r.subnet_id for r in found.collect()}

    # subnet-2 routes to a gateway without a flag: in neither scope
    assert ids("public") == {"subnet-1"}
    assert ids("private") == {"subnet-3", "subnet-4"}
    with pytest.raises(ValueError, match="scope"):
        ids("both")


def test_long_text_and_empty_ids(inventory):
    first = inventory.subnets.where("subnet_id = 'subnet-1'").first()
    assert first.subnet_name == "x" * 201
    pairs = attachments.subnet_sl(inventory.subnets).collect()
    assert [tuple(p) for p in pairs] == [
        ("subnet-1", "sl-1"),
        ("subnet-1", None),
        ("subnet-1", None),
    ]


def test_alternate_keys_skip_empty_text(inventory):
    assert tuple(inventory.privateips.first())[:3] == ("pip-1", "v-1", "10.0.0.1")


def test_store_and_open_give_the_same_tables(spark, inventory, tmp_path, monkeypatch):
    path = str(tmp_path / "tables")
    monkeypatch.setattr(Inventory.profiled, "__defaults__", (2,))
    inventory.store(path)
    opened = Inventory.open(spark, path)
    assert opened.hot == inventory.profiled().hot
    assert opened.hot.splits
    for name, table in inventory.tables().items():
        again = getattr(opened, name)
        assert again.columns == table.columns
        assert sorted(map(str, again.collect())) == sorted(map(str, table.collect()))


@pytest.fixture
def exports(tmp_path):
    for region, subnets in {"r-1": ["s-1", "s-2"], "r-2": ["s-3"], "r-3": []}.items():
        for name in COLLECTIONS:
            docs = [{"identifier": s} for s in subnets] if name == "subnets" else []
            put(tmp_path / f"{name}-ten-{region}.jsonl", *docs)
    put(tmp_path / "subnets-other-r-1.jsonl", {"identifier": "s-9"})
    put(tmp_path / "vnics-ten-r-2.jsonl", {"identifier": "v-1"}, raw=["{", '{"identifier": "v-2'])
    return str(tmp_path)


def test_consolidation_tags_regions(spark, exports):
    found = regions.consolidate_regions(spark, exports, "ten")["subnets"]
    assert {(r.region, r.identifier) for r in found.collect()} == {
        ("r-1", "s-1"),
        ("r-1", "s-2"),
        ("r-2", "s-3"),
    }


def test_region_selection(spark, exports):
    def chosen(include=(), skip=None):
        found = regions.consolidate_regions(spark, exports, "ten", include, skip)["subnets"]
        return {r.identifier for r in found.collect()}

    assert chosen(skip="r-2") == {"s-1", "s-2"}
    assert chosen() == {"s-1", "s-2", "s-3"}
    assert chosen(" r-2 , ,r-3") == {"s-3"}
    assert chosen(["r-2"], skip="r-2") == set()
    rows = spark.createDataFrame([("r-1",), ("r-2",), (None,)], "region string")
    assert {r.region for r in regions.select_regions(rows, skip="r-2").collect()} == {"r-1", None}


def test_only_exact_file_names_are_read(spark, exports, tmp_path):
    put(tmp_path / "old-subnets-ten-r-1.jsonl", {"identifier": "old"})
    put(tmp_path / "subnets-ten-r-1.jsonl.bak", {"identifier": "backup"})
    assert regions.export_regions(spark, exports, "ten") == ["r-1", "r-2", "r-3"]
    put(tmp_path / "subnets-ten-x-r-1.jsonl", {"identifier": "other tenancy"})
    with pytest.raises(ValueError, match="x-r-1"):
        regions.consolidate_regions(spark, exports, "ten")
    found = regions.consolidate_regions(spark, exports, "ten", ["r-1", "r-2"])["subnets"]
    assert {(r.region, r.identifier) for r in found.collect()} == {("r-1", "s-1"), ("r-1", "s-2"), ("r-2", "s-3")}


def test_parts_of_documents_that_are_lost_show(spark, exports, tmp_path):
    open_rule = {"source": "0.0.0.0/0", "protocol": "6"}
    bad = [
        {"identifier": "sl-1", "additional_details": {"ingressSecurityRules": [open_rule, 5, {"source": ["x"]}, "{"]}},
        {"identifier": "sl-2", "display_name": {"a": 1}, "additional_details": "text"},
        {"identifier": "sl-3", "additional_details": {"ingressSecurityRules": [open_rule]}},
    ]
    second = '{"identifier": "sl-4"} {"identifier": "sl-5"}'
    put(tmp_path / "securitylists-ten-r-1.jsonl", *bad, raw=[second, '{"identifier": "sl-6"}, {}'])
    lists = Inventory.from_regional_jsonl(spark, exports, "ten").securitylists
    cases = rules.sl_rule_cases(lists).where("securitylist_id = 'sl-1'").orderBy("rule_no").collect()
    assert [r.insecure_case for r in cases] == ["ALL", None, None, None]
    assert lists.count() == 5
    found = audit.load_audit(spark, exports, "ten", ["r-1"])
    row = found.where("collection = 'securitylists'").first()
    assert (row.status, row.documents, row.unreadable_lines) == ("PARTIAL_DOCUMENTS", 5, 0)
    assert row.partial_documents == 4
    with pytest.raises(ValueError, match="r-1 securitylists: PARTIAL_DOCUMENTS"):
        audit.require_complete(found.where("collection IN ('subnets', 'securitylists')"))


def test_lines_are_copied_verbatim(spark, exports, tmp_path):
    target = str(tmp_path / "all")
    regions.consolidate_lines(spark, exports, target, "ten")
    lines = {r.value for r in spark.read.text(f"{target}/vnics.jsonl").collect()}
    assert lines == {'{"identifier": "v-1"}', "{", '{"identifier": "v-2'}
    loaded = documents.load_collections(spark, target)
    assert loaded["subnets"].count() == 3
    assert loaded["vnics"].count() == 1


def test_counts_leave_failed_regions_out(spark, exports):
    found = audit.collection_counts(spark, exports, "ten", ["r-1", "r-2", "r-3"], ["r-1"])
    counts = {(r.region, r.collection): r.documents for r in found.collect()}
    assert counts["r-2", "subnets"] == counts[None, "subnets"] == 1
    assert counts["r-3", "subnets"] == counts[None, "routes"] == 0
    assert not any(region == "r-1" for region, _ in counts)
    assert len(counts) == 3 * len(COLLECTIONS)


def test_audit_reports_what_is_wrong(spark, exports):
    found = audit.load_audit(spark, exports, "ten", ["r-1", "r-2", "r-9"], ["r-1"])
    rows = {(r.region, r.collection): r for r in found.collect()}
    assert rows["r-1", "subnets"].status == "FAILED_REGION"
    assert rows["r-1", "subnets"].documents == 2
    assert rows["r-2", "vnics"].status == "UNREADABLE_LINES"
    assert (rows["r-2", "vnics"].documents, rows["r-2", "vnics"].unreadable_lines) == (1, 2)
    assert rows["r-2", "subnets"].status == "OK"
    assert rows["r-2", "routes"].status == rows["r-9", "routes"].status == "NO_RECORDS"


def test_parents_and_tags(spark):
    hits = spark.createDataFrame([("a",), ("",), (None,), ("a",), ("b",)], "identifier string")
    assert {r[0] for r in children.dedupe_public_ip_ids(hits).collect()} == {"a", "b"}
    assert children.dedupe_subnet_ids(hits).count() == 2
    tagged = children.tag_parent(hits.limit(1), region="r-1", nsg_id="nsg-1")
    assert tagged.columns == ["identifier", "region", "nsg-id"]
    assert tuple(tagged.first()) == ("a", "r-1", "nsg-1")


def test_json_lines_keep_nulls_and_characters(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("é 日本", None)], "name string, options string")
    documents.write_jsonl(df, path)
    documents.write_jsonl(df.limit(0), path)
    documents.write_jsonl(df, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ['{"name":"é 日本","options":null}'] * 2

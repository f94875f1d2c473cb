"""Reports on group rules: the rules of a group travel together and are taken apart after the sort."""

from __future__ import annotations

import pytest

from perimeter import Inventory
from perimeter.operators.skew import HotKeys
from perimeter.plans import reports
from perimeter.sources.tables import typed


@pytest.fixture(scope="module")
def inventory(spark) -> Inventory:
    """Groups of many rules, rule ids that repeat or are missing, an interface with two documents."""
    rows = {
        "routes": ['{"identifier":"rt","additional_details":{"routeRules":[{"networkEntityId":"internetgateway"}]}}'],
        "subnets": [
            f'{{"identifier":"s{n}","display_name":"{name}","additional_details":{{"routeTableId":"rt","prohibitPublicIpOnVnic":false}}}}'
            for n, name in ((1, "a"), (1, "b"), (2, "c"))
        ],
        "vnics": [
            f'{{"identifier":"v{n}","display_name":"{name}","additional_details":{{"subnetId":"s{s}"}}}}'
            for n, name, s in ((1, "x", 2), (2, "y", 2), (2, "z", 2), (3, "w", 1))
        ],
        "nsgvnic": [f'{{"nsg-id":"g{g}","vnic_id":"v{v}"}}' for g in (1, 2) for v in (1, 2, 3)],
        "nsgrules": [
            f'{{"nsg-id":"g{g}","id":{i},"direction":"INGRESS","source":"0.0.0.0/0","protocol":"{p}"}}'
            for g, n in ((1, 3 * reports.RULES_PER_ROW), (2, 2))
            for p in ("all", "1", "17")
            for i in (*(f'"r{k}"' for k in range(n)), '"r1"', "null")
        ],
        "securitylists": [], "nsgdata": [], "privateips": [], "publicips": [],
    }
    from pyspark.sql import functions as F

    from perimeter.schemas import document_schema

    def documents(name: str):
        lines = spark.createDataFrame([(line,) for line in rows[name]], "value string")
        return lines.select(F.from_json("value", document_schema(name)).alias("d")).select("d.*")

    return Inventory(**{name: typed(name, documents(name)) for name in rows})


def _key(row) -> list:
    return [(v is None, v) for v in row]


@pytest.mark.parametrize("hot", [{}, {"nsgrules.nsg_id": {"g1": 3}, "vnics.vnic_id": {"v2": 2}, "nsgvnic.nsg_id": {"g1": 2}}])
@pytest.mark.parametrize(("name", "rule"), [("insecure_nsg", ["insecure_rule_id", "insecure_case"]), ("other_nsg", ["rule_id"])])
def test_rows_come_whole_and_in_their_order(inventory, name, rule, hot):
    from dataclasses import replace

    found = getattr(reports, name)(replace(inventory, hot=HotKeys(hot)), "public")
    plain = getattr(reports, name)(inventory, "public", ordered=False)
    assert found.columns == plain.columns
    first = ["vnic_id", "nsg_id", *rule]
    order = [*first, *(c for c in found.columns if c not in first)]
    rows = [tuple(r[c] for c in order) for r in found.collect()]
    assert rows == sorted((tuple(r[c] for c in order) for r in plain.collect()), key=_key)
    # Distinct rules of both groups at five rows of interfaces.
    kinds = {"insecure_nsg": 1, "other_nsg": 2}[name]
    assert len(rows) == len(set(rows)) == 5 * kinds * (3 * reports.RULES_PER_ROW + 1 + 2 + 1)


def test_rules_of_a_group_are_sorted_together(inventory):
    plan = reports.other_nsg(inventory, "public")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("inline(rules") < plan.index("rangepartitioning(")

"""Reports on random small inventories against nested loops.

The inventories hold what large ones may: copies of documents, several
documents under one id, missing ids, and keys that hold a third of the rows.
Every report runs plainly and with all keys treated as hot.
"""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from brute import Brute

from perimeter import Inventory
from perimeter.plans import reports

COLLECTIONS = (
    "routes subnets securitylists vnics nsgdata nsgrules nsgvnic privateips publicips"
).split()


class Maker:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def id(self, prefix: str, n: int):
        """One key is hot, some are missing or empty."""
        roll = self.r.random()
        if roll < 0.06:
            return self.r.choice([None, ""])
        return f"{prefix}-0" if roll < 0.35 else f"{prefix}-{self.r.randrange(n)}"

    def ports(self, camel: bool):
        key = "destinationPortRange" if camel else "destination_port_range"
        low = self.r.choice([1, 20, 22, 23, 443, 3000, 3389])
        bounds = {"min": low, "max": low + self.r.choice([0, 3, 400])}
        return self.r.choice(
            [
                None,
                {},
                {key: bounds},
                {key: {k: str(v) for k, v in bounds.items()}},
                {key: {"min": low}},
                {key: {"min": f"{low}.0", "max": "x"}},
            ]
        )

    def rule(self, camel: bool) -> dict:
        tcp, udp = ("tcpOptions", "udpOptions") if camel else ("tcp_options", "udp_options")
        found = {
            "source": self.r.choice(["0.0.0.0/0", "0.0.0.0/0", "0.0.0.0/0", "::/0", "10.0.0.0/8"]),
            "protocol": self.r.choice(["all", "6", "6", "6", "17", "1", None]),
            tcp: self.ports(camel),
            udp: self.ports(camel),
        }
        if self.r.random() < 0.3:
            del found[tcp]
        return found

    def copies(self, docs: list[dict]) -> list[dict]:
        docs = docs + [self.r.choice(docs) for _ in range(len(docs) // 4)]
        self.r.shuffle(docs)
        return docs

    def documents(self) -> dict[str, list[dict]]:
        r = self.r
        made = {
            "routes": [
                {
                    "identifier": self.id("rt", 6),
                    "additional_details": {
                        "routeRules": [
                            {"networkEntityId": r.choice(["internetgateway.1", "natgateway.1"])}
                            for _ in range(r.randrange(3))
                        ]
                    },
                }
                for _ in range(6)
            ],
            "subnets": [
                {
                    "identifier": self.id("subnet", 8),
                    "display_name": r.choice(["a", "b", None]),
                    "additional_details": {
                        "routeTableId": self.id("rt", 6),
                        "prohibitPublicIpOnVnic": r.choice([True, False, False, None]),
                        "securityListIds": r.choice(
                            [None, [], *([self.id("sl", 8) for _ in range(3)] for _ in range(4))]
                        ),
                    },
                }
                for _ in range(14)
            ],
            "securitylists": [
                {
                    "identifier": self.id("sl", 8),
                    "display_name": r.choice(["x", "y", None]),
                    "additional_details": {
                        "ingressSecurityRules": [self.rule(True) for _ in range(r.randrange(5))]
                    },
                }
                for _ in range(12)
            ],
            "vnics": [
                {
                    "identifier": self.id("vnic", 12),
                    "display_name": r.choice(["v", None]),
                    "additional_details": {
                        "subnetId": self.id("subnet", 8),
                        "privateIp": r.choice(["10.0.0.1", "10.0.0.2", ""]),
                        "publicIp": r.choice(["1.1.1.1", None]),
                    },
                }
                for _ in range(16)
            ],
            "nsgdata": [
                {
                    r.choice(["identifier", "id"]): self.id("nsg", 8),
                    "display_name": r.choice(["n", "m", None]),
                }
                for _ in range(9)
            ],
            "nsgrules": [
                {
                    "nsg-id": self.id("nsg", 8),
                    "id": f"rule-{n}",
                    "direction": r.choice(["INGRESS", "INGRESS", "EGRESS"]),
                    **self.rule(False),
                }
                for n in range(20)
            ],
            "nsgvnic": [
                {"nsg-id": self.id("nsg", 8), "vnic_id": self.id("vnic", 12)} for _ in range(16)
            ],
            "privateips": [
                {
                    r.choice(["id", "identifier"]): self.id("pip", 8),
                    r.choice(["vnic_id", "vnic-id", "vnicId"]): self.id("vnic", 12),
                    r.choice(["ip_address", "ipAddress"]): r.choice(["10.0.0.1", "10.0.0.2"]),
                }
                for _ in range(10)
            ],
            "publicips": [
                {
                    r.choice(["private_ip_id", "privateIpId"]): self.id("pip", 8),
                    r.choice(["ip_address", "ipAddress"]): r.choice(["1.1.1.1", "10.0.0.1"]),
                }
                for _ in range(5)
            ],
        }
        return {name: self.copies(docs) for name, docs in made.items()}


def rows(df, *columns) -> Counter:
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


LOOKUP = (
    "vnic_id vnic_name private_ip public_ip subnet_name subnet_id rule_source policy_name "
    "policy_id rule_id source_cidr protocol destination_service_port"
).split()


@pytest.fixture
def interpreted(spark):
    """Tiny data: compiling a plan would take longer than running it."""
    settings = {
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        "spark.sql.shuffle.partitions": "3",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize(("seed", "hot"), [(1, False), (2, True)])
def test_random_inventory(spark, interpreted, tmp_path, seed, hot):
    docs = Maker(seed).documents()
    for name in COLLECTIONS:
        lines = "\n".join(json.dumps(d) for d in docs[name])
        (tmp_path / f"{name}.jsonl").write_text(lines + "\n\n", encoding="utf-8")
    inventory = Inventory.from_jsonl(spark, str(tmp_path))
    if hot:
        inventory = inventory.profiled(rows_per_task=2)
        assert inventory.hot.on("subnet_sl.securitylist_id")
        assert inventory.hot.on("nsgvnic.nsg_id") and inventory.hot.on("nsgrules.nsg_id")
    brute = Brute(docs)

    for scope in ("public", "private"):
        for which in ("insecure", "other"):
            report = {
                name: getattr(reports, f"{which}_{name}")(inventory, scope, ordered=False)
                for name in ("sl", "nsg", "vnics", "subnets")
            }
            assert rows(report["sl"]) == Counter(brute.sl(scope, which))
            assert rows(report["nsg"]) == Counter(brute.nsg(scope, which))
            assert rows(report["vnics"]) == Counter(brute.exposed_vnics(scope, which))
            assert rows(report["subnets"]) == Counter(brute.exposed_subnets(scope, which))
        summary = {
            tuple(r)[:3]: r.total_occurrences
            for r in reports.service_summary(inventory, scope, ordered=False).collect()
        }
        assert summary == dict(brute.summary(scope))
    unused = reports.unused_sl(inventory)
    assert rows(unused, "securitylist_name", "securitylist_id", "cis_insecure_case") == (
        brute.unused_sl()
    )
    unused = reports.unused_nsg(inventory)
    assert rows(unused, "nsg_name", "nsg_id", "cis_insecure_case") == brute.unused_nsg()
    found = reports.lookup_vnic(inventory, "vnic-0")
    assert rows(found, *LOOKUP) == brute.lookup({"vnic-0"})
    found = reports.lookup_ip(inventory, "10.0.0.1")
    assert rows(found, *LOOKUP) == brute.lookup(brute.owners("10.0.0.1"))

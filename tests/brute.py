"""The reports by nested loops over a handful of documents."""

from __future__ import annotations

from collections import Counter

ANY = "0.0.0.0/0"


def empty_is_none(value):
    return value or None


def number(value):
    try:
        return int(float(value))
    except (TypeError, ValueError):
        return None


def rule(raw: dict, tcp_key: str, udp_key: str, range_key: str) -> dict:
    def bounds(options):
        found = (options or {}).get(range_key) or {}
        return number(found.get("min")), number(found.get("max"))

    low, high = bounds(raw.get(tcp_key))
    udp_low, udp_high = bounds(raw.get(udp_key))
    return {
        "source": empty_is_none(raw.get("source")),
        "protocol": empty_is_none(raw.get("protocol")),
        "has_tcp": raw.get(tcp_key) is not None,
        "tcp": (low, high),
        "udp": (udp_low, udp_high),
        "direction": raw.get("direction", "INGRESS"),
    }


def kind(r: dict) -> str | None:
    """ALL, 22 or 3389, ``other``, or None for rules that are neither."""
    if r["source"] != ANY or r["direction"] != "INGRESS" or r["protocol"] is None:
        return None
    if r["protocol"] == "all" or (r["protocol"] == "6" and not r["has_tcp"]):
        return "ALL"
    low, high = r["tcp"]
    if r["protocol"] == "6" and low is not None and high is not None:
        for wanted in (22, 3389):
            if low <= wanted <= high:
                return str(wanted)
    return "other"


def label(protocol, upper=False):
    names = {"6": "TCP", "17": "UDP", **({"all": "ALL"} if upper else {})}
    return names.get(protocol, protocol)


def service(r: dict) -> str:
    low, high = r["udp"] if r["protocol"] == "17" else r["tcp"]
    if low is None or high is None:
        return "ALL_PORTS"
    return str(low) if low == high else f"{low}-{high}"


class Brute:
    def __init__(self, docs: dict[str, list[dict]]) -> None:
        def details(d):
            return d.get("additional_details") or {}

        e = empty_is_none
        self.gateways = {
            e(d.get("identifier"))
            for d in docs["routes"]
            for r in details(d).get("routeRules") or []
            if "internetgateway" in (r.get("networkEntityId") or "")
        } - {None}
        self.subnets = [
            {
                "id": e(d.get("identifier")),
                "name": e(d.get("display_name")),
                "rt": e(details(d).get("routeTableId")),
                "flag": {True: "true", False: "false"}.get(
                    details(d).get("prohibitPublicIpOnVnic")
                ),
                "lists": [e(i) for i in details(d).get("securityListIds") or []],
            }
            for d in docs["subnets"]
        ]
        self.lists = [
            {
                "id": e(d.get("identifier")),
                "name": e(d.get("display_name")),
                "rules": [
                    rule(r, "tcpOptions", "udpOptions", "destinationPortRange")
                    for r in details(d).get("ingressSecurityRules") or []
                ],
            }
            for d in docs["securitylists"]
        ]
        self.vnics = [
            {
                "id": e(d.get("identifier")),
                "name": e(d.get("display_name")),
                "subnet": e(details(d).get("subnetId")),
                "private": e(details(d).get("privateIp")),
                "public": e(details(d).get("publicIp")),
            }
            for d in docs["vnics"]
        ]
        self.groups = [
            {"id": e(d.get("identifier")) or e(d.get("id")), "name": e(d.get("display_name"))}
            for d in docs["nsgdata"]
        ]
        self.group_rules = [
            {
                "nsg": e(d.get("nsg-id")),
                "rule": e(d.get("id")),
                **rule(d, "tcp_options", "udp_options", "destination_port_range"),
            }
            for d in docs["nsgrules"]
        ]
        self.members = [(e(d.get("nsg-id")), e(d.get("vnic_id"))) for d in docs["nsgvnic"]]
        self.private_ips = [
            {
                "id": e(d.get("id")) or e(d.get("identifier")),
                "vnic": e(d.get("vnic_id")) or e(d.get("vnic-id")) or e(d.get("vnicId")),
                "ip": e(d.get("ip_address")) or e(d.get("ipAddress")),
            }
            for d in docs["privateips"]
        ]
        self.public_ips = [
            {
                "private": e(d.get("private_ip_id")) or e(d.get("privateIpId")),
                "ip": e(d.get("ip_address")) or e(d.get("ipAddress")),
            }
            for d in docs["publicips"]
        ]
        self.subnet_sl = [(s["id"], i) for s in self.subnets for i in s["lists"]]

    def scope(self, scope: str) -> set[tuple]:
        """Distinct (id, name, route table, flag)."""
        found = set()
        for s in self.subnets:
            routed = s["rt"] in self.gateways
            public = routed and s["flag"] == "false"
            private = s["flag"] == "true" or not routed
            if public if scope == "public" else private:
                found.add((s["id"], s["name"], s["rt"], s["flag"]))
        return found

    def _wanted(self, r: dict, which: str) -> bool:
        found = kind(r)
        return found == "other" if which == "other" else found not in (None, "other")

    def sl(self, scope: str, which: str) -> set[tuple]:
        found = set()
        for subnet, name, rt, flag in self.scope(scope):
            for attached, list_id in self.subnet_sl:
                if subnet is None or attached != subnet or list_id is None:
                    continue
                for sl in self.lists:
                    for n, r in enumerate(sl["rules"], 1):
                        if sl["id"] == list_id and self._wanted(r, which):
                            tail = (
                                (label(r["protocol"]), service(r))
                                if which == "other"
                                else (kind(r),)
                            )
                            found.add(
                                (sl["name"], list_id, name, subnet, flag, rt, n, *tail)
                            )
        return found

    def _in_scope(self, scope: str):
        for v in self.vnics:
            for subnet, name, rt in {s[:3] for s in self.scope(scope)}:
                if subnet is not None and subnet == v["subnet"]:
                    yield v["id"], v["name"], subnet, name, rt, v["private"], v["public"]

    def nsg(self, scope: str, which: str) -> set[tuple]:
        return {
            (
                *v,
                r["nsg"],
                r["rule"],
                *((label(r["protocol"]), service(r)) if which == "other" else (kind(r),)),
            )
            for v in self._in_scope(scope)
            for nsg, vnic in self.members
            if vnic is not None and vnic == v[0]
            for r in self.group_rules
            if nsg is not None and r["nsg"] == nsg and self._wanted(r, which)
        }

    def exposed_vnics(self, scope: str, which: str) -> set[tuple]:
        subnets = {row[3] for row in self.sl(scope, which)}
        by_sl = {v[0] for v in self._in_scope(scope) if v[2] in subnets}
        by_nsg = {row[0] for row in self.nsg(scope, which)}
        return {
            (*v, source)
            for v in self._in_scope(scope)
            for source, ids in (("SECURITY_LIST", by_sl), ("NSG", by_nsg))
            if v[0] is not None and v[0] in ids
        }

    def exposed_subnets(self, scope: str, which: str) -> set[tuple]:
        by_sl = {row[3] for row in self.sl(scope, which)}
        by_nsg = {row[2] for row in self.nsg(scope, which)}
        return {
            (*s[:3], source)
            for s in self.scope(scope)
            for source, ids in (("SECURITY_LIST", by_sl), ("NSG", by_nsg))
            if s[0] in ids
        }

    def summary(self, scope: str) -> Counter:
        ids = {s[0] for s in self.scope(scope)} - {None}
        found: Counter = Counter()
        for subnet, list_id in self.subnet_sl:
            if subnet in ids and list_id is not None:
                for sl in self.lists:
                    for r in sl["rules"]:
                        if sl["id"] == list_id and r["source"] == ANY:
                            found["SECURITY_LIST", label(r["protocol"]), service(r)] += 1
        for v in self.vnics:
            for nsg, vnic in self.members:
                if v["subnet"] in ids and vnic is not None and vnic == v["id"]:
                    for r in self.group_rules:
                        opened = r["source"] == ANY and r["direction"] == "INGRESS"
                        if nsg is not None and r["nsg"] == nsg and opened:
                            found["NSG", label(r["protocol"]), service(r)] += 1
        return found

    def _cases(self, rules) -> str:
        found = {kind(r) for r in rules}
        return ", ".join(c for c in ("ALL", "22", "3389") if c in found) or "NONE"

    def unused_sl(self) -> Counter:
        used = {i for _, i in self.subnet_sl} - {None}
        return Counter(
            (
                sl["name"],
                sl["id"],
                self._cases(
                    r for o in self.lists for r in o["rules"] if sl["id"] and o["id"] == sl["id"]
                ),
            )
            for sl in self.lists
            if sl["id"] not in used
        )

    def unused_nsg(self) -> Counter:
        used = {g for g, _ in self.members} - {None}
        return Counter(
            (
                g["name"],
                g["id"],
                self._cases(r for r in self.group_rules if g["id"] and r["nsg"] == g["id"]),
            )
            for g in self.groups
            if g["id"] not in used
        )

    def lookup(self, vnic_ids: set) -> Counter:
        found: Counter = Counter()
        for v in self.vnics:
            if v["id"] is None or v["id"] not in vnic_ids:
                continue
            for s in self.subnets:
                if v["subnet"] is None or s["id"] != v["subnet"]:
                    continue
                head = (v["id"], v["name"], v["private"], v["public"], s["name"], s["id"])
                for subnet, list_id in self.subnet_sl:
                    for sl in self.lists:
                        if subnet == v["subnet"] and list_id and sl["id"] == list_id:
                            for n, r in enumerate(sl["rules"], 1):
                                found[
                                    (*head, "SECURITY_LIST", sl["name"], list_id, str(n))
                                    + (r["source"], label(r["protocol"], True), service(r))
                                ] += 1
                for nsg, vnic in self.members:
                    for r in self.group_rules:
                        if vnic == v["id"] and nsg and r["nsg"] == nsg:
                            if r["direction"] != "INGRESS":
                                continue
                            names = [g["name"] for g in self.groups if g["id"] == nsg] or [None]
                            for name in names:
                                found[
                                    (*head, "NSG", name, nsg, r["rule"], r["source"])
                                    + (label(r["protocol"], True), service(r))
                                ] += 1
        return found

    def owners(self, ip: str) -> set:
        behind = {p["private"] for p in self.public_ips if p["ip"] == ip} - {None}
        return {p["vnic"] for p in self.private_ips if p["ip"] == ip or p["id"] in behind}

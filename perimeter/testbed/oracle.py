"""Expected results as SQL over the base tables.

Nothing here goes through JSON: each relation states what the mapping of
FIXTURES.md means for the base rows, so it checks encoding, reading and typing
as well as the operators.
"""

from __future__ import annotations

import re

from perimeter.testbed.workspace import (
    FAILED_REGION,
    LOOKUP_PRIVATE_IP,
    LOOKUP_PUBLIC_IP,
    LOOKUP_VNIC,
    MISSING_REGION,
    REGIONS,
)

_CASE = """CASE WHEN source = '0.0.0.0/0' AND {ingress} THEN
    CASE WHEN protocol = 'all' OR (protocol = '6' AND NOT has_tcp) THEN 'ALL'
         WHEN protocol = '6' AND tcp_port_min <= 22 AND tcp_port_max >= 22 THEN '22'
         WHEN protocol = '6' AND tcp_port_min <= 3389 AND tcp_port_max >= 3389 THEN '3389'
    END END"""

_SERVICE = """CASE WHEN protocol = '17' THEN
    CASE WHEN udp_port_min IS NULL THEN 'ALL_PORTS'
         WHEN udp_port_min = udp_port_max THEN CAST(udp_port_min AS VARCHAR)
         ELSE CAST(udp_port_min AS VARCHAR) || '-' || CAST(udp_port_max AS VARCHAR) END
  ELSE
    CASE WHEN tcp_port_min IS NULL THEN 'ALL_PORTS'
         WHEN tcp_port_min = tcp_port_max THEN CAST(tcp_port_min AS VARCHAR)
         ELSE CAST(tcp_port_min AS VARCHAR) || '-' || CAST(tcp_port_max AS VARCHAR) END
  END"""

_LABEL = "CASE protocol WHEN '6' THEN 'TCP' WHEN '17' THEN 'UDP' ELSE protocol END"
_LABEL_UPPER = (
    "CASE protocol WHEN '6' THEN 'TCP' WHEN '17' THEN 'UDP' WHEN 'all' THEN 'ALL' "
    "ELSE protocol END"
)
_FIELDS = "source, protocol, has_tcp, tcp_port_min, tcp_port_max, udp_port_min, udp_port_max"
_PORTS = "protocol, tcp_port_min, tcp_port_max, udp_port_min, udp_port_max"

_PRIVATE_IP = "'10.0.' || ((o_orderkey % 5000) // 250) || '.' || (o_orderkey % 250 + 1)"
_PUBLIC_IP = (
    "'198.' || (18 + o_orderkey // 62500) || '.' || ((o_orderkey // 250) % 250) || '.' || "
    "(o_orderkey % 250 + 1)"
)

# Relations by name; each may use those before it.
_RELATIONS: dict[str, str] = {
    "cust": "SELECT c.*, n.n_regionkey FROM customer c JOIN nation n ON n_nationkey = c_nationkey",
    "ord": "SELECT o.*, c.n_regionkey FROM orders o JOIN cust c ON c_custkey = o_custkey",
    "numbered": """
        SELECT *, (l_suppkey + l_linenumber) % 6 AS k,
          row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
            l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS rn
        FROM lineitem""",
    "based": """
        SELECT *,
          CASE WHEN k = 2 THEN CAST(l_quantity AS BIGINT)
            + CASE WHEN l_linestatus = 'F' THEN 0 ELSE 3360 END END AS tcp_port_min,
          CASE WHEN k = 3 AND l_linenumber <> 7
            THEN CAST(l_quantity AS BIGINT) + 500 END AS udp_port_min
        FROM numbered""",
    "rule": """
        SELECT l_orderkey, l_partkey, l_linenumber, rn,
          CASE WHEN l_discount < 0.02 THEN 'EGRESS' ELSE 'INGRESS' END AS direction,
          CASE WHEN l_returnflag = 'R' THEN '10.0.0.0/8' ELSE '0.0.0.0/0' END AS source,
          CASE k WHEN 0 THEN 'all' WHEN 3 THEN '17' WHEN 4 THEN '1' ELSE '6' END AS protocol,
          k IN (2, 5) AS has_tcp,
          tcp_port_min,
          tcp_port_min + (l_partkey % 3)
            * CASE WHEN l_linestatus = 'F' THEN 10 ELSE 15 END AS tcp_port_max,
          udp_port_min,
          udp_port_min + l_partkey % 2 AS udp_port_max
        FROM based""",
    "igw": "SELECT 'rt-' || n_nationkey AS route_table_id FROM nation WHERE n_regionkey IN (0, 1, 3)",
    "subnet": """
        SELECT 'subnet-' || c_custkey AS subnet_id, c_name AS subnet_name,
          'rt-' || c_nationkey AS route_table_id,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'true' WHEN 'MACHINERY' THEN NULL
            ELSE 'false' END AS prohibit_public_ip_on_vnic,
          'vcn-' || c_nationkey AS vcn_id,
          CASE WHEN c_custkey % 7 <> 0 THEN 'vcn' || c_nationkey END AS vcn_name,
          n_regionkey
        FROM cust""",
    "pub_scope": """
        SELECT s.* FROM subnet s JOIN igw USING (route_table_id)
        WHERE prohibit_public_ip_on_vnic = 'false'""",
    "priv_scope": """
        SELECT s.* FROM subnet s LEFT JOIN igw ON igw.route_table_id = s.route_table_id
        WHERE prohibit_public_ip_on_vnic = 'true' OR igw.route_table_id IS NULL""",
    "sub_sl": """
        SELECT 'subnet-' || o_custkey AS subnet_id, 'sl-' || o_orderkey AS securitylist_id
        FROM ord WHERE o_orderstatus = 'F'""",
    "sl": """
        SELECT 'sl-' || o_orderkey AS securitylist_id,
          'sl-name-' || o_orderkey AS securitylist_name,
          'comp-' || (o_custkey % 10) AS compartment_id, 'AVAILABLE' AS lifecycle_state,
          CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS time_created,
          'vcn-' || (o_custkey % 25) AS vcn_id
        FROM orders""",
    "sl_rule": f"""
        SELECT 'sl-' || l_orderkey AS securitylist_id, 'sl-name-' || l_orderkey AS securitylist_name,
          rn AS rule_no, {_FIELDS},
          {_CASE.format(ingress="TRUE")} AS insecure_case
        FROM rule JOIN orders ON o_orderkey = l_orderkey""",
    "sl_insecure": "SELECT * FROM sl_rule WHERE insecure_case IS NOT NULL",
    "sl_other": "SELECT * FROM sl_rule WHERE source = '0.0.0.0/0' AND insecure_case IS NULL",
    "nsg": """
        SELECT 'nsg-' || p_partkey AS nsg_id,
          CASE WHEN p_partkey % 11 <> 0 THEN 'nsg-name-' || p_partkey END AS nsg_name,
          'comp-' || (p_partkey % 10) AS compartment_id, 'AVAILABLE' AS lifecycle_state,
          '2020-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') AS time_created,
          'vcn-' || (p_partkey % 25) AS vcn_id
        FROM part""",
    "nsg_rule": f"""
        SELECT 'nsg-' || l_partkey AS nsg_id, 'rule-' || l_orderkey || '-' || rn AS rule_id,
          direction, {_FIELDS},
          {_CASE.format(ingress="direction = 'INGRESS'")} AS insecure_case,
          l_partkey % 5 AS region_no
        FROM rule""",
    "nsg_insecure": "SELECT * FROM nsg_rule WHERE insecure_case IS NOT NULL",
    "nsg_other": """
        SELECT * FROM nsg_rule
        WHERE direction = 'INGRESS' AND source = '0.0.0.0/0' AND insecure_case IS NULL""",
    "member": """
        SELECT 'nsg-' || l_partkey AS nsg_id, 'vnic-' || l_orderkey AS vnic_id,
          l_partkey % 5 AS region_no
        FROM lineitem JOIN part ON p_partkey = l_partkey
        WHERE p_size <= 40""",
    "vnic": f"""
        SELECT 'vnic-' || o_orderkey AS vnic_id, 'vnic-name-' || o_orderkey AS vnic_name,
          'subnet-' || o_custkey AS subnet_id, {_PRIVATE_IP} AS private_ip,
          CASE WHEN o_orderstatus = 'O' THEN {_PUBLIC_IP} END AS public_ip,
          o_orderkey, n_regionkey
        FROM ord""",
    "in_region": """
        SELECT 'nsgdata' AS collection, 'region-' || (p_partkey % 5) AS region,
          'nsg-' || p_partkey AS document_id FROM part
        UNION ALL SELECT 'nsgrules', 'region-' || region_no, rule_id FROM nsg_rule
        UNION ALL SELECT 'nsgvnic', 'region-' || region_no, nsg_id || '/' || vnic_id FROM member
        UNION ALL SELECT 'securitylists', 'region-' || n_regionkey, 'sl-' || o_orderkey FROM ord
        UNION ALL SELECT 'publicips', 'region-' || n_regionkey, 'pub-' || o_orderkey FROM ord
          WHERE o_orderstatus = 'O'
        UNION ALL SELECT 'privateips', 'region-' || n_regionkey, 'pip-' || o_orderkey FROM vnic
        UNION ALL SELECT 'subnets', 'region-' || n_regionkey, subnet_id FROM subnet
        UNION ALL SELECT 'vnics', 'region-' || n_regionkey, vnic_id FROM vnic
        UNION ALL SELECT 'routes', 'region-' || n_regionkey, 'rt-' || n_nationkey FROM nation""",
    "expected": """
        SELECT r.region, c.collection
        FROM (SELECT unnest([{regions}]) AS region) r,
          (SELECT unnest(['nsgdata', 'nsgrules', 'nsgvnic', 'securitylists', 'publicips',
            'privateips', 'subnets', 'vnics', 'routes']) AS collection) c""".format(
        regions=", ".join(f"'{r}'" for r in (*REGIONS, MISSING_REGION))
    ),
    "counted": """
        SELECT e.region, e.collection, count(d.document_id) AS documents
        FROM expected e LEFT JOIN in_region d
          ON d.region = e.region AND d.collection = e.collection
        GROUP BY ALL""",
    "broken": """
        SELECT 'region-' || n_regionkey AS region, 'vnics' AS collection, count(*) AS lines
        FROM vnic WHERE o_orderkey % 100 = 0 AND o_orderkey > 0 GROUP BY ALL""",
    "partial": """
        SELECT 'region-' || n_regionkey AS region, 'publicips' AS collection, count(*) AS doubled
        FROM ord WHERE o_orderstatus = 'O' AND o_orderkey % 100 = 0 AND o_orderkey > 0 GROUP BY ALL""",
}


def _effective(target: str) -> str:
    context = (
        "v.vnic_id, v.vnic_name, v.private_ip, v.public_ip, s.vcn_name, s.vcn_id, "
        "s.subnet_name, s.subnet_id"
    )
    return f"""
        SELECT {context}, 'SECURITY_LIST' AS rule_source, r.securitylist_name AS policy_name,
          r.securitylist_id AS policy_id, CAST(r.rule_no AS VARCHAR) AS rule_id,
          r.source AS source_cidr, {_LABEL_UPPER} AS protocol, {_SERVICE} AS destination_service_port
        FROM vnic v JOIN subnet s USING (subnet_id) JOIN sub_sl a USING (subnet_id)
          JOIN sl_rule r USING (securitylist_id)
        WHERE {target}
        UNION ALL
        SELECT {context}, 'NSG', g.nsg_name, r.nsg_id, r.rule_id, r.source, {_LABEL_UPPER}, {_SERVICE}
        FROM vnic v JOIN subnet s USING (subnet_id) JOIN member m USING (vnic_id)
          JOIN nsg_rule r USING (nsg_id) LEFT JOIN nsg g USING (nsg_id)
        WHERE r.direction = 'INGRESS' AND {target}"""


def _exposed(block: str, scope: str, kind: str) -> str:
    by_sl = f"""sub_sl a ON a.subnet_id = s.subnet_id
          JOIN sl_{kind} r ON r.securitylist_id = a.securitylist_id"""
    by_nsg = f"""member m ON m.vnic_id = v.vnic_id JOIN nsg_{kind} r ON r.nsg_id = m.nsg_id"""
    vnics = "vnic v ON v.subnet_id = s.subnet_id"
    return {
        "vnics_exposed_by_sl": f"""
            SELECT DISTINCT v.vnic_id, 'SECURITY_LIST' AS exposure_source
            FROM {scope} s JOIN {vnics} JOIN {by_sl}""",
        "vnics_exposed_by_nsg": f"""
            SELECT DISTINCT v.vnic_id, 'NSG' AS exposure_source
            FROM {scope} s JOIN {vnics} JOIN {by_nsg}""",
        "subnets_exposed_by_sl": f"""
            SELECT DISTINCT s.subnet_id, 'SECURITY_LIST' AS exposure_source
            FROM {scope} s JOIN {by_sl}""",
        "subnets_exposed_by_nsg": f"""
            SELECT DISTINCT s.subnet_id, 'NSG' AS exposure_source
            FROM {scope} s JOIN {vnics} JOIN {by_nsg}""",
    }[block]


def _services(scope: str, source: str) -> str:
    if source == "SECURITY_LIST":
        return f"""SELECT 'SECURITY_LIST' AS exposure_source, {_PORTS}
            FROM {scope} s JOIN sub_sl a USING (subnet_id) JOIN sl_rule r USING (securitylist_id)
            WHERE source = '0.0.0.0/0'"""
    return f"""SELECT 'NSG' AS exposure_source, {_PORTS}
        FROM {scope} s JOIN vnic v USING (subnet_id) JOIN member m USING (vnic_id)
          JOIN nsg_rule r USING (nsg_id)
        WHERE source = '0.0.0.0/0' AND direction = 'INGRESS'"""


def _all_services(scope: str) -> str:
    return f"{_services(scope, 'SECURITY_LIST')} UNION ALL {_services(scope, 'NSG')}"


def _occurrences(services: str) -> str:
    return f"SELECT *, count(*) AS occurrences FROM ({services}) GROUP BY ALL"


_ON_SUBNET = """securitylist_name, securitylist_id, subnet_name, subnet_id,
    prohibit_public_ip_on_vnic AS "prohibitPublicIpOnVnic", route_table_id"""
_ON_VNIC = """vnic_id, vnic_name, subnet_id, subnet_name, route_table_id, private_ip, public_ip"""


def _scoped(prefix: str) -> dict[str, str]:
    scope = f"{prefix}_scope"
    on_subnet = f"FROM {scope} JOIN sub_sl USING (subnet_id) JOIN {{}} USING (securitylist_id)"
    on_vnic = (
        f"FROM {scope} JOIN vnic USING (subnet_id) JOIN member USING (vnic_id) "
        "JOIN {} USING (nsg_id)"
    )
    found = {
        "insecure_sl": f"""SELECT DISTINCT {_ON_SUBNET}, rule_no AS insecure_rule_number,
            insecure_case {on_subnet.format("sl_insecure")}""",
        "insecure_nsg": f"""SELECT DISTINCT {_ON_VNIC}, nsg_id, rule_id AS insecure_rule_id,
            insecure_case {on_vnic.format("nsg_insecure")}""",
        "other_sl": f"""SELECT DISTINCT {_ON_SUBNET}, rule_no AS rule_number,
            {_LABEL} AS protocol, {_SERVICE} AS service {on_subnet.format("sl_other")}""",
        "other_nsg": f"""SELECT DISTINCT {_ON_VNIC}, nsg_id, rule_id,
            {_LABEL} AS protocol, {_SERVICE} AS service {on_vnic.format("nsg_other")}""",
        "service_summary": f"""SELECT exposure_source, {_LABEL} AS protocol,
            {_SERVICE} AS service, count(*) AS total_occurrences
            FROM ({_all_services(scope)}) GROUP BY 1, 2, 3""",
        "services_from_sl": _occurrences(_services(scope, "SECURITY_LIST")),
        "services_from_nsg": _occurrences(_services(scope, "NSG")),
        "all_services": _occurrences(_all_services(scope)),
    }
    for kind in ("insecure", "other"):
        vnics = " UNION ALL ".join(
            _exposed(b, scope, kind) for b in ("vnics_exposed_by_sl", "vnics_exposed_by_nsg")
        )
        subnets = " UNION ALL ".join(
            _exposed(b, scope, kind) for b in ("subnets_exposed_by_sl", "subnets_exposed_by_nsg")
        )
        found[f"{kind}_vnics"] = f"""SELECT DISTINCT {_ON_VNIC}, exposure_source
            FROM ({vnics}) e JOIN vnic USING (vnic_id) JOIN {scope} USING (subnet_id)"""
        found[f"{kind}_subnets"] = f"""
            SELECT DISTINCT subnet_id, subnet_name, route_table_id, exposure_source
            FROM ({subnets}) e JOIN {scope} USING (subnet_id)"""
        for block in (
            "vnics_exposed_by_sl",
            "vnics_exposed_by_nsg",
            "subnets_exposed_by_sl",
            "subnets_exposed_by_nsg",
        ):
            found[f"{kind}_{block}"] = _exposed(block, scope, kind)
    return {f"{prefix}_{key}": sql for key, sql in found.items()}


def _agg(relation: str, policy: str) -> str:
    return f"""SELECT {policy}, string_agg(insecure_case, ', ' ORDER BY
          CASE insecure_case WHEN 'ALL' THEN 1 WHEN '22' THEN 2 ELSE 3 END) AS cis_insecure_case
        FROM (SELECT DISTINCT {policy}, insecure_case FROM {relation}) GROUP BY {policy}"""


def _unused(details: str, used: str, cases: str, policy: str, name: str) -> str:
    return f"""SELECT {name}, {policy}, vcn_id, compartment_id, lifecycle_state, time_created,
          coalesce(cis_insecure_case, 'NONE') AS cis_insecure_case
        FROM {details} LEFT JOIN ({_agg(cases, policy)}) USING ({policy})
        WHERE {policy} NOT IN (SELECT {policy} FROM {used})"""


_SUBNET_COLUMNS = "subnet_id, subnet_name, route_table_id, prohibit_public_ip_on_vnic"
_SL_RULE = f"securitylist_id, securitylist_name, rule_no, {_FIELDS}"
_NSG_RULE = f"nsg_id, rule_id, direction, {_FIELDS}"
_DESCRIBED = "compartment_id, lifecycle_state, time_created, vcn_id"
_VNIC = "vnic_id, vnic_name, subnet_id, private_ip, public_ip"

_SELECTS: dict[str, str] = {
    **_scoped("pub"),
    **_scoped("priv"),
    "unused_sl": _unused("sl", "sub_sl", "sl_insecure", "securitylist_id", "securitylist_name"),
    "unused_nsg": _unused("nsg", "member", "nsg_insecure", "nsg_id", "nsg_name"),
    "lookup_vnic": _effective(f"v.vnic_id = '{LOOKUP_VNIC}'"),
    "lookup_ip": _effective(f"v.private_ip = '{LOOKUP_PRIVATE_IP}'"),
    "lookup_ip_public": _effective(f"v.public_ip = '{LOOKUP_PUBLIC_IP}'"),
    "igw_route_tables": "SELECT route_table_id FROM igw",
    "public_subnets": f"SELECT {_SUBNET_COLUMNS} FROM pub_scope",
    "private_subnets": f"SELECT {_SUBNET_COLUMNS} FROM priv_scope",
    "subnet_sl": "SELECT subnet_id, securitylist_id FROM sub_sl",
    "sl_rules": f"SELECT {_SL_RULE} FROM sl_rule",
    "sl_open_rules": f"SELECT {_SL_RULE} FROM sl_rule WHERE source = '0.0.0.0/0'",
    "sl_insecure_rules": f"SELECT {_SL_RULE}, insecure_case FROM sl_insecure",
    "sl_insecure_cases": "SELECT securitylist_id, rule_no, insecure_case FROM sl_rule",
    "sl_insecure_ids": "SELECT DISTINCT securitylist_id FROM sl_insecure",
    "sl_other_rules": f"SELECT {_SL_RULE} FROM sl_other",
    "nsg_rules": f"SELECT {_NSG_RULE} FROM nsg_rule",
    "nsg_open_rules": f"""SELECT {_NSG_RULE} FROM nsg_rule
        WHERE direction = 'INGRESS' AND source = '0.0.0.0/0'""",
    "nsg_insecure_rules": f"SELECT {_NSG_RULE}, insecure_case FROM nsg_insecure",
    "nsg_insecure_cases": "SELECT nsg_id, rule_id, insecure_case FROM nsg_rule",
    "nsg_insecure_ids": "SELECT DISTINCT nsg_id FROM nsg_insecure",
    "nsg_other_rules": f"SELECT {_NSG_RULE} FROM nsg_other",
    "sl_other_ids": "SELECT DISTINCT securitylist_id FROM sl_other",
    "nsg_other_ids": "SELECT DISTINCT nsg_id FROM nsg_other",
    "nsg_insecure_flags": """SELECT DISTINCT nsg_id,
        CASE WHEN insecure_case IS NOT NULL THEN 'INSECURE' END AS insecure_flag FROM nsg_rule""",
    "rule_labels": f"""SELECT rule_id, {_LABEL} AS protocol_label,
        {_LABEL_UPPER} AS protocol_label_upper, {_SERVICE} AS service_label FROM nsg_rule
        UNION ALL SELECT securitylist_id || '-' || rule_no, {_LABEL}, {_LABEL_UPPER}, {_SERVICE} FROM sl_rule""",
    "nsg_vnic_assoc": "SELECT nsg_id, vnic_id FROM member",
    "vnic_data": f"SELECT {_VNIC} FROM vnic",
    "used_securitylists": "SELECT DISTINCT securitylist_id FROM sub_sl",
    "used_nsgs": "SELECT DISTINCT nsg_id FROM member",
    "sl_details": f"SELECT securitylist_id, securitylist_name, {_DESCRIBED} FROM sl",
    "nsg_details": f"SELECT nsg_id, nsg_name, {_DESCRIBED} FROM nsg",
    "nsg_data": "SELECT nsg_id, nsg_name FROM nsg",
    "subnet_details": "SELECT subnet_id, subnet_name, vcn_id, vcn_name FROM subnet",
    "sl_insecure_agg": _agg("sl_insecure", "securitylist_id"),
    "nsg_insecure_agg": _agg("nsg_insecure", "nsg_id"),
    "ip_to_vnic": f"SELECT DISTINCT vnic_id FROM vnic WHERE private_ip = '{LOOKUP_PRIVATE_IP}'",
    "ip_to_vnic_public": f"SELECT DISTINCT vnic_id FROM vnic WHERE public_ip = '{LOOKUP_PUBLIC_IP}'",
    "vnic_target": f"SELECT {_VNIC} FROM vnic WHERE vnic_id = '{LOOKUP_VNIC}'",
    "vnic_target_by_ip": f"SELECT {_VNIC} FROM vnic WHERE private_ip = '{LOOKUP_PRIVATE_IP}'",
    "load_collections": "SELECT collection, document_id FROM in_region",
    "consolidate_regions": "SELECT collection, region, document_id FROM in_region",
    "select_regions": """SELECT collection, region, count(*) AS documents FROM in_region
        WHERE region IN ('region-1', 'region-3') GROUP BY ALL""",
    "tag_parent": """SELECT 'pip-' || o_orderkey AS child_id, 'region-' || n_regionkey AS region,
        subnet_id AS parent_id FROM vnic""",
    "dedupe_public_ip_ids": """SELECT DISTINCT 'pub-' || l_orderkey AS identifier
        FROM lineitem WHERE l_linestatus = 'O'""",
    "dedupe_subnet_ids": """SELECT subnet_id AS identifier FROM subnet
        UNION SELECT subnet_id FROM vnic""",
    "collection_counts": f"""
        SELECT region, collection, documents FROM counted WHERE region <> '{FAILED_REGION}'
        UNION ALL
        SELECT NULL, collection, CAST(sum(documents) AS BIGINT) FROM counted
        WHERE region <> '{FAILED_REGION}' GROUP BY collection""",
    "load_audit": f"""
        SELECT region, collection,
          CASE WHEN region = '{FAILED_REGION}' THEN 'FAILED_REGION'
               WHEN documents + coalesce(lines, 0) = 0 THEN 'NO_RECORDS'
               WHEN coalesce(lines, 0) > 0 THEN 'UNREADABLE_LINES'
               WHEN coalesce(doubled, 0) > 0 THEN 'PARTIAL_DOCUMENTS' ELSE 'OK' END AS status,
          documents, coalesce(lines, 0) AS unreadable_lines, coalesce(doubled, 0) AS partial_documents
        FROM counted LEFT JOIN broken USING (region, collection)
          LEFT JOIN partial USING (region, collection)""",
    "write_jsonl": """SELECT rule_id, NOT has_tcp AS tcp_options_null,
        udp_port_min IS NULL AS udp_options_null FROM nsg_rule""",
}


_SELECTS["loaded_audit"] = _SELECTS["load_audit"]
_SELECTS["append_batches"] = _SELECTS["write_jsonl"]
_SELECTS["regional_summary"] = " UNION ALL ".join(
    f"SELECT '{scope}' AS scope, * FROM ({_SELECTS[f'{scope}_service_summary']})" for scope in ("pub", "priv")
)
_POLICIES = (
    ("sl", "sl", "sub_sl", "sl_insecure", "securitylist_id", "securitylist_name"),
    ("nsg", "nsg", "member", "nsg_insecure", "nsg_id", "nsg_name"),
)
_SELECTS["cleanup_ledger"] = " UNION ALL ".join(
    f"""SELECT '{kind}' AS kind, {name} AS name, {policy} AS policy, vcn_id, compartment_id, lifecycle_state,
          time_created, cis_insecure_case FROM ({_SELECTS[f"unused_{kind}"]})"""
    for kind, _, _, _, policy, name in _POLICIES
)
_SELECTS["cleanup_changes"] = " UNION ALL ".join(
    f"""SELECT '{kind}' AS kind, {name} AS name, {policy} AS policy, vcn_id, compartment_id, lifecycle_state,
          time_created, coalesce(cis_insecure_case, 'NONE') AS cis_insecure_case, CAST(-count(*) AS BIGINT) AS n
        FROM {details} LEFT JOIN ({_agg(cases, policy)}) USING ({policy})
        WHERE {policy} IN (SELECT {policy} FROM {used}) GROUP BY ALL"""
    for kind, details, used, cases, policy, name in _POLICIES
)
for _kind in ("insecure", "other"):
    _SELECTS[f"colocated_{_kind}_nsg"] = " UNION ALL ".join(
        f"SELECT '{scope}' AS scope, * FROM ({_SELECTS[f'{scope}_{_kind}_nsg']})" for scope in ("pub", "priv")
    )
_SELECTS["write_report"] = _SELECTS["priv_other_subnets"]
for _table in ("vnics", "subnets"):
    _names = [f"{scope}_{kind}_{_table}" for scope in ("pub", "priv") for kind in ("insecure", "other")]
    _SELECTS[f"lattice_{_table}"] = " UNION ALL ".join(
        f"SELECT '{name}' AS report, * FROM ({_SELECTS[name]})" for name in _names
    )


def _with_relations(select: str) -> str:
    """``select`` preceded by the relations it needs, in order."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        sql = pending.pop()
        for name, body in _RELATIONS.items():
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                pending.append(body)
    parts = [f"{name} AS ({body})" for name, body in _RELATIONS.items() if name in needed]
    return f"WITH {', '.join(parts)} {select}" if parts else select


def oracle_sql() -> dict[str, str]:
    """Expected SQL of every registered query."""
    return {key: _with_relations(sql) for key, sql in _SELECTS.items()}

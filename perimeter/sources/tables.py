"""Typed tables: one flat projection per collection.

Documents become plain columns once, here. Every operator works on these
tables, so parquet statistics, column pruning and filter pushdown apply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from perimeter.constants import INTERNET_GATEWAY_MARKER
from perimeter.functions.scalars import (
    elements,
    insecure_case_sql,
    is_other_sql,
    parsed,
    port,
    struct,
    text,
)
from perimeter.schemas import INGRESS_RULE, PARSED_LIST, ROUTE_RULE, document_schema

_DETAILS = "additional_details"


def _first_of(*names: str) -> str:
    return f"coalesce({', '.join(text(name) for name in names)})"


_DESCRIBED = {
    "compartment_id": text("compartment_id"),
    "lifecycle_state": text("lifecycle_state"),
    "time_created": text("time_created"),
    "vcn_id": text(f"{_DETAILS}.vcnId"),
}


def _rule_fields(rule: str, tcp: str, udp: str, port_range: str) -> dict[str, str]:
    return {
        "source": text(f"{rule}source"),
        "protocol": text(f"{rule}protocol"),
        "has_tcp": f"{rule}{tcp} IS NOT NULL",
        "tcp_port_min": port(f"{rule}{tcp}.{port_range}.min", "ceil"),
        "tcp_port_max": port(f"{rule}{tcp}.{port_range}.max"),
        "udp_port_min": port(f"{rule}{udp}.{port_range}.min", "ceil"),
        "udp_port_max": port(f"{rule}{udp}.{port_range}.max"),
    }


# Lists that are documents themselves, as the expression that parses them; readers may have done so.
_LISTS = {
    "routes": parsed(f"{_DETAILS}.routeRules", ROUTE_RULE),
    "securitylists": parsed(f"{_DETAILS}.ingressSecurityRules", INGRESS_RULE),
}
_INGRESS_RULE = struct(_rule_fields("r.", "tcpOptions", "udpOptions", "destinationPortRange"))

# Column and the expression over a document that gives it, per collection.
_PROJECTIONS: dict[str, dict[str, str]] = {
    "routes": {
        "route_table_id": text("identifier"),
        "entity_ids": f"transform({PARSED_LIST}, r -> {text('r.networkEntityId')})",
    },
    "subnets": {
        "subnet_id": text("identifier"),
        "subnet_name": text("display_name"),
        "route_table_id": text(f"{_DETAILS}.routeTableId"),
        "prohibit_public_ip_on_vnic": text(f"{_DETAILS}.prohibitPublicIpOnVnic"),
        "securitylist_ids": f"transform({elements(f'{_DETAILS}.securityListIds')}, "
        f"i -> {text('i')})",
        "vcn_id": text(f"{_DETAILS}.vcnId"),
        "domain_name": text(f"{_DETAILS}.subnetDomainName"),
    },
    "securitylists": {
        "securitylist_id": text("identifier"),
        "securitylist_name": text("display_name"),
        **_DESCRIBED,
        "ingress_rules": f"transform({PARSED_LIST}, r -> {_INGRESS_RULE})",
    },
    "vnics": {
        "vnic_id": text("identifier"),
        "vnic_name": text("display_name"),
        "subnet_id": text(f"{_DETAILS}.subnetId"),
        "private_ip": text(f"{_DETAILS}.privateIp"),
        "public_ip": text(f"{_DETAILS}.publicIp"),
    },
    "nsgdata": {
        "nsg_id": _first_of("identifier", "id"),
        "nsg_name": text("display_name"),
        **_DESCRIBED,
    },
    "nsgrules": {
        "nsg_id": text("`nsg-id`"),
        "rule_id": text("id"),
        "direction": text("direction"),
        **_rule_fields("", "tcp_options", "udp_options", "destination_port_range"),
    },
    "nsgvnic": {
        "nsg_id": text("`nsg-id`"),
        "vnic_id": text("vnic_id"),
    },
    "privateips": {
        "private_ip_id": _first_of("id", "identifier"),
        "vnic_id": _first_of("vnic_id", "`vnic-id`", "vnicId"),
        "ip_address": _first_of("ip_address", "ipAddress"),
    },
    "publicips": {
        "ip_address": _first_of("ip_address", "ipAddress"),
        "private_ip_id": _first_of("private_ip_id", "privateIpId"),
    },
}

_OF_RULE = {
    name: f"r.{column}"
    for name, column in {
        "source": "source",
        "protocol": "protocol",
        "has_tcp": "has_tcp",
        "low": "tcp_port_min",
        "high": "tcp_port_max",
    }.items()
}

# Marks that reports filter by. They are columns, so the filters reach the stored files
# and no list of rules is taken apart to learn whether it has one.
_MARKS: dict[str, dict[str, str]] = {
    "routes": {"has_igw": f"exists(entity_ids, e -> contains(e, '{INTERNET_GATEWAY_MARKER}'))"},
    "securitylists": {
        "has_insecure": f"exists(ingress_rules, r -> {insecure_case_sql(**_OF_RULE)} IS NOT NULL)",
        "has_other": f"exists(ingress_rules, r -> {is_other_sql(**_OF_RULE)})",
    },
    "nsgrules": {
        "insecure_case": insecure_case_sql(direction="direction"),
        "is_other": is_other_sql(direction="direction"),
    },
}

# The column that names a row of each typed table; stored tables are sorted by it.
SORT_COLUMN = {
    "routes": "route_table_id",
    "subnets": "subnet_id",
    "securitylists": "securitylist_id",
    "vnics": "vnic_id",
    "nsgdata": "nsg_id",
    "nsgrules": "nsg_id",
    "nsgvnic": "vnic_id",
    "privateips": "ip_address",
    "publicips": "ip_address",
}

# Columns that are searched by equality though the files aren't sorted by them.
SEARCHED_COLUMNS = {
    "subnets": ("route_table_id",),
    "vnics": ("subnet_id",),
    "nsgvnic": ("nsg_id",),
    "privateips": ("private_ip_id", "vnic_id"),
    "publicips": ("private_ip_id",),
}


def typed(collection: str, documents: DataFrame) -> DataFrame:
    """Typed table of ``collection``; keeps one row per document."""
    columns = [f"{value} AS {name}" for name, value in _PROJECTIONS[collection].items()]
    if PARSED_LIST not in documents.columns and collection in _LISTS:
        columns = [column.replace(PARSED_LIST, _LISTS[collection]) for column in columns]
    region = "region" if "region" in documents.columns else "CAST(NULL AS STRING) AS region"
    marks = [f"{value} AS {name}" for name, value in _MARKS.get(collection, {}).items()]
    # The region comes last, where reading folders partitioned by it puts it.
    return documents.selectExpr(*columns, region).selectExpr(*_PROJECTIONS[collection], *marks, "region")


def table_schema(spark: SparkSession, collection: str) -> T.StructType:
    """Schema of the typed table, for reading it back."""
    return typed(collection, spark.createDataFrame([], document_schema(collection))).schema

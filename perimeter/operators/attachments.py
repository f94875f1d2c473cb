"""Which policy applies where: lists to subnets, groups to interfaces."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perimeter.constants import VCN_NAME_PATTERN
from perimeter.functions import scalars

_VNIC = ("vnic_id", "vnic_name", "subnet_id", "private_ip", "public_ip")
_DESCRIPTION = ("compartment_id", "lifecycle_state", "time_created", "vcn_id")


def subnet_sl(subnets: DataFrame) -> DataFrame:
    """(subnet, security list) pairs, copies kept."""
    return subnets.selectExpr("subnet_id", "explode(securitylist_ids) AS securitylist_id")


def used_securitylists(subnets: DataFrame) -> DataFrame:
    """Security lists attached to any subnet, each once."""
    return subnet_sl(subnets).select("securitylist_id").distinct()


def nsg_vnic_assoc(nsgvnic: DataFrame) -> DataFrame:
    """(group, interface) pairs, copies kept."""
    return nsgvnic.select("nsg_id", "vnic_id")


def used_nsgs(nsgvnic: DataFrame) -> DataFrame:
    """Groups attached to any interface, each once."""
    return nsgvnic.select("nsg_id").distinct()


def vnic_data(vnics: DataFrame) -> DataFrame:
    """Network interfaces, copies kept."""
    return vnics.select(*_VNIC)


def sl_details(securitylists: DataFrame) -> DataFrame:
    """Descriptive fields of security lists, copies kept."""
    return securitylists.select("securitylist_id", "securitylist_name", *_DESCRIPTION)


def nsg_details(nsgdata: DataFrame) -> DataFrame:
    """Descriptive fields of groups, copies kept."""
    return nsgdata.select("nsg_id", "nsg_name", *_DESCRIPTION)


def nsg_data(nsgdata: DataFrame) -> DataFrame:
    """Group names, copies kept."""
    return nsgdata.select("nsg_id", "nsg_name")


def subnet_details(subnets: DataFrame, pattern: str = VCN_NAME_PATTERN) -> DataFrame:
    """Subnets with their network's id and the network name in their domain."""
    return subnets.select(
        "subnet_id",
        "subnet_name",
        "vcn_id",
        scalars.vcn_name("domain_name", pattern).alias("vcn_name"),
    )

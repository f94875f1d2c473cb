"""Rules effective on a few interfaces.

A lookup starts from one id or address and usually touches a handful of rows in huge tables.
Nothing is fetched while a lookup is built: the ids that matter are subqueries. ``in_range`` takes
their smallest and largest value as a range that reaches the scan at run time, so only the row
groups of sorted files that can hold them are read. A semi join then keeps exactly the rows with
one of the ids; Spark can add a bloom filter to it. Both are bounded in size, however many ids
there are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.functions import scalars
from perimeter.operators.attachments import (
    nsg_data,
    nsg_vnic_assoc,
    subnet_details,
    subnet_sl,
    vnic_data,
)
from perimeter.operators.rules import nsg_rules, sl_rules
from perimeter.operators.skew import HotKeys, Salts, count_copies, expand_copies, keyed_join
from perimeter.sources.inventory import Inventory

def in_range(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key lies between the smallest and the largest wanted one; two scalar subqueries.

    Ranges inside ``wanted`` are planned twice each, so they should not nest deeply.
    """
    low, high = (wanted.agg(least(key)).scalar() for least in (F.min, F.max))
    return table.where((F.col(key) >= low) & (F.col(key) <= high))


@dataclass(frozen=True)
class Target:
    """Interfaces (copies kept) as the result reads them, and as subqueries do, without ranges."""

    rows: DataFrame
    plain: DataFrame


def _behind(public: DataFrame, privateips: DataFrame, hot: HotKeys, ranged: bool) -> DataFrame:
    """Interfaces of the private addresses that these public ones belong to."""
    pairs = privateips.select("private_ip_id", "vnic_id")
    if ranged:
        pairs = in_range(pairs, "private_ip_id", public)
    splits = hot.on("privateips.private_ip_id")
    return keyed_join(pairs.distinct(), public, "private_ip_id", "left_semi", splits).select("vnic_id")


def ip_to_vnic(
    privateips: DataFrame, publicips: DataFrame, ip_address: str, hot: HotKeys = HotKeys()
) -> DataFrame:
    """Interfaces that own the address, privately or through a public address."""
    wanted = F.col("ip_address") == F.lit(ip_address)
    private = privateips.where(wanted).select("vnic_id")
    public = publicips.where(wanted).select("private_ip_id")
    return private.unionByName(_behind(public, privateips, hot, True)).distinct()


def vnic_target(vnics: DataFrame, vnic_id: str) -> DataFrame:
    """The interface with this id; copies kept, no row when there is none."""
    return vnic_data(vnics).where(F.col("vnic_id") == F.lit(vnic_id))


def target_by_id(inventory: Inventory, vnic_id: str) -> Target:
    """The interface with this id, from the files that can hold it."""
    rows = vnic_data(inventory.rows_with("vnics", vnic_id))
    return Target(rows, rows)


def target_by_ip(inventory: Inventory, ip_address: str) -> Target:
    """The interfaces that own the address, from the files that can hold it."""
    hot = inventory.hot
    private = inventory.rows_with("privateips", ip_address).select("vnic_id")
    public = inventory.rows_with("publicips", ip_address).select("private_ip_id")

    def owners(ranged: bool) -> DataFrame:
        behind = _behind(public, inventory.privateips, hot, ranged)
        return private.unionByName(behind).distinct()

    def owned(rows: DataFrame, ids: DataFrame) -> DataFrame:
        return keyed_join(rows, ids, "vnic_id", "left_semi", hot.on("vnics.vnic_id"))

    vnics = vnic_data(inventory.vnics)
    near = count_copies(in_range(vnics, "vnic_id", owners(False)))
    return Target(expand_copies(owned(near, owners(True)), "copies"), owned(vnics, owners(False)))


def vnic_target_by_ip(inventory: Inventory, ip_address: str) -> DataFrame:
    """The interfaces that own the address; copies kept."""
    return target_by_ip(inventory, ip_address).rows


def _effective(rows: DataFrame, source: str, policy_name: str, policy: str, rule) -> DataFrame:
    return rows.select(
        "vnic_id",
        "vnic_name",
        "private_ip",
        "public_ip",
        "vcn_name",
        "vcn_id",
        "subnet_name",
        "subnet_id",
        F.lit(source).alias("rule_source"),
        F.col(policy_name).alias("policy_name"),
        F.col(policy).alias("policy_id"),
        rule.alias("rule_id"),
        F.col("source").alias("source_cidr"),
        scalars.protocol_label(upper_all=True).alias("protocol"),
        scalars.service_label().alias("destination_service_port"),
        F.col("copies"),
    )


def _times(rows: DataFrame, *factors: str) -> DataFrame:
    product = F.col(factors[0])
    for factor in factors[1:]:
        product = product * F.col(factor)
    return rows.withColumn("copies", product).drop(*(f for f in factors if f != "copies"))


def effective_rules(inventory: Inventory, target: Target) -> DataFrame:
    """Every ingress rule, from any source, that applies to the target interfaces.

    A row is repeated for every copy of the documents behind it. All tables
    carry copies as counts and the rows are only repeated at the very end.
    """
    hot = inventory.hot
    interfaces = count_copies(target.rows, "n_target")
    of_subnets = hot.on("subnet_sl.subnet_id")

    def lists_of(subnets: DataFrame) -> DataFrame:
        lists = subnet_sl(subnets)
        return keyed_join(lists, target.plain.select("subnet_id"), "subnet_id", "left_semi", of_subnets)

    def members_of(nsgvnic: DataFrame) -> DataFrame:
        members = nsg_vnic_assoc(nsgvnic)
        splits = hot.on("nsgvnic.vnic_id")
        return keyed_join(members, target.plain.select("vnic_id"), "vnic_id", "left_semi", splits)

    def of_policies(table: DataFrame, key: str, policies: DataFrame, column: str) -> DataFrame:
        return keyed_join(table, policies.select(key), key, "left_semi", hot.on(column))

    subnets = in_range(
        inventory.subnets.select(
            "subnet_id", "subnet_name", "vcn_id", "domain_name", "securitylist_ids"
        ),
        "subnet_id",
        target.plain,
    )
    details = count_copies(subnet_details(subnets), "n_subnet")
    placed = keyed_join(
        interfaces, details, "subnet_id", "inner",
        hot.on("vnics.subnet_id"), hot.on("subnets.subnet_id"),
    )
    placed = _times(placed, "n_target", "n_subnet")

    attached = lists_of(subnets)
    lists = count_copies(attached, "n_list")
    listed = in_range(inventory.securitylists, "securitylist_id", attached)
    rules = of_policies(
        count_copies(sl_rules(listed), "n_rule"), "securitylist_id", attached, "sl_rules.securitylist_id"
    )
    from_sl = keyed_join(
        placed, lists, "subnet_id", "inner",
        hot.on("vnics.subnet_id"), hot.on("subnet_sl.subnet_id"),
    )
    from_sl = keyed_join(
        from_sl, rules, "securitylist_id", "inner",
        hot.on("subnet_sl.securitylist_id"), hot.on("sl_rules.securitylist_id"),
    )
    from_sl = _effective(
        _times(from_sl, "copies", "n_list", "n_rule"),
        K.SOURCE_SL, "securitylist_name", "securitylist_id", F.col("rule_no").cast("string"),
    )

    memberships = members_of(in_range(inventory.nsgvnic, "vnic_id", target.plain))
    members = count_copies(memberships, "n_member")
    group_rules = nsg_rules(in_range(inventory.nsgrules, "nsg_id", memberships))
    group_rules = count_copies(group_rules.where(F.col("direction") == K.INGRESS), "n_rule")
    group_rules = of_policies(group_rules, "nsg_id", memberships, "nsgrules.nsg_id")
    names = count_copies(nsg_data(in_range(inventory.nsgdata, "nsg_id", memberships)), "n_name")
    names = of_policies(names, "nsg_id", memberships, "nsgdata.nsg_id")
    named = keyed_join(members, names, "nsg_id", "left", hot.on("nsgvnic.nsg_id"))
    named = _times(named.fillna(1, ["n_name"]), "n_member", "n_name")
    from_nsg = keyed_join(
        placed, named.withColumnRenamed("copies", "n_member"), "vnic_id", "inner",
        hot.on("vnics.vnic_id"), hot.on("nsgvnic.vnic_id"),
    )
    from_nsg = keyed_join(
        from_nsg, group_rules, "nsg_id", "inner",
        hot.on("nsgvnic.nsg_id"), hot.on("nsgrules.nsg_id"),
    )
    from_nsg = _effective(
        _times(from_nsg, "copies", "n_member", "n_rule"),
        K.SOURCE_NSG, "nsg_name", "nsg_id", F.col("rule_id"),
    )
    return from_sl.unionByName(from_nsg)

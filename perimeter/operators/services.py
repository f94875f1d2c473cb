"""Open services as attached: one row per rule and attachment, or their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.operators.attachments import nsg_vnic_assoc, subnet_sl
from perimeter.operators.rules import labelled, nsg_open_rules, sl_open_rules
from perimeter.operators.skew import HotKeys, count_copies, counted_join, keyed_join

_SERVICE = ("protocol", "tcp_port_min", "tcp_port_max", "udp_port_min", "udp_port_max")


def sl_attachments(subnets: DataFrame, scope: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """(list, n): how often each security list is attached in scope, copies counted."""
    ids = scope.select("subnet_id").distinct()
    splits = hot.on("subnet_sl.subnet_id")
    pairs = counted_join(subnet_sl(subnets), ids, "subnet_id", hot_left=splits)
    return pairs.groupBy("securitylist_id").agg(F.sum("n").alias("n"))


def nsg_attachments(
    vnics: DataFrame, nsgvnic: DataFrame, scope: DataFrame, hot: HotKeys = HotKeys()
) -> DataFrame:
    """(group, n): how often each group is attached in scope, copies counted."""
    ids = scope.select("subnet_id").distinct()
    places = vnics.select("vnic_id", "subnet_id")
    places = counted_join(places, ids, "subnet_id", hot_left=hot.on("vnics.subnet_id"))
    per_vnic = places.groupBy("vnic_id").agg(F.sum("n").alias("n_vnics"))
    splits = hot.on("nsgvnic.vnic_id")
    members = nsg_vnic_assoc(nsgvnic)
    members = counted_join(members, per_vnic, "vnic_id", "inner", splits, "n_members")
    return members.groupBy("nsg_id").agg(F.sum(F.col("n_members") * F.col("n_vnics")).alias("n"))


def _counted_services(
    rules: DataFrame, attachments: DataFrame, policy: str, source: str, splits
) -> DataFrame:
    """Rule and attachment counts meet per policy; pairs are multiplied, not listed."""
    per_policy = (
        labelled(rules)
        .groupBy(policy, "protocol", "service")
        .agg(F.count(F.lit(1)).alias("n_rules"))
    )
    return keyed_join(per_policy, attachments, policy, "inner", splits).select(
        F.lit(source).alias("exposure_source"),
        "protocol",
        "service",
        (F.col("n_rules") * F.col("n")).alias("n"),
    )


def counted_services_from_sl(
    subnets: DataFrame, securitylists: DataFrame, scope: DataFrame, hot: HotKeys = HotKeys()
) -> DataFrame:
    """Partial counts of open list rules per service, to be summed."""
    return _counted_services(
        sl_open_rules(securitylists),
        sl_attachments(subnets, scope, hot),
        "securitylist_id",
        K.SOURCE_SL,
        hot.on("sl_rules.securitylist_id"),
    )


def counted_services_from_nsg(
    vnics: DataFrame,
    nsgvnic: DataFrame,
    nsgrules: DataFrame,
    scope: DataFrame,
    hot: HotKeys = HotKeys(),
) -> DataFrame:
    """Partial counts of open group rules per service, to be summed."""
    return _counted_services(
        nsg_open_rules(nsgrules),
        nsg_attachments(vnics, nsgvnic, scope, hot),
        "nsg_id",
        K.SOURCE_NSG,
        hot.on("nsgrules.nsg_id"),
    )


def _listed_services(
    rules: DataFrame, attachments: DataFrame, policy: str, source: str, splits
) -> DataFrame:
    counted = count_copies(rules.select(policy, *_SERVICE), "n_rules")
    return keyed_join(counted, attachments, policy, "inner", splits).select(
        F.lit(source).alias("exposure_source"),
        *_SERVICE,
        (F.col("n_rules") * F.col("n")).alias("copies"),
    )


def services_from_sl(
    subnets: DataFrame, securitylists: DataFrame, scope: DataFrame, hot: HotKeys = HotKeys()
) -> DataFrame:
    """Open list rules as attached in scope; ``copies`` says how often each row counts."""
    return _listed_services(
        sl_open_rules(securitylists),
        sl_attachments(subnets, scope, hot),
        "securitylist_id",
        K.SOURCE_SL,
        hot.on("sl_rules.securitylist_id"),
    )


def services_from_nsg(
    vnics: DataFrame,
    nsgvnic: DataFrame,
    nsgrules: DataFrame,
    scope: DataFrame,
    hot: HotKeys = HotKeys(),
) -> DataFrame:
    """Open group rules as attached in scope; ``copies`` says how often each row counts."""
    return _listed_services(
        nsg_open_rules(nsgrules),
        nsg_attachments(vnics, nsgvnic, scope, hot),
        "nsg_id",
        K.SOURCE_NSG,
        hot.on("nsgrules.nsg_id"),
    )

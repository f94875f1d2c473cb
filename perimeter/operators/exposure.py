"""Which interfaces and subnets a set of policies exposes.

``rules`` below may be any rows with the policy's id; only the ids matter.
Existence tests are semi joins, so neither rules nor attachments multiply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.operators.attachments import nsg_vnic_assoc, subnet_sl, vnic_data
from perimeter.operators.skew import HotKeys, keyed_join, set_join


def attached_to(subnets: DataFrame, rules: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """(subnet, list) pairs, in any scope, of lists that have one of the rules."""
    policies = rules.select("securitylist_id").distinct()
    splits = hot.on("subnet_sl.securitylist_id")
    return set_join(subnet_sl(subnets), policies, "securitylist_id", hot_left=splits)


def members_of(nsgvnic: DataFrame, rules: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """(group, interface) pairs of groups that have one of the rules."""
    policies = rules.select("nsg_id").distinct()
    return set_join(nsg_vnic_assoc(nsgvnic), policies, "nsg_id", hot_left=hot.on("nsgvnic.nsg_id"))


def places_of(
    vnics: DataFrame, nsgvnic: DataFrame, rules: DataFrame, hot: HotKeys = HotKeys()
) -> DataFrame:
    """(interface, subnet) pairs, in any scope, of the members of such groups."""
    members = members_of(nsgvnic, rules, hot).select("vnic_id").distinct()
    places = vnics.select("vnic_id", "subnet_id")
    return set_join(places, members, "vnic_id", hot_left=hot.on("vnics.vnic_id"))


def vnics_in_scope(vnics: DataFrame, scope: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """Distinct interfaces of the subnets in ``scope``, with the subnet's columns."""
    interfaces = vnic_data(vnics).distinct()
    return keyed_join(interfaces, scope, "subnet_id", "inner", hot.on("vnics.subnet_id"))


def _tagged(ids: DataFrame, key: str, source: str) -> DataFrame:
    return ids.select(key).distinct().withColumn("exposure_source", F.lit(source))


def _located(vnics: DataFrame, subnet_ids: DataFrame, hot: HotKeys) -> DataFrame:
    """(interface, subnet) pairs of the given subnets."""
    places = vnics.select("vnic_id", "subnet_id")
    ids = subnet_ids.select("subnet_id").distinct()
    return set_join(places, ids, "subnet_id", hot_left=hot.on("vnics.subnet_id"))


def _subnets_by_sl(
    scope: DataFrame, subnets: DataFrame, rules: DataFrame, hot: HotKeys
) -> DataFrame:
    exposed = attached_to(subnets, rules, hot).select("subnet_id").distinct()
    in_scope = scope.select("subnet_id")
    return set_join(in_scope, exposed, "subnet_id", hot_left=hot.on("subnets.subnet_id"))


def vnic_flags(
    vnics: DataFrame,
    subnets: DataFrame,
    nsgvnic: DataFrame,
    scope: DataFrame,
    sl: DataFrame,
    nsg: DataFrame,
    hot: HotKeys = HotKeys(),
) -> DataFrame:
    """Exposed interfaces with a flag per source; those by group in any scope."""
    by_sl = _located(vnics, _subnets_by_sl(scope, subnets, sl, hot), hot)
    return _flags(by_sl, members_of(nsgvnic, nsg, hot), "vnic_id")


def subnet_flags(
    vnics: DataFrame,
    subnets: DataFrame,
    nsgvnic: DataFrame,
    sl: DataFrame,
    nsg: DataFrame,
    hot: HotKeys = HotKeys(),
) -> DataFrame:
    """Exposed subnets in any scope with a flag per source."""
    return _flags(attached_to(subnets, sl, hot), places_of(vnics, nsgvnic, nsg, hot), "subnet_id")


def vnics_exposed_by_sl(
    vnics: DataFrame,
    subnets: DataFrame,
    scope: DataFrame,
    rules: DataFrame,
    hot: HotKeys = HotKeys(),
) -> DataFrame:
    """Interfaces in scope whose subnet has a list with one of the rules, each once."""
    exposed = _located(vnics, _subnets_by_sl(scope, subnets, rules, hot), hot)
    return _tagged(exposed, "vnic_id", K.SOURCE_SL)


def vnics_exposed_by_nsg(
    vnics: DataFrame,
    nsgvnic: DataFrame,
    scope: DataFrame,
    rules: DataFrame,
    hot: HotKeys = HotKeys(),
) -> DataFrame:
    """Interfaces in scope that belong to a group with one of the rules, each once."""
    places = places_of(vnics, nsgvnic, rules, hot)
    ids = scope.select("subnet_id").distinct()
    exposed = set_join(places, ids, "subnet_id", hot_left=hot.on("vnics.subnet_id"))
    return _tagged(exposed, "vnic_id", K.SOURCE_NSG)


def subnets_exposed_by_sl(
    subnets: DataFrame, scope: DataFrame, rules: DataFrame, hot: HotKeys = HotKeys()
) -> DataFrame:
    """Subnets in scope with a list that has one of the rules, each once."""
    return _tagged(_subnets_by_sl(scope, subnets, rules, hot), "subnet_id", K.SOURCE_SL)


def subnets_exposed_by_nsg(
    vnics: DataFrame,
    nsgvnic: DataFrame,
    scope: DataFrame,
    rules: DataFrame,
    hot: HotKeys = HotKeys(),
) -> DataFrame:
    """Subnets in scope with an interface in a group with one of the rules, each once."""
    exposed = places_of(vnics, nsgvnic, rules, hot).select("subnet_id").distinct()
    in_scope = scope.select("subnet_id")
    found = set_join(in_scope, exposed, "subnet_id", hot_left=hot.on("subnets.subnet_id"))
    return _tagged(found, "subnet_id", K.SOURCE_NSG)


def _flags(by_sl: DataFrame, by_nsg: DataFrame, key: str) -> DataFrame:
    # Repeated ids combine before the shuffle, and grouping by the id alone
    # leaves the rows placed for the join that follows.
    rows = by_sl.select(key, F.lit(True).alias("_sl"), F.lit(False).alias("_nsg")).unionByName(
        by_nsg.select(key, F.lit(False).alias("_sl"), F.lit(True).alias("_nsg"))
    )
    return rows.groupBy(key).agg(F.bool_or("_sl").alias("_sl"), F.bool_or("_nsg").alias("_nsg"))


def exposure_sources() -> Column:
    """One row per source whose flag is set."""
    sources = F.array(
        F.when(F.col("_sl"), F.lit(K.SOURCE_SL)), F.when(F.col("_nsg"), F.lit(K.SOURCE_NSG))
    )
    return F.explode(F.array_compact(sources)).alias("exposure_source")

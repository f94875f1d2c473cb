"""The 22 reports: nine per scope, two cleanups and two lookups.

Inputs are made distinct before they meet, narrow and partially combined, so
joins work on sets, never repeat a pair, and need no distinct over the wide
result. ``ordered=False`` leaves out the final sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.operators.attachments import (
    nsg_details,
    nsg_vnic_assoc,
    sl_details,
    subnet_sl,
    vnic_data,
)
from perimeter.operators.exposure import (
    exposure_sources,
    members_of,
    subnet_flags,
    vnic_flags,
    vnics_in_scope,
)
from perimeter.operators.lookup import Target, effective_rules, target_by_id, target_by_ip
from perimeter.operators.rules import (
    case_flags,
    case_text,
    labelled,
    nsg_insecure_rules,
    nsg_other_rules,
    sl_insecure_ids,
    sl_insecure_rules,
    sl_other_ids,
    sl_other_rules,
)
from perimeter.operators.scope import SUBNET, SUBNET_WITH_FLAG, scope_subnets
from perimeter.operators.services import counted_services_from_nsg, counted_services_from_sl
from perimeter.operators.skew import Salts, counted_join, expand_copies, keyed_join, set_join
from perimeter.sources.inventory import Inventory


def _by(*names: str) -> list:
    return [F.col(n).asc_nulls_last() for n in names]


def _order(rows: DataFrame, *names: str) -> list:
    # The other columns break ties: the order is then the same in every run,
    # and rows that share the named columns can still go to several tasks.
    return _by(*names, *(c for c in rows.columns if c not in (*names, "copies")))


def _sorted(rows: DataFrame, ordered: bool, *names: str) -> DataFrame:
    return rows.orderBy(*_order(rows, *names)) if ordered else rows


def _scope(inventory: Inventory, scope: str, columns: tuple[str, ...]) -> DataFrame:
    return scope_subnets(inventory.subnets, inventory.routes, scope, columns, inventory.hot)


# Rules on subnets and interfaces


def _sl_rules_in_scope(inventory: Inventory, scope: str, rules: DataFrame) -> DataFrame:
    hot = inventory.hot
    attached = keyed_join(
        _scope(inventory, scope, SUBNET_WITH_FLAG), subnet_sl(inventory.subnets).distinct(),
        "subnet_id", "inner", hot.on("subnets.subnet_id"), hot.on("subnet_sl.subnet_id"),
    )
    return keyed_join(
        attached, rules.distinct(), "securitylist_id", "inner",
        hot.on("subnet_sl.securitylist_id"), hot.on("sl_rules.securitylist_id"),
    )


# Rules of a group that travel in one row with an interface.
RULES_PER_ROW = 64


def _packed(rules: DataFrame, hot: Salts) -> DataFrame:
    """nsg_id, rules: the distinct rules of a group in their order, some dozen a row; those of hot groups one by one.

    A group that isn't hot has few enough rules for one task to list them.
    """
    fields = [c for c in rules.columns if c != "nsg_id"]
    keys = [k for k in hot if k is not None]
    whole = rules.where(~F.col("nsg_id").isin(keys)) if keys else rules
    # What is missing comes last, as in the sort.
    placed = F.struct(*(c for f in fields for c in (F.col(f).isNull().alias(f"no_{f}"), F.col(f))))
    listed = F.transform(F.sort_array(F.collect_list(placed)), lambda r: F.struct(*(r[f].alias(f) for f in fields)))
    packed = whole.groupBy("nsg_id").agg(listed.alias("rules")).select(
        "nsg_id",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("rules"), F.lit(RULES_PER_ROW)),
                lambda n: F.slice("rules", n, RULES_PER_ROW),
            )
        ).alias("rules"),
    )
    if not keys:
        return packed
    single = rules.where(F.col("nsg_id").isin(keys)).select("nsg_id", F.array(F.struct(*fields)).alias("rules"))
    return packed.unionByName(single)


def _with_several(interfaces: DataFrame, hot: Salts) -> DataFrame:
    """Interfaces with ``several``: whether their id has other rows, too. Hot ids have."""
    keys = [k for k in hot if k is not None]
    whole = interfaces.where(~F.col("vnic_id").isin(keys)) if keys else interfaces
    others = F.struct(*(c for c in interfaces.columns if c != "vnic_id"))
    listed = whole.groupBy("vnic_id").agg(F.collect_list(others).alias("_rows"))
    counted = listed.select("vnic_id", (F.size("_rows") > 1).alias("several"), F.inline("_rows"))
    if not keys:
        return counted
    return counted.unionByName(interfaces.where(F.col("vnic_id").isin(keys)).withColumn("several", F.lit(True)))


def _nsg_rules_in_scope(
    inventory: Inventory, scope: str, rules: DataFrame, ordered: bool, names: dict[str, str], first: tuple[str, ...]
) -> DataFrame:
    """Interfaces in scope with the rules of their groups, sorted by ``first``; ``names`` are the rules' columns.

    The rows are many more than interfaces and rules, so rules of a group stay together until after the sort.
    """
    # Interfaces are wide and many: keep only members of such groups before
    # anything else moves them.
    hot = inventory.hot
    rules = rules.select("nsg_id", *names).distinct()
    members = members_of(inventory.nsgvnic, rules, hot).distinct()
    exposed = set_join(
        vnic_data(inventory.vnics), members.select("vnic_id").distinct(), "vnic_id",
        hot_left=hot.on("vnics.vnic_id"),
    )
    interfaces = vnics_in_scope(exposed, _scope(inventory, scope, SUBNET), hot)
    if ordered:
        interfaces = _with_several(interfaces, hot.on("vnics.vnic_id"))
    attached = keyed_join(
        interfaces, members, "vnic_id", "inner",
        hot.on("vnics.vnic_id"), hot.on("nsgvnic.vnic_id"),
    )
    found = keyed_join(
        attached, _packed(rules, hot.on("nsgrules.nsg_id")), "nsg_id", "inner",
        hot.on("nsgvnic.nsg_id"), hot.on("nsgrules.nsg_id"),
    )
    shown = (*_ON_VNIC, "nsg_id")
    if ordered:
        # Rows of one interface and group that differ in the interface take turns rule by rule. Where there is
        # but one, its rules follow each other as they are packed.
        one_by_one = F.transform("rules", lambda r: F.array(r))
        parts = F.when(F.col("several"), one_by_one).otherwise(F.array("rules"))
        found = found.select(*shown, F.explode(parts).alias("rules"))
        at = {shown_as: F.col("rules")[0][name] for name, shown_as in names.items()}
        rest = (c for c in (*shown, *names.values()) if c not in first)
        found = found.orderBy(*(at.get(c, F.col(c)).asc_nulls_last() for c in (*first, *rest)))
    return found.select(*shown, F.inline("rules")).withColumnsRenamed(names)


_ON_SUBNET = ("securitylist_name", "securitylist_id", "subnet_name", "subnet_id")
_ON_VNIC = (
    "vnic_id",
    "vnic_name",
    "subnet_id",
    "subnet_name",
    "route_table_id",
    "private_ip",
    "public_ip",
)


def insecure_sl(inventory: Inventory, scope: str, ordered: bool = True) -> DataFrame:
    """Insecure security-list rules that apply to a subnet in scope."""
    rules = sl_insecure_rules(inventory.securitylists).select(
        "securitylist_id", "securitylist_name", "rule_no", "insecure_case"
    )
    found = _sl_rules_in_scope(inventory, scope, rules).select(
        *_ON_SUBNET,
        F.col("prohibit_public_ip_on_vnic").alias("prohibitPublicIpOnVnic"),
        "route_table_id",
        F.col("rule_no").alias("insecure_rule_number"),
        "insecure_case",
    )
    return _sorted(
        found, ordered, "subnet_id", "securitylist_id", "insecure_rule_number", "insecure_case"
    )


def insecure_nsg(inventory: Inventory, scope: str, ordered: bool = True) -> DataFrame:
    """Insecure group rules that apply to an interface in scope."""
    rules = nsg_insecure_rules(inventory.nsgrules).select("nsg_id", "rule_id", "insecure_case")
    names = {"rule_id": "insecure_rule_id", "insecure_case": "insecure_case"}
    first = ("vnic_id", "nsg_id", "insecure_rule_id", "insecure_case")
    return _nsg_rules_in_scope(inventory, scope, rules, ordered, names, first)


def other_sl(inventory: Inventory, scope: str, ordered: bool = True) -> DataFrame:
    """Open security-list rules in scope that are not insecure, by service."""
    rules = labelled(sl_other_rules(inventory.securitylists))
    found = _sl_rules_in_scope(inventory, scope, rules).select(
        *_ON_SUBNET,
        F.col("prohibit_public_ip_on_vnic").alias("prohibitPublicIpOnVnic"),
        "route_table_id",
        F.col("rule_no").alias("rule_number"),
        "protocol",
        "service",
    )
    return _sorted(found, ordered, "subnet_id", "securitylist_id", "rule_number")


def other_nsg(inventory: Inventory, scope: str, ordered: bool = True) -> DataFrame:
    """Open group rules in scope that are not insecure, by service."""
    rules = labelled(nsg_other_rules(inventory.nsgrules)).drop("direction")
    names = {name: name for name in ("rule_id", "protocol", "service")}
    return _nsg_rules_in_scope(inventory, scope, rules, ordered, names, ("vnic_id", "nsg_id", "rule_id"))


# Exposed interfaces and subnets


def _exposed_vnics(
    inventory: Inventory, scope: str, sl: DataFrame, nsg: DataFrame, ordered: bool
) -> DataFrame:
    hot = inventory.hot
    subnets = _scope(inventory, scope, SUBNET)
    flags = vnic_flags(
        inventory.vnics, inventory.subnets, inventory.nsgvnic, subnets, sl, nsg, hot
    )
    exposed = set_join(
        vnic_data(inventory.vnics), flags, "vnic_id", "inner", hot.on("vnics.vnic_id")
    )
    found = keyed_join(exposed.distinct(), subnets, "subnet_id", "inner", hot.on("vnics.subnet_id"))
    return _sorted(
        found.select(*_ON_VNIC, exposure_sources()), ordered, "vnic_id", "exposure_source"
    )


def _exposed_subnets(
    inventory: Inventory, scope: str, sl: DataFrame, nsg: DataFrame, ordered: bool
) -> DataFrame:
    hot = inventory.hot
    flags = subnet_flags(inventory.vnics, inventory.subnets, inventory.nsgvnic, sl, nsg, hot)
    subnets = _scope(inventory, scope, SUBNET)
    found = keyed_join(subnets, flags, "subnet_id", "inner", hot.on("subnets.subnet_id"))
    return _sorted(
        found.select(*SUBNET, exposure_sources()), ordered, "subnet_id", "exposure_source"
    )


def insecure_vnics(inventory: Inventory, scope: str, ordered: bool = True) -> DataFrame:
    """Interfaces in scope with any insecure rule, per source of exposure."""
    return _exposed_vnics(
        inventory,
        scope,
        sl_insecure_ids(inventory.securitylists),
        nsg_insecure_rules(inventory.nsgrules),
        ordered,
    )


def insecure_subnets(inventory: Inventory, scope: str, ordered: bool = True) -> DataFrame:
    """Subnets in scope with any insecure rule, per source of exposure."""
    return _exposed_subnets(
        inventory,
        scope,
        sl_insecure_ids(inventory.securitylists),
        nsg_insecure_rules(inventory.nsgrules),
        ordered,
    )


def other_vnics(inventory: Inventory, scope: str, ordered: bool = True) -> DataFrame:
    """Interfaces in scope with any other open rule, per source of exposure."""
    return _exposed_vnics(
        inventory,
        scope,
        sl_other_ids(inventory.securitylists),
        nsg_other_rules(inventory.nsgrules),
        ordered,
    )


def other_subnets(inventory: Inventory, scope: str, ordered: bool = True) -> DataFrame:
    """Subnets in scope with any other open rule, per source of exposure."""
    return _exposed_subnets(
        inventory,
        scope,
        sl_other_ids(inventory.securitylists),
        nsg_other_rules(inventory.nsgrules),
        ordered,
    )


def service_summary(inventory: Inventory, scope: str, ordered: bool = True) -> DataFrame:
    """How often each open service occurs in scope, per source of exposure."""
    hot = inventory.hot
    subnets = _scope(inventory, scope, ("subnet_id", "route_table_id"))
    counted = counted_services_from_sl(
        inventory.subnets, inventory.securitylists, subnets, hot
    ).unionByName(
        counted_services_from_nsg(
            inventory.vnics, inventory.nsgvnic, inventory.nsgrules, subnets, hot
        )
    )
    summary = counted.groupBy("exposure_source", "protocol", "service").agg(
        F.sum("n").alias("total_occurrences")
    )
    if not ordered:
        return summary
    return summary.orderBy(
        *_by("exposure_source"),
        F.col("total_occurrences").desc(),
        *_by("protocol", "service"),
    )


# Policies attached to nothing


def _unused(
    details: DataFrame, attached: DataFrame, rules: DataFrame, policy: str, splits, columns, ordered
) -> DataFrame:
    # Attachments and rules say two things about a policy, so they are folded
    # into one row per policy and met in one join.
    marks = attached.select(
        policy, F.lit(True).alias("_used"), F.lit(None).cast("string").alias("insecure_case")
    ).unionByName(rules.select(policy, F.lit(False).alias("_used"), "insecure_case"))
    marks = marks.groupBy(policy).agg(F.bool_or("_used").alias("_used"), *case_flags())
    marked = counted_join(details, marks, policy, "left", splits, "copies")
    unused = marked.where(~F.coalesce("_used", F.lit(False))).select(
        *columns,
        "vcn_id",
        "compartment_id",
        "lifecycle_state",
        "time_created",
        F.coalesce(case_text(), F.lit(K.CASE_NONE)).alias("cis_insecure_case"),
        "copies",
    )
    return expand_copies(unused, "copies", _order(unused, *columns) if ordered else None)


def unused_sl(inventory: Inventory, ordered: bool = True) -> DataFrame:
    """Security lists attached to no subnet, with their insecure cases."""
    return _unused(
        sl_details(inventory.securitylists),
        subnet_sl(inventory.subnets),
        sl_insecure_rules(inventory.securitylists),
        "securitylist_id",
        inventory.hot.on("securitylists.securitylist_id"),
        ("securitylist_name", "securitylist_id"),
        ordered,
    )


def unused_nsg(inventory: Inventory, ordered: bool = True) -> DataFrame:
    """Groups attached to no interface, with their insecure cases."""
    return _unused(
        nsg_details(inventory.nsgdata),
        nsg_vnic_assoc(inventory.nsgvnic),
        nsg_insecure_rules(inventory.nsgrules),
        "nsg_id",
        inventory.hot.on("nsgdata.nsg_id"),
        ("nsg_name", "nsg_id"),
        ordered,
    )


# Lookups


def _lookup(inventory: Inventory, target: Target, ordered: bool) -> DataFrame:
    rules = effective_rules(inventory, target)
    order = _order(rules, "rule_source", "policy_name", "rule_id")
    return expand_copies(rules, "copies", order if ordered else None)


def lookup_vnic(inventory: Inventory, vnic_id: str, ordered: bool = True) -> DataFrame:
    """Every ingress rule effective on one interface."""
    return _lookup(inventory, target_by_id(inventory, vnic_id), ordered)


def lookup_ip(inventory: Inventory, ip_address: str, ordered: bool = True) -> DataFrame:
    """Every ingress rule effective on the interfaces that own an address."""
    return _lookup(inventory, target_by_ip(inventory, ip_address), ordered)


SCOPED_REPORTS = {
    "insecure_sl": insecure_sl,
    "insecure_nsg": insecure_nsg,
    "insecure_vnics": insecure_vnics,
    "insecure_subnets": insecure_subnets,
    "service_summary": service_summary,
    "other_sl": other_sl,
    "other_nsg": other_nsg,
    "other_vnics": other_vnics,
    "other_subnets": other_subnets,
}

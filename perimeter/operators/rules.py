"""Firewall rules of security lists and of network security groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.functions import scalars

RULE_FIELDS = (
    "source",
    "protocol",
    "has_tcp",
    "tcp_port_min",
    "tcp_port_max",
    "udp_port_min",
    "udp_port_max",
)

def labelled(rules: DataFrame) -> DataFrame:
    """Rules with ports replaced by ``service`` and the protocol by its label."""
    ports = [c for c in RULE_FIELDS if c.endswith(("_min", "_max"))]
    return rules.withColumns(
        {"service": scalars.service_label(), "protocol": scalars.protocol_label()}
    ).drop("source", "has_tcp", *ports)


def sl_rules(securitylists: DataFrame) -> DataFrame:
    """One row per ingress rule; ``rule_no`` is its place in the document, from 1."""
    return securitylists.selectExpr(
        "securitylist_id", "securitylist_name", "posexplode(ingress_rules) AS (_pos, _rule)"
    ).selectExpr(
        "securitylist_id", "securitylist_name", "CAST(_pos + 1 AS BIGINT) AS rule_no", "_rule.*"
    )


def sl_open_rules(securitylists: DataFrame) -> DataFrame:
    """Ingress rules open to any address."""
    return sl_rules(securitylists).where(scalars.is_open())


def sl_rule_cases(securitylists: DataFrame) -> DataFrame:
    """Every ingress rule with its ``insecure_case``, NULL when it has none."""
    return sl_rules(securitylists).withColumn("insecure_case", scalars.insecure_case())


def sl_insecure_rules(securitylists: DataFrame) -> DataFrame:
    """Over-permissive open rules with their case."""
    return sl_rule_cases(securitylists.where("has_insecure")).where("insecure_case IS NOT NULL")


def sl_other_rules(securitylists: DataFrame) -> DataFrame:
    """Open rules that are not insecure."""
    return sl_rules(securitylists.where("has_other")).where(scalars.is_other())


def sl_insecure_ids(securitylists: DataFrame) -> DataFrame:
    """Lists with an insecure rule, without taking the rules apart."""
    return securitylists.where("has_insecure").select("securitylist_id")


def sl_other_ids(securitylists: DataFrame) -> DataFrame:
    """Lists with an open rule that is not insecure."""
    return securitylists.where("has_other").select("securitylist_id")


def nsg_rules(nsgrules: DataFrame) -> DataFrame:
    """Group rules, any direction."""
    return nsgrules.select("nsg_id", "rule_id", "direction", *RULE_FIELDS)


def nsg_open_rules(nsgrules: DataFrame) -> DataFrame:
    """Group ingress rules open to any address."""
    return nsg_rules(nsgrules).where(scalars.is_open(direction="direction"))


def nsg_rule_cases(nsgrules: DataFrame) -> DataFrame:
    """Every group rule with its ``insecure_case``, NULL when it has none."""
    return nsgrules.select("nsg_id", "rule_id", "direction", *RULE_FIELDS, "insecure_case")


def nsg_insecure_rules(nsgrules: DataFrame) -> DataFrame:
    """Over-permissive open group rules with their case."""
    return nsg_rule_cases(nsgrules).where("insecure_case IS NOT NULL")


def nsg_insecure_flags(nsgrules: DataFrame) -> DataFrame:
    """Distinct (group, ``INSECURE`` or NULL): what the group's rules amount to."""
    flag = F.when(F.col("insecure_case").isNotNull(), K.FLAG_INSECURE).alias("insecure_flag")
    return nsg_rule_cases(nsgrules).select("nsg_id", flag).distinct()


def nsg_other_rules(nsgrules: DataFrame) -> DataFrame:
    """Open group ingress rules that are not insecure."""
    return nsg_rules(nsgrules.where("is_other"))


_CASES = (K.CASE_ALL, K.CASE_SSH, K.CASE_RDP)


def case_flags() -> list[Column]:
    """One aggregate per possible case: whether a policy has it.

    With three cases this gives the ordered list in one aggregation that
    combines before the shuffle, instead of a distinct and then a list.
    """
    return [F.bool_or(F.col("insecure_case") == case).alias(f"_case_{case}") for case in _CASES]


def case_text() -> Column:
    """The cases of ``case_flags`` as text, NULL when there is none."""
    named = [F.when(F.col(f"_case_{case}"), F.lit(case)) for case in _CASES]
    return F.nullif(F.concat_ws(K.CASE_SEPARATOR, *named), F.lit(""))


def case_list(
    rules: DataFrame, policy: str, order: Sequence[str] = _CASES, case: str = "insecure_case"
) -> DataFrame:
    """(policy, cis_insecure_case): the distinct cases of each policy as ordered text.

    Cases come in the given order, others after them by their text; there may be any number.
    Rules without case add nothing, and a policy with none has no row. Equal cases are combined
    before anything moves, so a policy of many rules brings no more rows than cases.
    """
    place = F.array_position(F.array(*map(F.lit, order)), F.col("_case"))
    held = (
        rules.select(F.col(policy), F.col(case).alias("_case"))
        .where(F.col("_case").isNotNull())
        .distinct()
        .withColumn("_place", F.when(place > 0, place))
    )
    listed = f"listagg(_case, '{K.CASE_SEPARATOR}') WITHIN GROUP (ORDER BY _place ASC NULLS LAST, _case)"
    return held.groupBy(policy).agg(F.expr(listed).alias("cis_insecure_case"))


def sl_insecure_agg(securitylists: DataFrame) -> DataFrame:
    """Insecure cases of each security list as text, in the order ALL, 22, 3389."""
    return case_list(sl_insecure_rules(securitylists), "securitylist_id")


def nsg_insecure_agg(nsgrules: DataFrame) -> DataFrame:
    """Insecure cases of each group as text, in the order ALL, 22, 3389."""
    return case_list(nsg_insecure_rules(nsgrules), "nsg_id")

"""Which subnets a report is about: those reachable from the internet, or not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimeter.operators.skew import HotKeys, keyed_join

PUBLIC = "public"
PRIVATE = "private"

SUBNET = ("subnet_id", "subnet_name", "route_table_id")
SUBNET_WITH_FLAG = (*SUBNET, "prohibit_public_ip_on_vnic")


def igw_route_tables(routes: DataFrame) -> DataFrame:
    """Route tables with a route to an internet gateway, each once."""
    return routes.where("has_igw").select("route_table_id").distinct()


def scope_subnets(
    subnets: DataFrame,
    routes: DataFrame,
    scope: str,
    columns: tuple[str, ...] = SUBNET_WITH_FLAG,
    hot: HotKeys = HotKeys(),
) -> DataFrame:
    """Distinct ``columns`` of the subnets in scope; must include the route table.

    Documents with equal ``columns`` become one row first, remembering whether
    any of them allows and whether any prohibits public addresses. The scope
    of a row depends on nothing else, so the result needs no second distinct.
    """
    if scope not in (PUBLIC, PRIVATE):
        raise ValueError(f"scope must be {PUBLIC!r} or {PRIVATE!r}, not {scope!r}")
    flag = F.coalesce("prohibit_public_ip_on_vnic", F.lit(""))
    wanted = F.lit("false" if scope == PUBLIC else "true")
    # A plain equality, which the scan of stored files can use.
    allowed = F.col("prohibit_public_ip_on_vnic") == wanted
    rows = subnets if scope == PRIVATE else subnets.where(allowed)
    rows = rows.groupBy(*columns).agg(F.bool_or(flag == wanted).alias("_flagged"))
    gateways = igw_route_tables(routes)
    hot_left = hot.on("subnets.route_table_id")
    if scope == PUBLIC:
        rows = keyed_join(rows, gateways, "route_table_id", "left_semi", hot_left)
    else:
        marked = gateways.withColumn("_gateway", F.lit(True))
        rows = keyed_join(rows, marked, "route_table_id", "left", hot_left)
        rows = rows.where(F.col("_flagged") | F.col("_gateway").isNull())
    return rows.select(*columns)


def public_subnets(subnets: DataFrame, routes: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """Subnets that route to an internet gateway and allow public addresses."""
    return scope_subnets(subnets, routes, PUBLIC, hot=hot)


def private_subnets(subnets: DataFrame, routes: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """Subnets that prohibit public addresses or have no internet gateway route."""
    return scope_subnets(subnets, routes, PRIVATE, hot=hot)

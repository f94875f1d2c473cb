"""Interfaces and group members that lie together, so that reports on both move neither.

Interfaces with their subnets, and the members of groups with open rules, are written in buckets of
``vnic_id``. The rule reports of groups (``insecure_nsg``, ``other_nsg``) join them where they lie and
move only the pairs found, once, to the rules of their group. What the reports of both scopes and kinds
compute alike (distinct interfaces, subnets in scope, which groups matter) is computed once, as bits.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimeter.operators.attachments import nsg_vnic_assoc, vnic_data
from perimeter.operators.rules import labelled, nsg_insecure_rules, nsg_other_rules
from perimeter.operators.skew import keyed_join
from perimeter.plans.lattice import INSECURE, KINDS, OTHER, SCOPES, scoped_subnets
from perimeter.sources.inventory import Inventory

_ON_VNIC = ("vnic_id", "vnic_name", "subnet_id", "subnet_name", "route_table_id", "private_ip", "public_ip")
_SCHEMAS = {
    "interfaces": ", ".join([*(f"{c} string" for c in _ON_VNIC), "scopes int"]),
    "members": "nsg_id string, vnic_id string, kinds int",
}
_LAYOUT = "layout"


def _interfaces(inventory: Inventory) -> DataFrame:
    """Distinct interfaces of subnets in any scope."""
    vnics = vnic_data(inventory.vnics.where("vnic_id IS NOT NULL")).distinct()
    rows = keyed_join(vnics, scoped_subnets(inventory), "subnet_id", "inner", inventory.hot.on("vnics.subnet_id"))
    return rows.select(*_ON_VNIC, F.col("scopes").cast("int").alias("scopes"))


def _members(inventory: Inventory) -> DataFrame:
    """Distinct (group, interface) pairs of groups with open rules, and the kinds of those."""
    marked = inventory.nsgrules.where("insecure_case IS NOT NULL OR is_other")
    bits = f"IF(insecure_case IS NOT NULL, {KINDS[INSECURE]}, 0) | IF(is_other, {KINDS[OTHER]}, 0)"
    kinds = marked.groupBy("nsg_id").agg(F.bit_or(F.expr(bits)).alias("kinds"))
    pairs = nsg_vnic_assoc(inventory.nsgvnic.where("vnic_id IS NOT NULL AND nsg_id IS NOT NULL")).distinct()
    rows = keyed_join(pairs, kinds, "nsg_id", "inner", inventory.hot.on("nsgvnic.nsg_id"))
    return rows.select("nsg_id", "vnic_id", F.col("kinds").cast("int").alias("kinds"))


def _bucketed(spark: SparkSession, path: str, name: str, buckets: int) -> str:
    """A catalog table, of a name of its own, over the files of a folder."""
    table, location = f"{name}_{uuid.uuid4().hex}", path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({_SCHEMAS[name]}) USING parquet "
        f"CLUSTERED BY (vnic_id) SORTED BY (vnic_id) INTO {buckets} BUCKETS LOCATION '{location}/{name}'"
    )
    return table


@dataclass(frozen=True)
class Colocated:
    """Stored interfaces and members, and the inventory whose rules they meet.

    Interfaces that the inventory measured as hot would fill a bucket; their rows lie in tables
    of their own (``hot``), unbucketed, and are joined with their keys split.
    """

    inventory: Inventory
    interfaces: DataFrame
    members: DataFrame
    hot: tuple[DataFrame, DataFrame] | None

    @classmethod
    def store(cls, inventory: Inventory, path: str, buckets: int | None = None) -> Colocated:
        """Write the tables; as many buckets as shuffle partitions unless their number is given."""
        spark = inventory.vnics.sparkSession
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        hot = {*inventory.hot.on("vnics.vnic_id"), *inventory.hot.on("nsgvnic.vnic_id")} - {None}
        keys = spark.createDataFrame([(k,) for k in sorted(hot)], "vnic_id string")
        for name, rows in (("interfaces", _interfaces(inventory)), ("members", _members(inventory))):
            if hot:
                rows.join(keys, "vnic_id", "left_semi").select(*rows.columns).write.parquet(f"{path}/hot_{name}")
                rows = rows.join(keys, "vnic_id", "left_anti").select(*rows.columns)
            table = _bucketed(spark, path, name, buckets)
            rows.repartition(buckets, "vnic_id").write.insertInto(table)
        layout = spark.createDataFrame([(buckets, bool(hot))], "buckets int, hot boolean")
        layout.coalesce(1).write.parquet(f"{path}/{_LAYOUT}")
        return cls.open(inventory, path)

    @classmethod
    def open(cls, inventory: Inventory, path: str) -> Colocated:
        """Tables written by ``store``, entered in the session's catalog under new names."""
        spark = inventory.vnics.sparkSession
        layout = spark.read.parquet(f"{path}/{_LAYOUT}").first()
        tables = [spark.table(_bucketed(spark, path, name, layout["buckets"])) for name in _SCHEMAS]
        hot = None
        if layout["hot"]:
            hot = tuple(spark.read.schema(s).parquet(f"{path}/hot_{name}") for name, s in _SCHEMAS.items())
        return cls(inventory, *tables, hot)

    def _attached(self, scope: str, kind: str) -> DataFrame:
        """Interfaces in scope with each of their groups that has rules of the kind."""
        if scope not in SCOPES:
            raise ValueError(f"scope must be one of {', '.join(map(repr, SCOPES))}, not {scope!r}")

        def held(interfaces: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
            return (
                interfaces.where(F.col("scopes").bitwiseAND(SCOPES[scope]) > 0).drop("scopes"),
                members.where(F.col("kinds").bitwiseAND(KINDS[kind]) > 0).drop("kinds"),
            )

        left, right = held(self.interfaces, self.members)
        found = left.join(right, "vnic_id")
        if self.hot:
            splits = self.inventory.hot
            left, right = held(*self.hot)
            also = keyed_join(
                left, right, "vnic_id", "inner", splits.on("vnics.vnic_id"), splits.on("nsgvnic.vnic_id")
            )
            found = found.unionByName(also)
        return found

    def _with_rules(self, scope: str, kind: str, rules: DataFrame, columns: list, ordered: bool) -> DataFrame:
        hot = self.inventory.hot
        attached = self._attached(scope, kind)
        found = keyed_join(
            attached, rules.distinct(), "nsg_id", "inner", hot.on("nsgvnic.nsg_id"), hot.on("nsgrules.nsg_id")
        ).select(*_ON_VNIC, "nsg_id", *columns)
        if not ordered:
            return found
        first = ["vnic_id", *found.columns[len(_ON_VNIC) : len(_ON_VNIC) + 2]]
        if kind == INSECURE:
            first.append("insecure_case")
        rest = (c for c in found.columns if c not in first)
        return found.orderBy(*(F.col(c).asc_nulls_last() for c in (*first, *rest)))

    def insecure_nsg(self, scope: str, ordered: bool = True) -> DataFrame:
        """The rows of ``reports.insecure_nsg``."""
        rules = nsg_insecure_rules(self.inventory.nsgrules).select("nsg_id", "rule_id", "insecure_case")
        columns = [F.col("rule_id").alias("insecure_rule_id"), "insecure_case"]
        return self._with_rules(scope, INSECURE, rules, columns, ordered)

    def other_nsg(self, scope: str, ordered: bool = True) -> DataFrame:
        """The rows of ``reports.other_nsg``."""
        rules = labelled(nsg_other_rules(self.inventory.nsgrules)).drop("direction")
        return self._with_rules(scope, OTHER, rules, ["rule_id", "protocol", "service"], ordered)

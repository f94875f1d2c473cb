"""All eight exposure reports from one pass over the interfaces.

Whether an interface or a subnet is exposed depends on three things: the scope of the subnet
(public, private), the kind of rule (insecure, other) and where it comes from (security list,
group). Every combination is a bit. Bits are joined to the interfaces once and combined per
interface and per subnet with ``bit_or``; a report is then a filter on two bits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perimeter.operators.attachments import nsg_vnic_assoc, subnet_sl, vnic_data
from perimeter.operators.exposure import exposure_sources
from perimeter.operators.scope import PRIVATE, PUBLIC, SUBNET, scope_subnets
from perimeter.operators.skew import HotKeys, keyed_join
from perimeter.sources.inventory import Inventory

INSECURE, OTHER = "insecure", "other"
KINDS = {INSECURE: 1, OTHER: 2}
SCOPES = {PUBLIC: 1, PRIVATE: 2}
# Places of the two bits of kinds: by group, and by list of a subnet in either scope.
_BY_GROUP, _BY_LIST = 0, {PUBLIC: 2, PRIVATE: 4}

_ON_VNIC = ("vnic_id", "vnic_name", "subnet_id", "subnet_name", "route_table_id", "private_ip", "public_ip")


def _kinds(insecure: str, other: str) -> Column:
    return F.expr(f"IF({insecure}, {KINDS[INSECURE]}, 0) | IF({other}, {KINDS[OTHER]}, 0)")


def _combined(rows: DataFrame, key: str, bits: str) -> DataFrame:
    return rows.groupBy(key).agg(F.bit_or(bits).alias(bits))


def list_kinds(inventory: Inventory) -> DataFrame:
    """subnet_id, listed: kinds of rules in the lists attached to a subnet."""
    hot = inventory.hot
    marked = inventory.securitylists.where("has_insecure OR has_other")
    kinds = _combined(
        marked.select("securitylist_id", _kinds("has_insecure", "has_other").alias("listed")),
        "securitylist_id",
        "listed",
    )
    attached = keyed_join(
        subnet_sl(inventory.subnets).distinct(), kinds, "securitylist_id", "inner",
        hot.on("subnet_sl.securitylist_id"),
    )
    return _combined(attached, "subnet_id", "listed")


def group_kinds(inventory: Inventory) -> DataFrame:
    """vnic_id, grouped: kinds of rules in the groups an interface belongs to."""
    hot = inventory.hot
    marked = inventory.nsgrules.where("insecure_case IS NOT NULL OR is_other")
    kinds = _combined(
        marked.select("nsg_id", _kinds("insecure_case IS NOT NULL", "is_other").alias("grouped")),
        "nsg_id",
        "grouped",
    )
    members = keyed_join(
        nsg_vnic_assoc(inventory.nsgvnic).distinct(), kinds, "nsg_id", "inner", hot.on("nsgvnic.nsg_id")
    )
    return _combined(members, "vnic_id", "grouped")


def scoped_subnets(inventory: Inventory) -> DataFrame:
    """The distinct subnets of both scopes, with a bit per scope."""
    rows = [
        scope_subnets(inventory.subnets, inventory.routes, name, SUBNET, inventory.hot).withColumn(
            "scopes", F.lit(bit)
        )
        for name, bit in SCOPES.items()
    ]
    return rows[0].unionByName(rows[1]).groupBy(*SUBNET).agg(F.bit_or("scopes").alias("scopes"))


def vnic_lattice(inventory: Inventory) -> DataFrame:
    """Exposed interfaces in each subnet row of either scope, with ``scopes`` and ``mask``.

    Bits belong to the id: those that any document of an interface earns hold for all of them.
    Interfaces without any bit are left out, as no report shows them.
    """
    hot: HotKeys = inventory.hot
    subnets = scoped_subnets(inventory)
    zero = F.lit(0)
    places = (
        subnets.select("subnet_id", "scopes", zero.alias("listed"))
        .unionByName(list_kinds(inventory).select("subnet_id", zero.alias("scopes"), "listed"))
        .groupBy("subnet_id")
        .agg(F.bit_or("scopes").alias("place_scopes"), F.bit_or("listed").alias("listed"))
    )
    rows = vnic_data(inventory.vnics).where("vnic_id IS NOT NULL").distinct()
    rows = keyed_join(rows, group_kinds(inventory), "vnic_id", "left", hot.on("vnics.vnic_id"))
    rows = keyed_join(rows, places, "subnet_id", "left", hot.on("vnics.subnet_id"))
    mask = F.coalesce("grouped", zero)
    for name, bit in SCOPES.items():
        listed = F.when(F.col("place_scopes").bitwiseAND(bit) != 0, F.shiftleft("listed", _BY_LIST[name]))
        mask = mask.bitwiseOR(F.coalesce(listed, zero))
    whole = F.bit_or("own").over(W.partitionBy("vnic_id"))
    rows = rows.withColumn("own", mask).withColumn("mask", whole).where("mask <> 0")
    found = keyed_join(rows.drop("grouped", "place_scopes", "listed", "own"), subnets, "subnet_id", "inner", hot.on("vnics.subnet_id"))
    return found.select(*_ON_VNIC, "scopes", "mask")


def subnet_lattice(inventory: Inventory, vnics: DataFrame) -> DataFrame:
    """Subnet rows of either scope with ``scopes`` and ``mask``, from the written interfaces."""
    by_group = F.col("mask").bitwiseAND(sum(KINDS.values()))
    both = sum(1 << place for place in _BY_LIST.values())
    kinds = (
        vnics.select("subnet_id", by_group.alias("mask"))
        .unionByName(list_kinds(inventory).select("subnet_id", (F.col("listed") * both).alias("mask")))
    )
    found = keyed_join(
        scoped_subnets(inventory), _combined(kinds, "subnet_id", "mask"), "subnet_id", "inner",
        inventory.hot.on("subnets.subnet_id"),
    )
    return found.where("mask <> 0").select(*SUBNET, "scopes", "mask")


@dataclass(frozen=True)
class Lattice:
    """The two written tables; reports read nothing else."""

    vnics: DataFrame
    subnets: DataFrame

    @classmethod
    def store(cls, inventory: Inventory, path: str, mode: str = "errorifexists") -> Lattice:
        """Writes both tables. The interfaces of the inventory are read once."""
        spark = inventory.vnics.sparkSession
        vnics = vnic_lattice(inventory)
        vnics.write.mode(mode).parquet(f"{path}/vnics")
        written = spark.read.schema(vnics.schema).parquet(f"{path}/vnics")
        subnet_lattice(inventory, written).write.mode(mode).parquet(f"{path}/subnets")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Lattice:
        return cls(spark.read.parquet(f"{path}/vnics"), spark.read.parquet(f"{path}/subnets"))

    def exposed_vnics(self, scope: str, kind: str, ordered: bool = True) -> DataFrame:
        """Interfaces in scope with any rule of the kind, per source of exposure."""
        found = _report(self.vnics, scope, kind, _ON_VNIC)
        return found.orderBy(*_by("vnic_id", "exposure_source", *_ON_VNIC[1:])) if ordered else found

    def exposed_subnets(self, scope: str, kind: str, ordered: bool = True) -> DataFrame:
        """Subnets in scope with any rule of the kind, per source of exposure."""
        found = _report(self.subnets, scope, kind, SUBNET)
        return found.orderBy(*_by("subnet_id", "exposure_source", *SUBNET[1:])) if ordered else found


def _by(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _report(rows: DataFrame, scope: str, kind: str, columns: tuple[str, ...]) -> DataFrame:
    if scope not in SCOPES or kind not in KINDS:
        raise ValueError(f"no exposure of {kind!r} rules in scope {scope!r}")

    def has(column: str, bits: int) -> Column:
        return F.col(column).bitwiseAND(bits) != 0

    by_list, by_group = KINDS[kind] << _BY_LIST[scope], KINDS[kind] << _BY_GROUP
    chosen = rows.where(has("scopes", SCOPES[scope]) & has("mask", by_list | by_group))
    flagged = chosen.select(*columns, has("mask", by_list).alias("_sl"), has("mask", by_group).alias("_nsg"))
    return flagged.select(*columns, exposure_sources())

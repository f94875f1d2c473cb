"""The cleanup reports between exports: signed changes per policy instead of whole runs.

What decides whether a policy is unused are facts about it: its attachments, its insecure cases and
its descriptions, each with a count. Every export adds the signed differences to the facts known
before, and the signed rows by which the list of unused policies changes. Both sum up to
the state after the last export. Only policies with a difference are looked at again, and only
differences are written, so an export like the one before it adds next to nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.operators.attachments import nsg_details, nsg_vnic_assoc, sl_details, subnet_sl
from perimeter.operators.rules import case_list, nsg_insecure_rules, sl_insecure_rules
from perimeter.operators.skew import expand_copies, keyed_join
from perimeter.sources.inventory import Inventory

_ATTACHED, _CASE, _DESCRIBED = "attached", "case", "described"
_DETAILS = ("vcn_id", "compartment_id", "lifecycle_state", "time_created")
_FACT = ("policy", "fact", "insecure_case", "name", *_DETAILS)
_ROW = ("name", "policy", *_DETAILS, "cis_insecure_case")
_TURN_SCHEMA = "number long, turn string, export string, whole boolean"


def _schema(columns: tuple[str, ...]) -> str:
    return ", ".join([*(f"{c} string" for c in columns), "n long"])


@dataclass(frozen=True)
class _Kind:
    policy: str
    name: str

    def facts(self, inventory: Inventory) -> DataFrame:
        """Every fact of an export with its count; what names no policy tells nothing about one."""
        if self.policy == "securitylist_id":
            details = sl_details(inventory.securitylists)
            attached, cases = subnet_sl(inventory.subnets), sl_insecure_rules(inventory.securitylists)
        else:
            details = nsg_details(inventory.nsgdata)
            attached, cases = nsg_vnic_assoc(inventory.nsgvnic), nsg_insecure_rules(inventory.nsgrules)
        named = F.col(self.policy).isNotNull()
        rows = (
            self._as(attached.where(named), _ATTACHED)
            .unionByName(self._as(cases.where(named), _CASE, insecure_case="insecure_case"))
            .unionByName(self._as(details, _DESCRIBED, name=self.name, **{c: c for c in _DETAILS}))
        )
        return rows.groupBy(*_FACT).agg(F.count(F.lit(1)).alias("n"))

    def _as(self, rows: DataFrame, fact: str, **columns: str) -> DataFrame:
        found = {"policy": F.col(self.policy), "fact": F.lit(fact)}
        found |= {c: F.col(columns[c]) if c in columns else F.lit(None).cast("string") for c in _FACT[2:]}
        return rows.select(*(found[c].alias(c) for c in _FACT))


KINDS = {"sl": _Kind("securitylist_id", "securitylist_name"), "nsg": _Kind("nsg_id", "nsg_name")}


def _summed(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Signed rows added up; what cancels out is gone."""
    return rows.groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")


def _minus(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n", -F.col("n"))


def _of(rows: DataFrame, policies: DataFrame) -> DataFrame:
    """Rows of these policies; a missing policy counts as one of its own."""
    wanted = policies.select(F.col("policy").alias("_wanted"))
    return rows.join(wanted, F.col("policy").eqNullSafe(F.col("_wanted")), "left_semi")


def _unused(facts: DataFrame) -> DataFrame:
    """Unused policies by their facts, one row per description with its copies as ``n``."""
    used = facts.where((F.col("fact") == _ATTACHED) & (F.col("n") > 0)).select("policy", F.lit(True).alias("_used"))
    held = facts.where((F.col("fact") == _CASE) & (F.col("n") > 0))
    marks = (
        used.withColumn("cis_insecure_case", F.lit(None).cast("string"))
        .unionByName(case_list(held, "policy").withColumn("_used", F.lit(False)))
        .groupBy("policy")
        .agg(F.bool_or("_used").alias("_used"), F.max("cis_insecure_case").alias("cis_insecure_case"))
    )
    described = facts.where((F.col("fact") == _DESCRIBED) & (F.col("n") > 0)).select("policy", "name", *_DETAILS, "n")
    marked = keyed_join(described, marks, "policy", "left").where(~F.coalesce("_used", F.lit(False)))
    case = F.coalesce("cis_insecure_case", F.lit(K.CASE_NONE)).alias("cis_insecure_case")
    return marked.select("name", "policy", *_DETAILS, case, "n")


class CleanupLedger:
    """Signed facts and signed report rows of one kind of policy (``sl`` or ``nsg``) below ``path``.

    Each export has a name and counts once: a repeated one changes nothing. Its changes are written in
    full before they are put in force, so a broken-off export changes nothing and can be
    repeated. One driver at a time may write. There are as many folders to read as
    exports since the last ``compact``.
    """

    def __init__(self, spark: SparkSession, path: str, kind: str) -> None:
        if kind not in KINDS:
            raise ValueError(f"kind must be one of {', '.join(map(repr, KINDS))}, not {kind!r}")
        self.spark, self.path, self.kind = spark, f"{path}/{kind}", KINDS[kind]

    def take(self, inventory: Inventory, export: str) -> bool:
        """A whole new export; False if one of this name was taken before."""
        if export in self.exports():
            return False
        return self._add(export, _summed(self.kind.facts(inventory).unionByName(_minus(self._facts())), _FACT))

    def revise(self, attached: DataFrame, export: str) -> bool:
        """Signed attachments (policy, n) since the last export, where no whole export is at hand.

        Reads no inventory. A policy counts as used while its attachments sum up to more than none.
        """
        if export in self.exports():
            return False
        rows = attached.where("policy IS NOT NULL AND n IS NOT NULL").select(
            F.col("policy").cast("string").alias("policy"),
            F.lit(_ATTACHED).alias("fact"),
            *(F.lit(None).cast("string").alias(c) for c in _FACT[2:]),
            F.col("n").cast("long").alias("n"),
        )
        return self._add(export, _summed(rows, _FACT))

    def exports(self) -> list[str]:
        """Names of the exports taken, in their order."""
        return [r["export"] for r in self._turns() if r["export"] is not None]

    def attachments(self) -> DataFrame:
        """(policy, n): how often each attached policy is."""
        return self._facts().where((F.col("fact") == _ATTACHED) & (F.col("n") > 0)).select("policy", "n")

    def unused(self, ordered: bool = True) -> DataFrame:
        """The rows of ``reports.unused_sl`` or ``unused_nsg`` after the last export."""
        rows = self._named(_summed(self._read("unused", _ROW), _ROW))
        first = [self.kind.name, self.kind.policy]
        order = [F.col(c).asc_nulls_last() for c in (*first, *(c for c in rows.columns if c not in (*first, "n")))]
        return expand_copies(rows, "n", order if ordered else None)

    def changes(self, export: str) -> DataFrame:
        """By how many copies (``n``) an export changed each row of the report: what became unused, and what no more.

        A row whose case or description changed is there twice. Exports before the last ``compact`` have none.
        """
        since = {r["export"]: r["turn"] for r in self._in_force()}
        if export not in since:
            raise ValueError(f"no changes of an export {export!r} are kept")
        return self._named(self._read("unused", _ROW, [since[export]]))

    def compact(self) -> None:
        """Fold all changes into one folder; the report stays as it is."""
        if len(self._in_force()) > 1:
            self._write(None, _summed(self._facts(), _FACT), _summed(self._read("unused", _ROW), _ROW))

    def _named(self, rows: DataFrame) -> DataFrame:
        return rows.withColumnsRenamed({"name": self.kind.name, "policy": self.kind.policy})

    def _add(self, export: str, changes: DataFrame) -> bool:
        turn = uuid.uuid4().hex
        changes = self._store("facts", turn, changes, _FACT)
        policies = changes.select("policy").distinct()
        now = _summed(_of(self._read("facts", _FACT).unionByName(changes), policies), _FACT)
        before = _of(self._read("unused", _ROW), policies)
        self._store("unused", turn, _summed(_unused(now).unionByName(_minus(before)), _ROW), _ROW)
        self._enforce(turn, export)
        return True

    def _write(self, export: str | None, facts: DataFrame, unused: DataFrame) -> None:
        turn = uuid.uuid4().hex
        self._store("facts", turn, facts, _FACT)
        self._store("unused", turn, unused, _ROW)
        self._enforce(turn, export, whole=True)

    def _store(self, name: str, turn: str, rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        rows.write.parquet(f"{self.path}/{name}/{turn}")
        return self.spark.read.schema(_schema(columns)).parquet(f"{self.path}/{name}/{turn}")

    def _enforce(self, turn: str, export: str | None, whole: bool = False) -> None:
        number = 1 + max((r["number"] for r in self._turns()), default=0)
        row = self.spark.createDataFrame([(number, turn, export, whole)], _TURN_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/turns")

    def _turns(self) -> list:
        """One small row per export so far, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/turns")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return []
        rows = self.spark.read.schema(_TURN_SCHEMA).parquet(f"{self.path}/turns").collect()
        return sorted(rows, key=lambda r: r["number"])

    def _in_force(self) -> list:
        """Turns whose changes add up to the state: those from the last whole one on."""
        turns = self._turns()
        return turns[max((n for n, r in enumerate(turns) if r["whole"]), default=0) :]

    def _facts(self) -> DataFrame:
        return _summed(self._read("facts", _FACT), _FACT)

    def _read(self, name: str, columns: tuple[str, ...], turns: list[str] | None = None) -> DataFrame:
        if turns is None:
            turns = [r["turn"] for r in self._in_force()]
        if not turns:
            return self.spark.createDataFrame([], _schema(columns))
        return self.spark.read.schema(_schema(columns)).parquet(*(f"{self.path}/{name}/{t}" for t in turns))

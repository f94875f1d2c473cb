"""Per-session workspace: exports written from the tables, and their inventory.

The flow is the one of a real run. Documents are written as per-region
JSON-lines exports, consolidated, typed, stored as parquet and opened again.
Each collection takes it when a query first reads it, whole; a query waits for no other. Those that a
query names are exported by one job and stored side by side.
"""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.operators.skew import Salts
from perimeter.plans.lattice import Lattice
from perimeter.sources.documents import packed
from perimeter.sources.inventory import Inventory
from perimeter.sources.loading import load_regional
from perimeter.sources.regions import consolidate_lines
from perimeter.testbed import fixtures

TENANCY = "tenancy-a"
REGIONS = tuple(f"region-{n}" for n in range(5))
MISSING_REGION = "region-9"
FAILED_REGION = "region-4"

# An interface and addresses that occur at every scale factor.
LOOKUP_VNIC = "vnic-50"
LOOKUP_PRIVATE_IP = "10.0.0.51"
LOOKUP_PUBLIC_IP = "198.18.0.51"


def _root(spark: SparkSession) -> str:
    """Shared folder of the cluster; a local one only for a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    warnings.warn("spark.checkpoint.dir is not set; using a local folder", stacklevel=2)
    return tempfile.mkdtemp(prefix="perimeter-")


# Collections that queries on rules of subnets, of interfaces and of both read together.
ON_SUBNETS = ("subnets", "routes", "securitylists")
ON_VNICS = ("subnets", "routes", "vnics", "nsgvnic", "nsgrules")
EXPOSURE = (*ON_VNICS, "securitylists")

# Files that a task of the export keeps open: those of all regions, so that lines need no sort.
OPEN_FILES = 64
# While the exports are written. Nothing is inferred from the join of lists and rules, as a filter below it would keep
# group rules and lists from sharing the shuffle of the line items; what was shuffled is removed when the job ends.
_WHILE_EXPORTED = {
    "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES),
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
# While a load is stored: what its jobs shuffled is removed as each ends, so reports don't share the disk with it.
_WHILE_LOADED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Tables that rows of join columns are made of, where they aren't named by the table.
_MADE_OF = {"subnet_sl": "subnets", "sl_rules": "securitylists"}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold for a while."""
    kept = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


class HotOnUse:
    """The measured hot keys of the tables that a query reads."""

    def __init__(self, load: Callable[[str], Inventory]) -> None:
        self._load = load

    def on(self, column: str) -> Salts:
        table = column.split(".")[0]
        return self._load(_MADE_OF.get(table, table)).hot.on(column)


class InventoryOnUse:
    """Stands for the inventory where a query reads some tables: each is loaded on its first use."""

    def __init__(self, load: Callable[[str], Inventory]) -> None:
        self._load, self.hot = load, HotOnUse(load)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in K.COLLECTIONS:
            raise AttributeError(name)
        return getattr(self._load(name), name)

    def rows_with(self, name: str, value: str) -> DataFrame:
        return self._load(name).rows_with(name, value)


class Workspace:
    """Everything derived from one folder of base tables; written on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = f"{_root(spark)}/perimeter-{uuid.uuid4().hex}"
        self._exported: set[str] = set()
        self._loaded: dict[str, Inventory] = {}

    @property
    def export_dir(self) -> str:
        """Folder with ``<collection>-<tenancy>-<region>.jsonl`` for all regions."""
        return self.exports(*K.COLLECTIONS)

    def exports(self, *names: str) -> str:
        """The folder of exports, with at least these collections."""
        path = f"{self.root}/exports"
        missing = [name for name in names if name not in self._exported]
        if missing:
            self._write_exports(missing, path)
            self._exported.update(missing)
        return path

    def _write_exports(self, names: list[str], path: str) -> None:
        files, documents = [], fixtures.documents(self.spark, self.sf_dir)
        for name in names:
            lines = fixtures.json_lines(name, documents[name])
            if name == "vnics":
                lines = lines.unionByName(fixtures.broken_lines(lines))
            if name == "publicips":
                lines = fixtures.with_trailing_text(lines)
            file_name = F.concat_ws(
                "-", F.lit(name), F.lit(TENANCY), F.concat("region", F.lit(".jsonl"))
            )
            files.append(lines.select(file_name.alias("export"), "value"))
        staged = f"{path}-{uuid.uuid4().hex}"
        with _settings(self.spark, _WHILE_EXPORTED):
            writer = reduce(DataFrame.unionByName, files).write.partitionBy("export")
            writer.options(**packed("gzip")).text(staged)
        self._name_exports(staged, path)

    def _name_exports(self, staged: str, path: str) -> None:
        """Folders ``export=<name>`` become ``<name>``, as an export names its files."""
        for name in self._entries(staged):
            if name.startswith("export="):
                self._move(f"{staged}/{name}", f"{path}/{name.removeprefix('export=')}")

    def _at(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _entries(self, path: str) -> list[str]:
        folder, system = self._at(path)
        return [status.getPath().getName() for status in system.listStatus(folder)]

    def _move(self, source: str, target: str) -> None:
        folder, system = self._at(target)
        system.mkdirs(folder.getParent())
        if not system.rename(self._at(source)[0], folder):
            raise OSError(f"{source} can't become {target}")

    @cached_property
    def consolidated_dir(self) -> str:
        """Folder with ``<collection>.jsonl`` over all regions."""
        path = f"{self.root}/consolidated"
        consolidate_lines(self.spark, self.export_dir, path, TENANCY, compression="gzip")
        return path

    def only(self, *names: str) -> Inventory:
        """Stored typed tables of these collections with their hot keys measured; no others."""
        missing = tuple(name for name in names if name not in self._loaded)
        if missing:
            # At a place of its own: what a stopped load left behind must not count with the next one's rows.
            place = f"{self.tables_dir}-{uuid.uuid4().hex}"
            exports = self.exports(*missing)
            with _settings(self.spark, _WHILE_LOADED):
                load_regional(
                    self.spark,
                    exports,
                    TENANCY,
                    place,
                    include=(*REGIONS, MISSING_REGION),
                    failed_regions=[FAILED_REGION],
                    require=False,
                    collections=missing,
                )
            self._take(place, missing)
            self._loaded |= {name: Inventory.open(self.spark, self.tables_dir, [name]) for name in missing}
        return Inventory.open(self.spark, self.tables_dir, names)

    def _take(self, place: str, names: tuple[str, ...]) -> None:
        """Moves a load that is whole to the others; what was measured and counted is in files of all loads."""
        for entry in self._entries(place):
            if entry in names:
                self._move(f"{place}/{entry}", f"{self.tables_dir}/{entry}")
                continue
            for file in self._entries(f"{place}/{entry}"):
                if file.startswith("part-"):
                    self._move(f"{place}/{entry}/{file}", f"{self.tables_dir}/{entry}/{file}")

    def _load(self, name: str) -> Inventory:
        if name not in self._loaded:
            self.only(name)
        return self._loaded[name]

    @cached_property
    def inventory(self) -> Inventory:
        """All nine stored typed tables with their hot keys measured."""
        return self.only(*K.COLLECTIONS)

    def loaded(self, *names: str) -> InventoryOnUse:
        """``on_use`` after loading together those of these collections that are still missing."""
        missing = [name for name in dict.fromkeys(names) if name not in self._loaded]
        if missing:
            self.only(*missing)
        return self.on_use

    @cached_property
    def on_use(self) -> InventoryOnUse:
        """The inventory for queries that read some of its tables."""
        return InventoryOnUse(self._load)

    @property
    def tables_dir(self) -> str:
        """Folder of the stored tables and what was counted while they were loaded."""
        return f"{self.root}/tables"

    @cached_property
    def lattice(self) -> Lattice:
        """Exposure of both scopes and kinds, from one pass over the stored interfaces."""
        return Lattice.store(self.loaded(*EXPOSURE), f"{self.root}/lattice")

    def new_path(self) -> str:
        return f"{self.root}/out-{uuid.uuid4().hex}"


_WORKSPACES: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of this application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WORKSPACES:
        _WORKSPACES[key] = Workspace(spark, sf_dir)
    return _WORKSPACES[key]

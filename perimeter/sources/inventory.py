"""The nine typed tables of one inventory, and where they come from."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.operators.skew import ROWS_PER_TASK, HotKeys, measure_hot_keys
from perimeter.sources.clustered import FILE_BYTES, FileRanges, store_ranges, write_clustered
from perimeter.sources.documents import load_collections
from perimeter.sources.regions import consolidate_regions
from perimeter.sources.tables import SEARCHED_COLUMNS, SORT_COLUMN, table_schema, typed


def _weight(column: str, key: str, rows: str = "1") -> str:
    weight = f"CAST({rows} AS BIGINT)"
    return f"named_struct('column', '{column}', 'key', {key}, 'weight', {weight})"


def _weights(table: str, *keys: str) -> str:
    return ", ".join(_weight(f"{table}.{key}", key) for key in keys)


# Per table, the join keys of a row and how many rows each brings to a join.
_JOIN_KEYS = {
    "subnets": f"""concat(
        array({_weights("subnets", "route_table_id", "subnet_id")},
          {_weight("subnet_sl.subnet_id", "subnet_id",
                   "coalesce(array_size(securitylist_ids), 0)")}),
        transform(coalesce(securitylist_ids, array()),
          i -> {_weight("subnet_sl.securitylist_id", "i")}))""",
    "securitylists": f"""array({_weights("securitylists", "securitylist_id")},
        {_weight("sl_rules.securitylist_id", "securitylist_id",
                 "coalesce(array_size(ingress_rules), 0)")})""",
    "vnics": f"array({_weights('vnics', 'vnic_id', 'subnet_id')})",
    "nsgdata": f"array({_weights('nsgdata', 'nsg_id')})",
    "nsgvnic": f"array({_weights('nsgvnic', 'nsg_id', 'vnic_id')})",
    "nsgrules": f"array({_weights('nsgrules', 'nsg_id')})",
    "privateips": f"array({_weights('privateips', 'private_ip_id')})",
}


TABLES_AT_ONCE = 4
_HOT_KEYS, _FILE_RANGES = "hot_keys", "file_ranges"


@dataclass(frozen=True)
class Inventory:
    """Typed tables plus the hot keys measured on them (none until ``profiled``)."""

    routes: DataFrame
    subnets: DataFrame
    securitylists: DataFrame
    vnics: DataFrame
    nsgdata: DataFrame
    nsgrules: DataFrame
    nsgvnic: DataFrame
    privateips: DataFrame
    publicips: DataFrame
    hot: HotKeys = field(default_factory=HotKeys)
    ranges: FileRanges = field(default_factory=FileRanges)

    @classmethod
    def from_documents(
        cls, documents: Mapping[str, DataFrame], collections: Iterable[str] = K.COLLECTIONS
    ) -> Inventory:
        """Type the documents of the nine collections; of those named only, the other tables are None."""
        tables: dict[str, DataFrame | None] = dict.fromkeys(K.COLLECTIONS)
        return cls(**tables | {name: typed(name, documents[name]) for name in collections})

    @classmethod
    def from_jsonl(
        cls, spark: SparkSession, directory: str, allow_missing: bool = False
    ) -> Inventory:
        """Consolidated files ``<directory>/<collection>.jsonl``."""
        return cls.from_documents(load_collections(spark, directory, allow_missing))

    @classmethod
    def from_regional_jsonl(
        cls,
        spark: SparkSession,
        directory: str,
        tenancy: str,
        include: str | Iterable[str] = (),
        skip: str | None = None,
        allow_missing: bool = False,
    ) -> Inventory:
        """Per-region files of one tenancy; every table keeps the region."""
        found = consolidate_regions(spark, directory, tenancy, include, skip, allow_missing)
        return cls.from_documents(found)

    @classmethod
    def open(cls, spark: SparkSession, path: str, collections: Iterable[str] = K.COLLECTIONS) -> Inventory:
        """Tables written by ``store``; those of other collections are None."""

        def read(name: str) -> DataFrame:
            return spark.read.schema(table_schema(spark, name)).parquet(f"{path}/{name}")

        collections = set(collections)
        tables = {name: read(name) if name in collections else None for name in K.COLLECTIONS}
        ranges = FileRanges.open(spark, path, f"{path}/{_FILE_RANGES}")
        return cls(**tables, hot=HotKeys.open(spark, f"{path}/{_HOT_KEYS}"), ranges=ranges)

    def tables(self) -> dict[str, DataFrame]:
        return {name: t for name in K.COLLECTIONS if (t := getattr(self, name)) is not None}

    def rows_with(self, name: str, value: str) -> DataFrame:
        """Rows of a table whose sort column has this value.

        Of stored tables only the files whose key range holds the value are opened, one per
        region at most.
        """
        table, wanted = getattr(self, name), F.col(SORT_COLUMN[name]) == F.lit(value)
        if name not in self.ranges.files or value is None:
            return table.where(wanted)
        paths = self.ranges.paths(name, value)
        if not paths:
            return table.sparkSession.createDataFrame([], table.schema)
        reader = table.sparkSession.read.schema(table.schema)
        return reader.option("basePath", f"{self.ranges.root}/{name}").parquet(*paths).where(wanted)

    def store(self, path: str, mode: str = "errorifexists", file_bytes: int = FILE_BYTES) -> None:
        """Write typed parquet, partitioned by region and clustered by the column lookups start from.

        ``file_bytes`` bounds the number of files; see ``write_clustered``.
        """

        def write(name: str, table: DataFrame) -> None:
            searched = SEARCHED_COLUMNS.get(name, ())
            write_clustered(table, f"{path}/{name}", SORT_COLUMN[name], searched, file_bytes, mode)

        # Several at once: the last tasks of one table then don't leave the other cores idle.
        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            list(pool.map(write, *zip(*self.tables().items(), strict=True)))
        spark = next(iter(self.tables().values())).sparkSession
        schemas = {name: t.schema for name, t in self.tables().items()}
        keys = {name: SORT_COLUMN[name] for name in schemas}
        store_ranges(spark, path, keys, schemas, f"{path}/{_FILE_RANGES}", mode)
        written = {name: spark.read.schema(s).parquet(f"{path}/{name}") for name, s in schemas.items()}
        replace(self, **written).profiled().hot.store(spark, f"{path}/{_HOT_KEYS}", mode)

    def profiled(self, rows_per_task: int = ROWS_PER_TASK) -> Inventory:
        """The same tables with their hot join keys measured, reading each table once.

        ``store`` does so and keeps the result; ``open`` reads it.
        """
        weighted = [t.selectExpr(f"inline({_JOIN_KEYS[name]})") for name, t in self.tables().items() if name in _JOIN_KEYS]
        if not weighted:
            return replace(self, hot=HotKeys())
        return replace(self, hot=measure_hot_keys(reduce(DataFrame.unionByName, weighted), rows_per_task))

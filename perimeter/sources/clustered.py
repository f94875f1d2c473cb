"""Typed tables written so that a key lies in one file per region.

Rows are staged once, as parsing twice would cost more; the staged bytes give the number of
files. They are then dealt out by ranges of (region, key) and sorted, so file sizes follow the
data and equal keys of a region share a file. Columns that are searched but not sorted by get
parquet bloom filters. The key range of every file is kept next to the tables, so a lookup
opens only the files that can hold its key, without touching the footers of the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perimeter.sources.documents import REGION_COLUMN

# Bytes of parquet that a file should have; one region's copies of one key may exceed it. One task
# sorts and writes a file: packed ids take some ten times these bytes as rows.
FILE_BYTES = 16 << 20

_RANGE_SCHEMA = "collection string, file string, low string, high string"


@dataclass(frozen=True)
class FileRange:
    """A file below its table's folder and the smallest and largest key in it."""

    file: str
    low: str
    high: str


@dataclass(frozen=True)
class FileRanges:
    """Key ranges of all files, per collection; as many as the stored bytes make files."""

    root: str = ""
    files: Mapping[str, list[FileRange]] = field(default_factory=dict)

    def paths(self, collection: str, key: str) -> list[str]:
        """Files that can hold the key. Text compares by code points here as in the files."""
        found = self.files.get(collection, [])
        return [f"{self.root}/{collection}/{f.file}" for f in found if f.low <= key <= f.high]

    @classmethod
    def open(cls, spark: SparkSession, root: str, path: str) -> FileRanges:
        found: dict[str, list[FileRange]] = {}
        for row in spark.read.schema(_RANGE_SCHEMA).parquet(path).collect():
            found.setdefault(row["collection"], [])
            if row["low"] is not None:
                found[row["collection"]].append(FileRange(row["file"], row["low"], row["high"]))
        return cls(root, found)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _bytes(spark: SparkSession, path: str) -> int:
    folder, system = _file_system(spark, path)
    return system.getContentSummary(folder).getLength()


def write_clustered(
    table: DataFrame,
    path: str,
    key: str,
    searched: tuple[str, ...] = (),
    file_bytes: int = FILE_BYTES,
    mode: str = "errorifexists",
) -> None:
    """Parquet partitioned by region, in files of about ``file_bytes`` that don't share keys.

    At most one file per ``file_bytes`` and one more per region are written. Rows without key
    lie together at the start of their region.
    """
    spark = table.sparkSession
    staging = f"{path}-staged-{uuid.uuid4().hex}"
    table.write.parquet(staging)
    files = max(1, -(-_bytes(spark, staging) // file_bytes))
    staged = spark.read.schema(table.schema).parquet(staging)
    rows = staged.repartitionByRange(files, REGION_COLUMN, key).sortWithinPartitions(REGION_COLUMN, key)
    writer = rows.write.mode(mode).partitionBy(REGION_COLUMN)
    for column in searched:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
    folder, system = _file_system(spark, staging)
    system.delete(folder, True)


def store_ranges(
    spark: SparkSession, root: str, keys: Mapping[str, str], schemas: Mapping[str, T.StructType], path: str, mode: str
) -> None:
    """The key range of each file of the tables below ``root``, from their key columns alone."""

    def ranges(collection: str, key: str) -> DataFrame:
        rows = spark.read.schema(schemas[collection]).parquet(f"{root}/{collection}")
        return (
            rows.select(F.col("_metadata.file_path").alias("file"), F.col(key).alias("key"))
            .groupBy("file")
            .agg(F.min("key").alias("low"), F.max("key").alias("high"))
            .select(F.lit(collection).alias("collection"), "file", "low", "high")
        )

    found = reduce(DataFrame.unionByName, (ranges(c, k) for c, k in keys.items())).collect()
    rows = [
        (r["collection"], unquote("/".join(r["file"].split("/")[-2:])), r["low"], r["high"]) for r in found
    ]
    spark.createDataFrame(rows, _RANGE_SCHEMA).coalesce(1).write.mode(mode).parquet(path)

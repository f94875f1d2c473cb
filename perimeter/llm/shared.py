"""Helpers of the corpus operators: shared folder, written intermediate tables, column names."""

from __future__ import annotations

import gc
import tempfile
import uuid
import warnings

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of a text: runs of anything but blank, tab and line ends.
WORD = r"[^\x20\x09-\x0D]+"
# Column that operators add to the caller's own ones.
KEY = "__key"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        warnings.warn("spark.checkpoint.dir is not set; using a local folder", stacklevel=2)
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="perimeter-llm-")
    return _LOCAL[context.applicationId]


class Scratch:
    """Tables written to the shared folder during one run of an operator.

    They replace long lineages: a lost executor only costs the tasks it ran.
    Tables behind a returned frame stay; ``drop`` removes those no longer read.
    Once a table is written, the shuffle files that led to it are garbage; Spark
    deletes them when the driver collects its own, so it is told to.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def store(self, rows: DataFrame, name: str = "table", *partition_by: str) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{name}-{self._count}"
        rows.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
        stored = self.spark.read.schema(rows.schema).parquet(path)
        del rows
        self.release()
        return stored

    def bucketed(self, rows: DataFrame, name: str, *keys: str) -> DataFrame:
        """A table that joins on ``keys`` read without moving it."""
        self._count += 1
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"{name}_{uuid.uuid4().hex}"
        writer = rows.repartition(buckets, *keys).write.option("path", f"{self.root}/{name}-{self._count}")
        writer.option("compression", "zstd").bucketBy(buckets, *keys).saveAsTable(table)
        self.release()
        return self.spark.table(table)

    def release(self) -> None:
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                conf = self.spark.sparkContext._jsc.hadoopConfiguration()
                path.getFileSystem(conf).delete(path, True)


def small_table(spark: SparkSession, schema: pa.Schema, rows: list[dict]) -> DataFrame:
    """A table of driver rows, of bounded number."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def ascii_lower(text: Column) -> Column:
    """Only A-Z are lowered; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_key(documents: DataFrame, doc_id: str, text: str, scratch: Scratch) -> tuple[DataFrame, bool]:
    """Adds ``KEY``, unique and in the order of doc_id; tells whether it is the id itself.

    Where ids repeat, are missing or negative, rows are sorted by id (missing ones last) and
    text, and numbered. The numbered rows are written, as their numbers must not change.
    """
    ids = documents.select(F.col(doc_id).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    if not ids.where("n > 1 OR id IS NULL OR id < 0").limit(1).count():
        return documents.withColumn(KEY, F.col(doc_id).cast("long")), True
    order = [F.col(doc_id).asc_nulls_last(), F.col(text).asc_nulls_first()]
    sorted_rows = documents.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.store(sorted_rows.withColumn(KEY, F.monotonically_increasing_id()), "keyed"), False

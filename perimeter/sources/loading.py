"""Exports read once: typed, stored and counted in the same pass.

The counters are metrics of the job that stages a collection. That job has no shuffle, and Spark
counts each of its tasks once however often it runs, so they stay exact when executors are lost.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.sources.audit import require_complete, with_status
from perimeter.sources.clustered import FILE_BYTES
from perimeter.sources.documents import REGION_COLUMN, is_partial, is_unreadable, readable
from perimeter.sources.inventory import Inventory
from perimeter.sources.regions import export_files, export_regions, include_list, regional_lines

COUNTERS = ("documents", "unreadable_lines", "partial_documents")
_FOLDER = "load_counters"
_SCHEMA = "region string, collection string, documents long, unreadable_lines long, partial_documents long"


def _metrics(collection: str, regions: list[str]) -> list[Column]:
    """Three counters per region, named by its place: an export has some dozen regions."""
    unreadable, partial = is_unreadable(collection), is_partial(collection)
    found = []
    for n, region in enumerate(regions):
        here = F.col(REGION_COLUMN) == region
        for name, wanted in zip(COUNTERS, (~unreadable, unreadable, partial), strict=True):
            found.append(F.count_if(here & wanted).alias(f"{name}_{n}"))
    return found


def load_regional(
    spark: SparkSession,
    directory: str,
    tenancy: str,
    path: str,
    include: str | Iterable[str] = (),
    skip: str | None = None,
    failed_regions: Iterable[str] = (),
    allow_missing: bool = False,
    require: bool = True,
    mode: str = "errorifexists",
    file_bytes: int = FILE_BYTES,
    collections: Iterable[str] = K.COLLECTIONS,
) -> Inventory:
    """Store the exports of one tenancy and open them; every line is read once.

    Of some ``collections`` only those are read, stored and counted, the other tables are None; with
    ``mode="append"`` others can follow at the same place. What was read is kept beside the tables, see ``loaded_audit``. With ``require`` a load with a
    failed region, a missing collection or lost lines raises at its end; the tables and
    counters are there all the same.
    """
    named = include_list(include) if isinstance(include, str) else list(include)
    regions = [r for r in named or export_regions(spark, directory, tenancy) if r != skip]
    collections = tuple(collections)
    watched: dict[str, Observation] = {}

    def documents(name: str) -> DataFrame:
        lines = regional_lines(spark, directory, name, tenancy, regions, allow_missing, with_lists=True)
        if export_files(spark, directory, name, tenancy, regions):
            watched[name] = Observation(f"{_FOLDER}_{name}")
            lines = lines.observe(watched[name], *_metrics(name, regions))
        return readable(name, lines)

    typed = Inventory.from_documents({name: documents(name) for name in collections}, collections)
    typed.store(path, mode, file_bytes)
    found = {name: watched[name].get if name in watched else {} for name in collections}
    rows = [
        (region, name, *(found[name].get(f"{counter}_{n}", 0) for counter in COUNTERS))
        for name in collections
        for n, region in enumerate(regions)
    ]
    counted = spark.createDataFrame(rows, _SCHEMA)
    with_status(counted, failed_regions).coalesce(1).write.mode(mode).parquet(f"{path}/{_FOLDER}")
    if require:
        require_complete(loaded_audit(spark, path))
    return Inventory.open(spark, path, collections)


def loaded_audit(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``load_audit`` for stored tables, as counted while they were loaded."""
    return spark.read.parquet(f"{path}/{_FOLDER}")

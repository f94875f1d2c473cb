"""Counters and load report over the per-region exports."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.sources.documents import REGION_COLUMN, is_partial, is_unreadable
from perimeter.sources.regions import regional_lines


def _expected(spark: SparkSession, regions: Iterable[str]) -> DataFrame:
    """Every (region, collection) that an export of ``regions`` should hold."""
    pairs = [(region, name) for region in regions for name in K.COLLECTIONS]
    return spark.createDataFrame(
        pa.table(
            {
                REGION_COLUMN: pa.array([p[0] for p in pairs], pa.string()),
                "collection": pa.array([p[1] for p in pairs], pa.string()),
            }
        )
    )


def _line_counts(
    spark: SparkSession, directory: str, tenancy: str, regions: list[str]
) -> DataFrame:
    flags = [
        regional_lines(spark, directory, name, tenancy, regions, allow_missing=True).select(
            REGION_COLUMN,
            F.lit(name).alias("collection"),
            is_unreadable(name).alias("unreadable"),
            is_partial(name).alias("partial"),
        )
        for name in K.COLLECTIONS
    ]
    return (
        reduce(DataFrame.unionByName, flags)
        .groupBy(REGION_COLUMN, "collection")
        .agg(
            F.count_if(~F.col("unreadable")).alias("documents"),
            F.count_if("unreadable").alias("unreadable_lines"),
            F.count_if("partial").alias("partial_documents"),
        )
    )


def _counted(
    spark: SparkSession, directory: str, tenancy: str, regions: Iterable[str]
) -> DataFrame:
    regions = list(regions)
    found = _line_counts(spark, directory, tenancy, regions)
    return _expected(spark, regions).join(found, [REGION_COLUMN, "collection"], "left").fillna(
        0, ["documents", "unreadable_lines", "partial_documents"]
    )


def collection_counts(
    spark: SparkSession,
    directory: str,
    tenancy: str,
    regions: Iterable[str],
    failed_regions: Iterable[str] = (),
) -> DataFrame:
    """Documents per region and collection, and per collection (region NULL).

    A failed region adds nothing to the counters.
    """
    failed = set(failed_regions)
    counted = _counted(spark, directory, tenancy, [r for r in regions if r not in failed])
    return counted.groupingSets(
        [[F.col(REGION_COLUMN), F.col("collection")], [F.col("collection")]],
        REGION_COLUMN,
        "collection",
    ).agg(F.sum("documents").alias("documents"))


def load_audit(
    spark: SparkSession,
    directory: str,
    tenancy: str,
    regions: Iterable[str],
    failed_regions: Iterable[str] = (),
) -> DataFrame:
    """What was read per region and collection, and what is wrong with it.

    The documents of a failed region count here, since they are still
    consolidated. ``NO_RECORDS`` matters most for routes: without route
    tables every subnet looks private.
    """
    return with_status(_counted(spark, directory, tenancy, regions), failed_regions)


def with_status(counted: DataFrame, failed_regions: Iterable[str] = ()) -> DataFrame:
    """The counters of each region and collection with what they say about the load."""
    failed = F.col(REGION_COLUMN).isin(list(failed_regions))
    status = (
        F.when(failed, "FAILED_REGION")
        .when(F.col("documents") + F.col("unreadable_lines") == 0, "NO_RECORDS")
        .when(F.col("unreadable_lines") > 0, "UNREADABLE_LINES")
        .when(F.col("partial_documents") > 0, "PARTIAL_DOCUMENTS")
        .otherwise("OK")
    )
    return counted.select(
        REGION_COLUMN,
        "collection",
        status.alias("status"),
        "documents",
        "unreadable_lines",
        "partial_documents",
    )


def require_complete(audit: DataFrame) -> None:
    """Raises if any region or collection of ``load_audit`` isn't OK: an open rule may be missing."""
    found = audit.where("status <> 'OK'").orderBy(REGION_COLUMN, "collection").take(20)
    if found:
        lines = "; ".join(f"{r[REGION_COLUMN]} {r['collection']}: {r['status']}" for r in found)
        raise ValueError(f"incomplete input: {lines}")

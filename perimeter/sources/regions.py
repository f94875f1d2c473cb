"""Per-region export files ``<collection>-<tenancy>-<region>.jsonl``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.sources.documents import REGION_COLUMN, packed, read_lines, readable


def include_list(csv: str) -> list[str]:
    """Region names of a comma-separated list, trimmed, blanks dropped."""
    return [name.strip() for name in csv.split(",") if name.strip()]


def select_regions(
    documents: DataFrame,
    include: str | Iterable[str] = (),
    skip: str | None = None,
) -> DataFrame:
    """Rows of the included regions (all when empty), then without ``skip`` if given.

    Both are plain filters on the region column, so a layout partitioned by
    region reads only the folders it needs.
    """
    names = include_list(include) if isinstance(include, str) else list(include)
    region = F.col(REGION_COLUMN)
    if names:
        documents = documents.where(region.isin(names))
    return documents.where(region.isNull() | (region != skip)) if skip else documents


def _names(include: str | Iterable[str]) -> list[str]:
    return include_list(include) if isinstance(include, str) else list(include)


def _file_names(spark: SparkSession, directory: str) -> set[str]:
    """Base names in the folder; a folder that isn't there raises."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {status.getPath().getName() for status in system.listStatus(path)}


def export_regions(spark: SparkSession, directory: str, tenancy: str) -> list[str]:
    """Regions for which the folder holds a file of the tenancy.

    The whole base name must match. A tenancy may be the beginning of another one's name, so
    a region that ends in another found region is ambiguous: the caller must name the regions.
    """
    found = set()
    for name in _file_names(spark, directory):
        for collection in K.COLLECTIONS:
            prefix = f"{collection}-{tenancy}-"
            if name.startswith(prefix) and name.endswith(".jsonl"):
                found.add(name.removeprefix(prefix).removesuffix(".jsonl"))
    doubtful = sorted(a for a in found for b in found if a.endswith(f"-{b}"))
    if doubtful:
        raise ValueError(f"files of {doubtful} may belong to another tenancy; name the regions")
    return sorted(found)


def export_files(
    spark: SparkSession,
    directory: str,
    collection: str,
    tenancy: str,
    include: str | Iterable[str],
) -> dict[str, str]:
    """Path per region of the files that exist, by their exact names."""
    there = _file_names(spark, directory)
    regions = _names(include) or export_regions(spark, directory, tenancy)
    names = {region: f"{collection}-{tenancy}-{region}.jsonl" for region in regions}
    return {region: f"{directory}/{name}" for region, name in names.items() if name in there}


def _region_of(path, collection: str, tenancy: str, regions: Iterable[str]):
    """Region of a file path; regions are told apart by their whole names."""
    found = F.lit(None).cast("string")
    for region in regions:
        name = f"/{collection}-{tenancy}-{region}.jsonl"
        found = F.when(path.contains(f"{name}/") | path.endswith(name), region).otherwise(found)
    return found


def regional_lines(
    spark: SparkSession,
    directory: str,
    collection: str,
    tenancy: str,
    include: str | Iterable[str] = (),
    allow_missing: bool = False,
    with_lists: bool = False,
) -> DataFrame:
    """Lines of one collection with the region taken from the file name.

    One region without a file is allowed and shows in the audit; a collection without a
    file in any region raises unless ``allow_missing``.
    """
    paths = export_files(spark, directory, collection, tenancy, include)
    if not paths and not allow_missing:
        raise FileNotFoundError(f"no {collection}-{tenancy}-<region>.jsonl in {directory}")
    lines = read_lines(spark, collection, list(paths.values()), "_file", with_lists)
    region = _region_of(F.col("_file"), collection, tenancy, paths) if paths else F.lit(None).cast("string")
    return lines.withColumn(REGION_COLUMN, region).drop("_file")


def consolidate_regions(
    spark: SparkSession,
    directory: str,
    tenancy: str,
    include: str | Iterable[str] = (),
    skip: str | None = None,
    allow_missing: bool = False,
    collections: Iterable[str] = K.COLLECTIONS,
) -> dict[str, DataFrame]:
    """The nine collections, or those named, over all selected regions, each row with its region."""

    def rows(name: str) -> DataFrame:
        lines = regional_lines(spark, directory, name, tenancy, include, allow_missing)
        return select_regions(readable(name, lines), include, skip)

    return {name: rows(name) for name in collections}


def consolidate_lines(
    spark: SparkSession,
    directory: str,
    target: str,
    tenancy: str,
    include: str | Iterable[str] = (),
    skip: str | None = None,
    allow_missing: bool = False,
    compression: str = "none",
) -> None:
    """Copy the selected regions' lines verbatim into ``<target>/<collection>.jsonl``."""
    for name in K.COLLECTIONS:
        paths = export_files(spark, directory, name, tenancy, include)
        paths = {region: path for region, path in paths.items() if region != skip}
        if not paths and not allow_missing:
            raise FileNotFoundError(f"no {name}-{tenancy}-<region>.jsonl in {directory}")
        lines = spark.read.text(list(paths.values())) if paths else spark.createDataFrame([], "value string")
        lines.select("value").write.mode("overwrite").options(**packed(compression)).text(f"{target}/{name}.jsonl")

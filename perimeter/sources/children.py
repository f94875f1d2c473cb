"""Work around per-parent listings: parent ids to list, tags on what comes back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_parent(children: DataFrame, **tags: Column | str) -> DataFrame:
    """Child records with the region and parent they were listed under.

    Tag names use underscores for the hyphens of the stored field, so
    ``nsg_id=...`` writes field ``nsg-id``. Text is a constant, a column is
    taken as it is; an existing field of that name is replaced.
    """
    return children.withColumns(
        {
            name.replace("_", "-"): F.lit(value) if isinstance(value, str) else value
            for name, value in tags.items()
        }
    )


def parent_ids(records: DataFrame, column: str = "identifier") -> DataFrame:
    """Each non-empty id once: the parents or details to fetch."""
    value = F.col(f"`{column}`")
    return records.where(value.isNotNull() & (value != "")).select(value.alias(column)).distinct()


def dedupe_public_ip_ids(search_results: DataFrame) -> DataFrame:
    """Public address ids to fetch: non-empty, each once."""
    return parent_ids(search_results)


def dedupe_subnet_ids(subnets: DataFrame) -> DataFrame:
    """Subnet ids whose private addresses are to be listed: non-empty, each once."""
    return parent_ids(subnets)

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark: SparkSession):
    """A function that makes a documents table of (doc_id, text[, lang[, source]]) rows."""

    def make(rows, partitions: int = 3) -> DataFrame:
        full = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make


@pytest.fixture
def clashing():
    """Adds columns with the names that operators use inside or return."""

    def add(rows: DataFrame) -> DataFrame:
        names = (
            "key", "hash", "size", "label", "class", "gram", "row", "words", "term", "slot", "shard", "block",
            "lang_pred", "score", "rejected", "copies", "_hash", "_slot", "packed", "vec", "item_id", "kind",
        )
        for n, name in enumerate(names):
            rows = rows.selectExpr("*", f"'{n}' AS {name}")
        return rows

    return add


@pytest.fixture(scope="session")
def today() -> datetime.date:
    return datetime.date(2024, 1, 1)

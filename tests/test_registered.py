"""Every registered query against its SQL over the base tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from check import difference, open_tables
from perimeter.testbed import workspace

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registered.registry.queries()
EXPECTED = registered.oracle.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, tables, key):
    found = QUERIES[key](spark, SF_DIR)
    assert difference(found, tables, EXPECTED[key]) == ""


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 58


@pytest.mark.parametrize(
    "key", ["pub_insecure_sl", "pub_insecure_vnics", "pub_service_summary", "unused_nsg"]
)
def test_order(spark, key):
    """Sorted as documented, missing values last."""
    order = {
        "pub_insecure_sl": ["subnet_id", "securitylist_id", "insecure_rule_number"],
        "pub_insecure_vnics": ["vnic_id", "exposure_source"],
        "pub_service_summary": ["exposure_source", "-total_occurrences", "protocol", "service"],
        "unused_nsg": ["nsg_name", "nsg_id"],
    }[key]

    def sort_key(row):
        values = (-row[c[1:]] if c.startswith("-") else row[c] for c in order)
        return [(v is None, v if v is not None else "") for v in values]

    rows = QUERIES[key](spark, SF_DIR).collect()
    assert rows == sorted(rows, key=sort_key)
    assert len(rows) > 10


def test_collections_hold_whole_tables(spark):
    """One document per row of the base table, or per row with a property of its own."""
    tables = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("orders", "lineitem", "part", "customer", "nation")}
    inventory = registered.registry.workspace(spark, SF_DIR).inventory
    expected = {
        "routes": tables["nation"],
        "subnets": tables["customer"],
        "securitylists": tables["orders"],
        "vnics": tables["orders"],
        "privateips": tables["orders"],
        "publicips": tables["orders"].where("o_orderstatus = 'O'"),
        "nsgdata": tables["part"],
        "nsgrules": tables["lineitem"],
        "nsgvnic": tables["lineitem"].join(tables["part"].where("p_size <= 40"), F.expr("l_partkey = p_partkey")),
    }
    for name, rows in expected.items():
        assert getattr(inventory, name).count() == rows.count(), name


def test_workspace_needs_a_shared_folder():
    class Remote:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace._root(Remote)

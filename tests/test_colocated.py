"""Interfaces and members in buckets: equal reports, and a join that moves neither."""

from __future__ import annotations

import json

import pytest
from test_random_inventories import COLLECTIONS, Maker, interpreted  # noqa: F401

from perimeter import Inventory
from perimeter.plans import reports
from perimeter.plans.colocated import Colocated

SCOPES = ("public", "private")


def _inventory(spark, folder, seed: int) -> Inventory:
    folder.mkdir()
    documents = Maker(seed).documents()
    for name in COLLECTIONS:
        lines = "".join(json.dumps(d) + "\n" for d in documents[name])
        (folder / f"{name}.jsonl").write_text(lines, encoding="utf-8")
    return Inventory.from_jsonl(spark, str(folder))


@pytest.mark.parametrize(("seed", "hot"), [(31, False), (31, True)])
def test_equal_reports(spark, interpreted, tmp_path, seed, hot):  # noqa: F811
    """Copies, missing ids, several documents of one id; hot interfaces lie apart."""
    inventory = _inventory(spark, tmp_path / "export", seed)
    if hot:
        inventory = inventory.profiled(rows_per_task=2)
        assert inventory.hot.on("vnics.vnic_id") or inventory.hot.on("nsgvnic.vnic_id")
    stored = Colocated.store(inventory, str(tmp_path / "it's stored"), buckets=3)
    assert (stored.hot is not None) == hot
    assert not hot or all(not table.isEmpty() for table in stored.hot)
    found = 0
    for scope in SCOPES:
        for name in ("insecure_nsg", "other_nsg"):
            expected = getattr(reports, name)(inventory, scope)
            rows = getattr(stored, name)(scope)
            assert rows.columns == expected.columns
            assert rows.collect() == expected.collect()
            found += rows.count()
    assert found > 0


def _joined(spark, frame) -> str:
    """The plan below the join of interfaces and members."""
    text = frame._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    at = next(n for n, line in enumerate(lines) if "SortMergeJoin [vnic_id" in line)
    return "\n".join(lines[at:])


def test_neither_side_moves(spark, tmp_path):
    """No exchange between the two tables, broadcasting off; filters reach both scans."""
    inventory = _inventory(spark, tmp_path / "export", 33)
    stored = Colocated.store(inventory, str(tmp_path / "stored"), buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for scope in SCOPES:
            pairs = stored._attached(scope, "insecure")
            text = _joined(spark, pairs)
            assert text.count("FileScan parquet") == 2
            assert "Exchange" not in text
            # The pairs found move once, to the rules of their group.
            whole = stored.insecure_nsg(scope, ordered=False)
            assert "Exchange" not in _joined(spark, whole).split("Exchange hashpartitioning(nsg_id")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_opened_again(spark, interpreted, tmp_path):  # noqa: F811
    inventory = _inventory(spark, tmp_path / "export", 34)
    stored = Colocated.store(inventory, str(tmp_path / "stored"), buckets=2)
    again = Colocated.open(inventory, str(tmp_path / "stored"))
    for scope in SCOPES:
        assert again.other_nsg(scope).collect() == stored.other_nsg(scope).collect()


def test_unknown_scope(spark, interpreted, tmp_path):  # noqa: F811
    inventory = _inventory(spark, tmp_path / "export", 35)
    with pytest.raises(ValueError, match="scope must be"):
        Colocated.store(inventory, str(tmp_path / "stored"), buckets=2).insecure_nsg("all")

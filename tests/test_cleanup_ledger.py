"""Cleanup reports from signed changes against whole runs, export after export."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from test_random_inventories import COLLECTIONS, Maker, interpreted  # noqa: F401

from perimeter import Inventory
from perimeter.plans import reports
from perimeter.plans.cleanup_ledger import CleanupLedger

REPORTS = {"sl": reports.unused_sl, "nsg": reports.unused_nsg}


def _inventory(spark, folder, documents) -> Inventory:
    folder.mkdir()
    for name in COLLECTIONS:
        lines = "".join(json.dumps(d) + "\n" for d in documents[name])
        (folder / f"{name}.jsonl").write_text(lines, encoding="utf-8")
    return Inventory.from_jsonl(spark, str(folder))


def _rows(frame) -> Counter:
    return Counter(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("kind", ["sl", "nsg"])
def test_three_random_exports(spark, interpreted, tmp_path, kind):  # noqa: F811
    """Copies, missing ids, several descriptions of one id; ledgers with and without compaction."""
    kept, compacted = (CleanupLedger(spark, str(tmp_path / n), kind) for n in ("kept", "compacted"))
    assert kept.unused().collect() == [] and kept.exports() == []
    state = Counter()
    for seed in (21, 22, 23):
        inventory = _inventory(spark, tmp_path / f"export-{seed}", Maker(seed).documents())
        expected = REPORTS[kind](inventory)
        for ledger in (kept, compacted):
            assert ledger.take(inventory, f"export-{seed}")
            assert not ledger.take(inventory, f"export-{seed}")
            assert ledger.unused().columns == expected.columns
            assert ledger.unused().collect() == expected.collect()
        for row in kept.changes(f"export-{seed}").collect():
            state[tuple(row)[:-1]] += row["n"]
        assert +state == _rows(expected) and min(state.values(), default=0) >= 0
        compacted.compact()
        assert compacted.unused().collect() == expected.collect()
    assert sum(state.values()) > 0
    assert kept.exports() == compacted.exports() == ["export-21", "export-22", "export-23"]
    assert _rows(kept.attachments()) == _rows(compacted.attachments())
    with pytest.raises(ValueError, match="no changes"):
        compacted.changes("export-21")


def test_only_changed_policies_are_written(spark, interpreted, tmp_path):  # noqa: F811
    documents = Maker(24).documents()
    ledger = CleanupLedger(spark, str(tmp_path / "ledger"), "nsg")
    ledger.take(_inventory(spark, tmp_path / "a", documents), "a")
    ledger.take(_inventory(spark, tmp_path / "b", documents), "b")
    written = {r["export"]: r["turn"] for r in ledger._turns()}
    assert spark.read.parquet(f"{ledger.path}/facts/{written['b']}").count() == 0
    assert spark.read.parquet(f"{ledger.path}/unused/{written['b']}").count() == 0
    used = ledger.attachments().orderBy("policy").first()["policy"]
    documents["nsgvnic"] = [d for d in documents["nsgvnic"] if used not in json.dumps(d)]
    inventory = _inventory(spark, tmp_path / "c", documents)
    ledger.take(inventory, "c")
    written = {r["export"]: r["turn"] for r in ledger._turns()}
    changed = spark.read.parquet(f"{ledger.path}/facts/{written['c']}").collect()
    assert [(r["policy"], r["fact"]) for r in changed] == [(used, "attached")]
    assert {r["nsg_id"] for r in ledger.changes("c").collect()} <= {used}
    assert ledger.unused().collect() == reports.unused_nsg(inventory).collect()


def test_signed_attachments_without_an_export(spark, interpreted, tmp_path):  # noqa: F811
    """Detaching all copies of a policy makes it unused, attaching it again undoes that."""
    inventory = _inventory(spark, tmp_path / "a", Maker(25).documents())
    ledger = CleanupLedger(spark, str(tmp_path / "ledger"), "sl")
    ledger.take(inventory, "a")
    before = ledger.unused().collect()
    described = {r[0] for r in inventory.securitylists.select("securitylist_id").collect()}
    counts = {p: n for p, n in ledger.attachments().collect() if p in described}
    policy, n = max(counts.items(), key=lambda c: c[1])
    schema = "policy string, n long"
    assert n > 1
    assert ledger.revise(spark.createDataFrame([(policy, 1 - n), (None, -1)], schema), "b")
    assert ledger.unused().collect() == before
    assert ledger.revise(spark.createDataFrame([(policy, -1)], schema), "c")
    assert not ledger.revise(spark.createDataFrame([(policy, -1)], schema), "c")
    added = _rows(ledger.unused()) - Counter(map(tuple, before))
    copies = inventory.securitylists.where(f"securitylist_id = '{policy}'").count()
    assert sum(added.values()) == copies and {r[1] for r in added} == {policy}
    assert ledger.revise(spark.createDataFrame([(policy, 3)], schema), "d")
    assert ledger.unused().collect() == before


def test_a_broken_off_export_changes_nothing(spark, interpreted, tmp_path, monkeypatch):  # noqa: F811
    one, two = (_inventory(spark, tmp_path / f"e{s}", Maker(s).documents()) for s in (26, 27))
    ledger = CleanupLedger(spark, str(tmp_path / "ledger"), "nsg")
    ledger.take(one, "one")
    before = ledger.unused().collect()

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(CleanupLedger, "_enforce", lost)
        with pytest.raises(RuntimeError):
            ledger.take(two, "two")
    assert ledger.unused().collect() == before and ledger.exports() == ["one"]
    assert ledger.take(two, "two")
    assert ledger.unused().collect() == reports.unused_nsg(two).collect()


def test_unknown_kind(spark, tmp_path):
    with pytest.raises(ValueError, match="kind must be"):
        CleanupLedger(spark, str(tmp_path), "lists")

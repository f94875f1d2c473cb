"""Counts per region against the summary of all tables, while regions are replaced."""

from __future__ import annotations

import json

import pytest
from test_random_inventories import COLLECTIONS, Maker, interpreted  # noqa: F401

from perimeter import Inventory
from perimeter.plans import reports
from perimeter.plans.regional_summary import RegionalSummary


def _regional(value, region: str):
    """Ids of subnets, route tables and interfaces belong to a region; policies may be shared."""
    if isinstance(value, dict):
        return {k: _regional(v, region) for k, v in value.items()}
    if isinstance(value, list):
        return [_regional(v, region) for v in value]
    local = isinstance(value, str) and value.split("-")[0] in ("subnet", "rt", "vnic")
    return f"{value}.{region}" if local else value


def _export(folder, seeds: dict[str, int]):
    folder.mkdir()
    for region, seed in seeds.items():
        made = Maker(seed).documents()
        for name in COLLECTIONS:
            lines = "\n".join(json.dumps(_regional(d, region)) for d in made[name])
            (folder / f"{name}-ten-{region}.jsonl").write_text(lines + "\n", encoding="utf-8")
    return str(folder)


def _rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_replacing_a_region_equals_the_whole_run(spark, interpreted, tmp_path):
    kept = RegionalSummary(spark, str(tmp_path / "counts"))
    assert kept.regions() == [] and _rows(kept.summary("public")) == []
    seeds = {"r-1": 1, "r-2": 2, "r-3": 3}
    changed = list(seeds)
    for turn in range(3):
        folder = _export(tmp_path / f"export-{turn}", seeds)
        inventory = Inventory.from_regional_jsonl(spark, folder, "ten")
        for region in changed:
            kept.replace(inventory, region)
        for scope in ("public", "private"):
            expected = _rows(reports.service_summary(inventory, scope))
            assert expected and _rows(kept.summary(scope)) == expected
        changed = [f"r-{turn + 1}"]
        seeds[changed[0]] = 10 + turn
    kept.remove("r-2")
    assert kept.regions() == ["r-1", "r-3"]


def test_a_broken_off_replacement_changes_nothing(spark, tmp_path, monkeypatch):
    folder = _export(tmp_path / "export", {"r-1": 4})
    inventory = Inventory.from_regional_jsonl(spark, folder, "ten")
    kept = RegionalSummary(spark, str(tmp_path / "counts"))
    kept.replace(inventory, "r-1")
    before = _rows(kept.summary("public"))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(RegionalSummary, "_enforce", lost)
        with pytest.raises(RuntimeError):
            kept.replace(inventory, "r-1")
    assert _rows(kept.summary("public")) == before and kept.regions() == ["r-1"]


def test_only_the_region_is_read(spark, tmp_path):
    """One region is counted anew though no file of the other can be read."""
    lake = tmp_path / "lake"
    Inventory.from_regional_jsonl(spark, _export(tmp_path / "export", {"r-1": 5, "r-2": 6}), "ten").store(str(lake))
    inventory = Inventory.open(spark, str(lake))
    kept = RegionalSummary(spark, str(tmp_path / "counts"))
    kept.replace(inventory, "r-1")
    before = sorted(map(str, _rows(kept.summary("private"))))
    for file in lake.glob("*/region=r-2/*.parquet"):
        file.write_bytes(b"none")
    kept.replace(Inventory.open(spark, str(lake)), "r-1")
    assert before and sorted(map(str, _rows(kept.summary("private")))) == before
    with pytest.raises(Exception, match="parquet"):
        kept.replace(Inventory.open(spark, str(lake)), "r-2")
    assert kept.regions() == ["r-1"]


def test_unknown_scope(spark, tmp_path):
    with pytest.raises(ValueError, match="scope must be"):
        RegionalSummary(spark, str(tmp_path)).summary("all")


def test_attachments_in_other_regions(spark, interpreted, tmp_path):  # noqa: F811
    """Group attachments listed in the other region count where their interface lies."""
    folder = tmp_path / "export"
    _export(folder, {"r-1": 7, "r-2": 8})
    one, two = (folder / f"nsgvnic-ten-{r}.jsonl" for r in ("r-1", "r-2"))
    swapped = one.read_text(), two.read_text()
    two.write_text(swapped[0])
    one.write_text(swapped[1])
    inventory = Inventory.from_regional_jsonl(spark, str(folder), "ten")
    kept = RegionalSummary(spark, str(tmp_path / "counts"), whole=("nsgvnic",))
    for region in ("r-1", "r-2"):
        kept.replace(inventory, region)
    for scope in ("public", "private"):
        assert _rows(kept.summary(scope)) == _rows(reports.service_summary(inventory, scope))
    with pytest.raises(ValueError, match="read whole"):
        RegionalSummary(spark, str(tmp_path), whole=("vnics",))

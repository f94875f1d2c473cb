"""Loads that count while they read, batches that repeat, rounded ports and long case lists."""

from __future__ import annotations

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from perimeter import constants as K
from perimeter.functions import scalars
from perimeter.operators.rules import case_list
from perimeter.sources import audit, batches, documents, loading


def _put(path, *lines):
    path.write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")


@pytest.fixture
def exports(tmp_path):
    """Two regions with good, unreadable and partial lines, one without any line, one collection short."""
    for region in ("r-1", "r-2", "r-3"):
        for n, name in enumerate(K.COLLECTIONS):
            if (region, name) == ("r-3", "publicips"):
                continue
            good = [json.dumps({"identifier": f"{name}-{region}-{k}"}) for k in range(n + 1)]
            odd = ["{", "x", good[0] + " {}"] if name in ("vnics", "routes") else []
            _put(tmp_path / f"{name}-ten-{region}.jsonl", *([] if region == "r-3" else good + odd), "")
    return str(tmp_path)


def test_counters_of_a_load_equal_the_audit(spark, exports, tmp_path):
    regions = ["r-1", "r-2", "r-3"]
    path = str(tmp_path / "lake")
    loaded = loading.load_regional(spark, exports, "ten", path, failed_regions=["r-2"], require=False)
    found = loading.loaded_audit(spark, path)
    expected = audit.load_audit(spark, exports, "ten", regions, ["r-2"])
    assert sorted(found.collect()) == sorted(expected.select(*found.columns).collect())
    assert found.where("unreadable_lines = 2 AND partial_documents = 1").count() == 4
    assert {s.status for s in found.collect()} == {"OK", "FAILED_REGION", "UNREADABLE_LINES", "NO_RECORDS"}
    assert loaded.subnets.count() == found.where("collection = 'subnets'").agg(F.sum("documents")).first()[0]


def test_an_incomplete_load_raises_after_it_was_stored(spark, exports, tmp_path):
    path = str(tmp_path / "lake")
    with pytest.raises(ValueError, match="UNREADABLE_LINES"):
        loading.load_regional(spark, exports, "ten", path, skip="r-3")
    assert loading.loaded_audit(spark, path).select("region").distinct().count() == 2


def test_a_failed_region_raises(spark, tmp_path):
    for name in K.COLLECTIONS:
        _put(tmp_path / f"{name}-ten-r-1.jsonl", json.dumps({"identifier": "a"}))
    path = str(tmp_path / "lake")
    with pytest.raises(ValueError, match="FAILED_REGION"):
        loading.load_regional(spark, str(tmp_path), "ten", path, failed_regions=["r-1"])
    good = loading.load_regional(spark, str(tmp_path), "ten", f"{path}-good")
    assert good.subnets.count() == 1


def _lines(spark, path):
    paths = batches.batch_paths(spark, path)
    return sorted(r.value for r in spark.read.text(paths).collect()) if paths else []


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    one, two = (spark.createDataFrame([(v, None)], "name string, options string") for v in ("é", "b"))
    assert batches.committed_batches(spark, path) == {} and _lines(spark, path) == []
    assert batches.append_batch(one, path, "2024-01")
    assert not batches.append_batch(two, path, "2024-01")
    assert batches.append_batch(two, path, "2024-02")
    assert not batches.append_batch(one, path, "2024-01")
    assert _lines(spark, path) == ['{"name":"b","options":null}', '{"name":"é","options":null}']
    for name in ("", "_x", "a/b", ".", "a b"):
        with pytest.raises(ValueError, match="not a batch name"):
            batches.append_batch(one, path, name)


def test_a_broken_off_batch_is_not_read_and_can_be_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    rows = spark.range(50).selectExpr("CAST(id AS STRING) AS name")
    fails = rows.select(F.when(F.col("name") == "37", F.raise_error(F.lit("lost"))).otherwise(F.col("name")).alias("name"))
    with pytest.raises(Exception, match="lost"):
        batches.append_batch(fails, path, "b")
    assert _lines(spark, path) == []
    # Written in full, but the driver was lost before the commit, or just as it began.
    documents.write_jsonl(rows, f"{path}/b-lost")
    (tmp_path / "out" / "_commits").mkdir()
    (tmp_path / "out" / "_commits" / "b").touch()
    assert _lines(spark, path) == []
    assert batches.append_batch(rows, path, "b") and not batches.append_batch(rows, path, "b")
    assert len(_lines(spark, path)) == 50
    read = documents.read_lines(spark, "subnets", batches.batch_paths(spark, path))
    assert read.count() == 50


def test_fractional_ports_round_into_the_range(spark):
    values = [("22.5",), ("22",), ("22.0",), ("21.5",), ("x",), ("-0.5",), (None,)]
    df = spark.createDataFrame(values, "value string")
    found = df.selectExpr(scalars.port("value", "ceil"), scalars.port("value", "floor")).collect()
    assert [tuple(r) for r in found] == [(23, 22), (22, 22), (22, 22), (22, 21), (None, None), (0, -1), (None, None)]


def test_case_lists_of_any_length(spark):
    order = ["ALL", "22", "3389", "21", "23", "445", "1433", "3306", "5432", "6379"]
    rng = random.Random(5)
    rows = [(f"p{rng.randrange(30)}", rng.choice([*order, None, "z", "a"])) for _ in range(600)]
    rows += [("hot", c) for c in order * 200] + [("none", None), (None, "22"), (None, "ALL")]
    found = case_list(spark.createDataFrame(rows, "policy string, insecure_case string"), "policy", order)
    key = {c: n for n, c in enumerate([*order, "a", "z"])}
    expected = {}
    for policy, group in itertools.groupby(sorted(rows, key=str), key=lambda r: r[0]):
        cases = {c for _, c in group if c is not None}
        if cases:
            expected.setdefault(policy, set()).update(cases)
    expected = {p: K.CASE_SEPARATOR.join(sorted(c, key=key.get)) for p, c in expected.items()}
    assert {r.policy: r.cis_insecure_case for r in found.collect()} == expected
    assert "none" not in expected and expected[None] == f"ALL{K.CASE_SEPARATOR}22"

"""Plans that must hold at scale."""

from __future__ import annotations

import re

import pytest

from perimeter.plans import reports
from perimeter.testbed.registry import queries
from perimeter.testbed.workspace import workspace

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inventory(spark):
    return workspace(spark, SF_DIR).inventory


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Nothing is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


SCOPED = [(name, scope) for name in reports.SCOPED_REPORTS for scope in ("public", "private")]


@pytest.mark.parametrize(("name", "scope"), SCOPED)
def test_reports_shuffle_when_nothing_is_small(large, inventory, name, scope):
    text = plan(reports.SCOPED_REPORTS[name](inventory, scope))
    assert "SortMergeJoin" in text
    for unwanted in ("Broadcast", "CartesianProduct", "NestedLoop", "Python", "Window"):
        assert unwanted not in text


@pytest.mark.parametrize("report", [reports.unused_sl, reports.unused_nsg])
def test_cleanup_meets_each_policy_once(large, inventory, report):
    text = plan(report(inventory))
    assert text.count("SortMergeJoin") == 1
    assert "Broadcast" not in text


@pytest.mark.parametrize("name", ["insecure_vnics", "insecure_subnets", "other_vnics"])
def test_exposure_uses_semi_joins(large, inventory, name):
    text = plan(reports.SCOPED_REPORTS[name](inventory, "public"))
    assert text.count("LeftSemi") >= 3


def test_summary_counts_before_it_joins(large, inventory):
    text = plan(reports.service_summary(inventory, "public"))
    joined = text[text.index("SortMergeJoin [securitylist_id") :]
    assert "count(1)" in joined[: joined.index("FileScan")]


def test_scans_read_only_what_a_report_needs(inventory):
    text = plan(reports.insecure_subnets(inventory, "public"))
    (vnics,) = set(re.findall(r"FileScan parquet \[(vnic_id#\d+,[^\]]*)\]", text))
    assert re.sub(r"#\d+L?", "", vnics) == "vnic_id,subnet_id,region"


LOOKUPS = [(reports.lookup_vnic, "vnic-50"), (reports.lookup_ip, "10.0.0.51"), (reports.lookup_ip, "198.18.0.51")]


@pytest.mark.parametrize(("report", "key"), LOOKUPS)
def test_lookups_start_no_job_until_they_run(spark, inventory, report, key):
    group = f"lookup-{report.__name__}-{key}"
    spark.sparkContext.setJobGroup(group, group)
    found = report(inventory, key)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    assert found.count() > 0
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize(("report", "key"), LOOKUPS[:1])
def test_lookup_filters_reach_the_scans(inventory, report, key):
    """Each scan has a value or a range that is known when it starts."""
    scans = re.findall(r"FileScan parquet \[[^\]]*\].*?DataFilters: \[(.*?)\], Format", plan(report(inventory, key)))
    assert scans and all(re.search(rf"= {key}|>= Subquery", s) for s in scans)


def test_spark_adds_bloom_filters_to_lookups(spark, large, inventory):
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "0")
    try:
        assert "might_contain" in plan(reports.lookup_vnic(inventory, "vnic-50"))
    finally:
        spark.conf.set(name, before)


def test_lookups_join_by_shuffle_when_nothing_is_small(large, inventory):
    text = plan(reports.lookup_ip(inventory, "10.0.3.11"))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_quotes_in_parameters_match_nothing(inventory):
    assert reports.lookup_vnic(inventory, "x' OR '1'='1").count() == 0
    assert reports.lookup_ip(inventory, '"; --').count() == 0


@pytest.mark.parametrize("key", sorted(queries()))
def test_no_query_runs_python_or_crosses(spark, key):
    text = plan(queries()[key](spark, SF_DIR))
    for unwanted in ("Python", "CartesianProduct", "NestedLoop"):
        assert unwanted not in text


@pytest.mark.parametrize("name", ["insecure_vnics", "insecure_subnets", "other_vnics", "other_subnets"])
def test_existence_takes_no_rules_apart(large, inventory, name):
    mark = "has_insecure" if name.startswith("insecure") else "has_other"
    text = reports.SCOPED_REPORTS[name](inventory, "public")._jdf.queryExecution().toString()
    assert "ingress_rules" not in text.split("== Physical Plan ==")[1]
    assert f"EqualTo({mark},true)" in text or f"IsNotNull({mark})" in text


def test_filters_reach_the_scans(large, inventory):
    text = reports.insecure_nsg(inventory, "public")._jdf.queryExecution().toString()
    assert "IsNotNull(insecure_case)" in text
    assert "EqualTo(prohibit_public_ip_on_vnic,false)" in text
    assert "EqualTo(has_igw,true)" in text or "IsNotNull(has_igw)" in text

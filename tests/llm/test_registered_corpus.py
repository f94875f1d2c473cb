"""Registered corpus queries against SQL, and the pipeline against its stages' rules."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from check import difference, open_tables
from perimeter.llm import decontamination, language, mixing, ngram_join, registry, sharding

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


def test_all_are_registered():
    assert {k.split("_")[0] for k in registry.queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(registry.oracle_sql()) <= set(registry.queries()) <= set(registered.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "mixing", "sharding",
    ]


@pytest.mark.parametrize("key", registry.oracle_sql())
def test_query(spark, tables, key):
    assert difference(registry.queries()[key](spark, SF_DIR), tables, registry.oracle_sql()[key]) == ""


def test_language_is_right_on_held_out(spark):
    found = registry.op2_language(spark, SF_DIR).where("held_out")
    lang = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = found.join(lang, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_pipeline(spark):
    """What each stage drops, from the operators run on the whole documents that reach it."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    found = language.identify(docs, language.learn(docs))
    docs = docs.join(found.where("NOT rejected").select("doc_id"), "doc_id", "left_semi")
    groups = ngram_join.jaccard_components(docs)
    docs = docs.join(groups.where("doc_id = component_id").select("doc_id"), "doc_id", "left_semi")
    hits = decontamination.decontaminate(docs, benchmark)
    docs = docs.join(hits.where("NOT contaminated").select("doc_id"), "doc_id", "left_semi")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    result = corpus_pipeline.run(spark, SF_DIR)
    assert set(result.columns) == {*docs.columns, "slot", "shard"}
    rows = result.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(copies) and rows
    table = sharding.fill_table(sharding.shard_names(sharding.SHARDS))
    assert all(r["shard"] == table[r["slot"]] for r in rows)


def test_stages_on_odd_rows(spark, documents, clashing):
    """Null, repeated and missing ids pass all stages; an empty table stays empty."""
    rows = [(1, "the of and that was " * 9, "en", "a"), (1, "die der und von den " * 9, "de", None), (None, None, None, "a")]
    rows += [(None, "the of and that was " * 9, "en", "a"), (2, "", "en", "a"), (3, "the of and that was " * 9, "en", "a")]
    for docs in (documents(rows), documents([]), clashing(documents(rows)).drop("slot", "shard")):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
            assert set(columns) <= set(docs.columns), name
        docs.collect()

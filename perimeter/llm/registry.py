"""Registered queries of the corpus operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimeter.llm import (
    decontamination,
    language,
    lexical,
    mixing,
    ngram_join,
    pii,
    quality,
    secret_scan,
    sharding,
    suffix_dedup,
    tokens,
    topk,
    whitening,
)
from perimeter.llm.expected import EXPECTED
from perimeter.llm.shared import KEY, Scratch, read_table, with_key

Query = Callable[[SparkSession, str], DataFrame]


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = sharding.shard_names(sharding.SHARDS)
    placed = sharding.place(read_table(spark, sf_dir, "documents"), "doc_id", names)
    return placed.select("doc_id", "slot", "shard")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    held_out = language.remainder(F.col("doc_id")) == 1
    dictionaries = language.learn(documents.where(~held_out))
    return language.identify(documents.select("doc_id", "text"), dictionaries).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicate(read_table(spark, sf_dir, "documents"))
    return found.drop("kept")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_list(F.col("base")), 256).alias("base_sha256"),
        pii.span_list(F.concat("base", "added")).alias("spans"),
        F.size("added").alias("n_added"),
    )


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under both versions, recounted without repeated lines, toxic ones deleted.

    Rows are told apart by a key, so repeated and missing ids count and are revised as others.
    """
    scratch = Scratch(spark, "tokens")
    documents, _ = with_key(read_table(spark, sf_dir, "documents"), "doc_id", "text", scratch)
    labelled = read_table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    toxic = documents.join(labelled, "doc_id", "left_semi").select(F.col(KEY).alias("doc_id"))
    rollup = tokens.Rollup(spark, f"{scratch.root}/rollup")
    revised = tokens.without_repeated_lines(documents)
    for version in tokens.VERSIONS:
        rollup.commit(f"insert-{version}", tokens.counts(documents, version, KEY))
        rollup.commit(f"revise-{version}", tokens.counts(revised, version, KEY))
    state = rollup.state()
    deleted = state.join(toxic, "doc_id", "left_semi").withColumn("tokens", F.lit(None).cast("long"))
    rollup.commit("delete-toxic", deleted)
    rollup.commit("delete-toxic", deleted)
    return rollup.totals()


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "units", "perplexity", "threshold", "keep")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    found = decontamination.decontaminate(documents, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find(read_table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in secret_scan.BASE_KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.span_list(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_list(F.concat("base", "added")).alias("spans"),
        F.size("added").alias("n_added"),
    )


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def queries() -> dict[str, Query]:
    return {
        "op1_shard": op1_shard,
        "op2_language": op2_language,
        "op3_topk": op3_topk,
        "op4_suffix": op4_suffix,
        "op5_jaccard": op5_jaccard,
        "op6_pii": op6_pii,
        "op7_mix": op7_mix,
        "op8_tokens": op8_tokens,
        "op9_quality": op9_quality,
        "op10_decontaminate": op10_decontaminate,
        "op11_search": op11_search,
        "op12_secrets": op12_secrets,
        "op13_whiten": op13_whiten,
    }


def oracle_sql() -> dict[str, str]:
    return dict(EXPECTED)

"""Corpus pipeline: from ``documents`` to documents placed on shards.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and
returns the columns of ``documents``; the last one adds slot and shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimeter.llm import decontamination, language, mixing, ngram_join, sharding
from perimeter.llm.shared import KEY, Scratch, read_table, with_key


def _without(docs: DataFrame, keyed: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose key isn't a dropped doc_id, with the columns of ``docs``."""
    return keyed.join(dropped.select(F.col("doc_id").alias(KEY)), KEY, "left_anti").select(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is rejected; a missing language is filled in.

    Where no document has a language to learn from, all are kept as they are.
    """
    dictionaries = language.learn(docs)
    if not dictionaries.content:
        return docs
    found = language.identify(docs, dictionaries)
    filled = F.coalesce("lang", "lang_pred").alias("lang")
    return found.where(~F.col("rejected")).select(
        *(filled if c == "lang" else F.col(c) for c in docs.columns)
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that n-gram links connect, the document with the smallest id stays."""
    keyed, _ = with_key(docs, "doc_id", "text", Scratch(spark, "near-duplicates"))
    found = ngram_join.jaccard_components(keyed, doc_id=KEY)
    return _without(docs, keyed, found.where("doc_id <> component_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    keyed, _ = with_key(docs, "doc_id", "text", Scratch(spark, "contaminated"))
    found = decontamination.decontaminate(keyed, read_table(spark, sf_dir, "benchmark"), doc_id=KEY)
    return _without(docs, keyed, found.where("contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, repeated ones twice."""
    return mixing.mixed_documents(docs)


def place_on_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.place(docs, "doc_id", sharding.shard_names(sharding.SHARDS))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", place_on_shards),
]

# The first stage compares compressed sizes, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents, each result written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return docs

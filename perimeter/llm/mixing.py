"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Every document has a fixed hash. A source that should give a part of its words
takes the documents whose hash is at most its threshold. The threshold is found
without sorting: words are summed by source and leading hash bits, the bucket
in which the budget ends is split by the next bits, and only the documents of
that small bucket are ordered. One filter then selects the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from perimeter.llm.shared import WORD, Scratch

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
# Bits of a document's hash, and of each of the two histogram levels.
HASH_BITS, LEVEL_BITS = 60, 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text; equal rows have equal hashes."""
    key = F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("-")),
        F.lit(":"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("-")),
    )
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(
    sources: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Adds ``target`` to one row per source with its ``source_size``.

    Sources by code point, null last, get ``weights`` in turn and share ``share`` times
    all words. A target is at most ``max_repeats`` times its source; what it can't take
    is shared by weight among the others. Sorted by the level at which a source is full,
    the first source that isn't full gives the level of all that follow.
    """
    in_order = W.partitionBy().orderBy(F.col("source").asc_nulls_last())
    everywhere = W.partitionBy()
    by_level = W.partitionBy().orderBy("full_at", "place")
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    after = by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    turn = (F.col("place") - 1) % len(weights) + 1
    level = F.col("level")
    return (
        sources.withColumn("place", F.row_number().over(in_order))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")))
        .withColumn("most", max_repeats * F.col("source_size"))
        .withColumn("full_at", F.col("most").cast("double") / F.col("weight"))
        .withColumn("budget", F.lit(share) * F.sum("source_size").over(everywhere))
        .withColumn("used", F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("level", (F.col("budget") - F.col("used")) / F.sum("weight").over(after))
        .withColumn("open", F.when(F.col("full_at") > level, F.struct("full_at", "place", "level")))
        .withColumn("level", F.min("open").over(everywhere)["level"])
        .withColumn(
            "target",
            F.least(F.col("most").cast("double"), F.coalesce(level * F.col("weight"), F.col("most").cast("double"))),
        )
        .select("source", "source_size", "target")
    )


def _bucket(level: int) -> Column:
    """Leading bits of the hash down to histogram ``level``."""
    return F.shiftright("hash", HASH_BITS - level * LEVEL_BITS)


def _boundary(sums: DataFrame, key: str) -> DataFrame:
    """Per source the first ``key`` at which the running sum reaches the rest of the budget."""
    running = W.partitionBy("source").orderBy(key)
    reached = sums.withColumn("upto", F.col("before") + F.sum("words").over(running))
    return (
        reached.where(F.col("upto") >= F.col("rest"))
        .groupBy("source")
        .agg(F.min_by(F.struct(key, (F.col("upto") - F.col("words")).alias("before"), "rest"), key).alias("b"))
        .select("source", "b.*")
    )


def _same_source(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["source"])


def _join_source(rows: DataFrame, by_source: DataFrame, how: str = "inner") -> DataFrame:
    right = by_source.withColumnRenamed("source", "_source")
    return rows.join(right, rows["source"].eqNullSafe(right["_source"]), how).drop("_source")


def thresholds(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``passes`` over all its documents, and the hash ``cut`` of one more pass.

    ``documents`` has source, size, hash. The unit (documents of one hash) in which the
    budget ends is taken where that comes nearer to it.
    """
    size = F.col("source_size")
    wanted = targets.withColumn(
        "passes", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("bigint")
    ).withColumn("rest", F.col("target") - (F.col("passes") * size).cast("double"))
    part = wanted.where("rest > 0").select("source", "rest", F.lit(0).cast("bigint").alias("before"))

    first = (
        documents.withColumn("top", _bucket(1)).groupBy("source", "top").agg(F.sum("size").alias("words"))
    )
    top = _boundary(_join_source(first, part), "top")
    inside = _join_source(documents, top).where(_bucket(1) == F.col("top"))
    second = (
        inside.withColumn("mid", _bucket(2))
        .groupBy("source", "mid", "before", "rest")
        .agg(F.sum("size").alias("words"))
    )
    mid = _boundary(second, "mid")
    units = (
        _join_source(documents, mid)
        .where(_bucket(2) == F.col("mid"))
        .groupBy("source", "mid", "hash", "before", "rest")
        .agg(F.sum("size").alias("words"))
    )
    running = W.partitionBy("source").orderBy("hash")
    upto = F.col("before") + F.sum("words").over(running)
    start = F.col("upto") - F.col("words")
    taken = (F.col("upto") <= F.col("rest")) | (
        (start < F.col("rest")) & (F.col("upto") - F.col("rest") <= F.col("rest") - start)
    )
    below = F.shiftleft("mid", HASH_BITS - 2 * LEVEL_BITS) - 1
    cuts = (
        units.withColumn("upto", upto)
        .groupBy("source")
        .agg(F.coalesce(F.max(F.when(taken, F.col("hash"))), F.max(below)).alias("cut"))
    )
    return _join_source(wanted, cuts, "left").select(
        "source", "source_size", "target", "passes", F.coalesce("cut", F.lit(-1)).alias("cut")
    )


def _plan(documents: DataFrame, doc_id, text, source, weights, share, max_repeats):
    """The written (doc_id, source, size, hash) table and thresholds per source."""
    scratch = Scratch(documents.sparkSession, "mixing")
    narrow = scratch.store(
        documents.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            document_hash(F.col(doc_id), F.col(text)).alias("hash"),
        ),
        "sizes",
    )
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, share, max_repeats)
    return narrow, scratch.store(thresholds(narrow, targets), "thresholds")


def _copies(max_repeats: int) -> Column:
    return F.least(
        F.col("passes") + (F.col("hash") <= F.col("cut")).cast("bigint"), F.lit(max_repeats)
    )


def mix(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """doc_id, source, size, hash, source_size, target, ``copies`` and ``taken`` per document.

    ``copies`` (0 to ``max_repeats``) is how often the mix holds the document, ``taken``
    its words times copies. Null text has size 0. Null sources are one source, the last.
    Rows with equal id and text share their hash and are taken together. Documents
    without words follow the threshold as well. An empty table gives no rows.
    """
    narrow, cuts = _plan(documents, doc_id, text, source, weights, share, max_repeats)
    return (
        _join_source(narrow, cuts)
        .withColumn("copies", _copies(max_repeats))
        .select(
            "doc_id",
            "source",
            "size",
            "hash",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def mixed_documents(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """The documents that the mix holds, repeated ones twice, with their own columns.

    Only the thresholds, one row per source, are joined; texts are not shuffled.
    """
    _, cuts = _plan(documents, doc_id, text, source, weights, share, max_repeats)
    cuts = cuts.select(F.col("source").alias("__source"), F.struct("passes", "cut").alias("__cut"))
    columns = [F.col(f"`{c}`") for c in documents.columns]
    hashed = document_hash(F.col(doc_id), F.col(text))
    more = F.coalesce(F.col("__cut.passes"), F.lit(0)) + (hashed <= F.col("__cut.cut")).cast("int")
    times = F.array_repeat(F.lit(1), F.least(more, F.lit(max_repeats)).cast("int"))
    return (
        documents.join(cuts, documents[source].eqNullSafe(cuts["__source"]))
        .select(*columns, F.explode(times).alias("__time"))
        .drop("__time")
    )

"""Benchmark decontamination with a positional inverted index (DataFrame functions only).

The index holds postings of the training corpus: a term, the document and position of
an occurrence, and the words around it. Only the terms that the search starts from are
stored. These are, for every window of test words, its rarest term in the corpus, so
that every occurrence of a window contains a posting. A posting is laid over each place
of its term in a test item; the lists of the other terms are intersected at adjusted
offsets by comparing the words on both sides outward from the common term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimeter.llm.shared import Scratch, ascii_lower

# What lies between words once A-Z are lowered; all else is a word.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Share of a test window's words that a corpus neighbourhood holds to count as near.
NEAR_SHARE = 0.8
# Not a word: its posting says that a document exists and how many words it has.
END = ""


def terms(text: Column) -> Column:
    """Lower-cased (A-Z) words: digits, letters a-z and everything beyond ASCII."""
    # Cutting takes a sixth of the time of collecting matches; only the ends of a text give empty words.
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _around(words: Column, at: Column, width: int) -> tuple[Column, Column]:
    """Up to ``width`` words before (nearest first) and after the 0-based position."""
    taken = F.least(at, F.lit(width))
    before = F.reverse(F.slice(words, F.greatest(at - taken + 1, F.lit(1)), taken))
    return before, F.slice(words, at + 2, F.lit(width))


def corpus_frequencies(documents: DataFrame, text: str, vocabulary: DataFrame) -> DataFrame:
    """How often each ``term`` of a stored vocabulary occurs in all documents."""
    found = documents.select(F.explode(terms(F.col(text))).alias("term")).join(vocabulary, "term")
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("frequency"))


def anchors(
    items: DataFrame, frequencies: DataFrame, window: int = WINDOW
) -> DataFrame:
    """The places of test items from which to search: the rarest term of each window.

    ``items`` has item_row, item_id and words. A window is ``window`` words, or a whole
    shorter item. Ties go to the smaller term, then to the earlier place.
    """
    ranked = (
        items.select("item_row", F.posexplode("words").alias("at", "term"))
        .join(frequencies, "term", "left")
        .select("item_row", F.struct(F.coalesce("frequency", F.lit(0)).alias("f"), "term", "at").alias("r"))
        .groupBy("item_row")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("r.at"), "r"))).alias("ranks"))
    )
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    rarest = F.transform(starts, lambda s: F.array_min(F.slice(F.col("ranks")["r"], s, length))["at"])
    before, after = _around(F.col("words"), F.col("at"), window - 1)
    return (
        items.join(ranked, "item_row")
        .withColumn("at", F.explode(F.array_distinct(rarest)))
        .select(
            F.element_at("words", F.col("at") + 1).alias("term"),
            "item_id",
            length.alias("needed"),
            before.alias("item_before"),
            after.alias("item_after"),
        )
    )


def postings(documents: DataFrame, doc_id: str, text: str, search: DataFrame, window: int = WINDOW) -> DataFrame:
    """term, row, doc_id, at, before, after for the stored table ``search`` of terms.

    Each document also has a posting of ``END`` at its number of words. ``row`` tells rows
    apart whose doc_id is null or repeated; it holds as long as the postings are stored.
    """
    words = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        terms(F.col(text)).alias("words"),
    )
    placed = words.select(
        "row", "doc_id", "words", F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("at", "term")
    )
    before, after = _around(F.col("words"), F.col("at"), window - 1)
    inside = F.col("term") != END
    return placed.join(search, "term").select(
        "term",
        "row",
        "doc_id",
        "at",
        F.when(inside, before).alias("before"),
        F.when(inside, after).alias("after"),
    )


def _equal_run(left: str, right: str) -> Column:
    """Number of leading elements that two arrays of words share."""
    differs = F.array_position(
        F.zip_with(left, right, lambda x, y: x.eqNullSafe(y)), False
    )
    return F.when(differs == 0, F.size(left)).otherwise(differs - 1).cast("int")


def matches(index: DataFrame, places: DataFrame, near_share: float = NEAR_SHARE) -> DataFrame:
    """row, item_id, kind, start, end (exclusive) of phrase and near matches.

    ``phrase``: the longest equal run through the common term, within a window's reach, that
    holds a whole window of the item. ``near``: the neighbourhood holds at least ``near_share``
    of the words around the item's term, in any order, without such a run.
    """
    back, forth = _equal_run("before", "item_before"), _equal_run("after", "item_after")
    anchor = F.array("term")
    item_words = F.array_distinct(F.concat("item_before", anchor, "item_after"))
    shared = F.array_intersect(item_words, F.concat("before", anchor, "after"))
    phrase = back + forth + 1 >= F.col("needed")
    near = F.size(shared) >= F.ceil(F.lit(near_share) * F.size(item_words))
    start = F.when(phrase, F.col("at") - back).otherwise(F.col("at") - F.size("before"))
    end = F.when(phrase, F.col("at") + forth + 1).otherwise(F.col("at") + F.size("after") + 1)
    return (
        index.join(places, "term")
        .where(phrase | near)
        .select(
            "row",
            "item_id",
            F.when(phrase, "phrase").otherwise("near").alias("kind"),
            start.alias("start"),
            end.alias("end"),
        )
    )


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    near_share: float = NEAR_SHARE,
) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids as text), near_items, contaminated per row.

    Every row of ``documents`` gives one row, repeated and null ids included. Null and empty
    texts have no words and no hits; items without words match nothing. An item without an
    id marks words, but is not listed. Repeated items count once. Empty tables give no hits.
    Small test sets are broadcast where the stored tables are under Spark's own limit and
    joined by shuffle beyond it.
    """
    scratch = Scratch(documents.sparkSession, "decontamination")
    items = scratch.store(
        benchmark.select(
            F.monotonically_increasing_id().alias("item_row"),
            F.col(item_id).cast("string").alias("item_id"),
            terms(F.col(item_text)).alias("words"),
        ).where(F.size("words") > 0),
        "items",
    )
    vocabulary = scratch.store(items.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    frequencies = scratch.store(corpus_frequencies(documents, text, vocabulary), "frequencies")
    places = scratch.store(anchors(items, frequencies, window), "anchors")
    end = documents.sparkSession.range(1).select(F.lit(END).alias("term"))
    search = scratch.store(places.select("term").distinct().unionByName(end), "search")
    index = scratch.store(postings(documents, doc_id, text, search, window), "postings")
    found = matches(index.where(F.col("term") != END), places, near_share)
    covered = F.when(F.col("kind") == "phrase", F.sequence("start", F.col("end") - 1))
    hits = found.select(
        "row",
        F.lit(None).cast("long").alias("n_words"),
        covered.alias("covered"),
        F.when(F.col("kind") == "phrase", F.col("item_id")).alias("item"),
        F.when(F.col("kind") == "near", F.col("item_id")).alias("near_item"),
    )
    rows = index.where(F.col("term") == END).select("row", "doc_id", F.col("at").cast("long").alias("n_words"))
    by_row = (
        rows.unionByName(hits, allowMissingColumns=True)
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.size(F.array_distinct(F.flatten(F.collect_set("covered")))).cast("long").alias("n_hit"),
            F.array_sort(F.collect_set("item")).alias("items"),
            F.collect_set("near_item").alias("near_items"),
        )
    )
    return by_row.select(
        "doc_id",
        "n_words",
        "n_hit",
        "items",
        F.array_sort(F.array_except("near_items", "items")).alias("near_items"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )

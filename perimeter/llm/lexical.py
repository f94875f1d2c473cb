"""Ranked lexical search by scanning documents with one automaton of all item terms.

There is no index of documents. The terms of all items form an Aho-Corasick automaton; each is
guarded by a blank on both sides, and a text is read with every separator as a blank, so a match
is a whole term. The automaton is broadcast and counts the occurrences of the terms straight from
the text. Its outputs map to the items that hold the term, so a document's scores are sums over
the matches alone.

Weights need the document frequencies, so texts are scanned twice: once for the corpus
statistics, once for the scores, of which a task keeps the best per item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from perimeter.llm.shared import Scratch, ascii_lower

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 10
# Bytes of the terms of one automaton: its nodes take some 60 bytes each.
AUTOMATON_BYTES = 2_000_000
# Scores (documents x items) and matched item terms that are held at once.
CELLS, MATCHES = 1 << 20, 1 << 20
# Parts of an item's candidates that are ranked on their own first.
PARTS = 32

_GUARD = b" "
# Separators become blanks, A-Z become a-z, all else (bytes beyond ASCII too) stays.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)
_COUNT_SCHEMA = "term int, times long, documents long"
_FOUND_SCHEMA = "item_row long, doc_id long, score long"


@dataclass(frozen=True)
class Terms:
    """The terms of a group of items, and for each the items that hold it, with repeats."""

    words: list[str]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray
    item_rows: np.ndarray

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        guard = _GUARD.decode()
        for number, word in enumerate(self.words):
            machine.add_word(f"{guard}{word}{guard}", number)
        if self.words:
            machine.make_automaton()
        return machine


@dataclass(frozen=True)
class Statistics:
    """Documents with terms, terms in all of them, and the weight of each item term."""

    documents: int
    terms: int
    weights: np.ndarray


def guarded(text: bytes) -> bytes:
    """The text with blanks for separators, at both ends too, and A-Z as a-z."""
    return _GUARD + text.translate(_PLAIN) + _GUARD


def term_count(plain: bytes) -> int:
    inside = np.frombuffer(plain, np.uint8) != 32
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def _tallies(batches: Iterator[pa.RecordBatch], terms: Terms) -> Iterator[tuple]:
    """doc_id, number of terms, and matched terms with their numbers, per document with terms."""
    machine = terms.automaton()
    for batch in batches:
        texts = batch["text"].cast(pa.binary())
        for doc_id, text in zip(batch["doc_id"], texts, strict=True):
            plain = guarded(text.as_py() or b"")
            count = term_count(plain)
            if not count:
                continue
            found = Counter()
            if terms.words:
                matched = machine.iter(plain.decode("utf-8", "surrogatepass"))
                found = Counter(map(itemgetter(1), matched))
            numbers = np.fromiter(found.keys(), np.int64, len(found))
            yield doc_id.as_py(), count, numbers, np.fromiter(found.values(), np.int64, len(found))


def _counting(shared: Broadcast):
    """One row per term that occurs in the task, and one without term for the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        frequency = np.zeros(len(terms.words), np.int64)
        documents = total = 0
        for _, count, numbers, _ in _tallies(batches, terms):
            frequency[numbers] += 1
            documents, total = documents + 1, total + count
        there = np.flatnonzero(frequency)
        columns = [
            pa.array([None, *there.tolist()], pa.int32()),
            pa.array([total, *(0 for _ in there)], pa.int64()),
            pa.array([documents, *frequency[there].tolist()], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["term", "times", "documents"])

    return run


class _Best:
    """The k best documents of each item so far: higher scores, then smaller ids, missing ones last."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.least = k, np.ones(items, np.int64)
        self.held = [np.zeros(0, np.int64) for _ in range(4)]

    def add(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        new = (item, score, ids, missing)
        item, score, ids, missing = (np.concatenate(c) for c in zip(self.held, new, strict=True))
        order = np.lexsort((ids, missing, -score, item))
        item, score, ids, missing = (c[order] for c in (item, score, ids, missing))
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.k
        self.held = [c[kept] for c in (item, score, ids, missing)]
        full = place == self.k - 1
        self.least[item[full]] = score[full]

    def batch(self, item_rows: np.ndarray) -> pa.RecordBatch:
        item, score, ids, missing = self.held
        columns = [pa.array(item_rows[item]), pa.array(ids, mask=missing == 1), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, ["item_row", "doc_id", "score"])


def _scores(terms: Terms, statistics: Statistics, counts, owners, numbers, times) -> np.ndarray:
    """Documents x items: the sum over matched terms of weight times saturated frequency."""
    items = len(terms.item_rows)
    scores = np.zeros((len(counts), items), np.int64)
    length = 25 + 75 * counts * statistics.documents // statistics.terms
    saturated = 1_000_000_000 * times // (1000 * times + 8 * length[owners])
    value = statistics.weights[numbers] * saturated
    spans = terms.starts[numbers + 1] - terms.starts[numbers]
    ends = np.cumsum(spans)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(terms.starts[numbers] - ends + spans, spans)
    cells = np.repeat(owners, spans) * items + terms.items[at]
    np.add.at(scores.ravel(), cells, np.repeat(value, spans) * terms.times[at])
    return scores


def _ranking(shared: Broadcast, statistics: Statistics, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        best = _Best(len(terms.item_rows), k)
        at_once = max(1, CELLS // max(len(terms.item_rows), 1))
        held: list[tuple] = []
        matches = 0

        def flush() -> None:
            ids, counts, numbers, times = zip(*held, strict=True)
            owners = np.repeat(np.arange(len(held)), [len(n) for n in numbers])
            scores = _scores(
                terms, statistics, np.array(counts), owners, np.concatenate(numbers), np.concatenate(times)
            )
            document, item = np.nonzero(scores >= best.least)
            if len(document):
                known = np.array([i if i is not None else 0 for i in ids], np.int64)
                missing = np.array([i is None for i in ids], np.int64)
                best.add(item, scores[document, item], known[document], missing[document])

        spans = np.diff(terms.starts)
        for tally in _tallies(batches, terms):
            held.append(tally)
            matches += int(spans[tally[2]].sum())
            if len(held) >= at_once or matches >= MATCHES:
                flush()
                held, matches = [], 0
        if held:
            flush()
        yield best.batch(terms.item_rows)

    return run


def _items(benchmark: DataFrame, item_id: str, text: str, scratch: Scratch) -> DataFrame:
    """item_row, item_id and the item's terms (term, times) as an array."""
    found = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TERM), F.lit(0))
    rows = benchmark.select(
        F.monotonically_increasing_id().alias("item_row"), F.col(item_id).alias("item_id"), found.alias("terms")
    )
    return scratch.store(rows.where(F.size("terms") > 0), "items")


def _groups(items: DataFrame, most: int) -> DataFrame:
    """Items with ``group``, numbered so that the terms of a group have at most ``most`` bytes.

    An item is never divided: one with more terms has a group to itself.
    """
    size = F.aggregate(F.array_distinct("terms"), F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 2)
    sized = items.withColumn("size", size)
    total = sized.agg(F.sum("size")).first()[0] or 0
    count = max(1, -(-total // most))
    while True:
        grouped = sized.withColumn("group", F.pmod(F.xxhash64("item_row"), F.lit(count)))
        over = grouped.groupBy("group").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        if not over.where((F.col("size") > most) & (F.col("n") > 1)).limit(1).count():
            return grouped.select("item_row", "terms", "group")
        count *= 2


def _terms(group: DataFrame) -> Terms:
    """The terms of one group; its size is bounded."""
    rows = group.select("item_row", F.explode("terms").alias("term")).groupBy("term", "item_row").agg(
        F.count(F.lit(1)).alias("times")
    )
    found = rows.orderBy("term", "item_row").toArrow()
    names, first = np.unique(np.array(found["term"].to_pylist(), object), return_index=True)
    item_rows, items = np.unique(found["item_row"].to_numpy(), return_inverse=True)
    starts = np.append(first, found.num_rows).astype(np.int64)
    return Terms(list(names), starts, items, found["times"].to_numpy(), item_rows)


def _statistics(rows: DataFrame, terms: Terms, shared: Broadcast) -> Statistics:
    counted = rows.mapInArrow(_counting(shared), _COUNT_SCHEMA).groupBy("term")
    summed = counted.agg(F.sum("times").alias("times"), F.sum("documents").alias("documents")).collect()
    frequency = {r["term"]: r["documents"] for r in summed}  # one row per term of the group
    documents = frequency.get(None, 0)
    weights = [
        floor(1000 * log((2 * documents + 2) / (2 * frequency.get(n, 0) + 1))) for n in range(len(terms.words))
    ]
    total = next((r["times"] for r in summed if r["term"] is None), 0)
    return Statistics(documents, max(total, 1), np.array(weights, np.int64))


def search(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = K,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of each row of ``benchmark``.

    Only scores above 0 are listed; equal ones go by doc_id, missing ids last. Each row of
    either table counts, repeated ones too, so an id that occurs twice can be listed twice. Null
    and empty texts have no terms; items without terms have no rows, nor has anything where a
    table is empty. Items whose terms don't fit into one automaton are searched in groups.
    """
    spark: SparkSession = documents.sparkSession
    scratch = Scratch(spark, "lexical")
    items = _items(benchmark, item_id, item_text, scratch)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    grouped = scratch.store(_groups(items, automaton_bytes), "groups")
    numbers = [r["group"] for r in grouped.select("group").distinct().orderBy("group").collect()]
    found = spark.createDataFrame([], _FOUND_SCHEMA)
    for number in numbers:
        terms = _terms(grouped.where(F.col("group") == number))
        shared = spark.sparkContext.broadcast(terms)
        statistics = _statistics(rows, terms, shared)
        found = found.unionByName(rows.mapInArrow(_ranking(shared, statistics, k), _FOUND_SCHEMA))

    def ranked(rows: DataFrame, *keys: str) -> DataFrame:
        order = W.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    parts = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS)))
    best = ranked(ranked(parts, "item_row", "part").drop("rank"), "item_row")
    return best.join(items.select("item_row", "item_id"), "item_row").select("item_id", "rank", "doc_id", "score")

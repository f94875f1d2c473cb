"""Jaccard self-join of word n-gram sets by vertical partitioning.

All n-grams have one global order: by frequency class (rare first, from a count sketch of the
whole corpus), then by hash. The order is cut into fragments of equal weight, and a set into
its segments. Two sets can only link if they share one of their first, rarest n-grams; such
pairs are candidates. For a candidate the overlap is counted in each fragment on its own, by
joining segments, and the partial counts are summed per pair.

Equal sets are one class from the start. Pairs inside a component that is already connected
need no count, so a group of near copies is first tied to few of its members; all candidate
pairs between different components are then counted, and none is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimeter.llm.components import components
from perimeter.llm.shared import Scratch

WORDS, PERCENT = 5, 80
FRAGMENTS = 8
# Counters of the frequency sketch, bits of the candidate filter: both of fixed size.
SKETCH_BITS, FILTER_BITS, CHUNKS = 22, 27, 64
# Rare n-grams that two sets must share to be counted (or all they need, if that is less).
# One would do; by chance two texts share one far more often than several.
EVIDENCE = 3
# Bytes of text that are cut into words at once.
PIECE = 1 << 18
LONG, INT, BINARY = pa.int64(), pa.int32(), pa.binary()
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word n-grams.

    A-Z count as a-z, words are split at ASCII blanks; a text of fewer words, but not none, is
    one n-gram. 64 bits: two n-grams of one pair of texts collide with negligible probability.
    """
    split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    lengths = np.array([len(w) for w in split], np.int64)
    flat = np.empty(int(lengths.sum()), object)
    flat[:] = [w for line in split for w in line]
    if not len(flat):
        return [np.zeros(0, np.uint64) for _ in split]
    hashed = pd.util.hash_array(flat, categorize=False)
    size = max(len(hashed) - words + 1, 0)
    grams = np.full(size, np.uint64(words))
    for n in range(words):
        grams = grams * _MIX + hashed[n : n + size]
    grams = _mixed(grams)
    sets, at = [], 0
    for length in lengths:
        if length >= words:
            sets.append(np.unique(grams[at : at + length - words + 1]))
        elif length:
            short = np.uint64(length)
            with np.errstate(over="ignore"):
                for h in hashed[at : at + length]:
                    short = short * _MIX + h
            sets.append(_mixed(np.array([short])))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += length
    return sets


def set_class(grams: np.ndarray) -> int:
    """64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "big", signed=True)


class Order:
    """The global order, from the frequency class of each sketch counter."""

    def __init__(self, classes: np.ndarray, weights: np.ndarray) -> None:
        self.classes = classes
        self.starts = np.concatenate([[0.0], np.cumsum(weights)[:-1]])
        self.weights = weights

    def frequency_class(self, grams: np.ndarray) -> np.ndarray:
        return self.classes[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]

    def rarest(self, grams: np.ndarray, count: int) -> np.ndarray:
        return grams[np.lexsort((grams, self.frequency_class(grams)))[:count]]

    def fragment(self, grams: np.ndarray, fragments: int) -> np.ndarray:
        """Fragments are ranges of the order that hold about equal numbers of n-grams."""
        kind = self.frequency_class(grams)
        place = self.starts[kind] + self.weights[kind] * (grams / 2.0**64)
        return np.minimum((place * fragments).astype(np.int64), fragments - 1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of some text: words as objects need many times its memory."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + PIECE, side="right")))
            yield batch.slice(at, to - at)
            at = to
        # A worker is used again by later steps; what Arrow holds back would come on top of theirs.
        del batch
        pa.default_memory_pool().release_unused()


def _batches(columns: tuple[str, ...], make: Callable) -> Callable:
    """A mapInArrow function from one that turns column lists into rows of arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            yield from make(*(batch[c].to_pylist() for c in columns))

    return run


def _described(words: int) -> Callable:
    """One row per document; the sketch of the task's n-grams follows in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int32)
        names = ["doc_id", "n", "class", "chunk", "counts"]
        types = [LONG, LONG, LONG, INT, BINARY]
        for batch in _pieces(batches):
            sets = shingle_sets(batch["text"].to_pylist(), words)
            classes = [set_class(s) if len(s) else None for s in sets]
            first = {c: s for c, s in zip(classes, sets, strict=True) if c is not None}
            if first:
                grams = np.concatenate(list(first.values())) >> np.uint64(64 - SKETCH_BITS)
                # Only counters that a piece touches: copies of the whole sketch would be four times its size.
                places, times = np.unique(grams.astype(np.int32), return_counts=True)
                counts[places] += times.astype(np.int32)
            none = [None] * len(sets)
            rows = [batch["doc_id"], [len(s) for s in sets], classes, none, none]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, t) if isinstance(r, list) else r for r, t in zip(rows, types, strict=True)], names
            )
        if counts.any():
            parts = [zstandard.compress(p.astype(np.int64).tobytes()) for p in np.split(counts, CHUNKS)]
            none = [None] * CHUNKS
            rows = [none, none, none, list(range(CHUNKS)), parts]
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=True)], names)

    return run


def _summed(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zstandard.decompress(c), np.int64) for c in rows["counts"].to_pylist())
    return pa.table({"chunk": rows["chunk"][:1], "counts": [zstandard.compress(total.tobytes())]})


def global_order(described: DataFrame) -> Order:
    """Adds up the sketches of all tasks, in two steps so that no group holds them all.

    A counter above twice the mean is of a higher class, one per doubling.
    """
    parts = described.where(F.col("chunk").isNotNull()).select(
        "chunk", "counts", F.pmod(F.xxhash64("counts"), F.lit(256)).alias("part")
    )
    for keys in (("chunk", "part"), ("chunk",)):
        schema = "chunk int, counts binary"
        parts = parts.groupBy(*keys).applyInArrow(lambda _, t: _summed(t), schema)
    counts = np.zeros((CHUNKS, (1 << SKETCH_BITS) // CHUNKS), np.int64)
    for row in parts.collect():  # CHUNKS rows of fixed size
        counts[row["chunk"]] = np.frombuffer(zstandard.decompress(bytes(row["counts"])), np.int64)
    counts = counts.ravel()
    mean = max(counts.mean(), 1.0)
    classes = np.clip(np.log2(np.maximum(counts, 1) / mean), 0, 60).astype(np.uint8)
    weights = np.bincount(classes, weights=counts, minlength=61)
    return Order(classes, weights / max(weights.sum(), 1))


PREFIX = ["gram", "class", "n", "place", "common"]
PREFIX_SCHEMA = "gram long, class long, n int, place int, common int"


def _prefixes(words: int, percent: int, order) -> Callable:
    """The rarest n-grams of each set: a row has the set's size, the place of the n-gram in the
    order, and how common the set's n-grams are on the whole. Sets too small to link with any
    other one (below four n-grams at 80 percent) have none: equal ones are one class already."""

    def make(texts):
        columns = [[] for _ in PREFIX]
        sets = [s for s in shingle_sets(texts, words) if 100 * len(s) >= percent * (len(s) + 1)]
        for name, grams in {set_class(s): s for s in sets}.items():
            first = order.value.rarest(grams, len(grams) + percent * len(grams) // -100 + EVIDENCE)
            common = int(1000 * order.value.frequency_class(grams).mean())
            columns[0].append(first.view(np.int64))
            for column, value in zip(columns[1:3], (name, len(grams)), strict=True):
                column.append(np.full(len(first), value))
            columns[3].append(np.arange(len(first)))
            columns[4].append(np.full(len(first), common))
        if columns[0]:
            types = (LONG, LONG, INT, INT, INT)
            arrays = [pa.array(np.concatenate(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, PREFIX)

    return _batches(("text",), make)


def _can_link(n, place, m, other, percent: int):
    """Whether an n-gram at these places of two sets of sizes n and m can be one of the first
    ``EVIDENCE`` that they share if they link.

    The overlap they need leaves each set so many n-grams outside it, and the first common
    ones lie no further in than that. Works on numbers, arrays and columns.
    """
    # The smallest overlap is percent / (100 + percent) of n + m, rounded up.
    outside_n = (100 + percent) * (n - place + EVIDENCE - 1) >= percent * (n + m)
    outside_m = (100 + percent) * (m - other + EVIDENCE - 1) >= percent * (n + m)
    return outside_n & outside_m & (100 * n >= percent * m) & (100 * m >= percent * n)


# Rows of one n-gram that are compared with each other here; of more, all go on.
NEAR, HELD = 32, 1 << 17


def _shared(percent: int) -> Callable:
    """Of rows sorted by gram and class: those that can link with another class of the gram,
    without repeats."""

    def chosen(rows: np.ndarray) -> np.ndarray:
        rows = rows[:, np.append(True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0))]
        grams, n, place = rows[0], rows[2], rows[3]
        keep = np.zeros(rows.shape[1], bool)
        many = grams[:-NEAR] == grams[NEAR:]
        for d in range(1, min(NEAR, rows.shape[1] - 1) + 1):
            same = grams[:-d] == grams[d:]
            if not same.any():
                break
            pairs = same & _can_link(n[:-d], place[:-d], n[d:], place[d:], percent)
            keep[:-d] |= pairs
            keep[d:] |= pairs
        if many.any():
            keep |= np.isin(grams, grams[:-NEAR][many])
        return rows[:, keep]

    def batch_of(rows: np.ndarray) -> pa.RecordBatch:
        types = (LONG, LONG, INT, INT, INT)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], PREFIX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(PREFIX), 0), np.int64)
        hot = None  # an n-gram of more rows than are held: all of them go on
        for batch in batches:
            rows = np.stack([batch[c].to_numpy().astype(np.int64) for c in PREFIX])
            held = np.concatenate([held, rows], axis=1)
            if not held.shape[1]:
                continue
            if hot is not None:
                known = held[0] == hot
                yield batch_of(held[:, known])
                held = held[:, ~known]
                if not held.shape[1]:
                    continue
                hot = None
            whole = int(np.searchsorted(held[0], held[0, -1]))
            if whole:
                yield batch_of(chosen(held[:, :whole]))
                held = held[:, whole:]
            if held.shape[1] > HELD:
                hot = held[0, 0]
                yield batch_of(held)
                held = held[:, :0]
        if held.shape[1]:
            yield batch_of(chosen(held))

    return run


def _segments(words: int, fragments: int, order, wanted) -> Callable:
    def make(ids, texts):
        bits = wanted.value
        keep = [
            n
            for n, i in enumerate(ids)
            if i is None or bits[(place := _filter_place(i)) >> 3] >> (place & 7) & 1
        ]
        sets = {set_class(s): s for s in shingle_sets([texts[n] for n in keep], words) if len(s)}
        names, numbers, parts = [], [], []
        for name, grams in sets.items():
            of = order.value.fragment(grams, fragments)
            for f in np.unique(of):
                names.append(name)
                numbers.append(int(f))
                parts.append(grams[of == f].view(np.int64))
        if names:
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, LONG), pa.array(numbers, INT), lists], ["class", "fragment", "grams"]
            )

    return _batches(("doc_id", "text"), make)


def _filter_place(doc_id: int) -> int:
    return (doc_id * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - FILTER_BITS)


_CHUNK_BITS = 15


def _bitmap(rows: pa.Table) -> pa.Table:
    bits = np.zeros(1 << _CHUNK_BITS, np.uint8)
    bits[rows["place"].to_numpy() & ((1 << _CHUNK_BITS) - 1)] = 1
    return pa.table({"chunk": rows["chunk"][:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def _filter_of(ids: DataFrame) -> np.ndarray:
    """Bitmap of fixed size over hashed ids: it may let others pass, but none of these out."""
    place = F.pandas_udf(lambda s: pd.Series([_filter_place(i) for i in s]), "long")
    rows = ids.select(place("doc_id").alias("place")).distinct()
    rows = rows.select("place", F.shiftright("place", _CHUNK_BITS).alias("chunk"))
    bits = np.zeros((1 << (FILTER_BITS - _CHUNK_BITS), 1 << (_CHUNK_BITS - 3)), np.uint8)
    for row in rows.groupBy("chunk").applyInArrow(_bitmap, "chunk long, bits binary").toLocalIterator():
        bits[row["chunk"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bits.ravel()


def _counted(pairs: DataFrame, segments: DataFrame, fragments: int, percent: int) -> DataFrame:
    """Pairs x, y (with sizes n, m) and ``linked``: partial overlaps per fragment, summed.

    Segments are bucketed by class and fragment and stay where they are; of each pair one
    segment at a time moves to the other. A set that was cut twice counts once.
    """
    left = segments.select(F.col("class").alias("x"), "fragment", F.col("grams").alias("left"))
    right = segments.select(F.col("class").alias("y"), "fragment", F.col("grams").alias("right"))
    partial = F.size(F.array_intersect("left", "right")).cast("long")
    parts = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))))
    both = parts.join(left, ["x", "fragment"]).join(right, ["y", "fragment"])
    overlap = (
        both.select("x", "y", "fragment", partial.alias("part"))
        .groupBy("x", "y", "fragment")
        .agg(F.max("part").alias("part"))
        .groupBy("x", "y")
        .agg(F.sum("part").alias("shared"))
    )
    shared = F.coalesce("shared", F.lit(0))
    union = F.col("n") + F.col("m") - shared
    return pairs.join(overlap, ["x", "y"], "left").select(
        "x", "y", (100 * shared >= percent * union).alias("linked")
    )


def _can_link_columns(percent: int):
    return _can_link(*(F.col(c).cast("long") for c in ("n", "place", "m", "other")), percent)


def _enough(percent: int):
    """Whether ``times`` shared n-grams are as many as linked sets of sizes n and m share there."""
    overlap = F.ceil(percent * (F.col("n") + F.col("m")).cast("long") / (100 + percent))
    return F.col("times") >= F.least(overlap, F.lit(EVIDENCE))


def _tied(rows: DataFrame, percent: int) -> DataFrame:
    """Per class one pair: with the most common set of one of its n-grams that can link.

    In a group of near copies that is the one with the fewest edits, so most members are tied
    to it at once. Only a start: pairs between components are all counted in the end.
    """
    turn = F.struct(-F.col("common"), "class", F.col("n").alias("m"), F.col("place").alias("other"), "label")
    centres = rows.groupBy("gram").agg(F.min(turn).alias("centre"))
    pairs = (
        rows.join(centres, "gram")
        .where(F.col("centre.label") != F.col("label"))
        .select(F.col("class").alias("x"), "n", "place", "centre.m", "centre.other", F.col("centre.class").alias("y"))
        .where(_can_link_columns(percent))
        .groupBy("x", "n", "y", "m")
        .agg(F.count(F.lit(1)).alias("times"))
        .where(_enough(percent))
    )
    best = pairs.groupBy("x", "n").agg(F.max_by(F.struct("y", "m"), F.struct("times", "y")).alias("b"))
    return best.select("x", "n", "b.y", "b.m")


def _remaining(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs of classes of different components that share enough rare n-grams to link."""
    left = rows.select("gram", F.col("class").alias("x"), "n", "place", F.col("label").alias("label_x"))
    right = rows.select(
        "gram",
        F.col("class").alias("y"),
        F.col("n").alias("m"),
        F.col("place").alias("other"),
        F.col("label").alias("label_y"),
    )
    apart = (F.col("x") < F.col("y")) & (F.col("label_x") != F.col("label_y"))
    pairs = left.join(right, "gram").where(apart & _can_link_columns(percent))
    shared = pairs.groupBy("x", "y", "n", "m").agg(F.count(F.lit(1)).alias("times"))
    return shared.where(_enough(percent)).drop("times")


def _open(rows: DataFrame) -> DataFrame:
    """Rows of n-grams that still have classes of several components."""
    several = rows.groupBy("gram").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b")
    return rows.join(several.select("gram"), "gram", "left_semi")


def jaccard_components(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    fragments: int = FRAGMENTS,
    tying_rounds: int = 1,
) -> DataFrame:
    """doc_id, n_shingles, class (smallest id with an equal set), component_id, per row.

    Two texts link when their n-gram sets have a Jaccard similarity of at least ``percent``
    percent; a component is what links connect, named by its smallest doc_id. Null texts and
    texts without words have an empty set and stand alone. Rows without id count as members and
    get the component of others with an equal or linked set. Repeated ids and rows are kept.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "ngram-join")
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    described = scratch.store(
        source.mapInArrow(
            _described(words), "doc_id long, n long, class long, chunk int, counts binary"
        ),
        "described",
    )
    order = spark.sparkContext.broadcast(global_order(described))
    rows = described.where(F.col("chunk").isNull()).select("doc_id", "n", "class")
    classes = scratch.store(
        rows.where("n > 0").groupBy("class", "n").agg(F.min("doc_id").alias("first")), "classes"
    )
    prefixes = source.select("text").mapInArrow(_prefixes(words, percent, order), PREFIX_SCHEMA)
    shared = scratch.store(
        prefixes.repartition("gram")
        .sortWithinPartitions("gram", "class")
        .mapInArrow(_shared(percent), PREFIX_SCHEMA),
        "shared",
    )

    def segments_of(pairs: DataFrame) -> DataFrame:
        """Segments of the sets that occur in pairs, cut anew from the texts."""
        named = pairs.select(F.explode(F.array("x", "y")).alias("class")).distinct()
        ids = classes.join(named, "class", "left_semi").select(F.col("first").alias("doc_id"))
        # Rows without id can't be found again by it: all of them pass the filter.
        wanted = spark.sparkContext.broadcast(_filter_of(ids.where(F.col("doc_id").isNotNull())))
        cut = source.mapInArrow(
            _segments(words, fragments, order, wanted), "class long, fragment int, grams array<long>"
        )
        found = scratch.bucketed(cut, "segments", "class", "fragment")
        wanted.unpersist()
        return found

    labels = None
    counted = None
    for turn in range(tying_rounds + 1):
        labelled = shared.withColumn("label", F.col("class"))
        if labels is not None:
            labelled = shared.join(
                labels.select(F.col("node").alias("class"), F.col("label").alias("_label")), "class", "left"
            ).select(*PREFIX, F.coalesce("_label", "class").alias("label"))
        remaining = scratch.store(_open(labelled), "open")
        pairs = _remaining(remaining, percent) if turn == tying_rounds else _tied(remaining, percent)
        pairs = pairs.select(
            F.least("x", "y").alias("x"),
            F.greatest("x", "y").alias("y"),
            F.when(F.col("x") < F.col("y"), F.col("n")).otherwise(F.col("m")).cast("long").alias("n"),
            F.when(F.col("x") < F.col("y"), F.col("m")).otherwise(F.col("n")).cast("long").alias("m"),
        ).distinct()
        if counted is not None:
            pairs = pairs.join(counted.select("x", "y"), ["x", "y"], "left_anti")
        # Written, so that Spark knows how small they are and need not move the segments.
        pairs = scratch.store(pairs, "pairs")
        found = scratch.store(_counted(pairs, segments_of(pairs), fragments, percent), "counted")
        counted = found if counted is None else counted.unionByName(found)
        edges = found.where("linked").select(F.col("x").alias("u"), F.col("y").alias("v"))
        if labels is not None:
            edges = edges.unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("v")))
        labels = components(edges, scratch)

    named = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "first", F.coalesce("label", "class").alias("label")
    )
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    by_class = scratch.store(
        named.join(smallest, "label").select("class", F.col("first").alias("set_id"), "component_id"), "named"
    )
    return rows.join(by_class, "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("set_id", "doc_id").alias("class"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )

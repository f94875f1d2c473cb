"""Removal of long repeated strings with a logarithmic family of suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier. Strings are
found by their anchor, the smallest hashed gram inside: equal strings have equal anchors, and
neighbouring strings share theirs, so a text becomes a few runs. Runs whose anchor occurs once
in the corpus can't repeat and are left out. A run that equals an earlier one is removed as a
whole. What remains are runs that share an anchor but differ. They arrive in document order at
the task of their anchor, batch by batch: a batch gets a suffix array (its strings, sorted), is
merge-scanned against the levels of earlier batches, and equal-sized levels merge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimeter.llm.shared import KEY, Scratch, with_key

LENGTH, GRAM = 100, 24
REACH = LENGTH - GRAM + 1
# Bytes that are hashed at once; positions inside must fit into POSITION_BITS.
CHUNK, POSITION_BITS = 1 << 19, 20
# Runs of a batch, and runs of one anchor that meet in one task; more are split by their strings.
BATCH, TOGETHER = 4_096, 20_000
# An anchor seen this often in one Arrow batch is known to repeat and needn't meet the others.
KNOWN = 8
_BASE = 0x9E3779B97F4A7C15
_RANDOM = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 24 bytes from each position, by doubling."""
    one = _RANDOM[data]
    two = one[:-1] * _power(1) + one[1:]
    four = two[:-2] * _power(2) + two[2:]
    eight = four[:-4] * _power(4) + four[4:]
    sixteen = eight[:-8] * _power(8) + eight[8:]
    both = sixteen[: len(data) - GRAM + 1] * _power(8) + eight[16:]
    both ^= both >> np.uint64(31)
    both *= np.uint64(0xBF58476D1CE4E5B9)
    return both ^ (both >> np.uint64(29))


def _anchors(hashes: np.ndarray) -> np.ndarray:
    """Position of the smallest hash (leftmost of equals) among ``REACH`` from each position."""
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = REACH - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    return (least & low).astype(np.int64)


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """anchor, text number, first string and number of strings of every run."""
    parts: list[tuple[int, int, bytes]] = []
    for n, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, CHUNK):
            parts.append((n, at, text[at : at + CHUNK + LENGTH - 1]))
    found = []
    while parts:
        taken, size = 0, 0
        while taken < len(parts) and (not taken or size + len(parts[taken][2]) <= CHUNK):
            size += len(parts[taken][2])
            taken += 1
        group, parts = parts[:taken], parts[taken:]
        data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        hashes = _gram_hashes(data)
        places = _anchors(hashes)
        sizes = np.array([len(p) for _, _, p in group])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        new = np.append(True, places[1:] != places[:-1])
        new[begins] = True
        first = np.zeros(len(places) + 1, np.int64)
        first[begins] += 1
        np.add.at(first, ends - LENGTH + 1, -1)
        starts = np.flatnonzero(new & (np.cumsum(first)[: len(places)] > 0))
        of = np.searchsorted(ends, starts, side="right")
        stops = np.minimum(np.append(starts[1:], len(data)), ends[of] - LENGTH + 1)
        number = np.array([n for n, _, _ in group])[of]
        offset = np.array([at for _, at, _ in group])[of] + starts - begins[of]
        found.append((hashes[places[starts]].view(np.int64), number, offset, stops - starts))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _bytes(column: pa.Array) -> list[bytes]:
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        blobs = pa.array([compressor.compress(t) for t in _bytes(batch["text"])], pa.binary())
        yield pa.RecordBatch.from_arrays([batch["key"], blobs], ["key", "packed"])


def _unpacked(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs with the value ``to`` by which they are dealt out: the anchor, or for anchors known
    to repeat the document, with one marker (key -1) that tells the anchor's task."""
    for batch in batches:
        anchors, numbers, starts, counts = runs_of(_bytes(batch["text"]))
        keys = batch["key"].to_numpy()[numbers]
        values, inverse, often = np.unique(anchors, return_inverse=True, return_counts=True)
        known = often[inverse] >= KNOWN
        marks = values[often >= KNOWN]
        none = np.full(len(marks), -1)
        columns = [
            (np.where(known, keys, anchors), marks),
            (anchors, marks),
            (keys, none),
            ((starts << 7) | counts, none),
        ]
        arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in columns]
        arrays.append(pa.array(np.append(known, np.zeros(len(marks), bool))))
        yield pa.RecordBatch.from_arrays(arrays, ["to", "anchor", "key", "run", "known"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor: runs whose anchor has another row, or is known to repeat."""
    names = ["anchor", "key", "run"]
    last, shown = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        anchors, keys, runs = (batch[c].to_numpy() for c in names)
        known = batch["known"].to_numpy(zero_copy_only=False)
        if last is not None:
            anchors, keys = np.append(last[0], anchors), np.append(last[1], keys)
            runs, known = np.append(last[2], runs), np.append(last[3], known)
        same = anchors[1:] == anchors[:-1]
        several = np.append(False, same) | np.append(same, False) | known
        fresh = several.copy()
        if last is not None:
            fresh[0] &= not shown
        shown = bool(several[-1])
        last = (anchors[-1], keys[-1], runs[-1], known[-1])
        fresh &= keys >= 0
        yield pa.RecordBatch.from_arrays([pa.array(c[fresh]) for c in (anchors, keys, runs)], names)


def _name_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins runs with their bytes: anchor, content (hash), key, start, strings."""
    for batch in batches:
        for n in range(batch.num_rows):
            text = _unpacked(batch["packed"][n].as_py())
            runs = batch["runs"][n].values
            packed = runs.field("run").to_numpy()
            starts, counts = packed >> 7, packed & 127
            names = [
                xxhash.xxh3_64_intdigest(text[s : s + c + LENGTH - 1])
                for s, c in zip(starts.tolist(), counts.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    runs.field("anchor"),
                    pa.array(np.array(names, np.uint64).view(np.int64)),
                    pa.array(np.full(len(starts), batch["key"][n].as_py())),
                    pa.array(starts),
                    pa.array(counts),
                ],
                ["anchor", "content", "key", "start", "strings"],
            )


def _cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "split", "splits", "key", "start", "bytes"]
    for batch in batches:
        for n in range(batch.num_rows):
            text, key = _unpacked(batch["packed"][n].as_py()), batch["key"][n].as_py()
            runs = batch["runs"][n].as_py()
            cut = [text[r["start"] : r["start"] + r["strings"] + LENGTH - 1] for r in runs]
            rows = [[r[c] for r in runs] for c in ("anchor", "split", "splits", "start")]
            columns = [pa.array(rows[0]), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int32())]
            columns += [pa.array([key] * len(runs)), pa.array(rows[3]), pa.array(cut, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)


class Levels:
    """Suffix arrays of earlier batches: sorted distinct strings, in levels of growing size."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def known(self, strings: np.ndarray) -> np.ndarray:
        """Which of the sorted strings some level holds."""
        found = np.zeros(len(strings), bool)
        for level in self.levels:
            place = np.minimum(np.searchsorted(level, strings), len(level) - 1)
            found |= level[place] == strings
        return found

    def add(self, strings: np.ndarray) -> None:
        """A new level; levels merge while the newer is at least as large as the older."""
        self.levels.append(strings)
        while len(self.levels) > 1 and len(self.levels[-1]) >= len(self.levels[-2]):
            newer, older = self.levels.pop(), self.levels.pop()
            self.levels.append(np.union1d(older, newer))


def _strings(contents: list[bytes], split: np.ndarray, splits: np.ndarray):
    """All strings of the runs as fixed-width values, with run number and place in the run."""
    counts = np.array([len(c) - LENGTH + 1 for c in contents])
    # UTF-8 has no byte 255, so adding one leaves no zero, which fixed-width values would drop.
    data = np.frombuffer(b"".join(contents), np.uint8) + np.uint8(1)
    begins = np.cumsum([0, *map(len, contents[:-1])])
    number = np.repeat(np.arange(len(contents)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[begins[number] + place]
    windows = np.ascontiguousarray(windows)
    if (splits > 1).any():
        mine = np.array(
            [
                splits[r] == 1 or xxhash.xxh3_64_intdigest(w.tobytes()) % int(splits[r]) == split[r]
                for r, w in zip(number, windows, strict=True)
            ]
        )
        windows, number, place = windows[mine], number[mine], place[mine]
    return windows.view(f"S{LENGTH}").ravel(), number, place


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of runs sorted by anchor and document: the places of strings that start earlier, too.

    Equal strings have one anchor, so levels are kept for the anchor that the last batch ended
    in and dropped when it changes. Any number of small groups share one sort.
    """
    levels, current = Levels(), None
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            anchors, split = part["anchor"].to_numpy(), part["split"].to_numpy()
            group = list(zip(anchors.tolist(), split.tolist(), strict=True))
            strings, number, place = _strings(part["bytes"].to_pylist(), split, part["splits"].to_numpy())
            order = np.argsort(strings, kind="stable")
            array = strings[order]
            first = np.append(True, array[1:] != array[:-1])[: len(array)]
            earlier = np.zeros(len(strings), bool)
            earlier[order] = ~first
            in_group = np.array([g == group[-1] for g in group])
            if current is not None and group[0] == current:
                continued = np.array([g == current for g in group])[number[order]]
                rows = order[continued]
                earlier[rows] |= levels.known(strings[rows])
            if group[-1] != current:
                levels = Levels()
            current = group[-1]
            mine = first & in_group[number[order]]
            if mine.any():
                fresh = array[mine]
                levels.add(fresh[~levels.known(fresh)] if levels.levels else fresh)
                levels.levels = [level for level in levels.levels if len(level)]
            keys, starts = part["key"].to_numpy(), part["start"].to_numpy()
            found = number[earlier]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[found]), pa.array(starts[found] + place[earlier])], ["key", "start"]
            )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in batches:
        rows = []
        for n in range(batch.num_rows):
            text = np.frombuffer(_unpacked(batch["packed"][n].as_py()), np.uint8)
            spans = batch["spans"][n]
            change = np.zeros(len(text) + 1, np.int64)
            if spans.is_valid:
                starts = spans.values.field("start").to_numpy()
                np.add.at(change, starts, 1)
                np.add.at(change, starts + spans.values.field("strings").to_numpy() + LENGTH - 1, -1)
            gone = np.cumsum(change)[:-1] > 0
            kept = text[~gone].tobytes()
            begins = int(np.count_nonzero(gone & ~np.append(False, gone[:-1])))
            digest = hashlib.sha256(kept).hexdigest()
            rows.append((batch["key"][n].as_py(), len(text), int(gone.sum()), begins, digest, kept))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


def deduplicate(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes), per row.

    Texts are UTF-8 bytes, null is empty; strings never cross rows. Earlier is a smaller doc_id,
    or an earlier place in the row. Rows that share an id count in the order of their text, rows
    without id come last; equal rows after the first are removed (from ``LENGTH`` bytes on).
    ``kept`` may end inside a character. The texts are written once, bucketed, so the three
    joins with them don't move them again.
    """
    scratch = Scratch(documents.sparkSession, "suffix-dedup")
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed, id_is_key = with_key(source, "doc_id", "text", scratch)
    keyed = keyed.withColumnRenamed(KEY, "key")
    pairs = keyed.select("key", "text")

    packed = pairs.mapInArrow(_packed, "key long, packed binary")
    texts = scratch.bucketed(packed, "texts", "key")

    runs = pairs.mapInArrow(_find_runs, "to long, anchor long, key long, run long, known boolean")
    repeated = scratch.store(
        runs.repartition("to")
        .sortWithinPartitions("anchor")
        .mapInArrow(_repeated, "anchor long, key long, run long"),
        "repeated",
    )
    by_text = repeated.groupBy("key").agg(F.collect_list(F.struct("anchor", "run")).alias("runs"))
    named = scratch.store(
        texts.join(by_text, "key")
        .select("key", "packed", "runs")
        .mapInArrow(_name_runs, "anchor long, content long, key long, start long, strings long"),
        "named",
    )
    firsts = scratch.store(
        named.groupBy("anchor", "content", "strings").agg(F.min(F.struct("key", "start")).alias("first")),
        "firsts",
    )
    copies = (
        named.join(firsts.select("anchor", "content", "strings", "first"), ["anchor", "content", "strings"])
        .where(F.struct("key", "start") != F.col("first"))
        .select("key", "start", "strings")
    )
    several = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    splits = F.ceil(F.col("n") / TOGETHER).cast("int")
    differing = (
        firsts.join(several, "anchor")
        .withColumn("splits", splits)
        .withColumn("split", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
        .select("first.key", F.struct("anchor", "split", "splits", F.col("first.start").alias("start"), "strings").alias("r"))
        .groupBy("key")
        .agg(F.collect_list("r").alias("runs"))
    )
    cut = (
        texts.join(differing, "key")
        .select("key", "packed", "runs")
        .mapInArrow(_cut_runs, "anchor long, split int, splits int, key long, start long, bytes binary")
    )
    earlier = (
        cut.repartition("anchor", "split")
        .sortWithinPartitions("anchor", "split", "key", "start")
        .mapInArrow(_scan, "key long, start long")
        .select("key", "start", F.lit(1).cast("long").alias("strings"))
    )
    spans = scratch.store(copies.unionByName(earlier), "spans")
    by_key = spans.groupBy("key").agg(F.collect_list(F.struct("start", "strings")).alias("spans"))
    result = (
        texts.join(by_key, "key", "left")
        .select("key", "packed", "spans")
        .mapInArrow(
            _removed,
            "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
        )
    )
    if id_is_key:
        return result.withColumnRenamed("key", "doc_id")
    return keyed.select("doc_id", "key").join(result, "key").drop("key")

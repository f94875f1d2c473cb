"""Exact top-k inner products on a bit-sliced index.

Rows are kept in blocks. A block holds one bitmap per bit of each quantised component
(a slice), over rows sorted by id. A query adds the slices, shifted by the bits of its own
components, in carry-save bitmap arithmetic; the sum is the score, again as slices. From the
most significant slice downward rows are taken as long as they fit into k, the others stay
only while they tie. What still ties at the end is taken by the smaller id.

Slices have no width of their own, so components of any size are added in the same way; only
their weights and the scores of the winners are then Python integers. Rows with such components
have blocks of their own, so that a few of them don't widen the others.

The blocks stay where they are written. Queries go to them in waves of bounded size, by
broadcast; a task keeps the k best per query of all its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from perimeter.llm.shared import Scratch

SCALE = 256
K = 5
# Components of a block (rows x dimensions), and of the queries of a wave.
BLOCK_CELLS, WAVE_CELLS = 1 << 18, 1 << 21
# Components beyond it, or whose products could leave 64 bits, are wide.
MAX_COMPONENT = 1 << 28

INDEX_SCHEMA = (
    "dim int, wide boolean, block int, ids array<long>, rows binary, slices binary, lows array<string>, bits array<int>"
)
# Scores that leave 64 bits have none; ``beyond`` says on which side, ``digits`` orders them.
HIT_SCHEMA = "query_row long, query_id long, vec_id long, score long, beyond int, digits string"


def quantised(vectors: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """vec_id, row, dim, wide, q (array<int>, floor of scale times the component) or x, per row.

    Vectors that are null or hold a null or non-finite component take no part; all others do, ids
    missing or repeated. Wide vectors have their components as doubles in ``x`` instead of ``q``.
    ``row`` tells rows apart as long as the result is stored.
    """
    cells = F.transform(F.col(vector), lambda x: x.cast("double"))
    # A comparison with null or NaN isn't true here, so those components fail the test.
    finite = F.forall("x", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    most = F.least(F.lit(float(MAX_COMPONENT)), F.sqrt(F.lit(2.0**62) / F.greatest("dim", F.lit(1)))) - 1
    narrow = F.forall("x", lambda x: F.abs(x * scale) < most)
    return (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), cells.alias("x"))
        .where(F.col("x").isNotNull() & finite)
        .withColumn("dim", F.size("x"))
        .withColumn("wide", ~narrow)
        .select(
            "vec_id",
            F.monotonically_increasing_id().alias("row"),
            "dim",
            "wide",
            F.when(~F.col("wide"), F.transform("x", lambda x: F.floor(x * scale).cast("int"))).alias("q"),
            F.when(F.col("wide"), F.col("x")).alias("x"),
        )
    )


def whole(component: float, scale: int) -> int:
    """floor(scale * component), exactly."""
    return floor(component * scale) if abs(component) < 1 << 52 else int(component) * scale


def _matrix(rows: pa.Table | pa.RecordBatch, dim: int, wide: bool, scale: int) -> np.ndarray:
    """Rows x dimensions: 64-bit integers, or Python integers where components are wide."""
    column = rows["x" if wide else "q"]
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    if not wide:
        return np.asarray(flat, dtype=np.int64).reshape(rows.num_rows, dim)
    return np.array([whole(x, scale) for x in flat.to_pylist()], object).reshape(rows.num_rows, dim)


def _building(scale: int):
    def build(rows: pa.Table) -> pa.Table:
        dim, wide = rows["dim"][0].as_py(), rows["wide"][0].as_py()
        order = pa.compute.sort_indices(rows, [("vec_id", "ascending"), ("row", "ascending")], null_placement="at_end")
        rows = rows.take(order)
        values = _matrix(rows, dim, wide, scale)
        lows = values.min(axis=0)
        above = (values - lows).T
        bits = [int(max(row)).bit_length() for row in above]
        width = -(-len(values) // 64) * 8
        slices = np.zeros((sum(bits), width), np.uint8)
        at = 0
        for row, count in zip(above, bits, strict=True):
            for bit in range(count):
                packed = np.packbits(((row >> bit) & 1).astype(np.uint8), bitorder="little")
                slices[at, : len(packed)] = packed
                at += 1
        return pa.table(
            {
                "dim": rows["dim"][:1],
                "wide": rows["wide"][:1],
                "block": rows["block"][:1],
                "ids": pa.array([rows["vec_id"].to_pylist()], pa.list_(pa.int64())),
                "rows": [rows["row"].to_numpy().tobytes()],
                "slices": [slices.tobytes()],
                "lows": pa.array([[str(low) for low in lows]], pa.list_(pa.string())),
                "bits": pa.array([bits], pa.list_(pa.int32())),
            }
        )

    return build


class _Block:
    """One block of the index, ready for queries."""

    def __init__(self, ids: pa.Array, rows: bytes, slices: bytes, lows: list[str], bits: list[int], wide: bool) -> None:
        self.ids, self.rows = ids, np.frombuffer(rows, np.int64)
        self.by_row = np.argsort(self.rows)
        self.wide, kind = wide, object if wide else np.int64
        self.lows = np.array([int(low) for low in lows], kind)
        self.tops = np.array([(1 << bit) - 1 for bit in bits], kind)
        words = -(-len(self.rows) // 64)
        plain = np.frombuffer(slices, np.uint64).reshape(-1, words)
        self.valid = np.zeros(words * 8, np.uint8)
        packed = np.packbits(np.ones(len(self.rows), np.uint8), bitorder="little")
        self.valid[: len(packed)] = packed
        self.valid = self.valid.view(np.uint64)
        # Negative weights count the complement; its constant is taken off afterwards.
        self.planes = np.concatenate([plain, ~plain & self.valid])
        self.count = len(plain)
        self.of_dim = np.repeat(np.arange(len(bits)), bits)
        self.of_bit = np.concatenate([np.arange(b) for b in bits]) if self.count else np.zeros(0, int)

    def _sum(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the score less a constant, and the constant."""
        size = np.abs(query)
        base = int(sum(query * self.lows)) - int(sum((size * self.tops)[query < 0]))
        weights = size[self.of_dim]
        rows = np.arange(self.count) + np.where(query[self.of_dim] < 0, self.count, 0)
        parts, places = [], []
        for bit in range(int(max(size, default=0)).bit_length()):
            chosen = ((weights >> bit) & 1).astype(bool)
            parts.append(rows[chosen])
            places.append(self.of_bit[chosen] + bit)
        if not parts or not sum(map(len, parts)):
            return [], base
        part, place = np.concatenate(parts), np.concatenate(places)
        columns = [self.planes[part[place == w]] for w in range(int(place.max()) + 1)]
        sums, w = [], 0
        while w < len(columns):
            column = columns[w]
            carried = []
            while len(column) > 1:
                third = max(len(column) // 3, 1)
                a, b = column[:third], column[third : 2 * third]
                c, rest = column[2 * third : 3 * third], column[3 * third :]
                either = a ^ b
                if len(c):
                    carried.append((a & b) | (either & c))
                    either = either ^ c
                else:
                    carried.append(a & b)
                column = np.concatenate([either, rest]) if len(rest) else either
            if carried:
                more = np.concatenate(carried)
                if w + 1 < len(columns):
                    columns[w + 1] = np.concatenate([columns[w + 1], more])
                else:
                    columns.append(more)
            sums.append(column[0] if len(column) else np.zeros_like(self.valid))
            w += 1
        return sums, base

    def best(self, query_row: int, query: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
        """Places of the k best rows but the query's own, and their scores."""
        if self.wide:
            query = query.astype(object)
        sums, base = self._sum(query)
        ties = self.valid.copy()
        at = int(np.searchsorted(self.rows, query_row, sorter=self.by_row))
        if at < len(self.rows) and self.rows[self.by_row[at]] == query_row:
            own = int(self.by_row[at])
            ties[own >> 6] &= ~np.uint64(1 << (own & 63))
        sure = np.zeros_like(ties)
        for plane in reversed(sums):
            upper = ties & plane
            found = int(np.bitwise_count(sure | upper).sum())
            if found > k:
                ties = upper
            else:
                sure |= upper
                ties &= ~plane
                if found == k:
                    break
        rows = _set_bits(sure)
        if len(rows) < k:
            rows = np.concatenate([rows, _set_bits(ties)[: k - len(rows)]])
        scores = [base] * len(rows)
        for w, plane in enumerate(sums):
            bits = (plane[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
            scores = [score + (int(bit) << w) for score, bit in zip(scores, bits, strict=True)]
        return rows, scores


def _set_bits(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


@dataclass(frozen=True)
class Wave:
    """Queries of one vector length: rows, ids and components."""

    rows: list[int]
    ids: list[int]
    values: list[np.ndarray]


def _ordered(score: int) -> tuple[int | None, int, str | None]:
    """score, beyond, digits: as a long, or as text that sorts like the number."""
    if -(1 << 63) <= score < 1 << 63:
        return score, 0, None
    text = f"{len(str(abs(score))):05d}{abs(score)}"
    if score > 0:
        return None, 1, text
    return None, -1, text.translate(str.maketrans("0123456789", "9876543210"))


def _searching(shared: Broadcast, k: int):
    """The k best rows of the task's blocks for each query of the wave."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waves: dict[int, Wave] = shared.value
        best: dict[tuple[int, int], list[tuple]] = {}
        for batch in batches:
            for n in range(batch.num_rows):
                dim = batch["dim"][n].as_py()
                if dim not in waves:
                    continue
                wave = waves[dim]
                parts = (batch[c][n].as_py() for c in ("rows", "slices", "lows", "bits", "wide"))
                block = _Block(batch["ids"][n].values, *parts)
                for at, (row, query) in enumerate(zip(wave.rows, wave.values, strict=True)):
                    places, scores = block.best(row, query, k)
                    ids = block.ids.take(pa.array(places)).to_pylist()
                    hits = best.get((dim, at), []) + [
                        (-score, i is None, i or 0, i) for score, i in zip(scores, ids, strict=True)
                    ]
                    best[dim, at] = sorted(hits, key=lambda h: h[:3])[:k]
        rows = [
            (waves[dim].rows[at], waves[dim].ids[at], hit[3], *_ordered(-hit[0]))
            for (dim, at), hits in best.items()
            for hit in hits
        ]
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = [field.split()[0] for field in HIT_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    return search


def _numbered(rows: DataFrame, scratch: Scratch, scale: int) -> DataFrame:
    """The index: rows dealt into blocks, each built in a task of its own and written."""
    # One row per vector length, at most two.
    counts = rows.groupBy("dim", "wide").count().orderBy("dim", "wide").collect()
    block, first = F.lit(0).cast("long"), 0
    for r in counts:
        number = max(1, -(-r["count"] // max(64, BLOCK_CELLS // max(r["dim"], 1))))
        here = (F.col("dim") == r["dim"]) & (F.col("wide") == r["wide"])
        block = F.when(here, F.lit(first) + F.pmod(F.xxhash64("row"), F.lit(number))).otherwise(block)
        first += number
    dealt = rows.withColumn("block", block.cast("int")).repartitionById(max(first, 1), F.col("block"))
    return scratch.store(dealt.groupBy("block").applyInArrow(_building(scale), INDEX_SCHEMA), "index")


def _wave(asked: DataFrame, scale: int) -> dict[int, Wave]:
    """The queries of one wave by vector length; their number is bounded."""
    table = asked.orderBy("dim", "row").toArrow()
    found: dict[int, Wave] = {}
    for dim in sorted(set(table["dim"].to_pylist())):
        wave = found.setdefault(dim, Wave([], [], []))
        for wide in (False, True):
            chosen = pa.compute.and_(pa.compute.equal(table["dim"], dim), pa.compute.equal(table["wide"], wide))
            rows = table.filter(chosen)
            wave.rows.extend(rows["row"].to_pylist())
            wave.ids.extend(rows["vec_id"].to_pylist())
            wave.values.extend(_matrix(rows, dim, wide, scale))
    return found


def search(
    vectors: DataFrame,
    queries: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for each row that meets ``queries``.

    ``queries`` is a condition on vec_id. Vectors are compared with those of their length. A
    query's own row is no candidate, all others are: rows of the same id, rows without id (after
    all others in a tie), and components of any finite size. A query without candidates has no
    rows; of a repeated id each row is a query. A score that leaves 64 bits ranks by its exact
    value and is null. Blocks and waves hold a bounded number of components, so memory doesn't
    depend on the table. See ``quantised`` for rows that take no part.
    """
    scratch = Scratch(vectors.sparkSession, "topk")
    rows = scratch.store(quantised(vectors, vec_id, vector, scale), "quantised")
    asked = rows.where(queries & F.col("vec_id").isNotNull())
    cells = asked.agg(F.sum(F.greatest("dim", F.lit(1)).cast("long"))).first()[0] or 0
    waves = -(-cells // WAVE_CELLS)
    found = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not waves:
        return found
    index = _numbered(rows, scratch, scale)
    best_first = [F.desc("beyond"), F.desc("score"), F.desc("digits"), F.asc_nulls_last("vec_id")]
    order = W.partitionBy("query_row").orderBy(*best_first)
    for number in range(waves):
        wave = _wave(asked.where(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(waves)) == number), scale)
        shared = vectors.sparkSession.sparkContext.broadcast(wave)
        hits = index.mapInArrow(_searching(shared, k), HIT_SCHEMA)
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked = ranked.select("query_id", "rank", "vec_id", "score")
        # Written, so that the queries of a wave aren't held longer than it takes.
        found = found.unionByName(scratch.store(ranked, "hits") if waves > 1 else ranked)
    return found

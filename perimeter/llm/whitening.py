"""Embedding whitening from an exact scatter by bit-sliced cross-products.

Components are fixed-point integers. Rows are packed dimension by dimension: less the smallest
value of its chunk, a dimension becomes bit planes, each with one bit per row in 64-bit words. The
product sum of two dimensions is the sum over pairs of planes of the number of rows that have
both bits (AND, then popcount), weighted by the planes' places. These sums are integers, so
adding them up over tasks in any order gives the same exact scatter, which is centred in
integers too (n * sum of products - product of sums) before it becomes a float for ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimeter.llm.shared import Scratch

SCALE = 64
COMPONENTS = 16
# Components (rows x dimensions) that are packed at once.
CHUNK_CELLS = 1 << 21
# Fixed-point values stay within it; what lies beyond counts as the limit.
LIMIT = (1 << 62) - 1
# Sums travel as signed digits of so many bits, so they are exact at any size.
DIGIT, DIGITS = 40, 5
_SUMS = "dim int, i int, j int, " + ", ".join(f"d{n} long" for n in range(DIGITS))


@dataclass(frozen=True)
class Fit:
    """What rows of one length are projected with. ``sums`` are exact, of the fixed-point values."""

    count: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.values)


def fixed_point(vectors: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """vec_id and x: floor(scale * component), array<long>. Rows with null or non-finite entries go.

    The offset that makes values positive is left out: deviations and covariances don't see it.
    """
    cells = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.forall(cells, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    bounded = lambda c: F.greatest(F.least(F.floor(c * scale), F.lit(LIMIT)), F.lit(-LIMIT))
    return vectors.where(F.col(vector).isNotNull() & finite).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(cells, bounded).alias("x")
    )


def bit_planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes (words of 64 rows each), the place of each, and where each dimension's planes begin.

    ``values`` are rows x dimensions, not negative. Every dimension has at least one plane.
    """
    places = [max(int(top).bit_length(), 1) for top in values.max(axis=0, initial=0)]
    words = -(-len(values) // 64)
    planes = np.zeros((sum(places), words * 8), np.uint8)
    at = 0
    for column, bits in zip(values.T, places, strict=True):
        for bit in range(bits):
            packed = np.packbits((column >> bit) & 1 == 1, bitorder="little")
            planes[at, : len(packed)] = packed
            at += 1
    place = np.concatenate([np.arange(b) for b in places])
    return planes.view(np.uint64), place, np.cumsum([0, *places[:-1]])


def _weighted(counts: np.ndarray, rows: np.ndarray, columns: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Numbers of rows per pair of planes, at these places, to one exact sum per dimension."""
    most = int(rows.max()) + int(columns.max()) + int(counts.max(initial=0)).bit_length()
    kind = np.int64 if most + 2 * len(columns).bit_length() < 62 else object
    across = np.array([1 << int(p) for p in columns], kind)
    down = np.array([[1 << int(p)] for p in rows], kind)
    return (np.add.reduceat(counts.astype(kind) * across, starts, axis=1) * down).sum(axis=0).astype(object)


def scatter(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums per dimension and product sums per pair, as Python integers."""
    low = values.min(axis=0)
    planes, place, starts = bit_planes(values - low)
    alone = np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
    sums = _weighted(alone[None, :], np.zeros(1, int), place, starts)
    products = np.zeros((len(starts), len(starts)), object)
    for i, start in enumerate(starts):
        end = starts[i + 1] if i + 1 < len(starts) else len(planes)
        rest = planes[start:]
        both = np.stack([np.bitwise_count(rest & plane).sum(axis=1, dtype=np.int64) for plane in planes[start:end]])
        products[i, i:] = _weighted(both, place[start:end], place[start:], starts[i:] - start)
        products[i:, i] = products[i, i:]
    low, rows = low.astype(object), len(values)
    products = products + np.outer(low, sums) + np.outer(sums, low) + rows * np.outer(low, low)
    return sums + rows * low, products


def _by_length(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of equal length with their values as a matrix; rows without components are left out."""
    for batch in batches:
        lengths = np.diff(batch[column].offsets.to_numpy())
        for dim in np.unique(lengths[lengths > 0]):
            rows = batch if (lengths == dim).all() else batch.filter(pa.array(lengths == dim))
            step = max(64, CHUNK_CELLS // int(dim))
            for at in range(0, rows.num_rows, step):
                part = rows.slice(at, step)
                yield part, part[column].flatten().to_numpy().reshape(part.num_rows, dim)


def _digits(value: int) -> list[int]:
    sign, rest = (1, value) if value >= 0 else (-1, -value)
    found = []
    for _ in range(DIGITS - 1):
        found.append(sign * (rest & ((1 << DIGIT) - 1)))
        rest >>= DIGIT
    return [*found, sign * rest]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of all rows of a task and one length: their number (-1, -1), sums (i, -1), products (i, j >= i)."""
    held: dict[int, list] = {}
    pending: dict[int, list[np.ndarray]] = {}

    def add(dim: int) -> None:
        values = np.concatenate(pending.pop(dim))
        sums, products = scatter(values)
        now = held.setdefault(dim, [0, 0, 0])
        held[dim] = [now[0] + len(values), now[1] + sums, now[2] + products]

    for _, values in _by_length(batches, "x"):
        dim = values.shape[1]
        pending.setdefault(dim, []).append(values)
        if sum(map(len, pending[dim])) * dim >= CHUNK_CELLS:
            add(dim)
    for dim in list(pending):
        add(dim)
    for dim, (rows, sums, products) in held.items():
        entries = [(-1, -1, rows), *((i, -1, s) for i, s in enumerate(sums))]
        entries += [(i, j, products[i, j]) for i in range(dim) for j in range(i, dim)]
        lists = zip(*((dim, i, j, *_digits(int(v))) for i, j, v in entries), strict=True)
        kinds = [pa.int32()] * 3 + [pa.int64()] * DIGITS
        names = ["dim", "i", "j", *(f"d{n}" for n in range(DIGITS))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(lists, kinds, strict=True)], names)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Per vector length the components of the covariance of ``x``, from one pass over the rows.

    The driver gets one row per pair of dimensions and finds the eigenvectors; that grows with
    the square of the length, not with the rows.
    """
    digits = [F.sum(f"d{n}").alias(f"d{n}") for n in range(DIGITS)]
    summed = distinct.mapInArrow(_summed, _SUMS).groupBy("dim", "i", "j").agg(*digits)
    found: dict[int, dict[tuple[int, int], int]] = {}
    for row in summed.collect():
        value = sum(row[f"d{n}"] << (DIGIT * n) for n in range(DIGITS))
        found.setdefault(row["dim"], {})[row["i"], row["j"]] = value
    return {dim: _fitted(dim, entries, components) for dim, entries in found.items()}


def _fitted(dim: int, entries: dict[tuple[int, int], int], components: int) -> Fit:
    count = entries[-1, -1]
    sums = [entries[i, -1] for i in range(dim)]
    covariance = np.zeros((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            # Division of integers is rounded once, so nothing is lost before.
            covariance[i, j] = covariance[j, i] = (count * entries[i, j] - sums[i] * sums[j]) / (count * count)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[: min(components, dim)]
    return Fit(count, sums, vectors[:, order], values[order], float(np.trace(covariance)))


def _scales(fitted: Fit) -> np.ndarray:
    """Square roots of the eigenvalues; NaN where a component has no variance but rounding."""
    least = len(fitted.sums) * np.finfo(float).eps * max(float(fitted.values.max()), 0.0)
    spread = fitted.values > least
    return np.where(spread, np.sqrt(np.where(spread, fitted.values, 1.0)), np.nan)


def project(values: np.ndarray, fitted: Fit) -> np.ndarray:
    """Rows x components, with variance one over the fit list."""
    whole = np.array([s // fitted.count for s in fitted.sums], np.int64)
    part = np.array([(s % fitted.count) / fitted.count for s in fitted.sums])
    return ((values - whole) - part) @ fitted.vectors / _scales(fitted)


def deviations(values: np.ndarray, fitted: Fit) -> list[int]:
    """Per row the exact sum over dimensions of (n * x - S)^2."""
    most = fitted.count * int(np.abs(values).max(initial=0)) + max(map(abs, fitted.sums))
    kind = np.int64 if len(fitted.sums) * most * most < 1 << 62 else object
    apart = values.astype(kind) * fitted.count - np.array(fitted.sums, kind)
    return (apart * apart).sum(axis=1).tolist()


def _products(fits: dict[int, Fit]):
    """Sums and product sums of the whitened rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, values in _by_length(batches, "x"):
            dim = values.shape[1]
            white = np.column_stack([np.ones(len(values)), project(values, fits[dim])])
            held[dim] = held.get(dim, 0) + white.T @ white
        for dim, sums in held.items():
            i, j = np.triu_indices(len(sums))
            columns = [np.full(len(i), dim, np.int32), i.astype(np.int32), j.astype(np.int32), sums[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dim", "i", "j", "value"])

    return run


def identity_errors(distinct: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Per length the largest entry of the whitened covariance less the identity.

    Components without variance are left out; without any other, there is no error.
    """
    rows = distinct.mapInArrow(_products(fits), "dim int, i int, j int, value double")
    found = {(r["dim"], r["i"], r["j"]): r["v"] for r in rows.groupBy("dim", "i", "j").agg(F.sum("value").alias("v")).collect()}
    errors = {}
    for dim, fitted in fits.items():
        whole = np.flatnonzero(~np.isnan(_scales(fitted))) + 1
        means = {i: found[dim, 0, i] / fitted.count for i in whole}
        errors[dim] = max(
            (
                abs(found[dim, i, j] / fitted.count - means[i] * means[j] - (i == j))
                for i in whole
                for j in whole
                if i <= j
            ),
            default=0.0,
        )
    return errors


_ROWS = "vec_id long, component int, n long, deviation string, whitened double, explained double, identity_error double"


def _whitened(fits: dict[int, Fit], errors: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values in _by_length(batches, "x"):
            fitted = fits[values.shape[1]]
            width, n = fitted.width, len(values)
            white = project(values, fitted).ravel()
            explained = fitted.values / fitted.trace if fitted.trace > 0 else np.full(width, np.nan)
            ids = rows["vec_id"].take(pa.array(np.repeat(np.arange(n), width)))
            deviation = pa.array([str(d) for d in deviations(values, fitted)])
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), n)),
                pa.array(np.full(n * width, fitted.count)),
                deviation.take(pa.array(np.repeat(np.arange(n), width))),
                pa.array(white, mask=np.isnan(white)),
                pa.array(np.tile(explained, n), mask=np.isnan(np.tile(explained, n))),
                pa.array(np.full(n * width, errors[values.shape[1]])),
            ]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _ROWS.split(", ")])

    return run


def whiten(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per row and component.

    The fit list holds each distinct fixed-point vector once, so copies don't weigh; all rows are
    projected, repeated and null ids too. Rows that are null or hold null or non-finite entries
    are dropped. Vectors of each length are a list of their own, those without components have no
    rows. A component without variance (one distinct vector, or dependent dimensions) has no
    whitened value; ``explained`` is null where nothing varies. Components beyond 2^62 after
    scaling count as that limit. ``deviation`` is a decimal(38,0), null if it has more digits.
    """
    scratch = Scratch(vectors.sparkSession, "whitening")
    rows = fixed_point(vectors, vec_id, vector, scale)
    distinct = scratch.store(rows.select("x").distinct(), "distinct")
    fits = fit(distinct, components)
    errors = identity_errors(distinct, fits)
    exact = F.col("deviation").try_cast("decimal(38,0)")
    return rows.mapInArrow(_whitened(fits, errors), _ROWS).withColumn("deviation", exact)

"""Bit-sliced top-k against plain sums, recall included."""

from __future__ import annotations

import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from perimeter.llm import topk

SCHEMA = "vec_id long, embedding array<float>, slices string"


def _brute(rows, k=5, every=50):
    vectors = [
        (vec_id, [math.floor(256 * x) for x in vector])
        for vec_id, vector, *_ in rows
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    found = Counter()
    for row, (query_id, q) in enumerate(vectors):
        if query_id is None or query_id % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, v, strict=True)), vec_id is None, vec_id or 0, vec_id)
            for other, (vec_id, v) in enumerate(vectors)
            if other != row and len(v) == len(q)
        )
        for n, (score, _, _, vec_id) in enumerate(scored[:k]):
            found[query_id, n + 1, vec_id, -score if abs(score) < 1 << 63 else None] += 1
    return found


def _search(spark, rows, every=50, schema=SCHEMA):
    frame = spark.createDataFrame(rows, schema).repartition(4)
    found = topk.search(frame, F.col("vec_id") % every == 0)
    return Counter(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("cells", [1 << 21, 640])
def test_equals_brute_force(spark, monkeypatch, cells):
    """Also with blocks of few rows; a third of the vectors are equal."""
    monkeypatch.setattr(topk, "BLOCK_CELLS", cells)
    monkeypatch.setattr(topk, "WAVE_CELLS", cells // 10)
    rng = random.Random(1)
    # Halves and quarters are exact as float and as double.
    rows = [
        (n, [0.5] * 8 if n % 3 == 0 else [rng.randrange(-64, 64) / 64 for _ in range(8)], "x")
        for n in range(-200, 600)
    ]
    assert _search(spark, rows) == _brute(rows)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, -1.0], None),
        (0, [0.5, -1.0], None),
        (50, None, None),
        (100, [1.0, float("nan")], None),
        (150, [1.0, None], None),
        (200, [float("inf"), 1.0], None),
        (250, [1.0, 2.0, 3.0], None),
        (300, [], None),
        (350, [], None),
        (1, [0.0, 0.0], None),
        (2, [-0.001, 0.0], None),
        (3, [1e5, -1e5], None),
        (None, [1.0, 1.0], None),
    ]
    assert _search(spark, rows) == _brute(rows)


def test_no_rows_and_no_queries(spark):
    assert not _search(spark, [])
    assert not _search(spark, [(1, [1.0], None)])


def test_components_of_any_size_and_repeated_ids(spark):
    """Exact ranks where products leave 64 bits; each row of an id is a query and a candidate."""
    rng = random.Random(4)
    rows = [(n % 90, [rng.uniform(-1, 1) * 10.0 ** rng.choice((0, 0, 3, 6, 9, 15, 30)) for _ in range(3)], None) for n in range(180)]
    rows += [(100, [1e30, -1e30, 1.0], None), (100, [1e30, -1e30, 1.0], None), (7, [-1e300, 1e300, 0.0], None)]
    rows += [(150, [float(1 << 20), 3.0, 2.0], None), (8, [float(1 << 21), 0.25, 0.0], None), (None, [1e30, -1e30, 1.0], None)]
    schema = SCHEMA.replace("float", "double")
    found = _search(spark, rows, 10, schema)
    assert found == _brute([(i, [Fraction(x) for x in v]) for i, v, _ in rows], every=10)
    assert found[100, 1, 100, None] == 2

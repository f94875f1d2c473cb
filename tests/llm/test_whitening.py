from __future__ import annotations

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from perimeter.llm import registry, whitening

VECTORS = "vec_id long, embedding array<double>, label int"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(partitions)


def sound(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def plain(rows):
    """n, sums and covariance of the distinct fixed-point vectors, in fractions."""
    distinct = {tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v in rows if sound(v)}
    n, dim = len(distinct), len(next(iter(distinct)))
    sums = [sum(x[d] for x in distinct) for d in range(dim)]
    centred = [[n * x[d] - sums[d] for d in range(dim)] for x in distinct]
    covariance = [[Fraction(sum(c[i] * c[j] for c in centred), n**3) for j in range(dim)] for i in range(dim)]
    return distinct, n, sums, np.array([[float(c) for c in row] for row in covariance])


@pytest.fixture
def rows():
    random.seed(3)
    base = [random.gauss(0, 1) for _ in range(20)]
    rows = [(n, [random.gauss(0, 1 + d / 5) + b for d, b in enumerate(base)]) for n in range(300)]
    rows += [(1000 + n, rows[5][1]) for n in range(60)] + [(None, rows[6][1]), (1001, rows[8][1])]
    bad = [(2000, None), (2001, [None] * 20), (2002, [math.nan] * 20), (2003, [math.inf] + [0.0] * 19), (2004, [])]
    return rows + bad


def test_scatter_is_exact():
    rng = np.random.default_rng(1)
    for rows, dim, top in ((1, 1, 5), (63, 3, 9), (64, 2, 1), (65, 4, 1 << 20), (200, 3, 1 << 61)):
        values = rng.integers(-top, top, (rows, dim))
        sums, products = whitening.scatter(values)
        exact = values.astype(object)
        assert (sums == exact.sum(axis=0)).all() and (products == exact.T @ exact).all()


def test_digits_give_the_value_back():
    for value in (0, 1, -1, 2**170 + 12345, -(2**190), 10**30):
        assert sum(d << (whitening.DIGIT * n) for n, d in enumerate(whitening._digits(value))) == value
        assert all(abs(d) < 1 << 62 for d in whitening._digits(value))


def test_against_fractions(spark, rows):
    distinct, n, sums, covariance = plain([r for r in rows if r[1] != []])
    found = whitening.whiten(frame(spark, rows)).collect()
    values = np.linalg.eigvalsh(covariance)[::-1]
    kept = [(i, v) for i, v in rows if sound(v) and v]
    assert Counter((r["vec_id"], r["component"]) for r in found) == Counter((i, c) for i, _ in kept for c in range(1, 17))
    assert {r["n"] for r in found} == {n}
    by_id = {}
    for r in found:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
        assert abs(r["explained"] / (values[r["component"] - 1] / np.trace(covariance)) - 1) < 1e-9
        assert r["identity_error"] < 1e-9
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in kept if i not in (None, 1001)}
    for i, v in x.items():
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        assert {int(r["deviation"]) for r in by_id[i].values()} == {deviation}
    # Of the fit list the whitened covariance is the identity, and each component is an eigenvector.
    first = {tuple(v): i for i, v in x.items()}
    white = np.array([[by_id[i][c]["whitened"] for c in range(1, 17)] for i in first.values()])
    centred = np.array([[n * a - s for a, s in zip(v, sums, strict=True)] for v in first]) / n
    assert len(white) == len(distinct)
    assert np.abs(white.T @ white / n - np.eye(16)).max() < 1e-9
    for c in range(16):
        vector = np.linalg.lstsq(centred, white[:, c] * math.sqrt(values[c]), rcond=None)[0]
        assert abs(np.linalg.norm(vector) - 1) < 1e-9
        assert np.abs(covariance @ vector - values[c] * vector).max() < 1e-6 * values[0]


def test_partitions_and_copies_change_nothing(spark, rows):
    def absolute(found):
        return {(r["vec_id"], r["component"]): (r["n"], int(r["deviation"]), round(abs(r["whitened"]), 9)) for r in found.collect() if r["vec_id"] != 1001}

    few = absolute(whitening.whiten(frame(spark, rows, 1)))
    assert absolute(whitening.whiten(frame(spark, rows + [r for r in rows if r[0] != 1001] * 2, 9))) == few


def test_no_variance_and_empty(spark):
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert {(r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in same} == {(1, 0, None, None, 0.0)}
    line = whitening.whiten(frame(spark, [(n, [float(n), 2.0 * n]) for n in range(9)])).collect()
    assert {r["component"] for r in line if r["whitened"] is None} == {2}
    assert all(abs(r["explained"] - (r["component"] == 1)) < 1e-12 and r["identity_error"] < 1e-9 for r in line)


def test_lengths_are_lists_of_their_own(spark):
    short = [(n, [float(n % 3), float(n % 5)]) for n in range(15)]
    long = [(100 + n, [float(n % 2), float(n % 3), float(n % 5)]) for n in range(30)]
    found = whitening.whiten(frame(spark, short + long)).collect()
    alone = whitening.whiten(frame(spark, long)).collect()
    pick = lambda rows: {(r["vec_id"], r["component"], r["n"], int(r["deviation"]), round(abs(r["whitened"]), 9)) for r in rows if r["vec_id"] >= 100}
    assert pick(found) == pick(alone) and Counter(r["component"] for r in found if r["vec_id"] < 100) == {1: 15, 2: 15}


def test_huge_components(spark):
    rows = [(n, [1e300 * (-1) ** n, float(n), 1e17 * n]) for n in range(12)]
    found = whitening.whiten(frame(spark, rows)).collect()
    first = {r["vec_id"]: r for r in found if r["component"] == 1}
    assert len(found) == 36 and abs(abs(first[0]["whitened"]) - abs(first[2]["whitened"])) < 0.5
    x = {n: [max(-whitening.LIMIT, min(whitening.LIMIT, math.floor(64 * c))) for c in v] for n, v in rows}
    sums = [sum(v[d] for v in x.values()) for d in range(3)]
    exact = {n: sum((12 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for n, v in x.items()}
    fits = {n: int(r["deviation"]) if r["deviation"] is not None else None for n, r in first.items()}
    assert fits == {n: d if d < 10**38 else None for n, d in exact.items()}


def test_registered_query(spark, clashing, monkeypatch, rows):
    monkeypatch.setattr(registry, "read_table", lambda *_: clashing(frame(spark, rows).drop("label")))
    found = registry.op13_whiten(spark, "")
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    assert found.count() == 362 * 16

"""Components of the n-gram join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from perimeter.llm import ngram_join as J
from perimeter.llm.components import components
from perimeter.llm.shared import Scratch

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _set(text):
    words = bytes(text or "", "utf-8").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4)))


def _brute(rows):
    sets = [_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    smallest = {}
    for n, row in enumerate(rows):
        if row[0] is not None:
            smallest[root(n)] = min(smallest.get(root(n), row[0]), row[0])
    return sorted(
        ((r[0], len(s), smallest.get(root(n)) if s else r[0]) for n, (r, s) in enumerate(zip(rows, sets, strict=True))),
        key=str,
    )


def _found(frame, **options):
    rows = J.jaccard_components(frame, **options)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows.collect()), key=str)


def _words(rng, count):
    return ["".join(rng.choices(LETTERS, k=4)) for _ in range(count)]


def _edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = "".join(rng.choices(LETTERS, k=4))
    return words


def _corpus():
    """Near copies with few to many edits, copies, a passage in many texts, chains of links."""
    rng = random.Random(3)
    base, passage = _words(rng, 120), _words(rng, 30)
    texts = [_edited(rng, base, rng.randrange(0, 9)) for _ in range(60)]
    texts += [_words(rng, rng.randrange(20, 90)) + passage for _ in range(40)]
    chain = _words(rng, 100)
    for n in range(20):
        texts.append(chain[n * 3 :] + _words(random.Random(n), n * 3))
        chain = texts[-1]
    texts += [texts[0]] * 15 + [_words(rng, 3)] * 3
    rng.shuffle(texts)
    ids = rng.sample(range(10_000), len(texts))
    return [(i, " ".join(t)) for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize("tying_rounds", [0, 1])
def test_equals_all_pairs(documents, tying_rounds):
    rows = _corpus()
    assert _found(documents(rows), tying_rounds=tying_rounds) == _brute(rows)


def _prefix_rows(rng):
    """Rows sorted by gram and class: grams of one to hundreds of sets."""
    rows = set()
    for gram in range(200):
        for _ in range(rng.choice([1, 2, 3, 40, 300])):
            n = rng.randrange(10, 200)
            rows.add((gram, rng.randrange(1_000), n, rng.randrange(max(n // 5, 1)), 0))
    return sorted({(r[0], r[1]): r for r in rows}.values())


def _batches_of(rows, size):
    for at in range(0, len(rows), size):
        yield pa.RecordBatch.from_pydict(dict(zip(J.PREFIX, map(list, zip(*rows[at : at + size], strict=True)), strict=True)))


@pytest.mark.parametrize(("near", "held", "size"), [(32, 1 << 17, 10_000), (4, 50, 7), (400, 1 << 17, 64)])
def test_rows_that_can_link_go_on(monkeypatch, near, held, size):
    """No row with a partner is lost; of grams that are compared in full only such rows stay."""
    monkeypatch.setattr(J, "NEAR", near)
    monkeypatch.setattr(J, "HELD", held)
    rows = _prefix_rows(random.Random(8))
    by_gram = {}
    for row in rows:
        by_gram.setdefault(row[0], []).append(row)
    needed = {
        a
        for group in by_gram.values()
        for a in group
        if any(a != b and J._can_link(a[2], a[3], b[2], b[3], 80) for b in group)
    }
    doubled = sorted(rows + rows[::3])
    found = [r for b in J._shared(80)(_batches_of(doubled, size)) for r in zip(*(c.to_pylist() for c in b), strict=True)]
    assert needed <= set(found)
    if near == 400:
        assert sorted(found) == sorted(needed)


class _Plain:
    """An order in which every n-gram is equally common, as a broadcast value."""

    value = J.Order(np.zeros(1 << J.SKETCH_BITS, np.uint8), np.array([1.0]))


def _prefix_count(texts, percent=80):
    batch = pa.RecordBatch.from_pydict({"text": texts})
    return sum(b.num_rows for b in J._prefixes(5, percent, _Plain)(iter([batch])))


def test_sets_too_small_to_link_are_not_compared(documents):
    """Texts that share one n-gram and are too short to link give no candidates at all."""
    blank = [f"this page was left blank w{n}" for n in range(4_000)]
    assert _prefix_count(blank) == 0
    assert _prefix_count(["a b c d e f g"]) == 0 and _prefix_count(["a b c d e f g h"]) > 0
    assert _prefix_count(["a b c d e f"], percent=60) > 0
    near = [(5_000, "a b c d e f g h"), (5_001, "a b c d e f g h i"), (5_002, "this page was left blank w7")]
    rows = [*enumerate(blank), *near]
    expected = {i: i for i, _ in rows} | {5_001: 5_000, 5_002: 7}
    assert {i: c for i, _, c in _found(documents(rows))} == expected


def test_odd_rows(documents, clashing):
    long = " ".join(_words(random.Random(1), 30_000))
    rows = [(5, None), (6, ""), (7, " \n\t"), (8, "One two"), (9, "one TWO"), (10, "two one"), (11, long)]
    rows += [(12, long + " x"), (13, "ÉCOLE a b c d"), (14, "école a b c d"), (15, "a b c d e f")]
    rows += [(8, "One two"), (3, "z y x w v u"), (3, "k l m n o p"), (None, "one two"), (None, "q"), (None, None)]
    assert _found(clashing(documents(rows))) == _brute(rows)
    assert _found(documents([])) == []


def test_fragments_partition_the_order():
    classes = np.zeros(1 << J.SKETCH_BITS, np.uint8)
    classes[np.random.default_rng(2).random(len(classes)) < 0.3] = 3
    order = J.Order(classes, np.array([0.7, 0, 0, 0.3]))
    grams = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5_000, dtype=np.uint64) * np.uint64(2))
    ranked = order.rarest(grams, len(grams))
    fragments = order.fragment(ranked, 8)
    assert (np.diff(fragments) >= 0).all() and set(fragments) == set(range(8))


def test_components_of_long_paths(spark):
    edges = [(n, n + 1) for n in range(300)] + [(1_000 + n, 1_000) for n in range(50)]
    frame = spark.createDataFrame(edges, "u long, v long")
    found = {r["node"]: r["label"] for r in components(frame, Scratch(spark, "test")).collect()}
    assert found == {n: 0 for n in range(1, 301)} | {n: 1_000 for n in range(1_001, 1_050)}

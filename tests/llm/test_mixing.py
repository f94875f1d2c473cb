"""Targets and thresholds of the mix against a plain walk over sorted hashes."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from perimeter.llm import mixing


def _hash(doc_id, text):
    body = "-" if text is None else hashlib.md5(text.encode()).hexdigest()
    name = "-" if doc_id is None else str(doc_id)
    return int(hashlib.md5(f"{name}:{body}".encode()).hexdigest()[:15], 16)


def _targets(sizes):
    """Shares by weight; what is over the limit is shared again until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), dict.fromkeys(order, 0.0)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.remove(s)
    return target


def _check(rows, found):
    sizes, words = defaultdict(int), {}
    for doc_id, text, _, source in rows:
        words[_hash(doc_id, text)] = len((text or "").split())
        sizes[source] += words[_hash(doc_id, text)]
    target = _targets(sizes)
    taken = Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - target[r["source"]]) < 1e-6
        assert r["size"] == words[r["hash"]] and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = max(words.values(), default=0)
    assert all(abs(taken[s] - target[s]) <= largest / 2 + 1e-6 for s in sizes)


def _rows(count=400):
    names = ["b", "ä", "a", None, "Z"]
    return [
        (n, "w " * (n * 7 % 23), "en", names[0] if n % 3 else names[n % 5]) for n in range(count)
    ]


def test_mix(documents):
    rows = _rows()
    found = mixing.mix(documents(rows)).collect()
    assert len(found) == len(rows)
    _check(rows, found)
    again = mixing.mix(documents(rows, partitions=7)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_thresholds_of_one_bucket(documents, monkeypatch):
    """With few bits per level the boundary bucket holds many documents."""
    monkeypatch.setattr(mixing, "LEVEL_BITS", 1)
    rows = _rows(150)
    _check(rows, mixing.mix(documents(rows)).collect())


def test_odd_rows(documents, clashing):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "x " * 50_000, "en", None), (4, "y", "en", "")]
    rows += [(5, "same words", "en", "b")] * 20 + [(None, "no id", None, "b")]
    found = mixing.mix(clashing(documents(rows))).collect()
    assert len(found) == len(rows)
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    assert len({r["copies"] for r in found if r["doc_id"] == 5}) == 1


def test_documents_of_the_mix(documents, clashing):
    rows = clashing(documents(_rows(60)))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(rows).collect()}
    kept = mixing.mixed_documents(rows)
    assert kept.columns == rows.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({k: v for k, v in copies.items() if v})


def test_empty(documents):
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mixed_documents(documents([])).count() == 0

"""Removed bytes against a scan over all strings in order."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from perimeter.llm import suffix_dedup as S


def _brute(rows):
    """rows in order of id, then text; strings are judged on the input."""
    seen, found = set(), []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode())):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - S.LENGTH + 1):
            string = data[s : s + S.LENGTH]
            if string in seen:
                gone[s : s + S.LENGTH] = b"\1" * S.LENGTH
            seen.add(string)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        found.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def _found(frame):
    rows = S.deduplicate(frame).collect()
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in rows)
    return sorted(
        ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows), key=str
    )


def _text(rng, length, letters="abcdefgh ä"):
    return "".join(rng.choices(letters, k=length))


def _corpus():
    rng = random.Random(2)
    base, line = _text(rng, 900), _text(rng, 130)
    rows = [(n, _text(rng, rng.randrange(0, 500))) for n in range(40)]
    rows += [(100 + n, _text(rng, n * 9) + line + _text(rng, 50)) for n in range(40)]
    for n in range(30):
        at = rng.randrange(0, 700)
        rows.append((200 + n, _text(rng, 60) + base[at : at + rng.randrange(95, 300)] + _text(rng, 30)))
    rows += [(300 + n, base) for n in range(12)]
    rows += [(400, "ab" * 400), (401, "a" * 350), (402, line + line + line[:99]), (403, "\0" * 250), (404, base[:100])]
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(documents):
    rows = _corpus()
    assert _found(documents(rows)) == _brute(rows)


def _runs(texts):
    anchors, numbers, starts, counts = S.runs_of(texts)
    rows = sorted(zip(anchors.tolist(), numbers.tolist(), starts.tolist(), counts.tolist(), strict=True))
    return [(a, n, s, texts[n][s : s + c + S.LENGTH - 1]) for a, n, s, c in rows]


@pytest.mark.parametrize("chunk", [256, 1 << 19])
def test_runs_hold_all_strings(monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    texts = [r[1].encode() for r in _corpus()]
    found = [(n, s + k) for _, n, s, cut in _runs(texts) for k in range(len(cut) - S.LENGTH + 1)]
    assert sorted(found) == [(n, s) for n, t in enumerate(texts) for s in range(len(t) - S.LENGTH + 1)]
    of_string = {}
    for anchor, _, _, cut in _runs(texts):
        for k in range(len(cut) - S.LENGTH + 1):
            assert of_string.setdefault(cut[k : k + S.LENGTH], anchor) == anchor


@pytest.mark.parametrize(("batch", "splits"), [(4_096, 1), (5, 1), (5, 3)])
def test_scan_of_small_batches(monkeypatch, batch, splits):
    """Many batches and levels, and anchors split over tasks by their strings."""
    monkeypatch.setattr(S, "BATCH", batch)
    texts = [r[1].encode() for r in sorted(_corpus()) if r[1]]
    seen, expected = set(), set()
    for n, text in enumerate(texts):
        for s in range(len(text) - S.LENGTH + 1):
            string = text[s : s + S.LENGTH]
            if string in seen:
                expected.add((n, s))
            seen.add(string)
    found = []
    for split in range(splits):
        names = ["anchor", "split", "splits", "key", "start", "bytes"]
        rows = [(a, split, splits, n, s, cut) for a, n, s, cut in _runs(texts)]
        table = pa.table(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))
        for out in S._scan(iter(table.to_batches(max_chunksize=11))):
            found += zip(out["key"].to_pylist(), out["start"].to_pylist(), strict=True)
    assert len(found) == len(set(found)) and set(found) == expected


def test_odd_rows(documents, clashing):
    text = _text(random.Random(5), 300)
    rows = [(1, None), (2, ""), (3, text), (3, text), (3, text[:200]), (None, text), (None, text + "x"), (None, None)]
    rows += [(-4, text[50:260]), (9, _text(random.Random(6), 60_000)), (10, "é" * 80)]
    assert _found(clashing(documents(rows))) == _brute(rows)
    assert _found(documents([])) == []


def test_levels_merge_geometrically():
    levels, rng = S.Levels(), np.random.default_rng(1)
    everything = np.zeros(0, "S4")
    for _ in range(32):
        fresh = np.unique(rng.integers(98, 122, (50, 4), np.uint8).view("S4").ravel())
        assert (levels.known(fresh) == np.isin(fresh, everything)).all()
        fresh = fresh[~levels.known(fresh)]
        levels.add(fresh)
        everything = np.union1d(everything, fresh)
        sizes = [len(level) for level in levels.levels]
        assert sizes == sorted(sizes, reverse=True) and len(sizes) <= 8
    assert sum(len(level) for level in levels.levels) == len(everything)
